"""Plans of queries that made or read the same thing several times."""

from tokenmill.operators import render as RD
from tokenmill.plans.registry import load_all

from conftest import SF_SMALL

QUERIES, _ = load_all()


def test_texts_of_a_conversation_get_ids_once(spark):
    turn = "struct<role: string, content: string>"
    rows = [(1, [("user", "hi"), ("assistant", "yes")]), (2, [("user", "alone")]), (3, [("assistant", "x"), ("user", "y")])]
    convs = spark.createDataFrame(rows, f"conv_id long, messages array<{turn}>").repartition(1)
    r = RD.render_conversations(convs)
    kept = RD.drop_unusable_examples(r.filter("reason is null"))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ISO-8859-1") == 2  # utf8_byte_ids names its text for the length and for the split
    assert [x.conv_id for x in kept.collect()] == [1] and kept.columns == r.columns
    assert {x.conv_id: x.reason for x in r.collect()} == {1: None, 2: None, 3: "bad_role_order"}


def test_words_are_made_of_the_texts_once(spark):
    rows = QUERIES["spelling_bee_rows"](spark, SF_SMALL)
    assert rows.inputFiles() and not any("documents.parquet" in f for f in rows.inputFiles())
