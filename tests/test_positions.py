"""Block prefix sums: exact, deterministic, and bounded with a hot group."""

import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tokenmill.plans.positions import global_position, prefix_sum, quantile_block


def test_prefix_sum_matches_pandas_with_hot_group(spark):
    rows = [(("hot" if i % 3 else f"g{i % 7}"), i * 3 + 1, (i * 7) % 11) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k long, v long")
    out = prefix_sum(df, ["k"], "v", ["g"], out="cb", rows_per_block=50).toPandas()
    pdf = pd.DataFrame(rows, columns=["g", "k", "v"]).sort_values(["g", "k"])
    pdf["cb"] = pdf.groupby("g")["v"].cumsum() - pdf["v"]
    m = out.merge(pdf, on=["g", "k"], suffixes=("", "_exp"))
    assert len(m) == len(rows)
    assert (m["cb"] == m["cb_exp"]).all()


def test_positions_dense_and_repeatable(spark):
    df = spark.range(0, 5000).select((F.col("id") * 13 % 5000).alias("k"), (F.col("id") % 4).alias("g"))
    a = global_position(df, ["k"], ["g"], out="p").toPandas().sort_values(["g", "k"])
    b = global_position(df.repartition(7), ["k"], ["g"], out="p").toPandas().sort_values(["g", "k"])
    assert (a["p"].values == b["p"].values).all()
    for _, grp in a.groupby("g"):
        assert list(grp["p"]) == list(range(len(grp)))


def test_composite_order(spark):
    rows = [(s, i) for s in ("b", "a", "c") for i in range(100, 0, -3)]
    df = spark.createDataFrame(rows, "s string, i long")
    out = global_position(df, ["s", "i"], (), out="p").orderBy("p").toPandas()
    exp = sorted(rows)
    assert list(zip(out["s"], out["i"])) == exp


def test_hot_shard_is_split_into_bounded_pack_groups(spark):
    from tokenmill.operators.packing import assign_pack_groups
    rows = [("hot" if i % 4 else "cold", i, 10) for i in range(4000)]
    df = spark.createDataFrame(rows, "source string, doc_id long, n_tokens long").withColumn("split", F.lit("train"))
    g = assign_pack_groups(df, ["source", "doc_id"], ["split"], group_docs=500)
    sizes = [r["count"] for r in g.groupBy("split", "pack_group").count().collect()]
    assert max(sizes) <= 500 and sum(sizes) == 4000


def test_null_groups_and_null_keys_keep_their_rows(spark):
    rows = [(g, s, i, i % 5) for g in (None, "a") for s in (None, "x") for i in range(20)]
    df = spark.createDataFrame(rows, "g string, s string, i long, v long")
    got = {(r.g, r.s, r.i): r.p for r in prefix_sum(df, ["s", "i"], "v", ["g"], out="p").collect()}
    want = {}
    for g in (None, "a"):
        total = 0
        for r in sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or "", r[2])):
            want[r[:3]], total = total, total + r[3]
    assert got == want


def _hard_keys(kind, n):
    if kind == "outlier":
        return "k long", [(i if i else 1 << 60,) for i in range(n)], ["k"]
    if kind == "common prefix":
        return "k string", [(f"https://example.org/{i:07d}",) for i in range(n)], ["k"]
    if kind == "time":
        t0 = datetime.datetime(2024, 1, 1)
        return "k timestamp_ntz", [(t0 + datetime.timedelta(milliseconds=i * i),) for i in range(n)], ["k"]
    return "s string, k long", [("hot" if i % 8 else f"cold{i % 5}", i) for i in range(n)], ["s", "k"]


@pytest.mark.parametrize("kind", ["outlier", "common prefix", "time", "hot leading key"])
def test_blocks_are_even_whatever_the_keys(spark, kind):
    n, width = 6000, 300
    schema, rows, order = _hard_keys(kind, n)
    df = spark.createDataFrame(rows, schema).repartition(7)
    block = quantile_block(df, order, width)
    sizes = {r.b: r["count"] for r in df.groupBy(block.alias("b")).count().collect()}
    assert sum(sizes.values()) == n and len(sizes) == n // width and max(sizes.values()) <= 2 * width
    assert quantile_block(df, order, n) is None
    got = prefix_sum(df, order, None, (), "p", rows_per_block=width).collect()
    assert [tuple(r)[:-1] for r in sorted(got, key=lambda r: r.p)] == sorted(rows)
    assert sorted(r.p for r in got) == list(range(n))


def test_blocks_of_null_keys_and_groups(spark):
    rows = [(g, None if i == 0 else i % 40, i) for g in (None, "a", "b") for i in range(400)]
    df = spark.createDataFrame(rows, "g string, s long, i long")
    got = {(r.g, r.s, r.i): r.p for r in prefix_sum(df, ["s", "i"], "i", ["g"], "p", rows_per_block=60).collect()}
    for g in (None, "a", "b"):
        total = 0
        for r in sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
            assert got[r] == total
            total += r[2]


def test_positions_of_no_rows(spark):
    assert global_position(spark.createDataFrame([], "k long"), ["k"]).columns == ["k", "pos"]


def test_blocks_are_dealt_to_as_many_tasks(spark):
    """Small rows may become many in the task that numbers them, so blocks are
    not put together by their bytes."""
    df = spark.range(1000).selectExpr("id as k", "1 as v")
    out = prefix_sum(df, ["k"], "v", (), out="p", rows_per_block=50)
    assert out.rdd.getNumPartitions() >= 20
    assert all(r.p == r.k for r in out.collect())
