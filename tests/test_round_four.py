"""Findings of round 4: orders without a function call per comparison."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tokenmill.operators import conversations as CV
from tokenmill.operators import packers as PR
from tokenmill.operators import packing as PK
from tokenmill.plans import positions as P
from tokenmill.plans.registry import load_all

from conftest import SF_SMALL

QUERIES, _ = load_all()


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("order", [["i"], ["s", "i"], ["x", "s", "i"], ["b", "t", "i"]])
def test_blocks_by_plain_comparisons(spark, order):
    rnd = random.Random(5)
    rows = [(i if i % 5 else None, rnd.choice([None, "", "a", "aé", "日", "Z"]), rnd.choice([None, float("nan"), -0.0, 0.0, float("-inf"), 1.5]),
             rnd.choice([None, True, False]), rnd.choice([None, b"", b"\xff", b"a"]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "i long, s string, x double, b boolean, t binary, id int").repartition(4)
    cuts, n = P._quantile_cuts(df, order, 40, 1 << 12)
    got = P._with_reached(df, order, cuts, n, "at").withColumn("want", P._reached(cuts, n, P._order_key(order)))
    rows = got.collect()
    assert n > 10 and [r.at for r in rows] == [r.want for r in rows] and len({r.at for r in rows}) > 10
    assert set(got.columns) == {*df.columns, "at", "want"}


def test_positions_are_compiled(spark):
    out = P.global_position(spark.range(1000).withColumnRenamed("id", "k"), ["k"])
    assert P.ROWS_PER_BLOCK > 1000 and [r.pos for r in out.sort("k").collect()] == list(range(1000))
    blocks = P.prefix_sum(spark.range(1000).withColumnRenamed("id", "k"), ["k"], None, (), "pos", rows_per_block=50)
    assert "lambda" not in _plan(blocks)
    assert all(r.pos == r.k for r in blocks.collect())


@pytest.mark.parametrize("width", [64, 1 << 18])
def test_seeded_order_in_blocks(spark, width):
    rows = [(t, i) for t in (0, 3, 12) for i in range(700)]
    df = spark.createDataFrame(rows, "t int, i long").repartition(5)
    out = P.seeded_position(df, 7, ["t", "i"], "p", rows_per_block=width)
    want = {r: p for p, r in enumerate(sorted(rows, key=lambda r: (hashlib.md5(f"7:{r[0]}:{r[1]}".encode()).hexdigest(), *r)))}
    assert {(r.t, r.i): r.p for r in out.collect()} == want and out.columns == ["t", "i", "p"]
    # whatever is done with it, and again
    assert {(r.t, r.i): r.p for r in out.where("p % 3 = 1").sort("i").collect()} == {r: p for r, p in want.items() if p % 3 == 1}
    assert out.agg(F.sum("p")).first()[0] == sum(range(len(rows)))
    assert P.seeded_position(df.limit(0), 7, ["t", "i"]).collect() == []


def test_recipe_rows_of_any_listing(spark):
    recipe = [CV.Part("a", 2), CV.Part("b", 2, 3), CV.Part("a", 1, 1), CV.Part("none", 4), CV.Part("c", 1, 0), CV.Part("b")]
    rows = [(t, i) for t, n in (("a", 2), ("b", 5), ("c", 2), ("other", 3), (None, 2)) for i in range(n)]
    got = CV.recipe_rows(spark.createDataFrame(rows, "task string, row_id long"), recipe)
    places = {"a": [(0, None), (1, None), (4, 1)], "b": [(2, 3), (3, 3), (10, None)], "c": [(9, 0)]}
    want = sorted((t, i, no) for t, i in rows for no, stop in places.get(t, []) if stop is None or i < stop)
    assert sorted(map(tuple, got.collect())) == want
    assert "lambda" not in _plan(got)


def test_recipe_mixture_reads_its_tables_once(spark):
    plan = QUERIES["recipe_mixture"](spark, SF_SMALL)
    files = plan.inputFiles()
    assert files and not any(f"{SF_SMALL}/" in f for f in files)
    assert "lambda" not in _plan(plan)


def test_buffered_packers_read_as_they_go():
    for packer, args in (("bestfit_crop", {"buffer_size": 20, "refill": 8}), ("bestfit_pad", {"buffer_size": 20})):
        lengths = [random.Random(i).randint(1, 40) for i in range(2000)]
        for last in (True, False):
            (d, r, dst, _, take), rest = PR.pack(packer, lengths, 25, last, **args)
            seen, left, got, placed = [0], [], [], 0

            def docs():
                for x in enumerate(lengths):
                    seen[0] += 1
                    yield x
            for k, row in enumerate(PR.packed_rows(packer, docs(), 25, last, left, **args)):
                got += [(k, *x) for x in row]
                placed += len(row)
                assert seen[0] <= placed + 20 + 8
            assert got == list(zip(*(x.tolist() for x in (r, d, dst, take)))) and left == rest.tolist()


def test_a_long_stream_is_one_group(spark):
    """45 million tokens, of which rows take few."""
    n, cap = 1500, 33
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("train").alias("split"), F.expr("sequence(0, cast(29000 + id * 7919 % 2000 as int))").alias("ids"))
    out = PK.pack_rows(df, "bestfit_crop", cap, -5, ["doc_id"], ["split"], buffer_size=1000)
    text = _plan(out)
    assert "FlatMapGroupsInArrow" not in text
    # what is shuffled: the tokens that a row can take
    assert spark.read.parquet(*out.inputFiles()).agg(F.max(F.size("_ids"))).first()[0] == cap
    d, r, dst, _, take = PR.bestfit_crop([29001 + i * 7919 % 2000 for i in range(n)], cap, 1000)
    got = {(x.pack_group, x.row_no): (x.docs, x.takes, x.tokens) for x in out.collect()}
    assert got == {(0, k): ([i], [cap], list(range(cap))) for i, k in zip(d.tolist(), r.tolist())} and len(got) == n


def test_streams_of_odd_keys(spark):
    """Null streams, equal order keys and a null key: every document once."""
    rows = [(s, k, i, [i, i + 1]) for i, (s, k) in enumerate([(s, k) for s in (None, "a", "b") for k in (None, "x", "x", "y")] * 10)]
    df = spark.createDataFrame(rows, "split string, k string, doc_id long, ids array<int>").repartition(5)
    for by, streams in ((["split"], 3), ([], 1)):
        got = PK.pack_rows(df, "bestfit_pad", 7, -5, ["k"], by, buffer_size=6).collect()
        assert sorted(d for x in got for d in x.docs) == list(range(120)) and all(x.pack_group == 0 for x in got)
        assert all(x.tokens == [t for d in x.docs for t in (d, d + 1)] + [-5] * (7 - 2 * len(x.docs)) for x in got)
        assert len(got) == streams * -(-120 // streams // 3)
