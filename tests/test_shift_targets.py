"""Shifted rows and their digests, made without a function call per token."""

import hashlib
import random

from pyspark.sql import functions as F

from tokenmill.operators import packing as PK
from tokenmill.plans.q_packing import _digest
from tokenmill.plans.registry import load_all

from conftest import SF_SMALL

QUERIES, _ = load_all()


def test_digest_of_any_list(spark):
    rnd = random.Random(4)
    lists = [None, [], [-1], [0, 255, 256, 65535], [65536, 1 << 20, (1 << 31) - 1], [-2, -1, 7]]
    lists += [[rnd.randrange(-1, 70_000) for _ in range(rnd.randrange(40))] for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(lists)), "i int, ids array<int>").coalesce(1)
    want = [None if x is None else hashlib.md5("".join("FFFF" if t < 0 else f"{t:04X}"[:4] for t in x).encode()).hexdigest() for x in lists]
    assert [r.h for r in df.where("i >= 0").select("i", _digest("ids").alias("h")).sort("i").collect()] == want


def test_targets_of_short_rows(spark):
    cap = 6
    rows = [(n, [*range(10, 10 + n), *[99] * (cap - n)], [i % 2 for i in range(n)] + [0] * (cap - n)) for n in range(cap + 1)]
    df = spark.createDataFrame(rows, "n_content int, tokens array<int>, mask array<int>")
    for mask in (None, "mask"):
        for r in PK.shift_targets(df, mask_col=mask).collect():
            assert r.inputs == r.tokens[:-1]
            assert r.targets == [t if i + 1 < r.n_content and (not mask or r.mask[i + 1]) else -1 for i, t in enumerate(r.tokens[1:])]


def test_no_call_per_token(spark):
    df = spark.createDataFrame([(3, [1, 2, 3])], "n_content int, tokens array<int>")
    plan = lambda x: x._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan(PK.shift_targets(df, mask_col=None).select(F.col("targets")))
    assert "lpad" not in plan(QUERIES["shift_targets"](spark, SF_SMALL))
