"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sizes are words. The sources, in code point order with null last, weigh 5, 2,
1 and again 5, 2, 1, ... and share the total size by weight; a target stops
at ``MAX_PASSES`` times its source's size and the excess is shared by weight
among the rest, until none is above.

The total is cut into equal blocks of ``BLOCK`` words. Sainte-Laguë gives the
blocks to the sources one by one to the highest quotient target / (2 k + 1);
what this comes to is found by a threshold search, not by handing out single
blocks. Each source is dealt into shards of about ``SHARD_DOCS`` documents by
a seeded hash, so a hot source is many shards, and the same rule gives its
blocks to its shards by their sizes: an integer quota per shard. In a shard
the documents stand in seeded order on a circle; the blocks taken are those
from a seeded start on, around the circle as often as the quota needs.

A shard takes quota * BLOCK words but never more than MAX_PASSES times its
size, so no document is taken more often than that, and a source misses its
target by BLOCK / 2 words plus BLOCK per shard at most.

Defined results: null or empty text has size 0 and takes nothing. A null
source is a source of its own, after all others. Null doc_ids and repeated
rows are rows like any other. Reruns agree: order depends on a row's id and
text alone. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.llm.scratch import LAST_ID, materialise
from tokenmill.llm.text import Words, slices

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
BLOCK = 16
SHARD_DOCS = 4096
SEED = 17


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("ord", "th", "no_source", "source")), pa.array(Words.of(part.column("text")).count)],
                                             names=["ord", "th", "no_source", "source", "size"])


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds weight by the place of a source in the order. Sorted rows get
    (task, place) numbers, and one row per task becomes the tasks' offsets."""
    task = F.shiftright("mark", 33)
    marked = materialise(sources.orderBy("no_source", "source").withColumn("mark", F.monotonically_increasing_id()), "sources")
    tasks = marked.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))  # a row per task
    offsets = tasks.select("task", F.coalesce(before, F.lit(0)).alias("offset"))
    place = F.col("offset") + F.col("mark").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    return marked.withColumn("task", task).join(offsets, "task").withColumn("weight", weight).drop("task", "offset", "mark")


def targets(sources: DataFrame) -> DataFrame:
    """Adds target to (no_source, source, source_size, weight). The share of
    a unit of weight rises until no source is above its limit; each round
    fetches four sums."""
    limit = F.col("source_size") * MAX_PASSES
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    share, full = 0.0, -1
    while True:
        at_limit = limit <= F.col("weight") * F.lit(share)
        n, used, weight = sources.agg(F.count_if(at_limit), F.sum(F.when(at_limit, limit).otherwise(0)), F.sum(F.when(at_limit, 0).otherwise(F.col("weight")))).first()
        if n == full or not weight:
            return sources.withColumn("target", F.least(limit.cast("double"), F.col("weight") * F.lit(share)))
        share, full = (total - used) / weight, n


def apportion(units: DataFrame, seats: DataFrame, group: list[str], key: list[str], weight: str, rounds: int = 5, width: int = 16) -> DataFrame:
    """Adds quota: the seats of each group (a row of ``seats``) go to its
    units by the highest quotients weight / (2 k + 1), ties to the smallest
    key.

    A unit has floor(weight / x + 1/2) quotients of x / 2 or more. ``x`` is
    enclosed from both sides, ``width`` times closer in each round, by sums
    per group; only quotients left between the bounds are ranked."""
    w = F.col(weight)
    given = lambda x: F.floor(w / x + 0.5)
    sums = units.groupBy(*group).agg(F.sum(w).cast("double").alias("w_sum"), F.max(w).cast("double").alias("w_max"), F.count("*").alias("n_units"))
    bound = seats.join(sums, group).where("w_sum > 0 and seats > 0").withColumn("lo", F.expr("w_sum / (seats + n_units)")).withColumn(
        "hi", F.expr("case when seats > n_units then least(w_sum / (seats - n_units), 2.1 * w_max) else 2.1 * w_max end"))
    bound = bound.select(*group, "seats", "lo", "hi")
    step = lambda i: F.col("lo") + (F.col("hi") - F.col("lo")) * (i / width)
    for r in range(rounds):
        counts = units.join(bound, group).groupBy(*group, "seats", "lo", "hi").agg(*(F.sum(given(step(i))).alias(f"c{i}") for i in range(1, width)))
        # the last step that still gives enough, and the next one
        enough = sum((F.when(F.col(f"c{i}") >= F.col("seats"), 1).otherwise(0) for i in range(1, width)), F.lit(0))
        edge = lambda i: F.col("lo") + (F.col("hi") - F.col("lo")) * (i / float(width))
        bound = counts.withColumn("i", enough).select(*group, "seats", edge(F.col("i")).alias("lo"), F.when(F.col("i") + 1 == width, F.col("hi")).otherwise(edge(F.col("i") + 1)).alias("hi"))
        bound = materialise(bound, "bounds")  # a row per group; keeps the plans small
    open_ = units.join(bound, group).withColumn("sure", given(F.col("hi"))).withColumn("most", given(F.col("lo")))
    left = open_.groupBy(*group, "seats").agg(F.sum("sure").alias("given")).select(*group, (F.col("seats") - F.col("given")).alias("left"))
    quotients = open_.where("most > sure").select(*group, *key, w.alias("w_"), F.explode(F.sequence("sure", F.col("most") - 1)).alias("seat_"))
    ranked = quotients.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(F.col("w_") / (2 * F.col("seat_") + 1)), *key)))
    extra = ranked.join(left, group).where("place <= left").groupBy(*group, *key).agg(F.count("*").alias("extra"))
    ids = list(dict.fromkeys([*group, *key]))
    sure = open_.select(*ids, "sure")
    return units.join(sure, ids, "left").join(extra, ids, "left").withColumn("quota", F.coalesce("sure", F.lit(0)) + F.coalesce("extra", F.lit(0))).drop("sure", "extra")


def mix(docs: DataFrame) -> DataFrame:
    """(ord, th, doc_id, size, source_size, target, taken) of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("ord"), F.xxhash64(text).alias("th"),
                       F.col("source").isNull().alias("no_source"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), text.alias("text"))
    rows = materialise(base.mapInArrow(_sizes, "ord long, th long, no_source boolean, source string, size long"), "sizes")
    name = ["no_source", "source"]
    sources = rows.groupBy(*name).agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    sources = materialise(targets(materialise(_ranked(sources), "ranked")).withColumn("all", F.lit(0)), "targets")
    whole = sources.groupBy("all").agg(F.sum("source_size").alias("s")).select("all", F.round(F.col("s") / BLOCK).cast("long").alias("seats"))
    sources = materialise(apportion(sources, whole, ["all"], name, "target").drop("all"), "quotas")

    dealt = rows.join(sources.drop("weight"), name).withColumn("shard", F.pmod(F.xxhash64("ord", "th", F.lit(SEED)), F.ceil(F.col("n_docs") / SHARD_DOCS)))
    shards = materialise(dealt.groupBy(*name, "shard").agg(F.sum("size").alias("shard_size")), "shards")
    seats = sources.select(*name, F.col("quota").alias("seats"))
    quotas = apportion(shards, seats, name, ["shard"], "shard_size")
    takes = F.least(F.col("quota") * BLOCK, F.col("shard_size") * MAX_PASSES)
    plan = materialise(quotas.where("shard_size > 0").withColumn("takes", takes).select(
        *name, "shard", "shard_size", F.floor(F.col("takes") / F.col("shard_size")).alias("passes"), (F.col("takes") % F.col("shard_size")).alias("rest"),
        F.pmod(F.xxhash64(*name, "shard", F.lit(SEED)), F.col("shard_size")).alias("begin")), "plan")
    circle = Window.partitionBy(*name, "shard").orderBy(F.xxhash64("th", "ord", F.lit(SEED)), "ord", "th").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("end", F.sum("size").over(circle)).join(plan, [*name, "shard"], "left")
    inside = lambda lo, hi: F.greatest(F.lit(0), F.least(F.col("end"), hi) - F.greatest(F.col("end") - F.col("size"), lo))
    stop = F.col("begin") + F.col("rest")
    part = inside(F.col("begin"), F.least(stop, F.col("shard_size"))) + inside(F.lit(0), stop - F.col("shard_size"))
    taken = F.coalesce(F.col("passes") * F.col("size") + part, F.lit(0))
    return placed.select("ord", "th", F.expr(f"nullif(ord, {LAST_ID}L)").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as rows of ``docs``: each document as often as the mix takes
    it, to the nearest whole number of times (half of it or more counts)."""
    times = F.floor((F.col("taken") * 2 + F.col("size")) / (2 * F.col("size"))).cast("int")
    taken = mix(docs).where("size > 0").select(F.col("ord").alias("ord_"), F.col("th").alias("th_"), times.alias("times_"))
    taken = materialise(taken.groupBy("ord_", "th_").agg(F.max("times_").alias("times_")).where("times_ > 0"), "times")
    whole = docs.select(F.struct("*").alias("row_"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("ord_"),
                        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("th_"))
    return whole.join(taken, ["ord_", "th_"]).select("row_", F.explode(F.sequence(F.lit(1), F.col("times_")))).select("row_.*")
