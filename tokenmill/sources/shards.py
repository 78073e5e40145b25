"""Balanced corpus shards.

Documents in seeded order are grouped into chunks of one row group
(1024 docs); a shard is cut after the first chunk at which the characters
since the previous cut reach ``chars_per_shard`` (cuts can only fall on
chunk boundaries, so the count is always a multiple of 1024). Documents
after the last cut are not written unless ``keep_tail``.

The cut rule is a sequential fold, but it is computed without folding:

1. chunk character sums (one grouped aggregation) and their prefix sums
   ``P`` (block prefix sums, see ``plans/positions.py``);
2. for every chunk ``s`` the next start ``nxt(s)`` = smallest ``k`` with
   ``P[k] >= P[s] + chars_per_shard`` - an as-of search done by unioning
   queries and points into value blocks and taking the first point at or
   after each query (window per block, plus a small block table for
   queries whose answer lies in a later block);
3. the chain ``0, nxt(0), nxt(nxt(0)), ...`` by pointer doubling
   (``J_{j+1} = J_j o J_j``, reached set doubled per round, each round
   checkpointed), about log2(#shards) rounds of joins;
4. shard id of a chunk = number of chain starts at or before it, minus 1.

No step holds the chunk table in one task. Shard ids are joined back and
the write is ``repartition(shard)`` + ``partitionBy(shard)`` with zstd, no
dictionary and 1024-row row groups. ``cut_chunks`` is the sequential rule
(used by the tests as the reference model).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.plans.positions import global_position, prefix_sum, seeded_key

ROW_GROUP = 1024
CHARS_PER_SHARD = 250_000_000


def cut_chunks(chunk_chars: np.ndarray, chars_per_shard: int, keep_tail: bool) -> np.ndarray:
    """Shard id per chunk (-1 = tail, not written)."""
    out = np.full(len(chunk_chars), -1, dtype=np.int64)
    shard, acc, start = 0, 0, 0
    for i, c in enumerate(chunk_chars):
        acc += int(c)
        if acc >= chars_per_shard:
            out[start:i + 1] = shard
            shard, acc, start = shard + 1, 0, i + 1
    if keep_tail and start < len(chunk_chars):
        out[start:] = shard
    return out


VALUE_BLOCKS = 1 << 16


def next_starts(prefix: DataFrame, chars_per_shard: int) -> DataFrame:
    """``(chunk, nxt)`` from ``(chunk, p, chars)`` (``p`` = chars before the
    chunk): ``nxt`` = first chunk index ``k`` (1..m) with inclusive prefix
    ``P[k] >= p + chars_per_shard``; NULL when the rest never reaches it."""
    total = prefix.agg(F.max(F.col("p") + F.col("chars"))).first()[0] or 0
    width = max(1, -(-(int(total) + chars_per_shard + 1) // VALUE_BLOCKS))
    pts = prefix.select((F.col("chunk") + 1).alias("id"), (F.col("p") + F.col("chars")).alias("v"),
                        F.lit(1).alias("typ"))
    qs = prefix.select(F.col("chunk").alias("id"), (F.col("p") + F.lit(chars_per_shard)).alias("v"),
                       F.lit(0).alias("typ"))
    u = pts.unionByName(qs).withColumn("blk", F.floor(F.col("v") / width))
    w = Window.partitionBy("blk").orderBy("v", "typ", "id").rowsBetween(0, Window.unboundedFollowing)
    pt_id = F.when(F.col("typ") == 1, F.col("id"))
    inblk = u.withColumn("_hit", F.first(pt_id, ignorenulls=True).over(w)).filter(F.col("typ") == 0)
    # first point of every later non-empty block (small table: <= VALUE_BLOCKS rows)
    firsts = u.groupBy("blk").agg(F.min(pt_id).alias("_first"))
    wb = Window.orderBy("blk").rowsBetween(1, Window.unboundedFollowing)
    later = firsts.select("blk", F.first("_first", ignorenulls=True).over(wb).alias("_later"))
    j = inblk.join(later, "blk", "left")
    return j.select(F.col("id").alias("chunk"), F.coalesce("_hit", "_later").alias("nxt"))


def chain_from_zero(nxt: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Nodes ``0, nxt(0), nxt(nxt(0)), ...`` by pointer doubling."""
    jump = nxt.select(F.col("chunk").alias("s"), F.col("nxt").alias("t")).checkpoint()
    reached = nxt.sparkSession.range(1).select(F.lit(0).cast("long").alias("s")).checkpoint()
    n = 1
    for _ in range(max_rounds):
        new = reached.join(jump, "s").filter(F.col("t").isNotNull()).select(F.col("t").alias("s"))
        reached = reached.unionByName(new).distinct().checkpoint()
        m = reached.count()
        if m == n:
            return reached
        n = m
        a, b = jump.alias("a"), jump.alias("b")
        jump = a.join(b, F.col("a.t") == F.col("b.s"), "left").select(
            F.col("a.s").alias("s"), F.col("b.t").alias("t")).checkpoint()
    raise RuntimeError("chain did not converge")


def assign_shards(docs: DataFrame, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
                  chars_per_shard: int = CHARS_PER_SHARD, rows_per_group: int = ROW_GROUP,
                  keep_tail: bool = False) -> DataFrame:
    """``docs`` + ``shuffle_pos``, ``chunk`` and ``shard`` (tail rows dropped).
    Ids are unique; only they and the lengths take part until the rows are
    given their shards."""
    d = docs.select(F.col(id_col).alias("_id"), F.length(text_col).alias("_chars"))
    d = d.withColumn("_sk", seeded_key(seed, "_id"))
    d = global_position(d, ["_sk", "_id"], (), out="shuffle_pos", block=F.substring("_sk", 1, 4))
    d = d.withColumn("chunk", F.floor(F.col("shuffle_pos") / rows_per_group).cast("long"))
    sums = d.groupBy("chunk").agg(F.sum("_chars").cast("long").alias("chars"))
    d = d.join(shard_of_chunks(sums, chars_per_shard, keep_tail), "chunk")
    d = d.select("_id", "shuffle_pos", "chunk", "shard")
    return docs.join(d, F.col(id_col).eqNullSafe(F.col("_id"))).drop("_id")


def shard_of_chunks(sums: DataFrame, chars_per_shard: int, keep_tail: bool = False) -> DataFrame:
    """``(chunk, shard)`` for the written chunks of a ``(chunk, chars)`` table."""
    pre = prefix_sum(sums, ["chunk"], "chars", (), out="p").checkpoint()
    nxt = next_starts(pre, chars_per_shard).checkpoint()
    starts = chain_from_zero(nxt)
    m = sums.agg(F.max("chunk")).first()[0]
    flag = pre.select("chunk").join(starts.select(F.col("s").alias("chunk"), F.lit(1).alias("_st")), "chunk", "left")
    flag = flag.withColumn("_st", F.coalesce("_st", F.lit(0)))
    shard = prefix_sum(flag, ["chunk"], "_st", (), out="_before").withColumn(
        "shard", (F.col("_before") + F.col("_st") - 1).cast("long"))
    # the tail starts at the last chain node whose shard never completes
    tail = starts.join(nxt.select(F.col("chunk").alias("s"), "nxt"), "s").filter(F.col("nxt").isNull())
    tail_start = tail.agg(F.min("s")).first()[0]
    out = shard.select("chunk", "shard")
    if tail_start is not None and tail_start <= m and not keep_tail:
        out = out.filter(F.col("chunk") < tail_start)
    return out


def write_shards(assigned: DataFrame, path: str, cols=("text",), rows_per_group: int = ROW_GROUP) -> None:
    (assigned.repartition("shard").sortWithinPartitions("shuffle_pos")
             .select("shard", *cols)
             .write.mode("overwrite").partitionBy("shard")
             .option("compression", "zstd")
             .option("parquet.enable.dictionary", "false")
             .option("parquet.block.row.count.limit", rows_per_group)
             .parquet(path))
