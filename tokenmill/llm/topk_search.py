"""Exact top-k search by distributed histogram selection.

Vectors become integers (floor of 256 times each component), and every score
is an integer inner product. The k-th best score of a query is found without
sorting: all pairs of a query and a candidate are scored block by block, and
each block counts its scores in histograms of 2 ** BITS buckets. Spark adds
the histograms of a query up and finds the bucket that holds the k-th value.
The next round splits just that bucket, until a bucket is one score. Then the
candidates at or above their query's k-th score are kept, and ties at it go
to the smallest ids.

A block is one of ``CANDIDATES`` candidates with one of ``QUERIES`` queries:
rows are dealt to blocks by a hash of their row number, so equal or frequent
vectors don't meet, and both sides of a cell are bounded whatever the tables'
sizes. A cell sends at most ``k`` rows a query in any round: buckets below
the one where its own counts reach what is still needed cannot hold the k-th
value (exact, nothing is lost).

Defined results: vectors that are null, or hold null or non-finite values,
take no part. Vectors of other lengths are compared over the components that
both have; an empty one scores 0. Every row is a candidate of its own, and a
query row leaves out only itself, so repeated ids come out as repeated rows
and a repeated query id gives a result for each of its rows. A null id is no
query and comes last among equals. Squared lengths of 2 ** 62 or more (scores
that may not fit a long) fail the job. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.llm.scratch import LAST_ID, materialise

CANDIDATES = 4096
QUERIES = 2048
BITS = 10
STRIP = 256  # queries of a cell that are scored at a time
SCALE = 256


def _quantised(table: DataFrame, key: str, vector: str, is_query: Column) -> DataFrame:
    """(row_id, ord, v, is_query) of the rows that take part, written."""
    x = F.col(vector).cast("array<double>")
    usable = F.col(vector).isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = table.where(usable).select(
        F.coalesce(F.col(key).cast("long"), F.lit(LAST_ID)).alias("ord"), F.transform(x, lambda c: F.floor(c * SCALE)).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"))
    return materialise(rows.withColumn("row_id", F.monotonically_increasing_id()), "topk-vectors")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _strips(candidates: pa.Table, queries: pa.Table, bound: int):
    """Scores plus ``bound`` of some queries and all candidates of a cell;
    -1 where the candidate is the query's own row."""
    width = max(int(np.diff(t["v"].combine_chunks().offsets.to_numpy()).max(initial=0)) for t in (candidates, queries))
    # sums of products stay below the bound, so float64 holds them exactly
    number = np.float64 if bound < 1 << 53 else np.int64
    c, q = (_matrix(t["v"], width).astype(number) for t in (candidates, queries))
    c_ids, q_ids = candidates["row_id"].to_numpy(), queries["row_id"].to_numpy()
    by_id = np.argsort(c_ids)
    for lo in range(0, len(q), STRIP):
        score = (q[lo:lo + STRIP] @ c.T).astype(np.int64)
        score += bound
        ids = q_ids[lo:lo + STRIP]
        place = np.minimum(np.searchsorted(c_ids, ids, sorter=by_id), len(c_ids) - 1)
        own = c_ids[by_id[place]] == ids
        score[np.flatnonzero(own), by_id[place[own]]] = -1
        yield lo, score


def cell_histogram(score: np.ndarray, prefix: np.ndarray, need: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, bucket, count) of the scores in each query's bucket of the
    round before, as far down as the cell's own counts may matter."""
    buckets = 1 << BITS
    row, col = np.nonzero((score >> (shift + BITS)) == prefix[:, None])
    inside = (score[row, col] >> shift) & (buckets - 1)
    counts = np.bincount(row * buckets + inside, minlength=len(score) * buckets).reshape(len(score), buckets)
    above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
    query, bucket = np.nonzero((counts > 0) & (above < need[:, None]))
    return query, bucket, counts[query, bucket]


def _cells(rows: DataFrame, queries: DataFrame, n: int, n_queries: int):
    """Candidates and queries grouped by cell, ready for a cogroup. Each
    block goes once to every block of the other side."""
    c_blocks, q_blocks = -(-n // CANDIDATES), -(-n_queries // QUERIES)
    block = lambda k: F.pmod(F.xxhash64("row_id"), F.lit(k))
    others = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    left = rows.select("row_id", "ord", "v", block(c_blocks).alias("c"), others(q_blocks).alias("q"))
    right = queries.select("row_id", "v", "prefix", "need", block(q_blocks).alias("q"), others(c_blocks).alias("c"))
    return left.groupBy("c", "q").cogroup(right.groupBy("c", "q"))


def _refine(cells, state: DataFrame, bound: int, shift: int) -> DataFrame:
    """Each query's bucket of this round, and what is still needed in it."""
    def run(candidates, queries):
        out = [np.zeros(0, np.int64)] * 3
        if candidates.num_rows and queries.num_rows:
            prefix, need, ids = (queries[c].to_numpy() for c in ("prefix", "need", "row_id"))
            parts = [out]
            for lo, score in _strips(candidates, queries, bound):
                hi = lo + len(score)
                query, bucket, count = cell_histogram(score, prefix[lo:hi], need[lo:hi], shift)
                parts.append((ids[lo + query], bucket, count))
            out = [np.concatenate(x) for x in zip(*parts, strict=True)]
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in out], names=["row_id", "bucket", "n"])

    counts = cells.applyInArrow(run, "row_id long, bucket long, n long").groupBy("row_id", "bucket").agg(F.sum("n").alias("n"))
    down = Window.partitionBy("row_id").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    reached = (counts.withColumn("above", F.coalesce(F.sum("n").over(down), F.lit(0))).join(state, "row_id").where("above < need")
               .groupBy("row_id", "prefix", "need").agg(F.min(F.struct("bucket", "above")).alias("at")))
    return reached.select("row_id", (F.col("prefix") * (1 << BITS) + F.col("at.bucket")).alias("prefix"), (F.col("need") - F.col("at.above")).alias("need"))


def _kept(cells, bound: int) -> DataFrame:
    """Candidates above their query's k-th score, and those at it that may be
    among its smallest ids."""
    def run(candidates, queries):
        parts = [[np.zeros(0, np.int64)] * 3]
        if candidates.num_rows and queries.num_rows:
            kth, need, ids = (queries[c].to_numpy() for c in ("prefix", "need", "row_id"))
            ords = candidates["ord"].to_numpy()
            by_ord = np.argsort(ords, kind="stable")
            for lo, score in _strips(candidates, queries, bound):
                score = score[:, by_ord]
                least = kth[lo:lo + len(score), None]
                tied = score == least
                keep = (score > least) | (tied & (tied.cumsum(axis=1) <= need[lo:lo + len(score), None]))
                row, col = np.nonzero(keep)
                parts.append([ids[lo + row], ords[by_ord[col]], score[row, col] - bound])
        out = [np.concatenate(x) for x in zip(*parts, strict=True)]
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in out], names=["row_id", "ord", "score"])

    return cells.applyInArrow(run, "row_id long, ord long, score long")


def top_k(table: DataFrame, k: int, is_query: Column, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k best other rows."""
    rows = _quantised(table, key, vector, is_query)
    squares = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    n, n_queries, longest = rows.agg(F.count("*"), F.count_if("is_query"), F.max(squares)).first()
    if not n_queries:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # no score is larger than the largest squared length (with some room for rounding)
    bound = int(longest * 1.001) + 1
    if bound >= 1 << 62:
        raise ValueError("the vectors are too long: their scores may not fit a long")
    queries = materialise(rows.where("is_query"), "topk-queries")
    state = queries.select("row_id", F.lit(0).cast("long").alias("prefix"), F.lit(k).cast("long").alias("need"))
    shift = -(-(2 * bound).bit_length() // BITS) * BITS
    while shift > 0:
        shift -= BITS
        cells = _cells(rows, queries.join(state, "row_id"), n, n_queries)
        state = materialise(_refine(cells, state, bound, shift), "topk-state")
    found = _kept(_cells(rows, queries.join(state, "row_id"), n, n_queries), bound)
    best = Window.partitionBy("row_id").orderBy(F.desc("score"), "ord")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = queries.select("row_id", F.col("ord").alias("query_id"))
    return ranked.join(names, "row_id").select("query_id", F.col("rank").cast("int").alias("rank"), F.expr(f"nullif(ord, {LAST_ID}L)").alias("vec_id"), "score")
