"""Exact dedup by a tree-merge of sorted digest runs.

Every partition turns its rows into one run: a row per digest with the best
identifier and the number of copies. Runs are merged in binomial rounds: the
address of a run has ``RADIX``-ary digits, and in round r each group of
``RADIX`` runs that differ only in digit r exchange slices, chosen by a digit
of the digest, and each merges the slices it gets (a multiway merge: Spark
sorts by run and digest and reduces neighbours). After the last round every
run holds one slice of the digests, wholly merged. No run ever meets all
digests, and a group of copies has shrunk to one row per run before it is
sent at all.

Equality is verified at every level: rows merge only if SHA-256, the length
and a second, independent 64-bit hash of the normalised text agree.

Defined results: null text counts as empty. Of equal texts the row with the
most code points in the original stays, then the smallest doc_id (null last);
rows that agree in all of that are repeated rows, of which the first keeps
its place. Other columns don't matter. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.scratch import LAST_ID, materialise

RADIX = 8
ROUNDS = 2  # RADIX ** ROUNDS runs
WHITE = " \t\n\x0b\x0c\r"
DIGEST = ["digest", "check", "n_norm"]


def _digests(docs: DataFrame) -> DataFrame:
    """Narrow rows: identity (ord and text_key), digests, code points."""
    text = F.coalesce(F.col("text"), F.lit(""))
    norm = F.translate(text, WHITE, "")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("ord"), F.xxhash64(text).alias("text_key"),
                       F.unhex(F.sha2(norm, 256)).alias("digest"), F.xxhash64(norm, F.lit("norm")).alias("check"),
                       F.length(norm).alias("n_norm"), F.length(text).cast("long").alias("n_points"))
    # numbered once and written, so that later reads agree on the numbers
    return materialise(rows.withColumn("row_id", F.monotonically_increasing_id()), "digests")


def merge_runs(rows: DataFrame, radix: int = RADIX, rounds: int = ROUNDS) -> DataFrame:
    """One row per digest: the best row, and the group's size."""
    # the order of keeping: most code points, smallest id, first row
    best = F.struct((-F.col("n_points")).alias("less"), "ord", "row_id")
    run = rows.select(*DIGEST, best.alias("best"), F.lit(1).cast("long").alias("group_size"),
                      F.pmod(F.spark_partition_id(), F.lit(radix ** rounds)).alias("run"))
    for r in range(rounds):
        digit = radix ** r
        slice_ = F.pmod(F.shiftright(F.col("check"), 8 * r), F.lit(radix)).cast("int")
        to = F.col("run") - F.pmod(F.floor(F.col("run") / digit), F.lit(radix)).cast("int") * digit + slice_ * digit
        run = (run.withColumn("run", to).groupBy("run", *DIGEST)
               .agg(F.min("best").alias("best"), F.sum("group_size").alias("group_size")))
    return run.select(*DIGEST, F.col("best.ord").alias("keep_ord"), F.col("best.row_id").alias("keep_row"), "group_size")


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs``."""
    rows = _digests(docs)
    return rows.join(merge_runs(rows), DIGEST).select(
        F.expr(f"nullif(ord, {LAST_ID}L)").alias("doc_id"), F.expr(f"nullif(keep_ord, {LAST_ID}L)").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Of repeated
    rows (same doc_id and text) one stays."""
    rows = _digests(docs)
    best = merge_runs(rows).select(F.col("keep_row").alias("row_id"))
    kept = rows.join(best, "row_id", "left_semi").select(F.col("ord").alias("ord_"), F.col("text_key").alias("key_"))
    whole = docs.select(F.struct("*").alias("row_"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("ord_"),
                        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("key_"))
    return whole.join(kept, ["ord_", "key_"], "left_semi").groupBy("ord_", "key_").agg(F.first("row_").alias("row_")).select("row_.*")
