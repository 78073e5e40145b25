"""Flagship job: how well do the packers fill rows on this corpus?

documents -> last-shard split (``source`` is the shard) -> byte tokens of
whole texts with BOS (length only: ``octet_length + 1``) -> stream
positions and bounded pack groups -> one plan per packer -> utilisation /
crop % / pad % per split and packer.

Only ``(doc_id, n_tokens)`` reach the Python packers; the text is read
once and measured on the JVM side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.operators.corpus import split_last_shard
from tokenmill.operators.packing import GROUP_DOCS, assign_pack_groups, chunk_plan, pack_plans, packing_stats

DEFAULT_PACKERS = ("chunk", "bestfit_crop", "greedy_crop", "greedy_pad", "ffd")


def byte_token_lengths(docs: DataFrame, shard_col: str = "source") -> DataFrame:
    """``(doc_id, shard, split, n_tokens)`` with ``n_tokens`` = UTF-8 bytes + BOS."""
    d = split_last_shard(docs.select("doc_id", shard_col, "text"), shard_col)
    return d.select("doc_id", shard_col, "split",
                    (F.octet_length("text") + 1).cast("long").alias("n_tokens"))


def packing_report(docs: DataFrame, T: int = 2048, packers=DEFAULT_PACKERS, group_docs: int = GROUP_DOCS,
                   buffer_size: int = 1000) -> DataFrame:
    """Utilisation / crop % / pad % per packer and split.

    The sequential packers share one ``applyInPandas`` pass over the bounded
    pack groups; the chunking packer is relational.
    """
    cap = T + 1
    order = ["source", "doc_id"]
    lengths = byte_token_lengths(docs)
    seq = {p: ({"buffer_size": buffer_size} if p == "bestfit_crop" else {}) for p in packers if p != "chunk"}
    parts = []
    if seq:
        grouped = assign_pack_groups(lengths, order, ["split"], group_docs)
        plans = pack_plans(grouped, seq, cap, ["split"], group_docs=group_docs)
        parts.append(packing_stats(plans, _inputs_per_packer(lengths, list(seq)), cap, ["packer", "split"]))
    if "chunk" in packers:
        parts.append(packing_stats(chunk_plan(lengths, cap, order, ["split"]), lengths, cap, ["split"])
                     .withColumn("packer", F.lit("chunk")))
    out = reduce(DataFrame.unionByName, parts)
    return out.select("packer", "split", "docs", "rows", "input_tokens", "used_tokens",
                      "util_pct", "crop_pct", "pad_pct")


def _inputs_per_packer(lengths: DataFrame, names) -> DataFrame:
    """The input documents once per packer name (a generator, not a join)."""
    return lengths.withColumn("packer", F.explode(F.array(*[F.lit(n) for n in names])))
