"""Quality rules at host level.

Documents are measured and tested against rules one by one. Failures of each
rule are summed by host (the column ``source``), and a host's rate of failures
is shrunk towards the rate of all hosts with a beta prior, whose two numbers
are fitted to the hosts' rates by moments (the prior mean is the mean rate,
the prior weight follows from how much the rates vary beyond chance). A host
of few documents therefore keeps close to the mean, and a host is rejected
for a rule only if its shrunk rate is above that rule's limit. Its verdict is
joined back to its documents; one that fails the base rules is rejected
whatever its host.

Rules: ``short`` (under 20 words) and ``repeated`` (more than 30 % of words
in repeated 8-word windows), the base; ``symbols`` (more symbols than words)
and ``lines`` (over half of the lines repeated).

Defined results: null or empty text has no words and fails the base. A null
source is no host; its documents are judged by the base alone. Null doc_ids
and repeated rows are rows like any other. Other columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.scratch import materialise
from tokenmill.llm.text import Words, covered, slices

REPEAT = 8
#: The shrunk failure rate from which a host is rejected, by rule.
LIMITS = {"short": 0.5, "repeated": 0.5, "symbols": 0.5, "lines": 0.5}
#: Bounds of the prior's weight in documents, for hosts that hardly differ.
PRIOR_WEIGHT = (2.0, 1000.0)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_doc(w: Words, marks: np.ndarray) -> np.ndarray:
    """Marked bytes of each document."""
    total = np.concatenate([[0], np.cumsum(marks)])
    return total[w.offsets[1:]] - total[w.offsets[:-1]]


def _distinct(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort order by document and hash, and which rows open a new value."""
    order = np.lexsort((h, doc))
    d, x = doc[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1])
    return order, new


def measures(col) -> dict[str, np.ndarray]:
    w = Words.of(col)
    n = len(w.count)
    inside = np.zeros(len(w.raw) + 1, np.int64)
    np.add.at(inside, w.start, 1)
    np.add.at(inside, w.end, -1)
    code_points = (w.raw & 0xC0) != 0x80
    # lines: cut at every \n and at the ends of documents
    breaks = np.flatnonzero(w.raw == 10)
    line_start = np.sort(np.concatenate([w.offsets[:-1], breaks + 1]))
    line_end = np.sort(np.concatenate([breaks, w.offsets[1:]]))
    has_word = np.searchsorted(w.start, line_end) > np.searchsorted(w.start, line_start)
    line_start, line_end = line_start[has_word], line_end[has_word]
    line_doc = np.searchsorted(w.offsets, line_start, side="right") - 1
    _, new = _distinct(line_doc, w.bytes_hash(line_start, line_end))
    lines = np.bincount(line_doc, minlength=n)
    at, gram = w.grams(REPEAT)
    order, opens = _distinct(w.doc[at], gram)
    group = np.cumsum(opens) - 1
    twice = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.zeros(0, bool)
    inside_repeat = covered(len(w.start), at[order[twice]], REPEAT)
    return {
        "n_words": w.count, "word_chars": _per_doc(w, code_points & (np.cumsum(inside[:-1]) > 0)), "n_symbols": _per_doc(w, _SYMBOL[w.raw]),
        "n_dup_lines": lines - np.bincount(np.sort(line_doc)[new], minlength=n),
        "n_repeat_words": np.bincount(w.doc[inside_repeat], minlength=n), "n_lines": lines}


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            m = measures(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("source"), *(pa.array(m[c].astype(np.int64)) for c in MEASURES)],
                                             names=["doc_id", "source", *MEASURES])


def host_verdicts(rows: DataFrame) -> DataFrame:
    """(source, rejected) of every host, from rows with rule columns."""
    n = F.count("*").cast("double")
    hosts = materialise(rows.where("source is not null").groupBy("source").agg(n.alias("n"), *(F.sum(F.col(r).cast("long")).cast("double").alias(r) for r in LIMITS)), "hosts")
    # sums over all hosts, of every rule at once: sizes, failures, and failures squared by size
    sums = [F.sum("n").alias("n"), F.count("*").alias("hosts"), *(F.sum(r).alias(r) for r in LIMITS), *(F.sum(F.col(r) * F.col(r) / F.col("n")).alias(f"{r}_sq") for r in LIMITS)]
    hosts = hosts.withColumn("all_hosts", hosts.agg(F.struct(*sums).alias("s")).scalar())  # one row, read as a column
    all_hosts = F.col("all_hosts")
    rejected = F.lit(False)
    for rule, limit in LIMITS.items():
        mean = all_hosts[rule] / all_hosts["n"]
        # variance of the rates beyond what chance gives a host of its size
        spread = all_hosts[f"{rule}_sq"] / all_hosts["n"] - mean * mean - mean * (1 - mean) * all_hosts["hosts"] / all_hosts["n"]
        weight = F.when(spread > 0, F.greatest(F.lit(PRIOR_WEIGHT[0]), F.least(F.lit(PRIOR_WEIGHT[1]), mean * (1 - mean) / spread - 1))).otherwise(PRIOR_WEIGHT[1])
        rejected = rejected | ((F.col(rule) + mean * weight) / (F.col("n") + weight) > limit)
    return hosts.select("source", rejected.alias("rejected"))


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the measures, base_failed and kept of every row of ``docs``."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").alias("text"))
    rows = materialise(base.mapInArrow(_measure, "doc_id long, source string, " + ", ".join(f"{c} long" for c in MEASURES)), "measures")
    rows = rows.withColumns({
        "short": F.col("n_words") < 20, "repeated": 100 * F.col("n_repeat_words") > 30 * F.col("n_words"),
        "symbols": F.col("n_symbols") > F.col("n_words"), "lines": 2 * F.col("n_dup_lines") > F.col("n_lines")})
    failed = F.col("short") | F.col("repeated")
    return rows.join(host_verdicts(rows), "source", "left").select(
        "doc_id", *MEASURES[:-1], failed.alias("base_failed"), (~failed & ~F.coalesce("rejected", F.lit(False))).alias("kept"))
