"""Ranked lexical search by an Aho-Corasick scan of the documents.

There is no index of the documents. The terms of all items make one
automaton, which goes to the tasks with the list of items of each term. A
task turns its texts into term characters and blanks, and each pattern is a
term between two blanks, so a hit is a whole term and neighbours share the
blank between them. One scan counts documents and terms (document
frequencies, N, L), a second one scores: term frequencies come from the hits,
the automaton's outputs map them to items, and a task keeps the best ``k``
documents of each item. Spark merges these in two levels.

What is sent to the tasks is bounded: items are dealt by a hash into groups
of about ``MAX_POSTINGS`` pairs of an item and a term (the number of groups is
doubled while a group of several items holds more than twice that), and each
group scans the documents with its own automaton. Texts are scanned whole, in
chunks that end at a blank.

Defined results: null or empty text has no term and is not counted; a null
item text has no term and no result. Rows of equal item_id are one item whose
terms add up; a null item_id is an item as well. Every row of the documents
is a document; equal scores go by ascending doc_id, null last, and repeated
rows stay repeated. Other columns don't matter. Empty tables give no rows.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.llm.scratch import LAST_ID, materialise
from tokenmill.llm.text import slices, text_buffer

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MAX_POSTINGS = 1 << 20
CHUNK = 1 << 20
PIECE = 1 << 22  # pairs of a document and an item that are scored at a time
BLANK = 0x20
BASE, TERM_WEIGHT, LENGTH_PERCENT, LENGTH_WEIGHT = 1_000_000_000, 1000, 25, 12
MERGE = 256

#: Byte after byte: term characters, A-Z lower-cased; all others are blanks.
_FOLD = np.full(256, BLANK, np.uint8)
for _lo, _hi, _to in ((0x30, 0x39, 0), (0x41, 0x5A, 32), (0x61, 0x7A, 0), (0x80, 0xFF, 0)):
    _FOLD[_lo:_hi + 1] = np.arange(_lo, _hi + 1) + _to


@dataclass
class ItemGroup:
    """What the tasks get: terms in code point order, and for term t the
    entries ``first[t]:first[t + 1]`` of ``item`` and ``times``."""

    terms: list[str]
    first: np.ndarray
    item: np.ndarray
    times: np.ndarray
    ids: list
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


_automata: dict[str, object] = {}


def _automaton(group: ItemGroup):
    """The group's automaton; a worker keeps the last one."""
    if group.key not in _automata:
        import ahocorasick
        _automata.clear()
        a = ahocorasick.Automaton()
        for t, term in enumerate(group.terms):
            a.add_word(f" {term.encode().decode('latin-1')} ", t)
        a.make_automaton()
        _automata[group.key] = a
    return _automata[group.key]


def folded(column) -> tuple[np.ndarray, np.ndarray]:
    """Term bytes and blanks of all texts, a blank around each; and the place
    where each text begins, with the end of the last."""
    raw, offsets = text_buffer(column)
    low = _FOLD[raw]
    begins = offsets + np.arange(1, len(offsets) + 1)
    out = np.full(len(low) + len(offsets), BLANK, np.uint8)
    for i, b in enumerate(begins[:-1]):
        out[b:b + offsets[i + 1] - offsets[i]] = low[offsets[i]:offsets[i + 1]]
    return out, begins


def scan(column, automaton, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text with repeats, and (document, term, tf) of the hits."""
    text, begins = folded(column)
    is_term = text != BLANK
    starts = np.flatnonzero(is_term[1:] & ~is_term[:-1]) + 1
    n_terms = np.diff(np.searchsorted(starts, begins))
    at, term = [], []
    lo = 0
    while lo < len(text) - 1:
        hi = min(lo + chunk, len(text) - 1)
        while text[hi] != BLANK:  # the last byte is a blank
            step = np.flatnonzero(text[hi:hi + chunk] == BLANK)
            hi = hi + int(step[0]) if len(step) else hi + chunk
        hits = np.fromiter(itertools.chain.from_iterable(automaton.iter(text[lo:hi + 1].tobytes().decode("latin-1"))), np.int64).reshape(-1, 2)
        # a hit ends at the blank after the term
        at.append(hits[:, 0] + (lo - 1))
        term.append(hits[:, 1])
        lo = hi
    if not at:
        return n_terms, *[np.zeros(0, np.int64)] * 3
    doc = np.searchsorted(begins, np.concatenate(at), side="right") - 1
    width = len(automaton)
    keys, tf = np.unique(doc * width + np.concatenate(term), return_counts=True)
    return n_terms, keys // width, keys % width, tf


def _count(group):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = group.value
        automaton = _automaton(items)
        df = np.zeros(len(items.terms) + 2, np.int64)
        for batch in batches:
            for part in slices(batch):
                n_terms, _, term, _ = scan(part.column("text"), automaton)
                df[:-2] += np.bincount(term, minlength=len(items.terms))
                df[-2] += np.count_nonzero(n_terms)
                df[-1] += n_terms.sum()
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(df[found], pa.int64())], names=["term", "df"])
    return run


class Best:
    """The best ``k`` documents of each of n items, by score and then id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.item, self.score, self.ord = (np.zeros(0, np.int64) for _ in range(3))
        # a document must beat this to come in, once an item has k
        self.least, self.least_ord = np.zeros(n, np.int64), np.full(n, -1 << 63, np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, ord_: np.ndarray) -> None:
        least = self.least[item]
        new = (score > least) | ((score == least) & (ord_ < self.least_ord[item]))
        if not new.any():
            return
        item, score, ord_ = (np.concatenate([a, b[new]]) for a, b in ((self.item, item), (self.score, score), (self.ord, ord_)))
        order = np.lexsort((ord_, -score, item))
        item, score, ord_ = item[order], score[order], ord_[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        keep = rank < self.k
        self.item, self.score, self.ord, rank = item[keep], score[keep], ord_[keep], rank[keep]
        full = rank == self.k - 1
        self.least[self.item[full]], self.least_ord[self.item[full]] = self.score[full], self.ord[full]


def _score(group, weight, n_docs: int, n_all: int, k: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, w = group.value, weight.value
        automaton = _automaton(items)
        n_items, per_term = len(items.ids), np.diff(items.first)
        # sums in float64 are exact below 2 ** 53
        most = np.bincount(items.item, weights=items.times, minlength=1).max() * max(int(w.max()), 1) * (BASE // TERM_WEIGHT)
        best = Best(n_items, k)
        for batch in batches:
            for part in slices(batch):
                n_terms, doc, term, tf = scan(part.column("text"), automaton)
                ords = part.column("ord").to_numpy()
                m = 100 - LENGTH_PERCENT + LENGTH_PERCENT * n_terms * n_docs // n_all
                gain = w[term] * (BASE * tf // (TERM_WEIGHT * tf + LENGTH_WEIGHT * m[doc]))
                sizes = per_term[term]
                upto = np.concatenate([[0], np.cumsum(sizes)])
                # cut between documents: few enough pairs, few enough sums
                cuts = np.searchsorted(doc, np.arange(len(ords) + 1))
                lo = 0
                while lo < len(ords):
                    hi = int(np.searchsorted(upto[cuts], upto[cuts[lo]] + piece, side="right")) - 1
                    hi = min(max(hi, lo + 1), lo + max(piece // n_items, 1), len(ords))
                    a, b = cuts[lo], cuts[hi]
                    own = sizes[a:b]
                    entry = np.repeat(items.first[term[a:b]] - (upto[a:b] - upto[a]), own) + np.arange(upto[b] - upto[a])
                    key = np.repeat((doc[a:b] - lo) * n_items, own) + items.item[entry]
                    value = np.repeat(gain[a:b], own) * items.times[entry]
                    if most < 1 << 53:
                        total = np.bincount(key, weights=value, minlength=(hi - lo) * n_items).astype(np.int64)
                    else:
                        total = np.zeros((hi - lo) * n_items, np.int64)
                        np.add.at(total, key, value)
                    hit = np.flatnonzero(total > 0)
                    best.add(hit % n_items, total[hit], ords[lo + hit // n_items])
                    lo = hi
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (best.item, best.ord, best.score)], names=["item", "ord", "score"])
    return run


def _postings(items: DataFrame) -> DataFrame:
    """(item_id, term, times), written."""
    lowered = F.translate("text", UPPER, UPPER.lower())
    terms = items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term"))
    return materialise(terms.groupBy("item_id", "term").agg(F.count("*").alias("times")), "search-items")


def _groups(postings: DataFrame) -> tuple[int, DataFrame]:
    """Number of groups, and the postings with theirs."""
    per_item = postings.groupBy("item_id").agg(F.count("*").alias("n"))
    n = -(-(per_item.agg(F.sum("n")).first()[0] or 0) // MAX_POSTINGS)
    hashed = lambda k: F.pmod(F.xxhash64("item_id"), F.lit(k)).alias("group")
    while n:
        sizes = per_item.groupBy(hashed(n)).agg(F.sum("n").alias("n"), F.count("*").alias("items"))
        if not sizes.where((F.col("n") > 2 * MAX_POSTINGS) & (F.col("items") > 1)).limit(1).count():
            break
        n *= 2
    return n, postings.withColumn("group", hashed(max(n, 1)))


def _item_group(rows: DataFrame) -> ItemGroup:
    """One group's postings (at most 2 * MAX_POSTINGS, or those of one item)
    on the driver."""
    got = rows.select("item_id", "term", "times").toArrow()
    ids = sorted(set(got["item_id"].to_pylist()), key=lambda i: (i is None, i or 0))
    terms = sorted(set(got["term"].to_pylist()))
    item_no, term_no = {x: i for i, x in enumerate(ids)}, {x: i for i, x in enumerate(terms)}
    item = np.array([item_no[x] for x in got["item_id"].to_pylist()], np.int64)
    term = np.array([term_no[x] for x in got["term"].to_pylist()], np.int64)
    order = np.lexsort((item, term))
    return ItemGroup(terms, np.searchsorted(term[order], np.arange(len(terms) + 1)), item[order], got["times"].to_numpy()[order], ids)


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id, score: the best ``k`` documents of each item."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("ord"), "text")
    n, postings = _groups(_postings(items))
    best = [spark.createDataFrame([], "item_id long, ord long, score long")]
    for g in range(n):
        mine = postings.where(F.col("group") == g)
        group = _item_group(mine)
        if not group.ids:
            continue
        sent = spark.sparkContext.broadcast(group)
        df = np.zeros(len(group.terms) + 2, np.int64)
        for term, count in rows.mapInArrow(_count(sent), "term long, df long").groupBy("term").agg(F.sum("df")).collect():
            df[term] = count
        n_docs, n_all = int(df[-2]), int(df[-1])
        if not n_all:
            continue
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df[:-2]], np.int64)
        scored = rows.mapInArrow(_score(sent, spark.sparkContext.broadcast(weight), n_docs, n_all, k, PIECE), "item long, ord long, score long")
        some = Window.partitionBy("item", "part").orderBy(F.desc("score"), "ord")
        scored = (scored.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE))).withColumn("r", F.row_number().over(some))
                  .where(F.col("r") <= k).drop("r", "part"))
        names = spark.createDataFrame(list(enumerate(group.ids)), "item long, item_id long")
        best.append(scored.join(names, "item").select("item_id", "ord", "score"))
    merged = best[0]
    for more in best[1:]:
        merged = merged.union(more)
    final = Window.partitionBy("item_id").orderBy(F.desc("score"), "ord")
    ranked = merged.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), F.expr(f"nullif(ord, {LAST_ID}L)").alias("doc_id"), "score")
