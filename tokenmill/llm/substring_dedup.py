"""Substring dedup with prefix-partitioned suffix trees.

A word-level suffix is cut off at the window length (50 words), and its first
50 words are two symbols of 25 words each (64-bit hashes). Suffixes sorted
by their symbols are the leaves of a suffix tree in order; neighbours'
longest common prefixes are its internal nodes. A node of depth two (50
words) is a repeat, its smallest doc_id keeps the text, and all other leaves
below it are removed windows. Windows that follow each other join into
maximal repeats.

The suffixes are dealt to groups by range: the bounds that Spark samples are
prefixes as long as needed to tell two groups apart, from part of the first
symbol up to both and the document, so groups have about equal sizes even
if a third of all suffixes start with the same passage. A group is sorted by
Spark (spilling if need be) and its tree is walked leaf by leaf in constant
memory. A node cut in two by a bound is put together from the groups' first
and last nodes.

Only suffixes that may repeat are sorted. Every 50-word window has one
anchor: its 8-word gram of smallest hash (the first on a tie). Equal windows
have equal anchors, so windows whose anchor gram occurs in one document alone
are dropped before the trees; this is exact. Documents of the same words are
represented by the smallest id.

Defined results: null text has no words. A null doc_id counts as larger than
all others. Rows that share a doc_id never remove each other's text (unless
another id does); repeated rows get the same result each. Other columns are
not read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.scratch import LAST_ID, materialise
from tokenmill.llm.text import Words, as_signed, covered, slices

WINDOW = 50
ANCHOR = 8
SYMBOL = 25
SYMBOLS = [f"s{i}" for i in range(WINDOW // SYMBOL)]


def _sliding_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the first smallest value of each full window of ``width``."""
    n = len(h) - width + 1
    best, at, reach = h.copy(), np.arange(len(h)), 1
    while reach < width:  # windows of doubled reach from two halves that may overlap
        step = min(reach, width - reach)
        m = len(best) - step
        right = best[step:] < best[:m]
        at = np.where(right, at[step:], at[:m])
        best = np.where(right, best[step:], best[:m])
        reach += step
    return at[:n]


def window_anchors(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, and of each the position and hash of its anchor."""
    starts = np.flatnonzero(np.arange(len(w.start)) + WINDOW <= w.first[1:][w.doc])
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    # grams across documents are computed too but no window reaches them
    at = np.arange(len(w.start) - ANCHOR + 1)
    gram = w.sequence_hash(at, at + ANCHOR)
    anchor = _sliding_argmin(gram, WINDOW - ANCHOR + 1)[starts]
    return starts, anchor, gram[anchor]


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: words, hashes of the word sequence, distinct anchors."""
    for batch in batches:
        for part in slices(batch):
            w = Words.of(part.column("text"))
            ends = w.first[1:]
            seq = w.sequence_hash(w.first[:-1], ends)
            seq2 = w.bytes_hash(*_word_bounds(w))
            starts, anchor, _ = window_anchors(w)
            at = np.unique(anchor)
            gram = w.sequence_hash(at, at + ANCHOR) if len(at) else np.zeros(0, np.uint64)
            cut = np.searchsorted(at, w.first)
            yield pa.RecordBatch.from_arrays([
                part.column("ord"), part.column("th"), pa.array(w.count.astype(np.int64)), as_signed(seq), as_signed(seq2),
                pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), as_signed(gram))],
                names=["ord", "th", "n_words", "seq", "seq2", "anchors"])


def _word_bounds(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte of all words of each document (0, 0 if none): a
    second, independent hash for texts whose white space is equal as well."""
    some = w.count > 0
    lo, hi = np.zeros(len(w.count), np.int64), np.zeros(len(w.count), np.int64)
    lo[some], hi[some] = w.start[w.first[:-1][some]], w.end[w.first[1:][some] - 1]
    return lo, hi


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstd frames: they go through two shuffles."""
    import zstandard
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        frames = [squeeze(text.as_buffer()) for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("ord"), batch.column("th"), pa.array(frames, pa.binary())], names=["ord", "th", "z"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with the texts back in place of their frames, in slices whose
    frames are small."""
    import zstandard
    whole = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for part in slices(batch, "z"):
            texts = pa.array([whole(z.as_buffer()).decode() for z in part.column("z")], pa.string())
            yield part.set_column(part.schema.get_field_index("z"), "text", texts)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes at the windows whose anchor gram other documents have too."""
    for batch in _texts(batches):
        for part in slices(batch):
            w = Words.of(part.column("text"))
            starts, anchor, gram = window_anchors(w)
            hot = part.column("hot")
            offs = np.asarray(hot.offsets)
            hot_hash = np.asarray(hot.values)[offs[0]:offs[-1]].view(np.uint64)
            hot_doc = np.repeat(np.arange(len(hot)), np.diff(offs))
            # a hash and its document as one key: a document's own anchors count
            salt = (np.arange(len(hot)).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            keep = np.isin(gram + salt[w.doc[starts]], hot_hash + salt[hot_doc])
            s = starts[keep]
            d = w.doc[s]
            cols = [as_signed(w.sequence_hash(s + i * SYMBOL, s + (i + 1) * SYMBOL)) for i in range(len(SYMBOLS))]
            cols += [part.column("ord").take(pa.array(d)), part.column("th").take(pa.array(d)),
                     pa.array((s - w.first[d]).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=[*SYMBOLS, "ord", "th", "pos"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk the leaves of one group in order. kind 0: a removed window. kind 1:
    a window of the group's first node whose document is the first there, to
    be decided by earlier groups. kind 2: the last node and its smallest id."""
    last = first = None  # a node's symbols and its smallest id
    names = [*SYMBOLS, "ord", "th", "pos", "kind"]
    for batch in batches:
        if not batch.num_rows:
            continue
        sym = np.stack([np.asarray(batch.column(s)) for s in SYMBOLS], 1)
        ids = np.asarray(batch.column("ord"))
        if first is None:
            first = last = (sym[0].copy(), ids[0])
        # the depth, in symbols, of the node that joins a leaf to the one before
        same = np.concatenate([(last[0] == sym[0])[None], sym[1:] == sym[:-1]])
        depth = np.cumprod(same, axis=1).sum(1)
        opens = depth < len(SYMBOLS)
        node = np.cumsum(opens)
        least = np.concatenate([[last[1]], ids[opens]])[node]
        kind = np.where(ids > least, 0, -1)
        kind[(ids == first[1]) & (sym == first[0]).all(1)] = 1
        pick = np.flatnonzero(kind >= 0)
        if len(pick):
            rows = batch.take(pa.array(pick))
            decided = pa.array(kind[pick] == 0)  # these need no symbols any more
            symbols = [pc.if_else(decided, None, rows.column(s)) for s in SYMBOLS]
            rest = [rows.column(c) for c in ("ord", "th", "pos")]
            yield pa.RecordBatch.from_arrays([*symbols, *rest, pa.array(kind[pick].astype(np.int32))], names=names)
        last = (sym[-1].copy(), least[-1])
    if last is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(v)], pa.int64()) for v in last[0]]
            + [pa.array([int(last[1])], pa.int64()), pa.array([0], pa.int64()), pa.array([0], pa.int32()), pa.array([2], pa.int32())], names=names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Apply the removed windows to the texts."""
    for batch in _texts(batches):
        ids, words, gone, digests, kept_texts = [], [], [], [], []
        for doc_id, text, full, pos in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "full", "pos"))):
            w = (text or "").encode().split()
            if full:
                mask = np.ones(len(w), bool)
            elif pos:
                mask = covered(len(w), np.array(pos), WINDOW)
            else:
                mask = None
            kept = w if mask is None else [x for x, m in zip(w, mask) if not m]
            joined = b" ".join(kept)
            ids.append(doc_id)
            words.append(len(w))
            gone.append(len(w) - len(kept))
            digests.append(hashlib.sha256(joined).hexdigest())
            kept_texts.append(joined.decode())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(words, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string()), pa.array(kept_texts, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def removed_windows(docs: DataFrame) -> DataFrame:
    """(ord, th, full, pos): per document and text, whether all words go, or
    the sorted starts of its removed windows. ``docs`` has doc_id and text."""
    base = _identified(docs)
    prof = materialise(base.mapInArrow(_profile, "ord long, th long, n_words long, seq long, seq2 long, anchors array<long>"), "anchors")
    long = prof.where(f"n_words >= {WINDOW}")
    least = long.groupBy("seq", "seq2", "n_words").agg(F.min("ord").alias("least"))
    marked = long.join(least, ["seq", "seq2", "n_words"])
    copies = marked.where("ord > least").select("ord", "th").distinct()
    anchors = marked.where("ord = least").select("ord", "th", F.explode("anchors").alias("gram"))
    shared = anchors.groupBy("gram").agg(F.min("ord").alias("a"), F.max("ord").alias("b")).where("a < b").select("gram")
    hot = anchors.join(shared, "gram").groupBy("ord", "th").agg(F.collect_set("gram").alias("hot"))
    schema = ", ".join(f"{s} long" for s in SYMBOLS) + ", ord long, th long, pos int"
    leaves = _frames(base).join(hot, ["ord", "th"]).dropDuplicates(["ord", "th"]).mapInArrow(_suffixes, schema)
    order = [*SYMBOLS, "ord", "th", "pos"]
    walked = leaves.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_walk, schema + ", kind int")
    found = materialise(walked, "repeats")
    ends = found.where("kind = 2").groupBy(*SYMBOLS).agg(F.min("ord").alias("least"))
    open_ = found.where("kind = 1").join(ends, SYMBOLS).where("ord > least")
    windows = found.where("kind = 0").select("ord", "th", "pos").union(open_.select("ord", "th", "pos"))
    spans = windows.groupBy("ord", "th").agg(F.sort_array(F.collect_set("pos")).alias("pos"))
    full = copies.select("ord", "th", F.lit(True).alias("full"), F.lit(None).cast("array<int>").alias("pos"))
    return full.unionByName(spans.withColumn("full", F.lit(False)))


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("ord"),
                       F.xxhash64(text).alias("th"), text.alias("text"))


def _frames(base: DataFrame) -> DataFrame:
    return base.mapInArrow(_squeezed, "ord long, th long, z binary")


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text of every row of ``docs``."""
    base = _identified(docs)
    joined = _frames(base).join(removed_windows(docs), ["ord", "th"], "left")
    return joined.select(F.expr(f"nullif(ord, {LAST_ID}L)").alias("doc_id"), "z", "full", "pos").mapInArrow(
        _cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
