"""N-gram Jaccard join with size-banded tiles and bitmap signatures.

A document's set is its distinct 5-word shingles (64-bit hashes). Documents
with equal sets form one class, handled once. Classes link when the Jaccard
similarity of their sets is 0.75 or more; components of linked classes give
every document its component_id. No link is lost:

1. *Buckets.* All shingles have one global order, the frequent ones last.
   Two linked sets share a shingle among the first n - ceil(0.75 n) + 1 of
   each, so a class is filed under these shingles and only classes that share
   a file are compared. The order needs no exact counts: any list of frequent
   shingles, such as the ``FREQUENT`` most frequent ones kept here, gives the
   same links, only in other files.
2. *Tiles.* The classes of a file are sorted by set size and cut into bands;
   only sizes within 3:4 of each other can link.
3. *Bitmaps.* Each class has a bitmap of hashed shingles, about two bits per
   shingle. A bit that one has and the other lacks is a shingle not shared,
   so bit counts bound the overlap from above; pairs below the need are out.
4. *Exact.* What is left is decided by intersecting sorted shingle arrays.

Large groups of near copies would give pairs by the square. A file of over
``SMALL`` classes therefore first compares each class with one pivot of its
band only. After the components of these links are known, ``ROUNDS`` more
rounds compare what lies in several components with other pivots. Then the
classes left are dealt into tiles of about ``SPREAD`` classes of one size
band, a large component into tiles of its own, and every two tiles whose sizes
fit are compared, but only pairs of different components, so no pair that could
join two components is left out: by the usual bitmaps first, then, among the
classes that have a likely partner left, by wider bitmaps and by sorted 32-bit
codes that bound the overlap too. Two tiles are one unit of the shuffle, so a
large file is spread over as many tasks as it has pairs of tiles.

Defined results: null or empty text has no shingles and component_id is its
own doc_id. Under five words the whole sequence is one shingle. A null doc_id
sorts last, so component_id is null only if all ids of a component are null.
Repeated rows get one result each. Other columns are not read. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.llm.components import connected
from tokenmill.llm.scratch import LAST_ID, materialise
from tokenmill.llm.text import Words, as_signed, mix, slices

SHINGLE = 5
FREQUENT = 1 << 17
LOCAL_FREQUENT = 2
SMALL = 32
TILE = 256
#: Classes of a tile in the shuffle, about; a task holds two tiles at a time.
SPREAD = 1 << 10
#: Rounds with new pivots before tiles are compared.
ROUNDS = 2
CHUNK = 1 << 12
#: Bits of a bitmap in a tile, in times of the usual bitmaps.
WIDE = 8
SIEVE_BITS = 1 << 22
#: Bytes of text whose shingles a task holds at a time (one longer text alone).
SLICE = 1 << 19
#: Bytes of an Arrow batch; Spark's 64 MB are held several times on both sides.
BATCH = 1 << 22
#: Classes a task remembers, so that it files copies once (memory only).
REMEMBERED = 1 << 20
_U = np.uint64


def shingle_sets(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(doc, hash) of the distinct shingles, sorted by document and hash."""
    at, h = w.grams(SHINGLE)
    doc = w.doc[at]
    short = np.flatnonzero((w.count > 0) & (w.count < SHINGLE))
    if len(short):
        doc = np.concatenate([doc, short])
        h = np.concatenate([h, w.sequence_hash(w.first[short], w.first[short + 1])])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def bitmap_bits(n: np.ndarray) -> np.ndarray:
    """Bits of the bitmap of a set of n: a power of two from n to 2 n."""
    return np.maximum(64, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))


def bitmaps(doc: np.ndarray, h: np.ndarray, n: np.ndarray) -> list[bytes]:
    bits = bitmap_bits(n)
    base = np.concatenate([[0], np.cumsum(bits)])
    have = np.zeros(base[-1], bool)
    have[base[doc] + (h & (bits[doc] - 1).astype(np.uint64)).astype(np.int64)] = True
    packed = np.packbits(have, bitorder="little").tobytes()
    return [packed[base[i] // 8:base[i + 1] // 8] for i in range(len(n))]


def overlap_bound(a: bytes, b: bytes, n_a: int, n_b: int) -> int:
    """The most shingles that the sets behind two bitmaps can share."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    x, y = fold(x, len(y)), fold(y, len(x))
    return min(n_a - int(np.bitwise_count(x & ~y).sum()), n_b - int(np.bitwise_count(y & ~x).sum()))


def fold(x: np.ndarray, to: int) -> np.ndarray:
    """A bitmap at fewer bits: what the smaller modulus would have given."""
    while x.shape[-1] > to:
        half = x.shape[-1] // 2
        x = x[..., :half] | x[..., half:]
    return x


def needed(n_a, n_b):
    """Shared shingles that a Jaccard similarity of 0.75 needs at least."""
    return (75 * (n_a + n_b) + 174) // 175


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: set size, class id, bitmap; the first of a slice also
    carries the shingles that are frequent in the slice."""
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            w = Words.of(part.column("text"), lower=True)
            doc, h = shingle_sets(w)
            n = np.bincount(doc, minlength=part.num_rows)
            bounds = np.concatenate([[0], np.cumsum(n)])
            total = np.concatenate([[0], np.cumsum(mix(h + _U(77)), dtype=np.uint64)]).astype(np.uint64)
            cid = mix(total[bounds[1:]] - total[bounds[:-1]] + n.astype(np.uint64))
            hs, counts = np.unique(h, return_counts=True)
            often = counts >= LOCAL_FREQUENT
            offs = np.zeros(part.num_rows + 1, np.int32)
            offs[1:] = often.sum()
            yield pa.RecordBatch.from_arrays([
                part.column("ord"), part.column("th"), pa.array(n.astype(np.int64)), as_signed(cid),
                pa.array(bitmaps(doc, h, n), pa.binary()),
                pa.ListArray.from_arrays(pa.array(offs), as_signed(hs[often])),
                pa.ListArray.from_arrays(pa.array(offs), pa.array(counts[often]))],
                names=["ord", "th", "n", "cid", "bits", "often", "often_n"])


def _files(frequent: np.ndarray):
    """Postings: every class under the first shingles of its set. ``frequent``
    is sorted by rising frequency; its shingles come last in the order."""
    by_hash = np.argsort(frequent)
    sorted_hash = frequent[by_hash]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                w = Words.of(part.column("text"), lower=True)
                doc, h = shingle_sets(w)
                n = np.bincount(doc, minlength=part.num_rows)
                total = np.concatenate([[0], np.cumsum(mix(h + _U(77)), dtype=np.uint64)]).astype(np.uint64)
                bounds = np.concatenate([[0], np.cumsum(n)])
                cid = mix(total[bounds[1:]] - total[bounds[:-1]] + n.astype(np.uint64)).view(np.int64)
                fresh = np.zeros(len(n), bool)
                for i, c in enumerate(cid.tolist()):
                    if n[i] and c not in seen:
                        fresh[i] = True
                        seen.add(c)
                if len(seen) > REMEMBERED:
                    seen.clear()
                key = h >> _U(1)
                if len(sorted_hash):
                    at = np.minimum(np.searchsorted(sorted_hash, h), len(sorted_hash) - 1)
                    hit = sorted_hash[at] == h
                    key[hit] = (_U(1) << _U(63)) | by_hash[at[hit]].astype(np.uint64)
                order = np.lexsort((key, doc))
                key = key[order]
                rank = np.arange(len(key)) - bounds[doc]
                take = (rank < (n - (3 * n + 3) // 4 + 1)[doc]) & fresh[doc]
                d = doc[take]
                yield pa.RecordBatch.from_arrays([as_signed(key[take]), pa.array(n[d].astype(np.int64)), pa.array(cid[d])],
                                                 names=["key", "n", "cid"])
    return run


def _whole_files(batches: Iterator[pa.RecordBatch], columns: list[str]):
    """Arrays of whole files from batches sorted by key: (bounds, columns)."""
    rest = None
    for batch in batches:
        cols = [np.asarray(batch.column(c)) if not pa.types.is_binary(batch.schema.field(c).type) else np.array(batch.column(c).to_pylist(), object) for c in columns]
        if rest is not None:
            cols = [np.concatenate([r, c]) for r, c in zip(rest, cols)]
        cut = len(cols[0]) and int(np.searchsorted(cols[0], cols[0][-1]))
        rest = [c[cut:] for c in cols]
        if cut:
            yield [c[:cut] for c in cols]
    if rest is not None and len(rest[0]):
        yield rest


def _file_bounds(key: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])


def _pairs_of_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: a pair (a, b) to be compared. kind 1: a row of a large file
    whose other pairs wait for the components: a is the file's pivot, b the
    class, n_b its size. Large files of one pivot become one file, as the many
    shingles of a group of near copies give nearly the same file each."""
    for key, n, cid in _whole_files(batches, ["key", "n", "cid"]):
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (cid[1:] != cid[:-1])
        key, n, cid = key[new], n[new], cid[new]
        bounds = _file_bounds(key)
        size = np.diff(bounds)
        left, right = [], []
        # files of up to SMALL classes: rows k apart, for each k
        own = np.repeat(size, size)
        end = np.repeat(bounds[1:], size)
        small = own <= SMALL
        for k in range(1, int(size[size <= SMALL].max(initial=1))):
            i = np.flatnonzero(small[:-k] & (np.arange(len(key) - k) + k < end[:-k]))
            i = i[3 * n[i + k] <= 4 * n[i]]
            left.append(i)
            right.append(i + k)
        big = [np.zeros((0, 3), np.int64)]
        for f in np.flatnonzero(size > SMALL):
            lo, hi = bounds[f], bounds[f + 1]
            band = np.floor(np.log(n[lo:hi]) / np.log(4 / 3)).astype(np.int64)
            start = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]]))
            tone = mix(cid[lo:hi].view(np.uint64))
            head = cid[lo + int(np.argmin(tone))]
            big.append(np.stack([np.full(hi - lo, head), cid[lo:hi], n[lo:hi]], 1))
            for s, e in zip(start, [*start[1:], hi - lo]):
                pivot = s + int(np.argmin(tone[s:e]))
                others = np.arange(s, e)
                left.append(np.full(e - s - 1, lo + pivot))
                right.append(lo + others[others != pivot])
        i = np.concatenate(left) if left else np.zeros(0, np.int64)
        j = np.concatenate(right) if right else np.zeros(0, np.int64)
        fits = 3 * np.maximum(n[i], n[j]) <= 4 * np.minimum(n[i], n[j])
        i, j = i[fits], j[fits]
        swap = cid[i] > cid[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        pair = np.unique(np.stack([cid[i], cid[j]], 1), axis=0) if len(i) else np.zeros((0, 2), np.int64)
        rows = np.unique(np.concatenate(big), axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], [len(pair), len(rows)]).astype(np.int32)), pa.array(np.concatenate([pair[:, 0], rows[:, 0]])),
             pa.array(np.concatenate([pair[:, 1], rows[:, 1]])), pa.array(np.concatenate([np.zeros(len(pair), np.int64), rows[:, 2]]))],
            names=["kind", "a", "b", "n_b"])


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose bitmaps leave enough overlap."""
    for batch in batches:
        n_a, n_b = (np.asarray(batch.column(c)) for c in ("n_a", "n_b"))
        need = needed(n_a, n_b)
        bits_a, bits_b = batch.column("bits_a"), batch.column("bits_b")
        keep = [overlap_bound(bits_a[i].as_py(), bits_b[i].as_py(), int(n_a[i]), int(n_b[i])) >= need[i] for i in range(batch.num_rows)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _meetings(key: np.ndarray, tile: np.ndarray):
    """Bounds (first, last) of the two tiles of each unit, which are one if a
    tile meets itself."""
    bounds = _file_bounds(key)
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        cuts = [lo + c for c in _file_bounds(tile[lo:hi])]
        yield (lo, cuts[1]), (cuts[-2], hi)


def _tile_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of two tiles (or one, with itself) that have a likely partner
    of another component there, by the usual bitmaps."""
    names = ["key", "tile", "n", "cid", "root"]
    for key, tile, n, cid, root, bits in _whole_files(batches, [*names, "bits"]):
        stays = np.zeros(len(key), bool)
        width = np.array([len(b) for b in bits])
        for first, last in _meetings(key, tile):
            # blocks of one width each; sizes ascend in a tile, so widths do
            blocks = [[(s, min(s + TILE, hi)) for lo, hi in zip(cuts[:-1], cuts[1:]) for s in range(lo, hi, TILE)]
                      for cuts in (one[0] + _file_bounds(width[slice(*one)]) for one in (first, last))]
            packed = [[np.frombuffer(b"".join(bits[s:e]), np.uint64).reshape(e - s, -1) for s, e in side] for side in blocks]
            for (s, e), wide_x in zip(blocks[0], packed[0]):
                for (t, u), wide_y in zip(blocks[1], packed[1]):
                    if (first == last and t < s) or 3 * n[t] > 4 * n[e - 1] or 3 * n[s] > 4 * n[u - 1]:
                        continue
                    fits = 3 * np.maximum(n[s:e, None], n[None, t:u]) <= 4 * np.minimum(n[s:e, None], n[None, t:u])
                    i, j = np.nonzero(fits & (root[s:e, None] != root[None, t:u]))
                    x, y = fold(wide_x, wide_y.shape[1]), fold(wide_y, wide_x.shape[1])
                    set_x, set_y = (np.bitwise_count(v).sum(1, dtype=np.int64) for v in (x, y))
                    for cut in range(0, len(i), CHUNK):
                        p, q = i[cut:cut + CHUNK], j[cut:cut + CHUNK]
                        both = np.bitwise_count(x[p] & y[q]).sum(1, dtype=np.int64)
                        likely = np.minimum(n[s + p] - set_x[p], n[t + q] - set_y[q]) + both >= needed(n[s + p], n[t + q])
                        stays[s + p[likely]] = True
                        stays[t + q[likely]] = True
        yield pa.RecordBatch.from_arrays([pa.array(c[stays]) for c in (key, tile, n, cid, root)], names=names)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Likely pairs of different components in two tiles (or one, with
    itself): by bitmaps of about ``WIDE`` bits per shingle, then by sorted
    codes."""
    for key, tile, n, cid, root, codes in _whole_files(batches, ["key", "tile", "n", "cid", "root", "codes"]):
        out = [np.zeros((0, 2), np.int64)]
        codes = [np.frombuffer(c, np.uint32) for c in codes]
        for first, last in _meetings(key, tile):
            for s in range(*first, TILE):
                e = min(s + TILE, first[1])
                for t in range(s if first == last else last[0], last[1], TILE):
                    u = min(t + TILE, last[1])
                    if 3 * n[t] > 4 * n[e - 1]:
                        break
                    differs = root[s:e, None] != root[None, t:u]
                    fits = 3 * np.maximum(n[s:e, None], n[None, t:u]) <= 4 * np.minimum(n[s:e, None], n[None, t:u])
                    i, j = np.nonzero(differs & fits)
                    if not len(i):
                        continue
                    width = int(bitmap_bits(n[s:e].mean())) * WIDE
                    x, y = code_bitmaps(codes[s:e], width), code_bitmaps(codes[t:u], width)
                    set_x, set_y = (np.bitwise_count(v).sum(1, dtype=np.int64) for v in (x, y))
                    for cut in range(0, len(i), CHUNK):
                        p, q = i[cut:cut + CHUNK], j[cut:cut + CHUNK]
                        both = np.bitwise_count(x[p] & y[q]).sum(1, dtype=np.int64)
                        # at most the shingles that are not seen to be missing
                        most = np.minimum(n[s + p] - set_x[p], n[t + q] - set_y[q]) + both
                        least = needed(n[s + p], n[t + q])
                        for k in np.flatnonzero(most >= least):
                            a, b = s + p[k], t + q[k]
                            if shared_codes(codes[a], codes[b]) + n[a] - len(codes[a]) >= least[k]:
                                out.append(np.array([[min(cid[a], cid[b]), max(cid[a], cid[b])]]))
        pair = np.concatenate(out)
        yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["a", "b"])


def _even_slices(batch: pa.RecordBatch):
    """Slices that are small on both sides of the pairs."""
    for part in slices(batch, "text_a", SLICE // 2):
        yield from slices(part, "text_b", SLICE // 2)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sorted shingle arrays overlap enough."""
    for batch in batches:
        for part in _even_slices(batch):
            sets = []
            for c in ("text_a", "text_b"):
                doc, h = shingle_sets(Words.of(part.column(c), lower=True))
                sets.append((doc, h, np.bincount(doc, minlength=part.num_rows)))
            doc = np.concatenate([sets[0][0], sets[1][0]])
            h = np.concatenate([sets[0][1], sets[1][1]])
            order = np.lexsort((h, doc))
            doc, h = doc[order], h[order]
            both = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
            shared = np.bincount(doc[1:][both], minlength=part.num_rows)
            union = sets[0][2] + sets[1][2] - shared
            yield part.select(["a", "b"]).filter(pa.array((100 * shared >= 75 * union) & (union > 0)))


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("ord"), F.xxhash64(text).alias("th"), text.alias("text"))


def _sieve(base: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``base`` whose text hash may be among ``ids``: a bitmap of
    ``SIEVE_BITS`` bits, of a fixed size whatever the input, keeps most texts
    that no pair needs out of the shuffle. The join that follows is exact."""
    bit = F.col("th").bitwiseAND(SIEVE_BITS - 1)
    words = ids.groupBy(F.shiftright(bit, 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(th & 63L as int))")).alias("v")).toArrow()
    bits = np.zeros(SIEVE_BITS // 64, np.int64)
    bits[words.column("w").to_numpy()] = words.column("v").to_numpy()
    shared = base.sparkSession.sparkContext.broadcast(np.unpackbits(bits.view(np.uint8), bitorder="little").view(bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value[np.asarray(batch.column("th")) & (SIEVE_BITS - 1)]))

    return base.mapInArrow(run, base.schema)


def _texts(base: DataFrame, ids: DataFrame) -> DataFrame:
    """One row (ord, th, text) for each of ``ids`` (ord, th, distinct)."""
    return _sieve(base, ids).join(ids, ["ord", "th"], "left_semi").groupBy("ord", "th").agg(F.first("text").alias("text"))


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted 32-bit codes of the shingles of each class."""
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            doc, h = shingle_sets(Words.of(part.column("text"), lower=True))
            bounds = np.searchsorted(doc, np.arange(part.num_rows + 1))
            small = (h >> _U(32)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [part.column("cid"), pa.array([np.unique(small[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())], names=["cid", "codes"])


def code_bitmaps(codes: list[np.ndarray], bits: int) -> np.ndarray:
    """Bitmaps of ``bits`` bits (a power of two) of some classes."""
    have = np.zeros((len(codes), bits), bool)
    for row, c in zip(have, codes):
        row[c & np.uint32(bits - 1)] = True
    return np.packbits(have, axis=1, bitorder="little").view(np.uint64)


def shared_codes(x: np.ndarray, y: np.ndarray) -> int:
    both = np.sort(np.concatenate([x, y]), kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _verify(base: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of class ids that link, decided on their texts."""
    wanted = materialise(pairs.select("a", "b").join(classes.select(F.col("cid").alias("a"), F.col("ord").alias("ord_a"), F.col("th").alias("th_a")), "a")
                         .join(classes.select(F.col("cid").alias("b"), F.col("ord").alias("ord_b"), F.col("th").alias("th_b")), "b"), "pairs")
    ids = materialise(wanted.select(F.col("ord_a").alias("ord"), F.col("th_a").alias("th")).union(wanted.select("ord_b", "th_b")).distinct(), "pair-ids")
    texts = _texts(base, ids)
    side = lambda s: texts.select(F.col("ord").alias(f"ord_{s}"), F.col("th").alias(f"th_{s}"), F.col("text").alias(f"text_{s}"))
    joined = wanted.join(side("a"), ["ord_a", "th_a"]).join(side("b"), ["ord_b", "th_b"])
    return materialise(joined.select("a", "b", "text_a", "text_b").mapInArrow(_linked, "a long, b long"), "linked")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Links of the components found so far, one for each node, and new ones."""
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links)


def _waiting(large: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, cid, n, band, root) of the large files whose classes fall into
    several components."""
    rooted = large.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    split = rooted.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("key")
    band = F.floor(F.log("n") / F.log(F.lit(4 / 3))).cast("long")
    return materialise(rooted.join(split, "key").select("key", "cid", "n", band.alias("band"), "root"), "waiting")


def _pivot_pairs(waiting: DataFrame, turn: int) -> DataFrame:
    """Pairs of different components of each class with two pivots of its
    band: one class dealt by lot, and one of a component dealt by lot, so that
    small components have their turn beside a large one."""
    lot = F.xxhash64("cid", F.lit(turn))
    pivots = waiting.groupBy("key", "band").agg(F.min_by(F.struct("cid", "root", "n"), lot).alias("x"),
                                                F.min_by(F.struct("cid", "root", "n"), F.struct(F.xxhash64("root", F.lit(turn)), lot)).alias("y"))
    pivots = pivots.select("key", "band", F.explode(F.array("x", "y")).alias("p"))
    met = waiting.join(pivots, ["key", "band"]).where("root <> p.root and 3 * greatest(n, p.n) <= 4 * least(n, p.n)")
    return met.select(F.expr("least(cid, p.cid)").alias("a"), F.expr("greatest(cid, p.cid)").alias("b")).distinct()


def _dealt(waiting: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tile of each row of ``waiting`` (key, cid, n, root, tile), and the
    pairs of tiles to be compared (tile, pair), a row for each of the two. A
    component of ``SPREAD`` classes or more in a band of a file has tiles of
    its own, which are not compared with each other; the rest share."""
    group = ["key", "band", "own"]
    count = waiting.groupBy("key", "band", "root").agg(F.count("*").alias("m")).withColumn("own", F.when(F.col("m") >= SPREAD, F.col("root")))
    slots = F.ceil(F.sum("m") / SPREAD).cast("long")
    sizes = count.groupBy(group).agg(slots.alias("slots"))
    tile = F.xxhash64("key", "band", "own", F.col("own").isNull(), "slot").alias("tile")
    rows = waiting.join(count.select("key", "band", "root", "own"), ["key", "band", "root"]).alias("w")
    rows = rows.join(sizes.alias("s"), F.expr("w.key = s.key and w.band = s.band and w.own <=> s.own")).select("w.*", "s.slots")
    rows = rows.withColumn("slot", F.pmod(F.xxhash64(F.when(F.col("own").isNull(), F.col("root")).otherwise(F.col("cid"))), "slots"))
    tiles = sizes.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1))).select("key", "band", "own", tile)
    one = tiles.select("key", F.explode(F.array("band", F.col("band") + 1)).alias("band"), F.col("band").alias("from"), F.col("own").alias("own_a"), F.col("tile").alias("a"))
    two = tiles.select("key", "band", F.col("own").alias("own_b"), F.col("tile").alias("b"))
    met = one.join(two, ["key", "band"]).where("(from < band or a <= b) and coalesce(own_a <> own_b, true)")
    pairs = met.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("tile"), F.xxhash64("a", "b").alias("pair"))
    return rows.select("key", "cid", "n", "root", tile), pairs


@contextmanager
def _small_batches(spark: SparkSession):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(ord, th, doc_id, n_shingles, component_id) of every row of ``docs``;
    ord and th identify a row by its id and text."""
    with _small_batches(docs.sparkSession):  # all steps in Python are run in here
        return _components(docs)


def _components(docs: DataFrame) -> DataFrame:
    base = _identified(docs)
    prof = materialise(base.mapInArrow(_profile, "ord long, th long, n long, cid long, bits binary, often array<long>, often_n array<long>"), "sets")
    often = prof.select(F.explode(F.arrays_zip("often", "often_n")).alias("x")).groupBy("x.often").agg(F.sum("x.often_n").alias("n"))
    top = often.orderBy(F.desc("n"), "often").limit(FREQUENT).select("often").toArrow()  # FREQUENT numbers at most
    frequent = np.asarray(top.column(0).combine_chunks())[::-1].view(np.uint64)

    # one row per class: its first document stands for it
    classes = materialise(prof.where("n > 0").groupBy("cid").agg(F.min(F.struct("ord", "th", "n", "bits")).alias("x")).select("cid", "x.*"), "classes")
    files = base.mapInArrow(_files(frequent), "key long, n long, cid long").repartition("key").sortWithinPartitions("key", "n", "cid")
    found = materialise(files.mapInArrow(_pairs_of_files, "kind int, a long, b long, n_b long"), "compare")

    pairs = found.where("kind = 0").select("a", "b").distinct()
    side = lambda s: classes.select(F.col("cid").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}"))
    sized = lambda x: x.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(_likely, "a long, b long")
    roots = connected(_verify(base, classes, sized(pairs)))

    large = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("cid"), F.col("n_b").alias("n")).distinct()
    waiting = _waiting(large, roots)
    for turn in range(ROUNDS):
        if waiting.isEmpty():
            break
        more = _verify(base, classes, sized(_pivot_pairs(waiting, turn)))
        if not more.isEmpty():
            roots = connected(_joined(roots, more))
            waiting = _waiting(large, roots)
    if not waiting.isEmpty():
        # narrow bitmaps first: few classes have a likely partner left, and only their texts are read
        rows, met = _dealt(waiting)
        met = rows.drop("key").join(classes.select("cid", "bits"), "cid").join(met, "tile").withColumnRenamed("pair", "key")
        met = met.repartition("key").sortWithinPartitions("key", "tile", "n", "cid").select("key", "tile", "n", "cid", "root", "bits")
        members = materialise(met.mapInArrow(_tile_members, "key long, tile long, n long, cid long, root long"), "members")
        ids = materialise(classes.join(members.select("cid").distinct(), "cid").select("ord", "th", "cid"), "member-ids")
        codes = _texts(base, ids.select("ord", "th").distinct()).join(ids, ["ord", "th"]).select("cid", "text").mapInArrow(_codes, "cid long, codes binary")
        tiles = members.join(codes, "cid").repartition("key").sortWithinPartitions("key", "tile", "n", "cid")
        rest = materialise(tiles.select("key", "tile", "n", "cid", "root", "codes").mapInArrow(_tiles, "a long, b long").distinct(), "tiles")
        if not rest.isEmpty():
            roots = connected(_joined(roots, _verify(base, classes, rest)))

    rows = prof.where("n > 0").select("ord", "th", "n", "cid")
    named = rows.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = named.groupBy("root").agg(F.min("ord").alias("least"))
    none = prof.where("n = 0").select("ord", "th", "n", F.col("ord").alias("least"))
    every = named.join(least, "root").select("ord", "th", "n", "least").union(none)
    return every.select("ord", "th", F.expr(f"nullif(ord, {LAST_ID}L)").alias("doc_id"), F.col("n").alias("n_shingles"),
                        F.expr(f"nullif(least, {LAST_ID}L)").alias("component_id"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component, with all its columns: that of the
    smallest doc_id (of rows that share it, the one of the smallest text
    hash). Documents without shingles have no copies and stay."""
    found = jaccard_components(docs)
    linked = found.where("n_shingles > 0").groupBy("component_id").agg(F.min(F.struct("ord", "th")).alias("x")).select("x.ord", "x.th")
    kept = materialise(linked.union(found.where("n_shingles = 0").select("ord", "th").distinct()), "kept")
    kept = kept.select(F.col("ord").alias("ord_"), F.col("th").alias("th_"))
    whole = docs.select(F.struct("*").alias("row_"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("ord_"),
                        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("th_"))
    return whole.join(kept, ["ord_", "th_"], "left_semi").groupBy("ord_", "th_").agg(F.first("row_").alias("row_")).select("row_.*")
