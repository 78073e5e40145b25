"""SentencePiece encoding and decoding by suffix-array matching.

Encoding works on the distinct units of a batch (a unit is a run of spaces
and what follows up to the next space; no piece reaches across units). Their
texts are laid end to end, the positions where a character starts are sorted
by what follows (a suffix array, ordered by ``DEPTH`` bytes, which is enough
for most pieces; the rest of longer pieces is compared byte by byte),
and every piece of the vocabulary is found by binary search as one range of
the array. The occurrences are edges from position to position. Sorted by
position they are relaxed in that order: a position keeps the one edge that
the encoding of the text up to there ends with.

For the BPE models handled here that edge is unique: a piece t after a piece
u stands in the encoding if and only if merging the characters of u + t by
rank ends in u, t. Such pairs are worked out once per worker and remembered.
Characters outside the vocabulary become byte pieces.

Decoding joins the pieces' bytes, turns the space mark into a space and drops
the one that encoding puts in front. The mark itself (U+2581) in a text means
a space, as in the public library, so it decodes to a space.

Defined results: null or empty text has no ids and decodes to the empty text.
Null doc_ids and repeated rows are rows like any other, other columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.text import _BASE, _BASE_INV, _BYTE_VALUE, powers, slices, span_hash, text_buffer

MARK = "▁"
SPACE, STOP = 0x20, 0xFF
DEPTH = 8
BATCH_BYTES = 1 << 22
MEMORY = 1 << 21
NOWHERE, BEGIN = -2, -1


class Pieces:
    """The vocabulary of a model and what is remembered about its pairs."""

    def __init__(self, model: bytes):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(self.size)]
        self.byte_id = np.full(256, sp.unk_id(), np.int32)
        self.rank: dict[str, float] = {}
        self.name = names
        normal, raw = [], []
        for i, name in enumerate(names):
            if sp.is_byte(i):
                self.byte_id[int(name[3:5], 16)] = i
                raw.append(bytes([int(name[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                raw.append(b"")
            else:
                normal.append(i)
                self.rank[name] = -sp.get_score(i)
                raw.append(name.replace(MARK, " ").encode())
        self.raw_size = np.array([len(x) for x in raw], np.int64)
        self.raw_first = np.concatenate([[0], np.cumsum(self.raw_size)])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.id = np.array(normal, np.int64)
        self.length = self.raw_size[self.id]
        words = np.zeros((len(normal), DEPTH), np.uint8)
        ends = np.full((len(normal), DEPTH), 0xFF, np.uint8)
        for k, i in enumerate(normal):
            own = np.frombuffer(raw[i][:DEPTH], np.uint8)
            words[k, :len(own)] = own
            ends[k, :len(own)] = own
        self.low, self.high = (np.ascontiguousarray(x).view(">u8").astype(np.uint64)[:, 0] for x in (words, ends))
        self.keys = np.full(MEMORY, -1, np.int64)
        self.fits = np.zeros(MEMORY, bool)

    def merged(self, left: str, right: str) -> bool:
        """Whether merging by rank ends in the two pieces as given."""
        parts, cut = list(left) + list(right), len(left)
        rank = self.rank
        pairs = [rank.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, r in enumerate(pairs):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if at < 0:
                break
            if at + 1 == cut:
                return False
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            if at + 1 < cut:
                cut -= 1
            del pairs[at]
            if at < len(pairs):
                pairs[at] = rank.get(parts[at] + parts[at + 1])
            if at:
                pairs[at - 1] = rank.get(parts[at - 1] + parts[at])
        return parts == ([left, right] if left else [right])

    def compatible(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """For pieces after others (BEGIN: at the start, or after bytes)."""
        key = (before.astype(np.int64) + 1) * self.size + piece
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(43)).astype(np.int64)
        new = self.keys[slot] != key
        if new.any():
            keys, back = np.unique(key[new], return_inverse=True)
            fits = np.empty(len(keys), bool)
            for i, k in enumerate(keys.tolist()):
                u, t = divmod(k, self.size)
                fits[i] = self.merged(self.name[u - 1] if u else "", self.name[t])
            got = np.empty(len(key), bool)
            got[~new] = self.fits[slot[~new]]
            got[new] = fits[back]
            self.keys[slot[new]] = key[new]
            self.fits[slot[new]] = fits[back]
            return got
        return self.fits[slot]


def suffix_array(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions ``at`` sorted by the DEPTH bytes from each on, and these
    bytes as numbers."""
    padded = np.concatenate([buf, np.full(DEPTH, STOP, np.uint8)]).astype(np.uint64)
    word = np.zeros(len(buf), np.uint64)
    for i in range(DEPTH):
        word = (word << np.uint64(8)) | padded[i:i + len(buf)]
    word = word[at]
    order = np.argsort(word)
    return at[order], word[order]


def edges(p: Pieces, buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, piece) of all occurrences of all pieces."""
    sa, word = suffix_array(buf, at)
    lo = np.searchsorted(word, p.low, "left")
    n = np.searchsorted(word, p.high, "right") - lo
    which = np.repeat(np.arange(len(n)), n)
    pos = sa[ranges(lo, n)]
    far = np.flatnonzero(p.length[which] > DEPTH)
    if len(far):
        ok = np.ones(len(which), bool)
        for i in range(DEPTH, int(p.length[which[far]].max())):
            far = far[(p.length[which[far]] > i) & ok[far]]
            q = np.minimum(pos[far] + i, len(buf) - 1)  # the last byte is a STOP
            ok[far] = buf[q] == p.raw[p.raw_first[p.id[which[far]]] + i]
        which, pos = which[ok], pos[ok]
    return pos, which


def encode_units(p: Pieces, buf: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of units, which stand at first[i] : first[i + 1] - 1 in ``buf``
    with a STOP after each; and their number per unit."""
    n = len(buf)
    end = first[1:] - 1
    starts_char = (buf & 0xC0) != 0x80
    starts_char[end] = False
    at = np.flatnonzero(starts_char)
    pos, which = edges(p, buf, at)
    # characters outside the vocabulary: an edge of their own
    known = np.zeros(n, bool)
    size = np.where(buf[at] < 0x80, 1, np.where(buf[at] < 0xE0, 2, np.where(buf[at] < 0xF0, 3, 4)))
    char_size = np.zeros(n, np.int64)
    char_size[at] = size
    known[pos[p.length[which] == char_size[pos]]] = True
    odd = at[~known[at]]
    other = p.size  # stands for any character outside the vocabulary
    pos = np.concatenate([pos, odd])
    piece = np.concatenate([p.id[which], np.full(len(odd), other)])
    length = np.concatenate([p.length[which], char_size[odd]])
    owner = np.repeat(np.arange(len(end)), np.diff(first))
    rel = pos + length - first[owner[pos]]
    top = int(rel.max(initial=0))
    order = np.argsort(rel.astype(np.uint16) if top < 1 << 16 else rel, kind="stable")
    pos, piece, length, rel = pos[order], piece[order], length[order], rel[order]
    last = np.full(n, NOWHERE, np.int64)
    came = np.zeros(n, np.int64)
    last[first[:-1]] = BEGIN
    bounds = np.flatnonzero(np.concatenate([[True], rel[1:] != rel[:-1], [True]])) if len(rel) else np.zeros(1, np.int64)
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        i, t = pos[lo:hi], piece[lo:hi]
        u = last[i]
        ok = (u != NOWHERE) & (t == other)
        ask = np.flatnonzero((u != NOWHERE) & (t != other))
        ok[ask] = p.compatible(np.where(u[ask] == other, BEGIN, u[ask]), t[ask])
        j = i[ok] + length[lo:hi][ok]
        last[j], came[j] = t[ok], i[ok]
    on_path = np.zeros(n, bool)
    cur = end.copy()
    begin = first[:-1].copy()
    while len(cur):
        on_path[cur] = True
        cur = came[cur]
        more = cur > begin
        cur, begin = cur[more], begin[more]
    ends = np.flatnonzero(on_path)
    token, start = last[ends], came[ends]
    count = np.where(token == other, ends - start, 1)
    ids = np.repeat(token, count)
    bytes_ = np.repeat(token == other, count)
    inner = np.arange(len(ids)) - np.repeat(np.cumsum(count) - count, count)
    ids[bytes_] = p.byte_id[buf[(np.repeat(start, count) + inner)[bytes_]]]
    return ids.astype(np.int32), np.bincount(owner[start], count, minlength=len(end)).astype(np.int64)


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (count[0] of them), first[1], ..."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


def encode(p: Pieces, col) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a text column, one after another, and len + 1 offsets."""
    raw, offsets = text_buffer(pc.replace_substring(col, MARK, " "))
    n = np.diff(offsets)
    size = n + (n > 0)  # a space in front of every text
    doc_first = np.concatenate([[0], np.cumsum(size)])
    buf = np.full(doc_first[-1], SPACE, np.uint8)
    if len(raw):
        buf[ranges(doc_first[:-1] + 1, n)] = raw
    if not len(buf):
        return np.zeros(0, np.int32), np.zeros(len(n) + 1, np.int64)
    opens = buf == SPACE
    opens[1:] &= buf[:-1] != SPACE
    opens[doc_first[:-1][n > 0]] = True
    first = np.flatnonzero(opens)
    end = np.concatenate([first[1:], [len(buf)]])
    prefix = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[buf] * powers(_BASE, len(buf)), out=prefix[1:])
    h = span_hash(prefix, powers(_BASE_INV, len(buf) + 1), first, end)
    _, one, back = np.unique(h, return_index=True, return_inverse=True)
    length = end[one] - first[one]
    unit_first = np.concatenate([[0], np.cumsum(length + 1)])
    units = np.full(unit_first[-1], STOP, np.uint8)
    units[ranges(unit_first[:-1], length)] = buf[ranges(first[one], length)]
    ids, count = encode_units(p, units, unit_first)
    id_first = np.cumsum(count) - count
    out = ids[ranges(id_first[back], count[back])]
    unit_doc = np.searchsorted(doc_first, first, side="right") - 1
    return out, np.concatenate([[0], np.cumsum(np.bincount(unit_doc, count[back], minlength=len(n)))]).astype(np.int64)


def decode(p: Pieces, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The texts behind runs of ids."""
    size = p.raw_size[ids]
    raw = p.raw[ranges(p.raw_first[ids], size)].tobytes()
    ends = np.concatenate([[0], np.cumsum(size)])[offsets]
    return [raw[a + (raw[a:a + 1] == b" "):b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _codec(make):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = None
        for batch in batches:
            p = p or make()
            for part in slices(batch, limit=BATCH_BYTES):
                ids, offsets = encode(p, part.column("text").cast(pa.large_string()))
                texts = decode(p, ids, offsets)
                same = [t == (x.as_py() or "").replace(MARK, " ").encode() for t, x in zip(texts, part.column("text"))]
                keys = [hashlib.sha256(ids[a:b].tobytes()).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]
                rest = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in rest), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)), pa.array(np.diff(offsets)),
                     pa.array(keys, pa.string()), pa.array([t.decode() for t in texts], pa.string()), pa.array(same, pa.bool_())],
                    names=[*rest, "ids", "n_tokens", "ids_sha256", "decoded", "round_trip"])
    return run


def code(docs: DataFrame, model_path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``keep``, ids, n_tokens, ids_sha256 (of the ids as 32-bit
    little-endian numbers), decoded, round_trip of every row. ``model_path``
    is a model file that the driver can read; it is sent to the tasks (under
    1 MB)."""
    with open(model_path, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    kept = [F.col(c).cast("string").alias(c) for c in keep]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *kept, F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id long, " + "".join(f"`{c}` string, " for c in keep) + "ids array<int>, n_tokens long, ids_sha256 string, decoded string, round_trip boolean"

    def run(batches):
        yield from _codec(lambda: Pieces(content.value))(batches)

    return rows.mapInArrow(run, schema)
