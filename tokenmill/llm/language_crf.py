"""Language ID with a linear-chain conditional random field over words.

Every word gets a label (a language). Its emission score sums learned weights
of its byte n-grams (with markers at both ends, so the outer ones are its
affixes) and of the word itself if it is in the lexicon of training words;
labels of neighbours are tied by learned transitions. Forward-backward gives
each word's label probabilities, so text that switches languages is labelled
part by part. A document's language has the highest mean probability over its
words with letters, and that mean is the score. The filter goes by the words'
own certainty (the mean of each word's highest probability), so a text in
several languages stays if its words are told.

Training: at most ``TRAIN_DOCS`` documents per language and ``TRAIN_TOTAL``
together (those of smallest hash among labelled rows that are not held out and
have at most ``TRAIN_CHARS`` characters), cut into spans that are strung together across
languages so that switches occur. That sample is bounded, so it is fitted on
the driver; everything else reads whole texts in Spark tasks.

Long documents are not cut: words are dealt into segments of ``SEGMENT``, each
segment's product of step matrices is made for all segments at once, and the
messages between segments are passed along the document.

Defined results: null text, or text without a letter, is ``und`` with score
0. A null doc_id is neither learned from nor held out. Ties go to the label
that sorts first. With nothing to learn from, all is ``und``. Repeated rows
are rows like any other, other columns are not read, an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.llm.scratch import materialise
from tokenmill.llm.text import _LOWER, Words, forget_powers, mix, slices

TRAIN_DOCS = 300
TRAIN_TOTAL = 8_000
TRAIN_CHARS = 20_000
#: Bytes of training texts that are hashed at a time.
TRAIN_SLICE = 1 << 17
HASH_BITS = 18
ORDERS = (2, 3, 4)
SEGMENT = 32
SPAN = (3, 24)
EPOCHS = 3
BATCH = 256
CHAIN = 48
RATE = 0.25
SHRINK = 1e-6
#: The least mean of the words' highest probabilities of a document that the
#: filter keeps.
LEAST_SCORE = 0.5
_U = np.uint64


@dataclass
class Crf:
    labels: list[str]
    grams: np.ndarray  # 2 ** HASH_BITS x labels
    lexicon: np.ndarray  # sorted word hashes
    words: np.ndarray  # lexicon x labels, the last row for unknown words
    start: np.ndarray
    step: np.ndarray  # from x to

    def save(self) -> dict:
        return dict(labels=self.labels, grams=self.grams, lexicon=self.lexicon, words=self.words, start=self.start, step=self.step)


def word_features(w: Words, at: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """For the words ``at``: for each order the hashed n-grams of all words in
    a row, and where each word begins among them."""
    n = w.end[at] - w.start[at]
    size = n + 3
    base = np.concatenate([[0], np.cumsum(size)])
    buf = np.full(base[-1], 2, np.uint8)  # the markers: 1 before, 2 after
    buf[base[:-1]] = 1
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    buf[np.repeat(base[:-1] + 1, n) + inner] = _LOWER[w.raw[np.repeat(w.start[at], n) + inner]]
    wide = buf.astype(np.uint64)
    out = []
    for order in ORDERS:
        code = np.full(max(len(buf) - order + 1, 0), order, np.uint64)
        for i in range(order):
            code = code * _U(257) + wide[i:len(buf) - order + 1 + i]
        keep = np.ones(len(buf), bool)
        for i in range(1, order):
            keep[base[1:] - i] = False
        out.append((mix(code)[keep[:len(code)]] & _U((1 << HASH_BITS) - 1)).astype(np.int64))
    return base, out


def emissions(crf_grams, lexicon, word_weights, w: Words, at: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Scores (words x labels) of the words ``at`` with hashes ``h``."""
    base, grams = word_features(w, at)
    out = word_weights[lexicon_place(lexicon, h)].astype(np.float32)
    for order, idx in zip(ORDERS, grams):
        starts = base[:-1] - np.arange(len(at)) * (order - 1)
        out += np.add.reduceat(crf_grams[idx], starts, axis=0)
    return out


def lexicon_place(lexicon: np.ndarray, h: np.ndarray) -> np.ndarray:
    if not len(lexicon):
        return np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(lexicon, h), len(lexicon) - 1)
    return np.where(lexicon[at] == h, at, len(lexicon))


def marginals(score: np.ndarray, first: np.ndarray, start: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Label probabilities of every word. ``first`` bounds the sequences in
    ``score``; an empty sequence is fine."""
    total, k = score.shape
    if not total:
        return score
    e = np.exp(score - score.max(1, keepdims=True)).astype(np.float64) + 1e-30
    hop, pi = np.exp(step - step.max()), np.exp(start - start.max())
    count = np.diff(first)
    segs = -(-count // SEGMENT)
    seq = np.repeat(np.arange(len(count)), segs)
    rank = np.arange(len(seq)) - np.repeat(np.cumsum(segs) - segs, segs)
    lo = first[seq] + rank * SEGMENT
    length = np.minimum(SEGMENT, first[seq + 1] - lo)
    grid = np.ones((len(seq), SEGMENT, k))
    inside = np.arange(SEGMENT) < length[:, None]
    grid[inside] = e  # segments follow the words' order
    opens = rank == 0

    def norm(x):
        x /= x.sum(axis=tuple(range(1, x.ndim)), keepdims=True)
        return x

    # product of the step matrices of each segment
    prod = np.where(opens[:, None, None], np.eye(k), hop) * grid[:, 0][:, None, :]
    for t in range(1, SEGMENT):
        live = length > t
        if not live.any():
            break
        nxt = (prod[live].reshape(-1, k) @ hop).reshape(-1, k, k) * grid[live, t][:, None, :]
        prod[live] = norm(nxt)
    # messages between segments, one step for all sequences at a time
    enter = np.ones((len(seq), k))
    leave = np.ones((len(seq), k))
    order = np.argsort(rank, kind="stable")
    cuts = np.searchsorted(rank[order], np.arange(rank.max() + 2))
    enter[opens] = pi
    for r in range(rank.max()):
        nxt = order[cuts[r + 1]:cuts[r + 2]]
        enter[nxt] = norm(np.einsum("ni,nij->nj", enter[nxt - 1], prod[nxt - 1]))
    for r in range(rank.max(), 0, -1):
        cur = order[cuts[r]:cuts[r + 1]]
        leave[cur - 1] = norm(np.einsum("nij,nj->ni", prod[cur], leave[cur]))
    # inside the segments
    ahead = np.empty_like(grid)
    msg = np.where(opens[:, None], enter, enter @ hop) * grid[:, 0]
    ahead[:, 0] = norm(msg)
    for t in range(1, SEGMENT):
        msg = np.where((length > t)[:, None], (ahead[:, t - 1] @ hop) * grid[:, t], ahead[:, t - 1])
        ahead[:, t] = norm(msg)
    back = leave
    for t in range(SEGMENT - 1, -1, -1):
        live = (length > t)[:, None]
        ahead[:, t] *= np.where(live, back, 1)
        back = np.where(live, norm((back * grid[:, t]) @ hop.T), back)
    out = ahead[inside]
    return out / out.sum(1, keepdims=True)


def train(texts: list[str], langs: list[str], seed: int = 5) -> Crf:
    """Fit a field to labelled texts by stochastic gradient (Adagrad)."""
    labels = sorted(set(langs))
    k = len(labels)
    rng = np.random.default_rng(seed)
    sample = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], names=["text"])
    w = Words.of(sample.column("text"), lower=True)
    # slice by slice: the driver would keep the prefix sums of the whole sample
    w.hash = np.concatenate([np.zeros(0, np.uint64), *(Words.of(part.column("text"), lower=True).hash for part in slices(sample, limit=TRAIN_SLICE))])
    label = np.array([labels.index(x) for x in langs], np.int64)[w.doc] if texts else np.zeros(0, np.int64)
    seen, counts = np.unique(w.hash, return_counts=True)
    lexicon = seen[counts >= 5]
    crf = Crf(labels, np.zeros((1 << HASH_BITS, k), np.float32), lexicon, np.zeros((len(lexicon) + 1, k), np.float32), np.zeros(k), np.zeros((k, k)))
    if not len(w.start):
        return crf
    # spans of one document each, strung together in random order
    cuts, at = [], 0
    for n in w.count:
        stop = at + int(n)
        while at < stop:
            size = int(rng.integers(SPAN[0], SPAN[1] + 1))
            cuts.append((at, min(at + size, stop)))
            at += size
        at = stop
    memory = [np.full(x.shape, 1e-2, x.dtype) for x in (crf.grams, crf.words, crf.start, crf.step)]
    for _ in range(EPOCHS):
        # neighbours often share a language, as in running text
        order = rng.permutation(len(cuts))
        words = np.concatenate([np.arange(*cuts[i]) for i in order])
        for lo in range(0, len(words), BATCH * CHAIN):
            at = words[lo:lo + BATCH * CHAIN]
            first = np.arange(0, len(at) + CHAIN, CHAIN).clip(max=len(at))
            score = emissions(crf.grams, lexicon, crf.words, w, at, w.hash[at])
            prob = marginals(score, first, crf.start, crf.step)
            want = np.eye(k)[label[at]]
            miss = (prob - want).astype(np.float32)
            head = first[:-1][np.diff(first) > 0]
            pairs = np.setdiff1d(np.arange(1, len(at)), head)
            # expected transitions from neighbours' pair probabilities
            hop = np.exp(crf.step - crf.step.max())
            joint = pair_marginals(score, prob, pairs, hop)
            g_step = joint.sum(0) - want[pairs - 1].T @ want[pairs]
            g_start = (prob[head] - want[head]).sum(0)
            base, grams = word_features(w, at)
            g_grams = np.zeros_like(crf.grams)
            for order_n, idx in zip(ORDERS, grams):
                owner = np.repeat(np.arange(len(at)), np.diff(base) - order_n + 1)
                for c in range(k):
                    g_grams[:, c] += np.bincount(idx, miss[owner, c], 1 << HASH_BITS).astype(np.float32)
            place = lexicon_place(lexicon, w.hash[at])
            g_words = np.stack([np.bincount(place, miss[:, c], len(lexicon) + 1) for c in range(k)], 1).astype(np.float32)
            for x, g, m in zip((crf.grams, crf.words, crf.start, crf.step), (g_grams, g_words, g_start, g_step), memory):
                g = g + SHRINK * x
                m += g * g
                x -= RATE * g / np.sqrt(m)
    return crf


def pair_marginals(score: np.ndarray, prob: np.ndarray, pairs: np.ndarray, hop: np.ndarray) -> np.ndarray:
    """Joint probabilities of (word - 1, word), from the words' own by fitting
    the pair potentials to both margins (exact for a chain's pair beliefs)."""
    a, b = prob[pairs - 1], prob[pairs]
    joint = np.broadcast_to(hop, (len(pairs), *hop.shape)).copy()
    for _ in range(8):
        joint *= (a / joint.sum(2))[:, :, None]
        joint *= (b / joint.sum(1))[:, None, :]
    return joint


def _label(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = model["labels"]
        for batch in batches:
            for part in slices(batch):
                w = Words.of(part.column("text"), lower=True)
                n = part.num_rows
                pred, best, certain = np.full(n, "und", object), np.zeros(n), np.zeros(n)
                if labels and len(w.start):
                    _, one, back = np.unique(w.hash, return_index=True, return_inverse=True)
                    score = emissions(model["grams"], model["lexicon"], model["words"], w, one, w.hash[one])[back]
                    prob = marginals(score, w.first, model["start"], model["step"])
                    letter = np.zeros(len(w.raw) + 1, np.int64)
                    np.cumsum((w.raw >= 128) | ((w.raw >= 97) & (w.raw <= 122)), out=letter[1:])
                    votes = prob * (letter[w.end] > letter[w.start])[:, None]
                    total = np.stack([np.bincount(w.doc, votes[:, c], n) for c in range(len(labels))], 1)
                    mass = total.sum(1)
                    some = (mass > 0) & np.asarray(part.column("letters").to_numpy(zero_copy_only=False), bool)
                    top = total.argmax(1)
                    pred[some] = np.array(labels, object)[top[some]]
                    best[some] = np.clip(total[some, top[some]] / mass[some], 0, 1)
                    certain[some] = np.clip(np.bincount(w.doc, votes.max(1), n)[some] / mass[some], 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in part.schema.names if c not in ("text", "letters")), pa.array(pred.tolist(), pa.string()), pa.array(best), pa.array(certain)],
                    names=[*(c for c in part.schema.names if c not in ("text", "letters")), "lang_pred", "score", "certain"])
    return run


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame) -> Crf:
    """Train on the bounded sample of the labelled rows of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").alias("text"))
    fit_for = rows.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") <= TRAIN_CHARS) & F.col("text").rlike(r"\p{L}"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "lang"), "doc_id", "key"))
    keys = fit_for.select("lang", "doc_id", F.xxhash64("text").alias("key")).withColumn("place", place).where(F.col("place") <= TRAIN_DOCS)
    picked = materialise(keys.orderBy("place", "lang").limit(TRAIN_TOTAL).select("doc_id", "key").distinct(), "sample")
    sample = fit_for.join(picked, (fit_for.doc_id == picked.doc_id) & (F.xxhash64(fit_for.text) == picked.key), "left_semi")
    got = sample.orderBy("lang", F.xxhash64("doc_id", "text")).select("lang", "text").limit(TRAIN_TOTAL).collect()
    crf = train([r["text"] for r in got], [r["lang"] for r in got])
    forget_powers()
    return crf


def _told(docs: DataFrame, crf: Crf) -> DataFrame:
    """doc_id, key (of the text), held_out, lang_pred, score, certain (the
    mean of the words' highest probabilities) of every row."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(crf.save())  # fixed size per label
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
                       F.coalesce(held_out(F.col("doc_id").cast("long")), F.lit(False)).alias("held_out"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"), F.col("text").alias("text"))

    def run(batches):
        yield from _label(model.value)(batches)

    return rows.mapInArrow(run, "doc_id long, key long, held_out boolean, lang_pred string, score double, certain double")


def predict(docs: DataFrame, crf: Crf) -> DataFrame:
    """doc_id, key (of the text), held_out, lang_pred, score of every row."""
    return _told(docs, crf).drop("certain")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs))


def crc_held_out(doc_id: int) -> bool:
    """The same split outside Spark, for tests."""
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def drop_unidentified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose words' languages are told with enough
    certainty, whether they have one language or several."""
    found = _told(docs, fit(docs)).where((F.col("lang_pred") != "und") & (F.col("certain") >= LEAST_SCORE))
    kept = materialise(found.select(F.col("doc_id").alias("id_"), F.col("key").alias("key_")).distinct(), "identified")
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(kept.id_) & (key == kept.key_), "left_semi")
