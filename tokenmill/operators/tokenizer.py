"""Tokenizer jobs.

* pre-tokenisation is one native ``regexp_extract_all`` (no UDF);
* the pre-token histogram is a map-side-combined ``groupBy(piece)``;
* BPE training runs over the *word table* (distinct pieces with counts), never
  over the corpus again; a round settles hundreds or thousands of merges from
  the distinct runs of frequent pairs, then changes words and pair counts;
  both are written to the folder of ``spark.checkpoint.dir``;
* encoding and decoding are one pass per document batch without a shuffle;
  merge ranks or token bytes are broadcast (their size is the vocabulary's)
  and workers code the distinct pieces of a slice of documents once.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.functions.text import utf8_byte_ids
from tokenmill.session import scratch_path

# fixed values: special tokens in id order, and the pre-tokenisation pattern
SPECIAL_TOKENS = [
    "<|bos|>", "<|user_start|>", "<|user_end|>", "<|assistant_start|>", "<|assistant_end|>",
    "<|python_start|>", "<|python_end|>", "<|output_start|>", "<|output_end|>",
]
SPLIT_PATTERN = (r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,2}| ?[^\s\p{L}\p{N}]++[\r\n]*"""
                 r"""|\s*[\r\n]|\s+(?!\S)|\s+""")
N_BYTES = 256


def special_id(name: str, n_merges: int = 0) -> int:
    """Specials come after the byte ids and the merges."""
    return N_BYTES + n_merges + SPECIAL_TOKENS.index(name)


BOS = special_id("<|bos|>")


# ------------------------------------------------------------ pre-tokens --

def pretokenize(text) -> Column:
    """Pieces of the GPT-4-style split (digits in groups of 1-2)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(c, F.lit("(?U)" + SPLIT_PATTERN), 0)


def pretoken_histogram(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Count per distinct piece (partial counts combine before the shuffle)."""
    return (docs.select(F.explode(pretokenize(text_col)).alias("piece"))
                .groupBy("piece").agg(F.count("*").alias("freq")))


# ----------------------------------------------------------- byte level --

def byte_tokens(text, bos: bool = True) -> Column:
    """UTF-8 bytes as ids 0-255, optionally prefixed by BOS (256)."""
    ids = utf8_byte_ids(text)
    return F.concat(F.array(F.lit(BOS)), ids) if bos else ids


def byte_vocab(spark: SparkSession) -> DataFrame:
    """Byte tokenizer vocabulary: 256 byte ids + 9 specials (``hex`` of the
    token bytes; specials carry their name)."""
    byte_rows = spark.range(N_BYTES).select(F.col("id").cast("int").alias("token_id"),
                                            F.lpad(F.hex("id"), 2, "0").alias("hex"),
                                            F.lit(False).alias("is_special"))
    sp = spark.createDataFrame([(N_BYTES + i, None, True) for i in range(len(SPECIAL_TOKENS))],
                               "token_id int, hex string, is_special boolean")
    return byte_rows.unionByName(sp)


@F.pandas_udf(T.IntegerType())
def _decoded_utf8_len(hexes: pd.Series) -> pd.Series:
    """Bytes after a lenient UTF-8 decode (invalid bytes become U+FFFD)."""
    return hexes.map(lambda h: None if h is None else
                     len(bytes.fromhex(h).decode("utf-8", errors="replace").encode("utf-8"))).astype("Int32")


def token_bytes(vocab: DataFrame, exact: bool = False, zero_specials: bool = True) -> DataFrame:
    """``n_bytes`` per token: UTF-8 length of the *decoded* token (a lone
    continuation byte decodes to U+FFFD and counts 3); 0 for specials.
    ``exact=True`` counts the raw bytes instead; ``zero_specials=False`` is
    the variant that counts a special's own text. The vocabulary is a small
    bounded table, so the lenient decode runs as a pandas UDF over it."""
    n = F.octet_length(F.unhex("hex")) if exact else _decoded_utf8_len(F.col("hex"))
    if zero_specials:
        n = F.when(F.col("is_special"), F.lit(0)).otherwise(n)
    else:
        names = F.array(*[F.lit(t) for t in SPECIAL_TOKENS])
        first_special = vocab.filter(F.col("is_special")).select(F.min("token_id")).scalar()
        n = F.when(F.col("is_special"), F.octet_length(F.get(names, F.col("token_id") - first_special))) \
             .otherwise(n)
    return vocab.select("token_id", n.cast("int").alias("n_bytes"))


def token_bytes_stats(tb: DataFrame) -> DataFrame:
    nz = F.when(F.col("n_bytes") > 0, F.col("n_bytes"))
    return tb.agg(F.sum(F.when(F.col("n_bytes") == 0, 1).otherwise(0)).cast("long").alias("n_zero"),
                  F.min(nz).alias("min_bytes"), F.max(nz).alias("max_bytes"),
                  F.avg(nz).alias("mean_bytes"), F.stddev_samp(nz).alias("std_bytes"))


# ------------------------------------------------------------ char vocab --

def char_vocab(words: DataFrame, col: str = "word") -> DataFrame:
    """Sorted distinct characters -> ids 0..n-1 (BOS = n)."""
    from tokenmill.plans.positions import global_position
    chars = words.select(F.explode(F.split(col, "", -1)).alias("ch")).filter(F.length("ch") > 0).distinct()
    return global_position(chars, ["ch"], (), out="char_id")


def char_encode(words: DataFrame, vocab: DataFrame, col: str = "word", key: str = "word") -> DataFrame:
    """Long form ``(word, pos, token_id)`` with BOS at both ends."""
    n = vocab.select(F.count("*")).scalar()
    ex = words.select(key, F.posexplode(F.split(col, "", -1)).alias("pos", "ch")).filter(F.length("ch") > 0)
    body = ex.join(vocab, "ch").select(key, (F.col("pos") + 1).alias("pos"),
                                                   F.col("char_id").alias("token_id"))
    ends = words.select(key, F.explode(F.array(F.lit(0), F.length(col) + 1)).alias("pos"),
                        n.cast("long").alias("token_id"))
    return body.unionByName(ends)


# ---------------------------------------------------------------- BPE --

ID_BASE = 0x10000      # a token id is written as the character ID_BASE + id
FIRST_HOT = 64         # pairs that the first round of training may merge
MOST_HOT = 1 << 15     # and any round
MOST_RUNS = 1 << 18    # distinct runs that a round fetches at most


def word_table(hist: DataFrame) -> DataFrame:
    """``(word STRING, freq)`` from a piece histogram; a word is a string with
    one character per token id."""
    code = F.array_join(F.transform(utf8_byte_ids("piece"), lambda b: F.lpad(F.hex(b + ID_BASE), 8, "0")), "")
    return hist.select(F.decode(F.unhex(code), "UTF-32").alias("word"), F.col("freq").cast("long").alias("freq")) \
               .groupBy("word").agg(F.sum("freq").alias("freq"))


NO_RANK = 1 << 62
LONG_WORD = 256        # ids; longer words are merged one by one


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all words in a row, and where each word starts (then
    the end)."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    words = words.cast(pa.large_string())
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    return np.frombuffer(words.buffers()[2] or b"", np.uint8)[at[0]:at[-1]].astype(np.int64), at - at[0]


def _flat(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words in a row, and where each word starts (then the
    end). All characters from ID_BASE on take four bytes."""
    b, at = _bytes(words)
    b = b.reshape(-1, 4)
    return ((b[:, 0] & 7) << 18 | (b[:, 1] & 63) << 12 | (b[:, 2] & 63) << 6 | b[:, 3] & 63) - ID_BASE, at // 4


def _spelt(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    """The words of ids in a row."""
    c = ids + ID_BASE
    b = np.stack([0xF0 | c >> 18, 0x80 | c >> 12 & 63, 0x80 | c >> 6 & 63, 0x80 | c & 63], axis=1).astype(np.uint8)
    return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer((4 * at).astype(np.int64)), pa.py_buffer(b.tobytes())).cast(pa.string())


def _neighbours(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of each id and the next, and whether both are in one word."""
    inside = np.ones(max(0, len(ids) - 1), bool)
    ends = at[1:-1] - 1
    inside[ends[(ends >= 0) & (ends < len(inside))]] = False
    return ids[:-1] << 32 | ids[1:], inside


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of stretches, one after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def merge_ranks(merges) -> tuple[np.ndarray, np.ndarray]:
    """Pair codes of ``merges``, ascending, and their new ids."""
    m = np.array(merges, np.int64).reshape(-1, 3)
    code = m[:, 0] << 32 | m[:, 1]
    order = np.argsort(code)
    return code[order], m[order, 2]


def merge_words(ids: np.ndarray, at: np.ndarray, ranks: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All words after the merges of ``ranks``, as flat ids and starts. In
    every step each word has its lowest-ranked pair merged wherever it stands,
    from the left; words without such a pair are done and leave the step."""
    codes, new = ranks
    n_words, sizes = len(at) - 1, np.diff(at)
    if not len(codes) or not len(ids):
        return ids, at
    of = np.repeat(np.arange(n_words), sizes)
    done = []
    if (sizes > LONG_WORD).any():
        table = {(c >> 32, c & 0xFFFFFFFF): x for c, x in zip(codes.tolist(), new.tolist())}
        for w in np.flatnonzero(sizes > LONG_WORD):
            got = np.array(encode_piece(ids[at[w]:at[w + 1]].tolist(), table), np.int64)
            done.append((got, np.full(len(got), w)))
        short = sizes[of] <= LONG_WORD
        ids, of = ids[short], of[short]

    def rank_at(i):
        code = ids[i] << 32 | ids[i + 1]
        k = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        return np.where((codes[k] == code) & (of[i] == of[i + 1]), new[k], NO_RANK)

    rank = np.append(rank_at(np.arange(len(ids) - 1)), NO_RANK)[:len(ids)]
    while len(ids):
        starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(ids))))
        live = best < NO_RANK
        if not live.all():
            done.append((ids[~live], of[~live]))
            ids, of, rank, best = ids[live], of[live], rank[live], best[live]
        hit = rank == best
        after = np.zeros_like(hit)
        after[1:] = hit[:-1]
        if (hit & after).any():  # a pair of equal ids: every other one of a stretch
            i = np.arange(len(hit))
            hit &= (i - np.maximum.accumulate(np.where(hit & ~after, i, 0))) % 2 == 0
            after[1:] = hit[:-1]
        ids = np.where(hit, rank, ids)[~after]
        of, rank, hit = of[~after], rank[~after], hit[~after]
        anew = hit.copy()  # a merge changes the pair at its place and the one before
        anew[:-1] |= hit[1:]
        rank[anew] = NO_RANK
        anew = np.flatnonzero(anew[:-1])
        rank[anew] = rank_at(anew)
    ids, of = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(of, kind="stable")
    return ids[order], np.searchsorted(of[order], np.arange(n_words + 1))


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of ``n``, without those of sum 0."""
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    sums = np.add.reduceat(n, starts) if len(keys) else n
    return keys[starts][sums != 0], sums[sums != 0]


def _pair_sums(df: DataFrame, *signs: tuple[str, int]) -> DataFrame:
    """``(pair, n)``: pairs of the named word columns, times their signs and
    ``freq``, added up in each batch."""
    def run(batches):
        for batch in batches:
            freq = np.asarray(batch.column("freq"))
            found = []
            for name, sign in signs:
                ids, at = _flat(batch.column(name))
                code, inside = _neighbours(ids, at)
                found.append((code[inside], np.repeat(sign * freq, np.diff(at))[:-1][inside]))
            code, n = _summed(*(np.concatenate(x) for x in zip(*found)))
            pair = np.stack([code >> 32, code & 0xFFFFFFFF], axis=1).ravel()
            yield pa.RecordBatch.from_arrays([_spelt(pair, np.arange(0, len(pair) + 1, 2)), pa.array(n, pa.int64())], ["pair", "n"])

    return df.select(*[name for name, _ in signs], "freq").mapInArrow(run, "pair string, n long")


def pair_counts(words: DataFrame) -> DataFrame:
    """``(pair, n)``: how often two ids stand next to each other."""
    return _pair_sums(words.where("length(word) > 1"), ("word", 1)).groupBy("pair").agg(F.sum("n").alias("n"))


def changed_counts(counts: DataFrame, rewritten: DataFrame) -> DataFrame:
    """``counts`` after a round: only words that it changed take part, with
    their old pairs taken off and their new ones added."""
    delta = _pair_sums(rewritten.where("old is not null"), ("old", -1), ("word", 1))
    return counts.unionByName(delta).groupBy("pair").agg(F.sum("n").alias("n")).where("n > 0")


def hot_runs(words: DataFrame, hot: list[str]) -> DataFrame:
    """``(run, freq)``: the longest stretches of words whose neighbours are
    all hot pairs, with how often each occurs."""
    shared = words.sparkSession.sparkContext.broadcast(np.sort(np.array([(ord(p[0]) - ID_BASE) << 32 | ord(p[1]) - ID_BASE for p in hot], np.int64)))

    def cut(batches):
        codes = shared.value
        for batch in batches:
            ids, at = _flat(batch.column("word"))
            code, inside = _neighbours(ids, at)
            k = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            edge = np.diff(np.concatenate([[False], inside & (codes[k] == code), [False]]).astype(np.int8))
            starts, sizes = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - np.flatnonzero(edge == 1) + 1
            runs = _spelt(ids[_gather(starts, sizes)], np.append(0, np.cumsum(sizes)))
            freq = np.asarray(batch.column("freq"))[np.searchsorted(at, starts, side="right") - 1]
            summed = pa.table({"run": runs, "freq": pa.array(freq, pa.int64())}).group_by("run").aggregate([("freq", "sum")])
            yield from summed.select(["run", "freq_sum"]).rename_columns(["run", "freq"]).to_batches()

    runs = words.select("word", "freq").where("length(word) > 1").mapInArrow(cut, "run string, freq long")
    return runs.groupBy("run").agg(F.sum("freq").alias("freq"))


def replay(runs: list[tuple[str, int]], last: tuple[int, int, int] | None, first_id: int, most: int) -> list[tuple[int, int, int]]:
    """Greedy merges over ``runs`` while the best pair is not worse than
    ``last`` (-count, a, b), at most ``most``. Counts are kept by deltas, and
    an index from pair to runs names those that a merge touches."""
    ids = [[ord(c) - ID_BASE for c in run] for run, _ in runs]
    count: dict[tuple[int, int], int] = {}
    where: dict[tuple[int, int], set[int]] = {}
    for k, (_, freq) in enumerate(runs):
        for pair in zip(ids[k], ids[k][1:]):
            count[pair] = count.get(pair, 0) + freq
            where.setdefault(pair, set()).add(k)
    heap = [(-n, *pair) for pair, n in count.items()]
    heapq.heapify(heap)
    merges: list[tuple[int, int, int]] = []
    while heap and len(merges) < most:
        best = heapq.heappop(heap)
        a, b = best[1:]
        now = count.get((a, b), 0)
        if -best[0] != now:
            if now:  # stale: its present count is entered again
                heapq.heappush(heap, (-now, a, b))
            continue
        if last is not None and best > last:
            break
        new = first_id + len(merges)
        merges.append((a, b, new))
        touched = set()
        for k in where.pop((a, b)):
            old, freq = ids[k], runs[k][1]
            out, i = [], 0
            while i < len(old):
                if old[i] == a and i + 1 < len(old) and old[i + 1] == b:
                    out.append(new)
                    i += 2
                else:
                    out.append(old[i])
                    i += 1
            for pair in zip(old, old[1:]):
                count[pair] -= freq
            for pair in zip(out, out[1:]):
                count[pair] = count.get(pair, 0) + freq
                where.setdefault(pair, set()).add(k)
                if new in pair:
                    touched.add(pair)
            ids[k] = out
        count.pop((a, b))
        for pair in touched:
            heapq.heappush(heap, (-count[pair], *pair))
    return merges


def rewrite(words: DataFrame, merges) -> DataFrame:
    """``(old, word, freq)``: every word after ``merges``, in order; ``old`` is
    null where none applies. Words of one id have no pair left and go."""
    shared = words.sparkSession.sparkContext.broadcast(merge_ranks(merges))

    def run(batches):
        for batch in batches:
            ids, at = _flat(batch.column("word"))
            new, new_at = merge_words(ids, at, shared.value)
            same = pa.array(np.diff(at) == np.diff(new_at))
            old = pc.if_else(same, pa.scalar(None, pa.string()), batch.column("word").cast(pa.string()))
            yield pa.RecordBatch.from_arrays([old, _spelt(new, new_at), batch.column("freq")], ["old", "word", "freq"])

    return words.select("word", "freq").where("length(word) > 1").mapInArrow(run, "old string, word string, freq long")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def train_bpe(hist: DataFrame, vocab_size: int, most_runs: int = MOST_RUNS, first_hot: int = FIRST_HOT) -> list[tuple[int, int, int]]:
    """Greedy byte-level BPE: ``vocab_size - 256 - 9`` merges, or as many as
    the corpus allows, as ``[(a, b, new_id)]`` in order.

    Each merge is the most frequent pair (count desc, then pair asc - our tie
    rule). A round takes the best pairs of the count table, *hot* ones, and
    cuts the words into runs of hot pairs. Equal runs are added up in Spark,
    so few distinct ones are left of any number of words; the driver fetches
    them (their number is checked; above ``most_runs`` the round is repeated
    with fewer hot pairs) and replays the merges there with counts by deltas
    and an index. That is exact while the best pair is not worse than the last
    hot one: other pairs only get rarer, and a pair that a merge makes across
    the end of a run occurs at most as often as the cold pair that was there,
    and has a larger id in it, so it comes after the last hot one too. Then
    the words are rewritten for all merges of the round at once, and the
    count table gets the difference of the changed words. Words and counts
    are written in every round, so a lost executor repeats one round at most.
    """
    n_merges = vocab_size - N_BYTES - len(SPECIAL_TOKENS)
    if n_merges < 0:
        raise ValueError("vocab_size must leave room for 256 bytes and 9 specials")
    words = _written(word_table(hist), "bpe-words")
    counts = _written(pair_counts(words), "bpe-pairs")
    merges: list[tuple[int, int, int]] = []
    n_hot = first_hot
    while len(merges) < n_merges:
        top = counts.orderBy(F.col("n").desc(), "pair").limit(n_hot + 1).collect()
        if not top:
            break
        hot = top[:n_hot]
        runs = hot_runs(words, [r["pair"] for r in hot]).limit(most_runs + 1).collect()
        if len(runs) > most_runs:
            if n_hot == 1:  # runs of one pair differ in length only
                raise ValueError(f"one pair has more than {most_runs} distinct runs")
            n_hot = max(1, n_hot // 4)
            continue
        last = None
        if len(top) > len(hot):
            last = (-int(hot[-1]["n"]), *(ord(c) - ID_BASE for c in hot[-1]["pair"]))
        settled = replay([(r["run"], r["freq"]) for r in runs], last, N_BYTES + len(merges), n_merges - len(merges))
        merges += settled
        if len(runs) < most_runs // 4:
            n_hot = min(2 * n_hot, MOST_HOT)
        if len(merges) < n_merges:
            rewritten = _written(rewrite(words, settled), "bpe-words")
            counts = _written(changed_counts(counts, rewritten), "bpe-pairs")
            words = rewritten.select("word", "freq")
    return merges


def merges_vocab(spark: SparkSession, merges) -> DataFrame:
    """Vocabulary table of a trained merge list (hex bytes per token, no
    names), without a job: the driver holds the list already."""
    hexes = {i: f"{i:02X}" for i in range(N_BYTES)}
    for a, b, new in merges:
        hexes[new] = hexes[a] + hexes[b]
    rows = [(i, h, False) for i, h in hexes.items()]
    n = N_BYTES + len(merges)
    rows += [(n + i, None, True) for i in range(len(SPECIAL_TOKENS))]
    return spark.createDataFrame(rows, "token_id int, hex string, is_special boolean")


def build_vocab(merges: DataFrame, specials=SPECIAL_TOKENS, rounds: int = 40) -> DataFrame:
    """Vocabulary from a merge table (``a, b, token_id``): ``token_id, hex,
    is_special, name``. Specials follow the merges in their own order.

    Every token is a string over ids; a round replaces the merged ids at all
    places at once, by the strings that they have become, so the strings
    double in depth: a vocabulary whose merges nest d deep takes log2(d) + 1
    rounds. A merge of an unknown or later token fails after ``rounds``.
    """
    spark = merges.sparkSession
    base = spark.range(N_BYTES).select(F.col("id").cast("int").alias("token_id"),
                                       F.lpad(F.hex("id"), 2, "0").alias("hex"))
    # parts: what a token is made of so far, in order; ids under 256 are bytes
    parts = merges.select("token_id", F.posexplode(F.array("a", "b")).alias("i", "part"))
    parts = parts.select("token_id", F.array("i").alias("at"), "part").checkpoint()
    for _ in range(rounds):
        if parts.filter(F.col("part") >= N_BYTES).isEmpty():
            break
        inner = parts.select(F.col("token_id").alias("part"), F.col("at").alias("_in"), F.col("part").alias("_p"))
        done, rest = parts.filter(F.col("part") < N_BYTES), parts.filter(F.col("part") >= N_BYTES)
        parts = done.unionByName(rest.join(inner, "part").select(
            "token_id", F.concat("at", "_in").alias("at"), F.col("_p").alias("part"))).checkpoint()
    else:
        raise ValueError("the merge table has a cycle")
    spelt = parts.groupBy("token_id").agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("s")).select(
        "token_id", F.array_join(F.transform("s", lambda x: F.lpad(F.hex(x["part"]), 2, "0")), "").alias("hex"))
    n = merges.select(F.count("*")).scalar()
    names = spark.createDataFrame(list(enumerate(specials)), "i int, name string")
    special = names.select((F.lit(N_BYTES) + n + F.col("i")).cast("int").alias("token_id"),
                           F.lit(None).cast("string").alias("hex"), F.lit(True).alias("is_special"), "name")
    tokens = base.unionByName(spelt).select("token_id", "hex", F.lit(False).alias("is_special"),
                                            F.lit(None).cast("string").alias("name"))
    return tokens.unionByName(special)


def bos_id(vocab: DataFrame) -> Column:
    """Id of the token a document starts with: ``<|bos|>``, or
    ``<|endoftext|>`` where there is none; the query fails if neither is."""
    wanted = vocab.filter(F.col("name").isin("<|bos|>", "<|endoftext|>"))
    found = wanted.select(F.min_by("token_id", F.col("name") != "<|bos|>")).scalar()
    return F.coalesce(found, F.raise_error(F.lit("the vocabulary has no BOS token")).cast("int"))


REMEMBERED_PIECES = 1 << 18     # by a worker
SLICE = 1 << 19                 # pieces or ids that a worker handles at once, unless one row has more


def encode_piece(data: bytes | list[int], ranks: dict) -> list[int]:
    """Ids of one piece (its bytes, or ids so far): the lowest-ranked pair is merged first, from the
    left. A heap of pairs over a linked list, so a long piece takes n log n."""
    ids = list(data)
    n = len(ids)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
    heapq.heapify(heap)
    while heap:
        new, i, a, b = heapq.heappop(heap)
        j = right[i]
        if j >= n or ids[i] != a or ids[j] != b:
            continue                                   # one of the two has been merged
        ids[i], ids[j] = new, None
        right[i] = right[j]
        if right[i] < n:
            left[right[i]] = i
        for x, y in ((left[i], i), (i, right[i])):
            if x >= 0 and y < n and (ids[x], ids[y]) in ranks:
                heapq.heappush(heap, (ranks[ids[x], ids[y]], x, ids[x], ids[y]))
    return [x for x in ids if x is not None]


def _piece_encoder(merges):
    """A function from piece to ids that remembers pieces, made per worker."""
    ranks = {(a, b): new for a, b, new in merges}
    seen: dict[str, list[int]] = {}

    def ids_of(piece: str) -> list[int]:
        got = seen.get(piece)
        if got is None:
            got = encode_piece(piece.encode("utf-8"), ranks)
            if len(seen) >= REMEMBERED_PIECES:
                seen.clear()
            if len(piece) <= 64:
                seen[piece] = got
        return got

    return ids_of


def _coded(pieces: pa.Array, ranks: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all pieces in a row and where each piece starts."""
    return merge_words(*_bytes(pieces), ranks)


def _slices(batches, col: str):
    """Slices of batches with the values and starts of list column ``col``:
    about ``SLICE`` values each, one row at least."""
    for batch in batches:
        lists = batch.column(col)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.append(0, np.cumsum(sizes))
        row = 0
        while row < len(sizes):
            end = max(row + 1, int(np.searchsorted(at, at[row] + SLICE, side="right")) - 1)
            part = batch.slice(row, end - row)
            yield part, part.column(col).flatten(), at[row:end + 1] - at[row]
            row = end


def encode_pieces(pieces: DataFrame, merges, piece_col: str = "piece") -> DataFrame:
    """``(piece, ids)`` for distinct pieces; lowest-rank merge first."""
    shared = pieces.sparkSession.sparkContext.broadcast(merges)

    def run(batches):
        ranks = merge_ranks(shared.value)
        for batch in batches:
            ids, at = _coded(batch.column(0), ranks)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(at.astype(np.int32), ids.astype(np.int32))], [piece_col, "ids"])

    schema = T.StructType([T.StructField(piece_col, T.StringType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return pieces.select(piece_col).distinct().mapInArrow(run, schema)


def _end_id(token: int | str | None, n_merges: int) -> list[int]:
    if token is None:
        return []
    return [special_id(token, n_merges) if isinstance(token, str) else int(token)]


def encode_bpe(docs: DataFrame, merges, id_col: str = "doc_id", text_col: str = "text",
               prepend: int | str | None = "<|bos|>", append: int | str | None = None, keep=()) -> DataFrame:
    """``(doc_id, *keep, ids)``: pre-tokens from the JVM, ids of each document in one
    Arrow pass, no shuffle. ``prepend`` and ``append`` are ids or names of
    special tokens. A worker codes the distinct pieces of a slice of documents
    and copies their ids to where the pieces stand, all in flat arrays."""
    shared = docs.sparkSession.sparkContext.broadcast(merges)
    head, tail = _end_id(prepend, len(merges)), _end_id(append, len(merges))
    ends = len(head) + len(tail)

    def run(batches):
        ranks = merge_ranks(shared.value)
        for part, pieces, starts in _slices(batches, "pieces"):
            coded = pieces.dictionary_encode()
            known, at = _coded(coded.dictionary, ranks)
            which = coded.indices.to_numpy(zero_copy_only=False)
            sizes = np.diff(at)[which]
            total = np.append(0, np.cumsum(sizes))[starts]  # ids before each document
            n = np.diff(total)
            begin = total + ends * np.arange(len(total))
            out = np.empty(begin[-1], np.int32)
            out[_gather(begin[:-1] + len(head), n)] = known[_gather(at[which], sizes)]
            for k, x in enumerate(head):
                out[begin[:-1] + k] = x
            for k, x in enumerate(tail):
                out[begin[1:] - len(tail) + k] = x
            ids = pa.ListArray.from_arrays(begin.astype(np.int32), out)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in (id_col, *keep)], ids], [id_col, *keep, "ids"])

    pieces = F.coalesce(pretokenize(text_col), F.array().cast("array<string>"))
    schema = T.StructType([*[docs.schema[c] for c in (id_col, *keep)], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.select(id_col, *keep, pieces.alias("pieces")).mapInArrow(run, schema)


def encode_nested(spark: SparkSession, merges):
    """A column function from texts as pieces, nested in messages and parts,
    to ids nested alike."""
    shared = spark.sparkContext.broadcast(merges)
    made: dict = {}

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.ArrayType(T.IntegerType()))))
    def encode(rows: pd.Series) -> pd.Series:
        if "of" not in made:
            made["of"] = _piece_encoder(shared.value)
        ids_of = made["of"]
        return pd.Series([None if row is None else [[[x for piece in pieces for x in ids_of(piece)] for pieces in parts] for parts in row] for row in rows],
                         dtype=object)
    return encode


def decode_ids(tokens: DataFrame, vocab: DataFrame, id_col: str = "doc_id", ids_col: str = "ids",
               skip_special: bool = True) -> DataFrame:
    """``(doc_id, text)``: token bytes joined in order and decoded as UTF-8
    (bad bytes become U+FFFD), in one pass. The vocabulary's bytes are
    fetched and broadcast. Unknown ids decode to nothing, special tokens to
    nothing or to their names."""
    table = {}
    specials = sorted(r["token_id"] for r in vocab.filter("is_special").collect())
    for r in vocab.filter("not is_special").select("token_id", "hex").collect():
        table[r["token_id"]] = bytes.fromhex(r["hex"])
    if not skip_special:
        table.update((i, SPECIAL_TOKENS[k].encode()) for k, i in enumerate(specials))
    shared = tokens.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        size = max(shared.value, default=-1) + 2  # the last entry, without bytes, stands for unknown ids
        spelt = [shared.value.get(i, b"") for i in range(size)]
        data, at = np.frombuffer(b"".join(spelt), np.uint8), np.append(0, np.cumsum([len(x) for x in spelt], dtype=np.int64))
        for part, ids, starts in _slices(batches, ids_col):
            which = pc.fill_null(ids, -1).to_numpy(zero_copy_only=False).astype(np.int64)
            which[(which < 0) | (which >= size)] = size - 1
            sizes = np.diff(at)[which]
            total = np.append(0, np.cumsum(sizes))[starts]
            raw = data[_gather(at[which], sizes)].tobytes()
            texts = [raw[a:b].decode("utf-8", errors="replace") for a, b in zip(total[:-1].tolist(), total[1:].tolist())]
            yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(texts, pa.string())], [id_col, "text"])

    schema = T.StructType([tokens.schema[id_col], T.StructField("text", T.StringType())])
    return tokens.select(id_col, ids_col).mapInArrow(run, schema)


def compression_ratio(tokens: DataFrame, texts: DataFrame, group_col: str, id_col: str = "doc_id",
                      ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """Per text type: bytes, tokens and bytes per token."""
    j = texts.select(id_col, group_col, F.octet_length(text_col).alias("_b")).join(
        tokens.select(id_col, F.size(ids_col).alias("_t")), id_col)
    g = j.groupBy(group_col).agg(F.sum("_b").alias("bytes"), F.sum("_t").alias("tokens"))
    return g.withColumn("ratio", F.col("bytes") / F.col("tokens"))


def compare_tokenizers(base: DataFrame, ours: DataFrame, group_col: str) -> DataFrame:
    """Relative token difference ``(base - ours) / base * 100``; the better
    tokenizer has the higher bytes/token ratio, else 'Tie'."""
    j = base.alias("b").join(ours.alias("o"), group_col)
    return j.select(group_col, F.col("b.tokens").alias("base_tokens"), F.col("o.tokens").alias("our_tokens"),
                    ((F.col("b.tokens") - F.col("o.tokens")) / F.col("b.tokens") * 100).alias("diff_pct"),
                    F.when(F.col("o.ratio") > F.col("b.ratio"), F.lit("ours"))
                     .when(F.col("o.ratio") < F.col("b.ratio"), F.lit("base")).otherwise(F.lit("Tie"))
                     .alias("better"))
