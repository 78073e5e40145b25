"""The Merkle manifest, the exact top-k search and the lexical search against
brute force and on awkward rows."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenmill.llm import lexical_search, topk_search
from tokenmill.llm.lexical_search import search
from tokenmill.llm.merkle_manifest import append_log, fold, height, position, prove, sibling_pairs
from tokenmill.llm.topk_search import cell_histogram, top_k

from test_operators import awkward_rows, make, prose, same

H = lambda parts: hashlib.sha256("".join(parts).encode()).hexdigest()


# 11 --------------------------------------------------------------------------

def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([H(out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def climb(levels, i, node):
    siblings = []
    for level in levels[:-1]:
        lo = i - i % 8
        near, far = level[lo:i], level[i + 1:lo + 8]
        siblings += near + far
        node, i = H([*near, node, *far]), i // 8
    return siblings, node


def brute_manifest(rows):
    def digest(r, text):
        doc_id, _, lang, source, n_chars = r
        part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
        return H([part(v) for v in (doc_id, source, lang, n_chars, text)])
    lower = lambda t: None if t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t)
    trees = {}
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        leaf = digest(r, r[1])
        trees.setdefault(r[2], []).append(((r[0] is None, r[0] or 0), leaf, digest(r, lower(r[1])) if hit else leaf, r[0]))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    levels = {x: levels_of([leaf for _, leaf, _, _ in sorted(trees[x])]) for x in langs}
    top = levels_of([levels[x][-1][0] for x in langs]) if langs else []
    out = []
    for k, x in enumerate(langs):
        for i, (_, leaf, changed, doc_id) in enumerate(sorted(trees[x])):
            near, node = climb(levels[x], i, changed)
            far, node = climb(top, k, node)
            out.append((doc_id, leaf, levels[x][-1][0], top[-1][0], H(near + far), node, node == top[-1][0]))
    return out


def many_rows(n, langs):
    rng = random.Random(5)
    return [(i, rng.choice(["Aa", "bb", "C c", ""]) + str(i) if i % 7 else None, langs[min(i % 97, len(langs) - 1)], rng.choice(["s", None]), i) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 100, 511, 512])
def test_log_positions_and_proofs(n):
    leaves = [H([str(i)]) for i in range(n)]
    log, levels = append_log(leaves, height(n)), levels_of(leaves)
    assert len(levels) == height(n) + 1 and len(log) == sum(map(len, levels))
    places = {position(n, height(n), k, j): node for k, level in enumerate(levels) for j, node in enumerate(level)}
    assert [places[i] for i in range(len(log))] == log
    pairs = sibling_pairs(log, n, height(n))
    for i in range(n):
        assert fold(leaves[i], [pairs[k][i // 8 ** k] for k in range(height(n))]) == levels[-1][0]


def test_manifest_of_awkward_rows(spark):
    rows = awkward_rows() + [(30, "lone", None, "s", 1), (31, "x", "é", None, None), (31, "x", "é", None, None), (32, "x", "", "s", 1)]
    got = prove(make(spark, rows, clashes=True))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    same(got.collect(), brute_manifest(rows))


def test_manifest_over_several_rounds(spark):
    rows = many_rows(120, [None, "a", "b", *map(str, range(9))])
    same(prove(make(spark, rows), levels=1).collect(), brute_manifest(rows))


def test_manifest_spans_blocks(spark):
    rows = many_rows(1500, ["a"])
    got = prove(make(spark, rows, parts=7)).collect()
    same(got, brute_manifest(rows))
    assert any(not r.verified for r in got) and any(r.verified for r in got)


def test_manifest_of_nothing(spark):
    assert prove(make(spark, [])).collect() == []


# 12 --------------------------------------------------------------------------

def brute_top(rows, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, u) in enumerate(ok):
        if i is None or i % 50:
            continue
        found = sorted((-sum(x * y for x, y in zip(u, v)), (j is None, j or 0)) for b, (j, v) in enumerate(ok) if b != a)
        out += [(i, r + 1, None if j[0] else j[1], -s) for r, (s, j) in enumerate(found[:k])]
    return out


VECTORS = "vec_id long, embedding array<float>, prefix string, need string, row_id string, v string, ord string, is_query string"


def vectors(spark, rows, parts=3):
    return spark.createDataFrame([(*r, *"clashe") for r in rows], VECTORS).repartition(parts)


def test_top_k_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "CANDIDATES", 64)
    monkeypatch.setattr(topk_search, "QUERIES", 4)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(400)]
    rows += [(i, [0.5] * 8) for i in range(400, 520)]  # one frequent vector, ties by id
    rows += [(None, [9.0] * 8), (600, None), (650, [1.0, None] + [0.0] * 6), (700, [float("nan")] * 8), (750, [float("inf")] * 8), (800, []), (850, [1.0, 2.0])]
    rows += [(50, [0.25] * 8), (50, [0.25] * 8)]
    for k in (1, 5):
        got = top_k(vectors(spark, rows), k, F.col("vec_id") % 50 == 0)
        assert got.schema.simpleString() == "struct<query_id:bigint,rank:int,vec_id:bigint,score:bigint>"
        same(got.collect(), brute_top(rows, k))


def test_top_k_of_few_rows(spark):
    query = F.col("vec_id") % 50 == 0
    assert top_k(vectors(spark, []), 5, query).collect() == []
    assert top_k(vectors(spark, [(0, [1.0])]), 5, query).collect() == []
    assert top_k(vectors(spark, [(1, [1.0])]), 5, query).collect() == []
    rows = [(0, [1.0, -1.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0]), (50, [0.0, 0.0])]
    same(top_k(vectors(spark, rows), 5, query).collect(), brute_top(rows, 5))


def test_top_k_of_long_vectors(spark):
    rows = [(i, [float(1 << 20) + i, 3.0 * i, -1e6]) for i in range(60)]
    same(top_k(vectors(spark, rows), 5, F.col("vec_id") % 50 == 0).collect(), brute_top(rows, 5))
    with pytest.raises(ValueError, match="may not fit a long"):
        top_k(vectors(spark, [(0, [1e30]), (1, [1.0])]), 5, F.col("vec_id") % 50 == 0)


def test_histogram_is_exact_down_to_the_need():
    rng = np.random.default_rng(1)
    score = rng.integers(0, 1 << 20, (5, 400))
    query, bucket, count = cell_histogram(score, np.zeros(5, np.int64), np.full(5, 7), 10)
    for q in range(5):
        whole = np.bincount(score[q] >> 10, minlength=1 << 10)
        mine = dict(zip(bucket[query == q], count[query == q]))
        assert all(whole[b] == c for b, c in mine.items()) and sum(mine.values()) >= 7
        assert set(np.flatnonzero(whole[min(mine):]) + min(mine)) == set(mine)


# 13 --------------------------------------------------------------------------

def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, k=20):
    bags = [(i, terms(t)) for i, t in docs]
    n_docs, n_all = sum(bool(b) for _, b in bags), sum(len(b) for _, b in bags)
    df = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, []).extend(terms(t))
    out = []
    for i, want in wanted.items():
        found = []
        for doc_id, b in bags:
            if not b:
                continue
            m = 75 + 25 * len(b) * n_docs // n_all
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * b.count(t) // (1000 * b.count(t) + 12 * m)) for t in want if t in df)
            if score > 0:
                found.append((-score, (doc_id is None, doc_id or 0)))
        out += [(i, r + 1, None if d[0] else d[1], -s) for r, (s, d) in enumerate(sorted(found)[:k])]
    return out


ITEMS = [(0, "one two"), (1, None), (2, ""), (3, "Line LINE line two"), (4, "ünïcödé 日本語 straße ſtraße"), (5, "abcdefghijkl 0123456789abcdef"), (6, "x" * 5000),
         (7, "a b-c_d;e,a"), (8, prose(40, 10)), (8, "same"), (None, "words"), (9, "no such thing"), (10, "wor ords same wordss ")]


def item_table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "item_id long, text string, ord string, term string")


def test_search_against_brute_force(spark):
    rows = awkward_rows() + [(40 + i, "same words twice same", "en", "a", 1) for i in range(30)]
    got = search(make(spark, rows, clashes=True), item_table(spark, ITEMS))
    assert got.schema.simpleString() == "struct<item_id:bigint,rank:int,doc_id:bigint,score:bigint>"
    same(got.collect(), brute_search([r[:2] for r in rows], ITEMS))


def test_search_in_groups_and_pieces(spark, monkeypatch):
    for name, value in (("MAX_POSTINGS", 100), ("PIECE", 50), ("MERGE", 2)):
        monkeypatch.setattr(lexical_search, name, value)
    rows = awkward_rows() + [(40 + i, prose(50, i), "en", "a", 1) for i in range(40)]
    items = ITEMS + [(20 + i, prose(12, 100 + i)) for i in range(12)]
    same(search(make(spark, rows), item_table(spark, items), 7).collect(), brute_search([r[:2] for r in rows], items, 7))


def test_search_of_nothing(spark):
    rows = make(spark, awkward_rows())
    assert search(make(spark, []), item_table(spark, ITEMS)).collect() == []
    assert search(rows, item_table(spark, [])).collect() == []
    assert search(rows, item_table(spark, [(1, None), (2, " -- ")])).collect() == []
    assert search(make(spark, [(1, None, None, None, None), (2, "!?", None, None, None)]), item_table(spark, ITEMS)).collect() == []


def test_scan_in_chunks():
    group = lexical_search.ItemGroup(["a", "bb", "é", "x" * 90], None, None, None, [])
    automaton = lexical_search._automaton(group)
    texts = ["A bb-a", "", None, "É é " + "x" * 90 + " " + "X" * 90, "a" * 300, " a a\na", "bb"]
    want = [x.tolist() for x in lexical_search.scan(pa.array(texts), automaton)]
    assert want[0] == [len(terms(t)) for t in texts]
    assert want[1:] == [[0, 0, 3, 3, 5, 6], [0, 1, 2, 3, 0, 1], [2, 1, 1, 2, 3, 1]]
    for chunk in (1, 2, 37):
        assert [x.tolist() for x in lexical_search.scan(pa.array(texts), automaton, chunk)] == want


def test_best_keeps_the_smallest_ids():
    best = lexical_search.Best(2, 3)
    for ords in ([9, 5, 7], [1, 8], [2, 3, 4]):
        ords = np.array(ords)
        best.add(np.zeros(len(ords), np.int64), np.full(len(ords), 10), ords)
    assert best.ord.tolist() == [1, 2, 3]
