"""The tokenizer queries that SQL cannot express, against plain models."""

from collections import Counter

import pyarrow.parquet as pq
import pytest
import regex

from tokenmill.operators.tokenizer import SPECIAL_TOKENS, SPLIT_PATTERN
from tokenmill.operators.packers import pack
from tokenmill.plans.q_packing import T_CONVS, _rendered
from tokenmill.plans.registry import load_all

from conftest import SF_SMALL
from test_units import naive_bpe

QUERIES, _ = load_all()
EVERY = 300      # merges that the slow model replays


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def merges(spark):
    rows = sorted(tuple(r) for r in QUERIES["train_bpe"](spark, SF_SMALL).collect())
    assert [r[0] for r in rows] == list(range(len(rows)))
    return [r[1:] for r in rows]


def pieces(text):
    return regex.findall(SPLIT_PATTERN, text or "")


def encode(piece, ranks):
    ids = list(piece.encode())
    while len(ids) > 1:
        best = min(zip(ids, ids[1:]), key=lambda p: ranks.get(p, 1 << 60))
        if best not in ranks:
            break
        out, i = [], 0
        while i < len(ids):
            hit = tuple(ids[i:i + 2]) == best
            out.append(ranks[best] if hit else ids[i])
            i += 2 if hit else 1
        ids = out
    return ids


def measured(documents, merges):
    ranks = {(a, b): new for a, b, new in merges}
    known, total = {}, {}
    for d in documents:
        n = total.setdefault(d["lang"], [0, 0])
        n[0] += len((d["text"] or "").encode())
        for p in pieces(d["text"]):
            if p not in known:
                known[p] = len(encode(p, ranks))
            n[1] += known[p]
    return total


def test_histogram_equals_the_pattern_run_by_python(spark, documents):
    got = {r.piece: r.freq for r in QUERIES["pretoken_histogram"](spark, SF_SMALL).collect()}
    assert got == Counter(p for d in documents for p in pieces(d["text"]))


def test_first_merges_equal_the_naive_model(documents, merges):
    val = max(d["source"] for d in documents)
    words = Counter(p for d in documents if d["source"] != val for p in pieces(d["text"]))
    assert merges[:EVERY] == naive_bpe(words, EVERY)
    assert len({m[:2] for m in merges}) == len(merges) and all(max(m[:2]) < m[2] for m in merges)


def test_token_bytes_and_vocabulary_follow_the_merges(spark, merges):
    spelt = {i: bytes([i]) for i in range(256)}
    for a, b, new in merges:
        spelt[new] = spelt[a] + spelt[b]
    n = len(spelt)
    got = {r.token_id: r.n_bytes for r in QUERIES["token_bytes"](spark, SF_SMALL).collect()}
    want = {i: len(t.decode("utf-8", errors="replace").encode()) for i, t in spelt.items()}
    assert got == want | {n + i: 0 for i in range(len(SPECIAL_TOKENS))}
    vocab = QUERIES["build_vocab"](spark, SF_SMALL).collect()
    assert {r.token_id: bytes.fromhex(r.hex) for r in vocab if not r.is_special} == spelt
    assert {r.name: r.token_id for r in vocab if r.is_special} == {s: n + i for i, s in enumerate(SPECIAL_TOKENS)}
    assert {r.bos_id for r in vocab} == {n}


def test_compression_equals_pieces_encoded_one_by_one(spark, documents, merges):
    total = measured(documents, merges)
    got = {r.lang: r for r in QUERIES["compression_ratio"](spark, SF_SMALL).collect()}
    assert {k: [r.bytes, r.tokens] for k, r in got.items()} == total
    assert all(r.ratio == pytest.approx(r.bytes / r.tokens) for r in got.values())
    for r in QUERIES["compare_tokenizers"](spark, SF_SMALL).collect():
        size, tokens = total[r.lang]
        assert (r.base_tokens, r.our_tokens) == (size, tokens) and r.better == "ours"
        assert r.diff_pct == pytest.approx(100 * (size - tokens) / size)


def test_packed_rows_hold_the_encoded_documents(spark, documents, merges):
    ranks, known = {(a, b): new for a, b, new in merges}, {}
    bos, val = 256 + len(merges), max(d["source"] for d in documents)
    ids = {}
    for d in documents:
        out = [bos]
        for p in pieces(d["text"]):
            if p not in known:
                known[p] = encode(p, ranks)
            out += known[p]
        ids[d["doc_id"]] = out
    rows = QUERIES["bpe_pack_rows"](spark, SF_SMALL).collect()
    seen = {"train": {}, "val": {}}
    for r in rows:
        content = [x for doc, take in zip(r.docs, r.takes) for x in ids[doc][:take]]
        assert r.inputs == content[:-1] and r.targets == content[1:] and len(content) == T_CONVS + 1 == r.n_content
        seen[r.split][r.row_no] = list(zip(r.docs, r.takes))
    for split, got in seen.items():
        docs = sorted((d for d in documents if (d["source"] == val) == (split == "val")),
                      key=lambda d: (d["source"], d["doc_id"]))
        (at, row, dst, _, take), _ = pack("bestfit_crop", [len(ids[d["doc_id"]]) for d in docs], T_CONVS + 1, True,
                                          buffer_size=1000)
        want = {}
        for i, no, _, n in sorted(zip(at, row, dst, take), key=lambda x: (x[1], x[2])):
            want.setdefault(int(no), []).append((docs[i]["doc_id"], int(n)))
        assert got == want


def test_chat_rows_hold_the_rendered_conversations(spark, merges):
    rendered = {r.conv_id: r for r in _rendered(spark, SF_SMALL, merges=merges).filter("reason is null").collect()}
    bos, placed = 256 + len(merges), []
    for r in QUERIES["bpe_sft_rows"](spark, SF_SMALL).collect():
        assert list(r.takes) == [len(rendered[c].ids) for c in r.docs]
        ids = [x for c in r.docs for x in rendered[c].ids]
        mask = [x for c in r.docs for x in rendered[c]["mask"]]
        pad = len(r.inputs) + 1 - len(ids)
        assert len(ids) == r.n_content and pad >= 0
        ids, mask = ids + [bos] * pad, mask + [0] * pad
        assert r.inputs == ids[:-1] and r.targets == [x if m else -1 for x, m in zip(ids[1:], mask[1:])]
        placed += r.docs
    assert len(placed) == len(set(placed)) and set(placed) <= set(rendered)
    assert {c for c in rendered if len(rendered[c].ids) <= T_CONVS + 1} <= set(placed)
