"""Packing in groups and levels against the stated rule."""

import random

import pytest
from pyspark.sql import functions as F

from tokenmill.operators import packers as P
from tokenmill.operators import packing as PK

ARGS = {"bestfit_crop": {"buffer_size": 8, "refill": 2}, "bestfit_pad": {"buffer_size": 6}, "greedy_crop": {}, "greedy_pad": {}, "ffd": {}}
CAP = 20


def by_levels(packer, docs, group_of):
    """Rows {(pack_group, row): [(doc, take)]} of documents [(doc, length)]:
    groups packed side by side, what they leave packed in order by the next
    level, until there is one group."""
    rows, level = {}, 0
    while docs:
        groups = {}
        for at, x in enumerate(docs):
            groups.setdefault(group_of(docs, at), []).append(x)
        left = []
        for g, part in sorted(groups.items()):
            (d, r, dst, src, take), rest = P.pack(packer, [n for _, n in part], CAP, len(groups) == 1, **ARGS[packer])
            for i, row, _, t in sorted(zip(d, r, dst, take), key=lambda x: (x[1], x[2])):
                rows.setdefault((g + level * PK.LEVEL, int(row)), []).append((part[i][0], int(t)))
            left += [part[i] for i in rest]
        docs, level = left, level + 1
    return rows


def streams(seed):
    rng = random.Random(seed)
    return {s: [(1000 * k + i, min(int(rng.expovariate(0.12)) + 1, 60)) for i in range(n)] for k, (s, n) in enumerate((("a", 700), ("b", 30), (None, 150)))}


@pytest.mark.parametrize("packer", sorted(ARGS))
def test_left_documents_and_rows_make_the_whole(packer):
    docs = streams(1)["a"]
    lengths = [n for _, n in docs]
    (d, r, dst, src, take), left = P.pack(packer, lengths, CAP, False, **ARGS[packer])
    assert not set(d) & set(left) and list(left) == sorted(left)
    if packer != "ffd":
        assert set(d) | set(left) == set(range(len(docs)))
    assert len(left) < 40
    whole, none = P.pack(packer, lengths, CAP, True, **ARGS[packer])
    assert not len(none) and [x[:len(d)].tolist() for x in whole[:2]] == [d.tolist(), r.tolist()] or packer == "ffd"


def test_plans_over_levels_follow_the_rule(spark):
    data = streams(2)
    rows = [(s, i, n) for s, docs in data.items() for i, n in docs]
    df = spark.createDataFrame(rows, "split string, doc_id long, n_tokens long").repartition(5)
    grouped = PK.assign_pack_groups(df, ["doc_id"], ["split"], 64)
    got = {}
    for x in PK.pack_plans(grouped, ARGS, CAP, ["split"], group_docs=64).collect():
        got.setdefault((x.packer, x.split, x.pack_group, x.row_no), []).append((x.dst, x.doc_id, x["take"]))
    want = {}
    for packer in ARGS:
        for s, docs in data.items():
            for k, v in by_levels(packer, docs, lambda _, at: at // 64).items():
                want[(packer, s, *k)] = v
    assert {k: [(d, t) for _, d, t in sorted(v)] for k, v in got.items()} == want
    short = {(k[0], k[1]) for k, v in want.items() if sum(t for _, t in v) < CAP}
    assert not any(p in P.CROPPING for p, _ in short)


@pytest.mark.parametrize("packer", sorted(ARGS))
@pytest.mark.parametrize("group_tokens", [600, 1 << 25])
def test_rows_over_levels_follow_the_rule(spark, packer, group_tokens):
    data = streams(3)
    rows = [(s, f"k{i:07d}", i, [i % 97 + j for j in range(n)], [(i + j) % 2 for j in range(n)]) for s, docs in data.items() for i, n in docs]
    df = spark.createDataFrame(rows, "split string, at string, doc_id long, ids array<int>, mask array<int>").repartition(5)
    out = PK.pack_rows(df, packer, CAP, -5, ["at"], ["split"], mask_col="mask", group_tokens=group_tokens, **ARGS[packer]).collect()

    def group_of(docs, at):
        return sum(n for _, n in docs[:at]) // group_tokens
    want = {(s, *k): v for s, docs in data.items() for k, v in by_levels(packer, docs, group_of).items()}
    assert {(x.split, x.pack_group, x.row_no): list(zip(x.docs, x.takes)) for x in out} == want
    if group_tokens == 600:
        assert any(x.pack_group >= PK.LEVEL for x in out)
    for x in out:
        tokens = [d % 97 + j for d, t in zip(x.docs, x.takes) for j in range(t)]
        mask = [(d + j) % 2 for d, t in zip(x.docs, x.takes) for j in range(t)]
        assert x.n_content == len(tokens) and x.tokens == tokens + [-5] * (CAP - len(tokens)) and x["mask"] == mask + [0] * (CAP - len(mask))


def test_rows_of_nothing(spark):
    df = spark.createDataFrame([(1, []), (2, None)], "doc_id long, ids array<int>")
    assert PK.pack_rows(df, "bestfit_pad", CAP, 0, ["doc_id"]).collect() == []
    assert PK.pack_rows(df.limit(0), "bestfit_crop", CAP, 0, ["doc_id"]).collect() == []
    one = df.withColumn("ids", F.array(*[F.lit(7)] * 3))
    assert [r.tokens for r in PK.pack_rows(one, "greedy_pad", 4, 0, ["doc_id"]).orderBy("row_no").collect()] == [[7, 7, 7, 0]] * 2
    assert PK.pack_rows(one, "greedy_crop", 5, 0, ["doc_id"]).first().docs == [1, 2]


def test_bpe_rows_end_to_end(spark):
    import regex

    from tokenmill.operators import render as RD
    from tokenmill.operators import tokenizer as TK

    texts = {i: " ".join(random.Random(i).choice(["low", "lower", "newest", "wider", "été", "日本"]) for _ in range(5 + i)) for i in range(40)}
    docs = spark.createDataFrame([(i, t, "s") for i, t in texts.items()], "doc_id long, text string, split string")
    merges = TK.train_bpe(TK.pretoken_histogram(docs), 256 + 9 + 30)
    ranks = {(a, b): n for a, b, n in merges}

    def encode(text):
        return [x for piece in regex.findall(TK.SPLIT_PATTERN, text) for x in TK.encode_piece(piece.encode(), ranks)]
    bos = TK.special_id("<|bos|>", len(merges))
    ids = TK.encode_bpe(docs, merges, keep=("split",))
    want = {i: [bos, *encode(t)] for i, t in texts.items()}
    assert {r.doc_id: r.ids for r in ids.collect()} == want
    for r in PK.pack_rows(ids, "bestfit_crop", 33, bos, ["doc_id"], ["split"], buffer_size=8, refill=4).collect():
        assert r.tokens == [x for d, t in zip(r.docs, r.takes) for x in want[d][:t]] and len(r.tokens) == 33

    convs = spark.createDataFrame(
        [(1, [("system", [("text", "be low")]), ("user", [("text", "newest wider")]), ("assistant", [("text", "low"), ("python", "1+1"), ("python_output", "2")])]),
         (2, [("user", [("text", "日本")]), ("assistant", [("text", "été")])]), (3, [("system", [("text", "x")]), ("assistant", [("text", "y")])]), (4, [])],
        "conv_id long, messages array<struct<role: string, parts: array<struct<type: string, text: string>>>>")
    sid = lambda n: TK.special_id(f"<|{n}|>", len(merges))
    got = {r.conv_id: r for r in RD.render_conversations(convs, has_parts=True, merges=merges).collect()}
    one = [[bos], [sid("user_start"), *encode("be low\n\nnewest wider"), sid("user_end")], [sid("assistant_start")], encode("low"),
           [sid("python_start"), *encode("1+1"), sid("python_end")], [sid("output_start"), *encode("2"), sid("output_end")], [sid("assistant_end")]]
    assert got[1].ids == [x for part in one for x in part]
    assert got[1]["mask"] == [m for part, m in zip(one, [0, 0, 0, 1, 1, 0, 1]) for _ in part]
    assert got[2].ids == [bos, sid("user_start"), *encode("日本"), sid("user_end"), sid("assistant_start"), *encode("été"), sid("assistant_end")]
    assert (got[3].reason, got[3].ids) == ("system_not_followed_by_user", None) and got[4].reason == "empty"
    bytes_of = {r.conv_id: r for r in RD.render_conversations(convs, has_parts=True).collect()}
    assert bytes(x for x in bytes_of[1].ids if x < 256) == "be low\n\nnewest widerlow1+12".encode()


def test_masks_travel_as_bytes(spark):
    from tokenmill.operators.packing import pack_rows
    docs = spark.createDataFrame([(i, [i] * 3, [0, 1, 1]) for i in range(5)], "doc_id long, ids array<int>, mask array<int>")
    rows = pack_rows(docs, "bestfit_pad", 7, 99, ["doc_id"], (), mask_col="mask", buffer_size=3)
    assert "array<tinyint>" in rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.schema["mask"].dataType.simpleString() == "array<int>"
    assert sorted((r.n_content, r.tokens.count(99), sum(r.mask)) for r in rows.collect()) == [(3, 4, 2), (6, 1, 4), (6, 1, 4)]
