"""Unit checks of per-row helpers and small semantics."""

import os
import random
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from tokenmill.functions import grading as G
from tokenmill.operators import tokenizer as TK
from tokenmill.operators import scoring as S


CALCULATIONS = [
    ("12*3", "36"), ("1,000+5", "1005"), ("7/2", "3.5"), ("2**10", None), ("'banana'.count('a')", "3"),
    ("__import__('os')", None), ("open('x')", None), ("abc", None), ("(1+2)*3", "9"), ("-4+1", "-3"), ("3-10", "-7"),
    ("1-2-3", "-4"), ("2+3*4-6/3", "12.0"), ("7//2", "3"), ("-(2+3)*-2", "10"), ("1/0", None), ("007", None), ("1 2", None),
    ("(1", None), ("", None), (None, None), ("*3", None), ("0*5", "0"), ("05*2", None), ("'a'.count('dir')", None), (".5+1.", "1.5"),
    ("9" * 3000 + "*" + "9" * 3000, None), ("(" * 5000 + "1" + ")" * 5000, None), ("999999999*999999999", "999999998000000001"),
    ('"strawberry".count("r")', "3"), ("'aa'.count('')", "3"),
]


def test_calculator(spark):
    df = spark.createDataFrame([(i, e) for i, (e, _) in enumerate(CALCULATIONS)], "i int, e string")
    got = {r.i: r.v for r in df.select("i", G.calc_eval("e").alias("v")).collect()}
    assert [got[i] for i in range(len(CALCULATIONS))] == [v for _, v in CALCULATIONS]


def test_bad_lines_do_not_fail_the_job(spark):
    from tokenmill.operators import runs as R
    logs = spark.createDataFrame([(1, 0, "CORE metric: n/a"), (1, 1, "Calculated number of iterations from target FLOPs: many"),
                                  (1, 2, "lm_head : ,"), (1, 3, "Step 1 | Validation bpb: 0.8.1"), (2, 0, "CORE metric: 0.25")],
                                 "file_no long, line_no long, line string")
    got = {r.file_no: r for r in R.scrape_run_logs(logs).collect()}
    assert got[1].core is None and got[1].num_iters is None and got[1].params_lm_head is None and got[1].val_bpb is None
    assert got[2].core == 0.25
    lines = spark.createDataFrame([("base", 0, "CORE without colon"), ("sft", 1, "- CORE: 0.5")], "stage string, line_no long, line string")
    assert {r.stage: r.value for r in R.scrape_report_kv(lines, ["CORE"]).collect()} == {"base": None, "sft": "0.5"}


def test_words_merged_together_equal_words_merged_one_by_one():
    import numpy as np
    draw = random.Random(5)
    for n_ids in (1, 2, 5):
        merges = []
        for new in range(n_ids, n_ids + 30):
            pair = (draw.randrange(new), draw.randrange(new))
            merges += [] if pair in {m[:2] for m in merges} else [(*pair, new)]
        ranks = {(a, b): new for a, b, new in merges}
        words = [[draw.randrange(n_ids) for _ in range(draw.choice([0, 1, 2, 3, 8, 40, TK.LONG_WORD + 9]))] for _ in range(300)]
        at = np.append(0, np.cumsum([len(w) for w in words]))
        ids, starts = TK.merge_words(np.array(sum(words, []), np.int64), at, TK.merge_ranks(merges))
        assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [TK.encode_piece(w, ranks) for w in words]


def test_a_round_leaves_settled_words_alone(spark):
    hist = spark.createDataFrame([("ab", 3), ("xab", 2), ("xyz", 1), ("q", 9)], "piece string, freq long")
    spelt = lambda *ids: "".join(chr(TK.ID_BASE + i) for i in ids)
    got = {tuple(r) for r in TK.rewrite(TK.word_table(hist), [(97, 98, 256)]).select("old", "word", "freq").collect()}
    # untouched words carry no old form, so the counts of the round don't read them; "q" has no pair
    assert got == {(spelt(97, 98), spelt(256), 3), (spelt(120, 97, 98), spelt(120, 256), 2), (None, spelt(120, 121, 122), 1)}


def test_slices_of_pieces_give_each_document_its_own_ids(spark, monkeypatch):
    draw = random.Random(7)
    words = ["".join(draw.choices("abé ", k=draw.choice([1, 3, 9, 90]))) for _ in range(40)]
    texts = [None, "", *(" ".join(draw.choices(words, k=draw.choice([0, 1, 30]))) for _ in range(60))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    merges = naive_bpe(Counter(regex.findall(TK.SPLIT_PATTERN, " ".join(words))), 40)
    ranks = {(a, b): new for a, b, new in merges}
    rows = docs.select("doc_id", F.coalesce(TK.pretokenize("text"), F.array().cast("array<string>")).alias("pieces")).toArrow().to_batches()
    monkeypatch.setattr(TK, "SLICE", 16)
    parts = list(TK._slices(rows, "pieces"))
    # a slice has more than SLICE pieces only if it is one document
    assert len(parts) > 20 and all(len(at) == 2 or at[-1] <= 16 for _, _, at in parts)
    want = {i: [7, *(x for p in regex.findall(TK.SPLIT_PATTERN, t or "") for x in TK.encode_piece(p.encode(), ranks)), 8] for i, t in enumerate(texts)}
    enc = TK.encode_bpe(docs, merges, prepend=7, append=8)
    assert {r.doc_id: r.ids for r in enc.collect()} == want
    ids = spark.createDataFrame([(0, [97, 999, -5, 98]), (1, []), (2, [195])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in TK.decode_ids(ids, TK.merges_vocab(spark, merges)).collect()} == {0: "ab", 1: "", 2: "\ufffd"}


def test_extract_answer_and_grade(spark):
    df = spark.createDataFrame([("#### 1,234", "x #### 1234"), ("none", "none"), ("#### 12.", "#### 12")],
                               "ref string, comp string")
    r = df.select(G.extract_answer("ref").alias("a"), G.grade_numeric("ref", "comp").alias("ok")).collect()
    assert [x.a for x in r] == ["1234", None, "12."]
    assert [x.ok for x in r] == [True, True, False]


def test_parse_tool_calls(spark):
    df = spark.createDataFrame([("a<<2*3=6>>b<<7>>",)], "t string")
    parts = df.select(G.parse_tool_calls("t").alias("p")).first().p
    assert [(p.type, p.text) for p in parts] == [
        ("text", "a"), ("python", "2*3"), ("python_output", "6"), ("text", "b"),
        ("python", "7"), ("python_output", ""), ("text", "")]


def naive_bpe(words, n_merges):
    """Merges on strings, a recount for each."""
    spelled = {"".join(chr(0x10000 + b) for b in w.encode()): c for w, c in words.items()}
    merges = []
    for new in range(256, 256 + n_merges):
        counts = Counter()
        for w, c in spelled.items():
            counts.update({p: c * k for p, k in Counter(map("".join, zip(w, w[1:]))).items()})
        if not counts:
            break
        best = min(counts, key=lambda p: (-counts[p], p))
        merges.append((ord(best[0]) - 0x10000, ord(best[1]) - 0x10000, new))
        merged = Counter()
        for w, c in spelled.items():
            merged[w.replace(best, chr(0x10000 + new))] += c
        spelled = merged
    return merges


def naive_encode(text, merges):
    w = "".join(chr(0x10000 + b) for b in text.encode())
    for a, b, new in merges:
        w = w.replace(chr(0x10000 + a) + chr(0x10000 + b), chr(0x10000 + new))
    return [ord(c) - 0x10000 for c in w]


def test_bpe_on_a_generated_corpus(spark):
    rng = random.Random(5)
    parts = ["low", "er", "est", "new", "wid", "ing", "é", "un", "re", "aa", "tion"]
    text = [" ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))) for _ in range(300)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*text, "", None, "a" * 3000])], "doc_id long, text string")
    hist = TK.pretoken_histogram(docs)
    assert hist.count() > 1000
    merges = TK.train_bpe(hist, 256 + 9 + 60)
    assert merges == naive_bpe({r.piece: r.freq for r in hist.collect()}, 60)
    enc = TK.encode_bpe(docs, merges, prepend="<|user_start|>", append=7)
    assert "Exchange" not in enc._jdf.queryExecution().executedPlan().toString()
    ids = {r.doc_id: r.ids for r in enc.collect()}
    pieces = {r.doc_id: r.p or [] for r in docs.select("doc_id", TK.pretokenize("text").alias("p")).collect()}
    head = TK.special_id("<|user_start|>", len(merges))
    assert ids == {i: [head, *(x for p in ps for x in naive_encode(p, merges)), 7] for i, ps in pieces.items()}
    dec = {r.doc_id: r.text for r in TK.decode_ids(enc, TK.merges_vocab(spark, merges)).collect()}
    assert dec == {r.doc_id: (r.text or "") + chr(7) for r in docs.collect()}


@pytest.mark.parametrize("first_hot, most_runs", [(64, 1 << 18), (3, 1 << 18), (1, 1 << 18), (500, 60)])
def test_bpe_learns_all_merges(spark, first_hot, most_runs):
    """Until no pair is left: ties, runs of one letter, rounds of any size."""
    rng = random.Random(7)
    parts = ["low", "er", "est", "new", "aa", "a", "é", "un", "日"]
    n_words = 60 if first_hot == 1 else 1200
    rows = [("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4 if first_hot == 1 else 9))), rng.choice([1, 1, 2, 3])) for _ in range(n_words)]
    words = Counter()
    for w, c in [*rows, ("a" * 40, 2), ("ab" * 30, 3)]:
        words[w] += c
    hist = spark.createDataFrame(list(words.items()), "piece string, freq long")
    want = naive_bpe(words, 400 if first_hot > 1 else 40)
    assert TK.train_bpe(hist, 256 + 9 + (400 if first_hot > 1 else 40), most_runs, first_hot) == want
    if first_hot == 64:
        few = dict(list(words.items())[:30])
        assert TK.train_bpe(spark.createDataFrame(list(few.items()), "piece string, freq long"), 100_000) == naive_bpe(few, 100_000)
    assert TK.train_bpe(hist.limit(0), 100_000) == []


def test_bpe_matches_naive_and_round_trips(spark):
    text = ["low lower lowest", "newer newest new", "wider wide widest low", "aaa aaaa aa"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "doc_id long, text string")
    hist = TK.pretoken_histogram(docs)
    merges = TK.train_bpe(hist, 256 + 9 + 12)
    words = {r.piece: r.freq for r in hist.collect()}
    assert merges == naive_bpe(words, 12)
    enc = TK.encode_bpe(docs, merges)
    dec = TK.decode_ids(enc, TK.merges_vocab(spark, merges)).toPandas().sort_values("doc_id")
    assert list(dec["text"]) == text


def test_pass_at_k(spark):
    rows = [("t", 0, 0, False), ("t", 0, 1, True), ("t", 1, 0, True), ("t", 1, 1, False),
            ("t", 2, 0, False), ("t", 2, 1, False)]
    df = spark.createDataFrame(rows, "task string, idx long, k long, is_correct boolean")
    r = {x.k: x.pass_at_k for x in S.pass_at_k(df).collect()}
    assert r == {1: pytest.approx(1 / 3), 2: pytest.approx(2 / 3)}


def test_strict_baseline_raises(spark):
    acc = spark.createDataFrame([("a", 0.5), ("b", 0.1)], "task string, accuracy double")
    base = spark.createDataFrame([("a", 0.25)], "task string, baseline double")
    with pytest.raises(ValueError):
        S.join_baseline_strict(acc, base)


def test_token_bytes_replacement_char(spark):
    vocab = spark.createDataFrame([(0, "41", False), (1, "80", False), (2, "C3A9", False), (3, None, True)],
                                  "token_id int, hex string, is_special boolean")
    r = {x.token_id: x.n_bytes for x in TK.token_bytes(vocab).collect()}
    assert r == {0: 1, 1: 3, 2: 2, 3: 0}


def test_shard_cuts_match_sequential_rule(spark):
    import random
    from tokenmill.sources.shards import cut_chunks, shard_of_chunks
    rnd = random.Random(3)
    for trial in range(4):
        chars = [rnd.randint(0, 50) for _ in range(rnd.randint(1, 120))]
        cps = rnd.randint(20, 200)
        for keep in (False, True):
            exp = cut_chunks(chars, cps, keep)
            df = spark.createDataFrame([(i, c) for i, c in enumerate(chars)], "chunk long, chars long")
            got = {r.chunk: r.shard for r in shard_of_chunks(df, cps, keep).collect()}
            want = {i: int(s) for i, s in enumerate(exp) if s >= 0}
            assert got == want, (chars, cps, keep)


def test_prefix_extreme(spark):
    from tokenmill.plans.positions import prefix_extreme
    rows = [(i, float((i * 37) % 101)) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, v double")
    got = {r.k: r.m for r in prefix_extreme(df, ["k"], "v", (), out="m", rows_per_block=16).collect()}
    best = None
    for k, v in rows:
        assert got[k] == best
        best = v if best is None else min(best, v)


def test_token_bytes_specials_variant(spark):
    vocab = TK.merges_vocab(spark, [])
    r = {x.token_id: x.n_bytes for x in TK.token_bytes(vocab, zero_specials=False).collect()}
    assert r[256] == len("<|bos|>") and r[264] == len("<|output_end|>") and r[65] == 1


def test_bpe_batched_round_trips(spark):
    text = ["the cat sat on the mat", "then the rat ate the oat", "that other hat"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "doc_id long, text string")
    merges = TK.train_bpe(TK.pretoken_histogram(docs), 256 + 9 + 10, first_hot=2)
    assert len(merges) == 10 and len({m[2] for m in merges}) == 10
    dec = TK.decode_ids(TK.encode_bpe(docs, merges), TK.merges_vocab(spark, merges)).toPandas()
    assert sorted(dec["text"]) == sorted(text)


def shared_length(seqs, direction):
    step = 1 if direction == "left" else -1
    return len(os.path.commonprefix([tuple(s[::step]) for s in seqs]))


def test_common_length(spark):
    import random
    from pyspark.sql import functions as F
    from tokenmill.operators.core_prompts import common_length
    rnd = random.Random(5)
    rows = []
    for k in range(60):
        base = [rnd.randint(0, 3) for _ in range(rnd.randint(0, 8))]
        seqs = [base[: rnd.randint(0, len(base))] + [rnd.randint(0, 3) for _ in range(rnd.randint(0, 4))]
                for _ in range(rnd.randint(1, 3))]
        rows.append((k, seqs))
    df = spark.createDataFrame(rows, "k int, s array<array<int>>")
    got = {r.k: (r.l, r.r) for r in df.select("k", common_length(F.col("s"), "left").alias("l"),
                                               common_length(F.col("s"), "right").alias("r")).collect()}
    for k, seqs in rows:
        assert got[k] == (shared_length(seqs, "left"), shared_length(seqs, "right")), seqs


def test_items_without_enough_shots_are_quarantined(spark):
    from tokenmill.operators.core_prompts import fewshot_quarantine, fewshot_sample
    items = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 3, 0), ("b", 4, 1)], "task string, item_id long, num_fewshot int")
    kept = {r.item_id: len(r.shots) for r in fewshot_sample(items).collect()}
    assert kept == {1: 1, 2: 2, 3: 0}
    assert [(r.item_id, r.reason) for r in fewshot_quarantine(items).collect()] == [(4, "too_few_items")]


def test_shards_may_be_files_or_folders_of_parts(spark, tmp_path):
    from tokenmill.sources.corpus import scan_shards
    spark.range(0, 7).coalesce(1).write.parquet(str(tmp_path / "raw"))
    next((tmp_path / "raw").glob("part-*.parquet")).rename(tmp_path / "a.parquet")
    spark.range(7, 20, 1, 3).write.parquet(str(tmp_path / "b.parquet"))
    (tmp_path / "c.parquet.tmp").write_text("not yet whole")
    df = scan_shards(spark, str(tmp_path / "none"), legacy_path=str(tmp_path))
    rows = df.collect()
    assert sorted((r.id, r.file_name) for r in rows) == [(i, "a.parquet" if i < 7 else "b.parquet") for i in range(20)]
    assert len({(r.file_name, r.part_name, r.row_index) for r in rows}) == 20


def test_train_val_split_moves_no_text(spark):
    from tokenmill.operators.corpus import train_val_docs
    df = spark.createDataFrame([(3, " c "), (1, "a"), (2, None), (9, " \n"), (5, "e")], "doc_id long, text string")
    out = train_val_docs(df, ["doc_id"])
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = out.groupBy("doc_id", "split", "text").count().collect()
    assert sorted((r.doc_id, r.split, r.text) for r in got) == [(1, "train", "a"), (3, "train", "c"), (5, "val", "e")]
    one = train_val_docs(df.filter("doc_id = 1"), ["doc_id"]).select("doc_id", "split").distinct().collect()
    assert sorted(tuple(r) for r in one) == [(1, "train"), (1, "val")]


def test_pad_batches_sorts_no_ids(spark):
    from tokenmill.operators.render import pad_batches
    rows = [(i, [1] * (1 + i % 5), [1] * (1 + i % 5)) for i in range(11)]
    df = pad_batches(spark.createDataFrame(rows, "row_id long, ids array<int>, mask array<int>"), 4, 9)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    for r in df.collect():
        n, longest = 1 + r.row_id % 5, max(1 + i % 5 for i in range(11) if i // 4 == r.row_id // 4)
        assert r.batch == r.row_id // 4 and r.ids == [1] * n + [9] * (longest - n) and r.mask == [1] * n + [0] * (longest - n)
