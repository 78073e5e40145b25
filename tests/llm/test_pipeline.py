"""The pipeline's stages, each on what the one before kept."""

import re

import pytest

import corpus_pipeline
from tokenmill.llm import language_crf

from test_operators import awkward_rows, brute_components, make

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, SF).write.parquet(out := str(tmp_path / name))
        after = spark.read.parquet(out)
        was, now = before.collect(), after.collect()
        assert {r.doc_id for r in now} <= {r.doc_id for r in was}
        if k < 4:
            assert after.columns == columns
        if name == "language_id":
            kept = {r.doc_id for r in language_crf.identify(before).where("lang_pred <> 'und' and score >= 0.5").collect()}
            assert sorted(r.doc_id for r in now) == sorted(kept) and len(now) > 0.95 * len(was)
        if name == "exact_dedup":
            best = {}
            for r in was:
                best.setdefault(norm(r.text), []).append((-len(r.text), r.doc_id))
            assert sorted(r.doc_id for r in now) == sorted(min(g)[1] for g in best.values())
        if name == "ngram_jaccard_join":
            assert sorted(r.doc_id for r in now) == sorted({c for _, _, c in brute_components([(r.doc_id, r.text) for r in was])})
        if name == "source_mixing":
            text = {r.doc_id: r.text for r in was}
            assert all(r.text == text[r.doc_id] for r in now)
        if name == "sentencepiece":
            assert len(now) == len(was) and all(r.round_trip for r in now)
        before = after


@pytest.mark.parametrize("kind", ["clashing", "empty", "texts are null"])
def test_stages_on_awkward_tables(spark, tmp_path, kind):
    """Nulls, ties, repeated rows, long texts, other columns, no rows at all.
    Every stage gets the whole table, as language_id keeps little of it."""
    rows = {"empty": [], "texts are null": [(i, None, "en", "a", 1) for i in (1, 1, 2, None)]}.get(kind, awkward_rows())
    docs = make(spark, rows, clashes=kind == "clashing")
    whole = {(r.doc_id, r.text) for r in docs.collect()}
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(out := str(tmp_path / name))
        after = spark.read.parquet(out)
        now = after.collect()
        if name != "sentencepiece":
            assert after.columns == docs.columns
            assert {(r.doc_id, r.text) for r in now} <= whole
        if name == "language_id":
            assert all(r.text and re.search(r"[^\W\d_]", r.text) for r in now)
        if name == "exact_dedup":
            groups = {}
            for i, t, *_ in rows:
                groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0))
            assert sorted((-len(r.text or ""), r.doc_id is None, r.doc_id or 0) for r in now) == sorted(min(g) for g in groups.values())
        if name == "ngram_jaccard_join":
            # without words there is no copy; all others are told apart by their texts at least
            assert {r.doc_id for r in now if not norm(r.text)} == {i for i, t, *_ in rows if not norm(t)}
            texts = [r.text for r in now if norm(r.text)]
            assert len(texts) == len(set(texts)) and (len(texts) > 0) == any(norm(t) for _, t, *_ in rows)
        if name == "sentencepiece":
            assert len(now) == len(rows) and all(r.round_trip for r in now)


def test_run_gives_rows(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
