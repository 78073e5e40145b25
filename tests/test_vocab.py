"""Vocabulary from a merge table, BOS and its fallback."""

import random

import pytest
from pyspark.sql import functions as F

from tokenmill.operators import tokenizer as TK

MERGES = "a int, b int, token_id int"


def test_vocabulary_equals_merges_replayed_in_order(spark):
    rng = random.Random(5)
    merges = [(97, 98, 256), (256, 256, 257), (257, 257, 258), (258, 0, 259), (259, 259, 260)]
    merges += [(rng.randrange(i), rng.randrange(i), i) for i in range(261, 400)]
    got = TK.build_vocab(spark.createDataFrame(merges, MERGES)).collect()
    want = {r.token_id: r.hex for r in TK.merges_vocab(spark, merges).collect()}
    assert {r.token_id: r.hex for r in got} == want and len(got) == len(want)
    assert [r.name for r in sorted(got, key=lambda r: r.token_id) if r.is_special] == TK.SPECIAL_TOKENS


def test_vocabulary_without_merges(spark):
    got = TK.build_vocab(spark.createDataFrame([], MERGES)).collect()
    assert {r.token_id: r.hex for r in got} == {r.token_id: r.hex for r in TK.byte_vocab(spark).collect()}


def test_bos_its_fallback_and_its_absence(spark):
    none = spark.createDataFrame([], MERGES)

    def first(specials):
        vocab = TK.build_vocab(none, specials)
        return vocab.select(TK.bos_id(vocab).alias("b")).first().b

    assert first(["<|endoftext|>", "<|bos|>"]) == 257
    assert first(["<|pad|>", "<|endoftext|>"]) == 257
    with pytest.raises(Exception, match="no BOS token"):
        first(["<|pad|>"])


def test_merges_in_a_circle_are_refused(spark):
    with pytest.raises(ValueError, match="cycle"):
        TK.build_vocab(spark.createDataFrame([(257, 1, 256), (256, 1, 257)], MERGES), rounds=3)
