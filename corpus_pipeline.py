"""Corpus pipeline: five operators of ``tokenmill.llm`` in a row.

Every stage is (spark, docs, sf_dir) -> DataFrame; its result is written as
Parquet and reread as the next stage's documents. All but the last keep the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokenmill.llm.exact_dedup import drop_exact_copies
from tokenmill.llm.language_crf import drop_unidentified
from tokenmill.llm.ngram_jaccard import drop_near_copies
from tokenmill.llm.piece_codec import code
from tokenmill.llm.queries import TOKENIZERS
from tokenmill.llm.scratch import materialise
from tokenmill.llm.source_mix import mixed_documents
from tokenmill.session import checkpoint_dir, ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; the others go, with them null texts
    and texts without a letter. Repeated rows are judged alike."""
    return drop_unidentified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, of equally long
    ones the smallest doc_id (null last). Null and empty texts are one group."""
    return drop_exact_copies(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, that of the smallest
    doc_id (null last). Texts without a word have no copies and stay; rows equal
    in id and text are one."""
    return drop_near_copies(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, to the nearest
    whole number of times, at most three; those of which less than half is taken
    go, with them all without words. A null source is a source of its own."""
    return mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as ids; rows whose ids don't decode to their text fail
    the job, as they would lose data. Null and empty texts have no ids."""
    coded = code(docs, f"{TOKENIZERS}/piece_bpe_32k.model", keep=("lang", "source"))
    return coded.selectExpr("doc_id", "lang", "source", "assert_true(round_trip) is null as round_trip", "n_tokens", "ids_sha256", "ids")


def _ready(stage):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        checkpoint_dir(spark)
        ship_package(spark)
        return stage(spark, docs, sf_dir)
    run.__name__ = stage.__name__
    return run


STAGES = [(f.__name__, _ready(f)) for f in (language_id, exact_dedup, ngram_jaccard_join, source_mixing, sentencepiece)]

#: The stages include a learned model, apportionment and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
