"""Registered tokenizer queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.operators import tokenizer as TK
from tokenmill.operators.corpus import split_last_shard
from tokenmill.plans.catalog import load, oracle
from tokenmill.plans.registry import query
from tokenmill.session import scratch_path

VOCAB_SIZE = 32768                    # the reference's vocabulary: 256 bytes, 9 specials, the rest merges
BPE_MERGES = VOCAB_SIZE - TK.N_BYTES - len(TK.SPECIAL_TOKENS)


def _train_docs(spark, sf_dir):
    """Training text: whole documents of the train split. A character budget
    and a cap per document are P1 and P2, with queries of their own."""
    return split_last_shard(load(spark, sf_dir).documents, "source").filter("split = 'train'")


_MERGE_TABLES: dict = {}


def trained_merges(spark, sf_dir, n_merges: int = BPE_MERGES):
    """The merges of the training job. Its table is written once per session
    and input; later queries read it."""
    key = (sf_dir, n_merges, spark.sparkContext.applicationId)
    if key not in _MERGE_TABLES:
        merges = TK.train_bpe(TK.pretoken_histogram(_train_docs(spark, sf_dir)), TK.N_BYTES + len(TK.SPECIAL_TOKENS) + n_merges)
        path = scratch_path(spark, "merges")
        spark.createDataFrame(merges, "a int, b int, token_id int").write.parquet(path)
        _MERGE_TABLES[key] = path
    rows = spark.read.parquet(_MERGE_TABLES[key]).orderBy("token_id").collect()  # as many as merges
    return [(r["a"], r["b"], r["token_id"]) for r in rows]


@query("pretokenize", oracle("""
select doc_id, true as roundtrip_ok from documents"""))
def q_pretokenize(spark, sf_dir):
    d = load(spark, sf_dir).documents
    pieces = TK.pretokenize("text")
    return d.select("doc_id", (F.array_join(pieces, "") == F.col("text")).alias("roundtrip_ok"))


@query("pretoken_histogram")
def q_pretoken_histogram(spark, sf_dir):
    return TK.pretoken_histogram(load(spark, sf_dir).documents)


@query("byte_tokens", oracle("""
select doc_id, octet_length(encode(text)) + 1 as n_tokens, md5(hex(encode(text))) as bytes_md5 from documents"""))
def q_byte_tokens(spark, sf_dir):
    d = load(spark, sf_dir).documents.select("doc_id", TK.byte_tokens("text").alias("ids"))
    hx = F.array_join(F.transform(F.slice("ids", 2, F.size("ids")), lambda i: F.lpad(F.hex(i), 2, "0")), "")
    return d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.md5(hx).alias("bytes_md5"))


_CHARS = """chars as (select ch, row_number() over (order by ch) - 1 as char_id from (
  select distinct unnest(string_split(word, '')) as ch from words) c where length(ch) > 0)"""


@query("char_vocab", oracle(f"""
with {_CHARS} select ch, char_id from chars""", "words"))
def q_char_vocab(spark, sf_dir):
    return TK.char_vocab(load(spark, sf_dir).words)


@query("char_encode", oracle(f"""
with {_CHARS},
e as (select word, unnest(string_split(word, '')) as ch, unnest(generate_series(1, length(word))) as pos from words)
select word, cast(pos as bigint) as pos, char_id as token_id from e join chars using (ch)
union all
select word, 0, (select count(*) from chars) from words
union all
select word, length(word) + 1, (select count(*) from chars) from words""", "words"))
def q_char_encode(spark, sf_dir):
    w = load(spark, sf_dir).words
    enc = TK.char_encode(w, TK.char_vocab(w))
    return enc.select("word", F.col("pos").cast("long").alias("pos"), F.col("token_id").cast("long").alias("token_id"))


@query("token_bytes_stats", oracle("""
select cast(sum(case when n_bytes = 0 then 1 else 0 end) as bigint) as n_zero,
       min(case when n_bytes > 0 then n_bytes end) as min_bytes, max(case when n_bytes > 0 then n_bytes end) as max_bytes,
       avg(case when n_bytes > 0 then n_bytes end) as mean_bytes, stddev_samp(case when n_bytes > 0 then n_bytes end) as std_bytes
from token_bytes""", "token_bytes"))
def q_token_bytes_stats(spark, sf_dir):
    return TK.token_bytes_stats(load(spark, sf_dir).token_bytes)


@query("train_bpe")
def q_train_bpe(spark, sf_dir):
    merges = trained_merges(spark, sf_dir)
    return spark.createDataFrame([(i, a, b, n) for i, (a, b, n) in enumerate(merges)],
                                 "rank int, a int, b int, token_id int")


@query("encode_bpe", oracle("""
select doc_id, true as roundtrip_ok from documents"""))
def q_encode_bpe(spark, sf_dir):
    merges = trained_merges(spark, sf_dir)
    d = load(spark, sf_dir).documents
    enc = TK.encode_bpe(d, merges)
    dec = TK.decode_ids(enc, TK.merges_vocab(spark, merges))
    j = d.select("doc_id", "text").join(dec.withColumnRenamed("text", "decoded"), "doc_id", "left")
    return j.select("doc_id", (F.coalesce(F.col("decoded"), F.lit("")) == F.col("text")).alias("roundtrip_ok"))


@query("build_vocab")
def q_build_vocab(spark, sf_dir):
    """Vocabulary of the trained merges with the id a document starts with."""
    merges = spark.createDataFrame(trained_merges(spark, sf_dir), "a int, b int, token_id int")
    vocab = TK.build_vocab(merges)
    return vocab.withColumn("bos_id", TK.bos_id(vocab))


@query("token_bytes")
def q_token_bytes(spark, sf_dir):
    return TK.token_bytes(TK.merges_vocab(spark, trained_merges(spark, sf_dir)))


@query("compression_ratio")
def q_compression_ratio(spark, sf_dir):
    d = load(spark, sf_dir).documents
    enc = TK.encode_bpe(d, trained_merges(spark, sf_dir), prepend=None)
    return TK.compression_ratio(enc, d, "lang")


@query("compare_tokenizers")
def q_compare_tokenizers(spark, sf_dir):
    d = load(spark, sf_dir).documents
    base = TK.compression_ratio(d.select("doc_id", TK.byte_tokens("text", bos=False).alias("ids")), d, "lang")
    ours = TK.compression_ratio(TK.encode_bpe(d, trained_merges(spark, sf_dir), prepend=None), d, "lang")
    return TK.compare_tokenizers(base, ours, "lang")
