"""Registered corpus queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.operators import corpus as C
from tokenmill.operators.packing import multi_epoch
from tokenmill.plans.catalog import load, oracle
from tokenmill.plans.positions import global_position
from tokenmill.plans.registry import query
from tokenmill.session import scratch_path
from tokenmill.sources.corpus import scan_shards, write_train_val

# DuckDB spelling of Python's Unicode whitespace class (RE2 \s is ASCII only)
WS = r"[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _docs_with_pos(spark, sf_dir):
    cat = load(spark, sf_dir)
    d = cat.documents.withColumnRenamed("source", "shard")
    return cat, global_position(d, ["doc_id"], ["shard"], out="pos")


@query("scan_shards", oracle("""
select doc_id, 'documents.parquet' as file_name, n_chars from documents"""))
def q_scan_shards(spark, sf_dir):
    missing = scratch_path(spark, "no_shards_here")     # primary folder absent -> legacy folder
    df = scan_shards(spark, missing, glob="documents*.parquet", legacy_path=sf_dir)
    return df.select("doc_id", "file_name", "n_chars")


@query("split_last_shard", oracle("""
select case when source = (select max(source) from documents) then 'val' else 'train' end as split,
       count(*) as docs, cast(sum(n_chars) as bigint) as chars
from documents group by 1"""))
def q_split_last_shard(spark, sf_dir):
    d = C.split_last_shard(load(spark, sf_dir).documents, "source")
    return d.groupBy("split").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"))


@query("rank_stride", oracle("""
select doc_id, shard, cast(pos as bigint) as pos, cast(floor(pos / 8) as bigint) as rg_idx,
       cast(floor(pos / 8) % 3 as int) as rank
from shards""", "shards"))
def q_rank_stride(spark, sf_dir):
    _, d = _docs_with_pos(spark, sf_dir)
    d = C.rank_stride(C.with_row_groups(d, rows_per_group=8), world=3)
    return d.select("doc_id", "shard", "pos", "rg_idx", "rank")


@query("resume_after", oracle("""
select doc_id, shard, cast(floor(pos / 4) as bigint) as rg_idx from (
  select *, cast(substr(shard, 4) as int) as shard_no from shards) s
where floor(pos / 4) % 2 = 1
  and (shard_no > 3 or (shard_no = 3 and floor(pos / 4) >= (5 // 2 + 1) * 2 + 1))""", "shards"))
def q_resume_after(spark, sf_dir):
    _, d = _docs_with_pos(spark, sf_dir)
    d = C.with_row_groups(d, rows_per_group=4).withColumn(
        "shard_no", F.substring("shard", 4, 10).cast("int"))
    d = C.resume_after(d, pq_idx=3, rg_idx=5, world=2, rank=1)
    return d.select("doc_id", "shard", "rg_idx")


@query("crop_document", oracle("""
select doc_id, cast(length(substr(text, 1, 10000)) as bigint) as n_chars,
       md5(substr(text, 1, 10000)) as text_md5
from documents"""))
def q_crop_document(spark, sf_dir):
    d = C.crop_document(load(spark, sf_dir).documents)
    return d.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


@query("char_budget_prefix", oracle("""
select doc_id, cast(chars_before as bigint) as chars_before from (
  select doc_id, coalesce(sum(length(substr(text, 1, 10000))) over (
           order by source, doc_id rows between unbounded preceding and 1 preceding), 0) as chars_before
  from documents where source <> (select max(source) from documents)) t
where chars_before <= 1000000"""))
def q_char_budget_prefix(spark, sf_dir):
    d = C.split_last_shard(load(spark, sf_dir).documents, "source").filter("split = 'train'")
    d = C.char_budget_prefix(d, 1_000_000, ["source", "doc_id"])
    return d.select("doc_id", "chars_before")


@query("clean_transcript", oracle(rf"""
select id, md5(clean) as clean_md5, cast(length(clean) as bigint) as clean_chars from (
  select id, case when length(t) < 100 then '' else t end as clean from (
    select id, regexp_replace(regexp_replace(regexp_replace(text, '\[.*?\]', '', 'g'),
                 '{WS}+', ' ', 'g'), '^{WS}+|{WS}+$', '', 'g') as t
    from transcripts) a) b""", "transcripts"))
def q_clean_transcript(spark, sf_dir):
    d = C.clean_transcript(load(spark, sf_dir).transcripts)
    return d.select("id", F.md5("clean").alias("clean_md5"), F.length("clean").cast("long").alias("clean_chars"))


@query("min_length_filter", oracle("""
select doc_id, n_chars from documents where length(text) >= 100"""))
def q_min_length_filter(spark, sf_dir):
    return C.min_length_filter(load(spark, sf_dir).documents).select("doc_id", "n_chars")


@query("repeat_rows", oracle("""
select d.doc_id, c.copy from documents d
join (select unnest(generate_series(1, cast(greatest(1, floor(500000 / (select sum(length(text)) from documents))) as bigint)))
      as copy) c on true"""))
def q_repeat_rows(spark, sf_dir):
    d = load(spark, sf_dir).documents
    d = C.repeat_rows(d, C.corpus_multiplier(d))
    return d.select("doc_id", F.col("copy").cast("long").alias("copy"))


@query("corpus_profile", oracle("""
select lang, source, count(*) as docs, cast(sum(length(text)) as bigint) as chars,
       cast(floor(sum(length(text)) / 4) as bigint) as approx_tokens
from documents group by rollup(lang, source)"""))
def q_corpus_profile(spark, sf_dir):
    d = C.corpus_profile(load(spark, sf_dir).documents)
    return d.select("lang", "source", "docs", F.col("chars").cast("long").alias("chars"), "approx_tokens")


@query("length_histogram", oracle("""
select cast(length(text) as bigint) as length, count(*) as docs,
       cast(min(length(text)) over () as bigint) as min_length,
       cast(max(length(text)) over () as bigint) as max_length
from documents group by length(text)"""))
def q_length_histogram(spark, sf_dir):
    h = C.length_histogram(load(spark, sf_dir).documents).withColumn("length", F.col("length").cast("long"))
    return h.select("length", "docs", h.select(F.min("length")).scalar().alias("min_length"),
                    h.select(F.max("length")).scalar().alias("max_length"))


@query("seeded_shuffle", oracle("""
select doc_id, row_number() over (order by md5('42:' || cast(doc_id as varchar)), doc_id) - 1 as shuffle_pos
from documents"""))
def q_seeded_shuffle(spark, sf_dir):
    return C.seeded_shuffle(load(spark, sf_dir).documents, 42, "doc_id").select("doc_id", "shuffle_pos")


@query("multi_epoch", oracle("""
select doc_id, cast(e.epoch as bigint) as epoch,
       (e.epoch - 1) * (select count(*) from documents) + row_number() over (partition by e.epoch order by source, doc_id) - 1
         as stream_pos
from documents cross join (select 1 as epoch union all select 2 union all select 3) e"""))
def q_multi_epoch(spark, sf_dir):
    d = load(spark, sf_dir).documents
    d = global_position(d, ["source", "doc_id"], (), out="pos")
    n = d.select(F.count("*")).scalar()
    d = multi_epoch(d, 3)
    return d.select("doc_id", F.col("epoch").cast("long").alias("epoch"),
                    ((F.col("epoch") - 1) * n + F.col("pos")).alias("stream_pos"))


@query("train_val_docs", oracle(rf"""
with d as (
  select doc_id, regexp_replace(text, '^{WS}+|{WS}+$', '', 'g') as t from documents),
n as (select count(*) as n, sum(length(t)) as chars from d where length(t) > 0),
p as (select doc_id, t, row_number() over (order by doc_id) - 1 as doc_pos from d where length(t) > 0)
select doc_id, 'val' as split, cast(1 as bigint) as copy from p, n where doc_pos = n.n - 1
union all
select doc_id, 'train' as split, cast(c.copy as bigint) as copy from p, n,
  (select unnest(generate_series(1, cast(greatest(1, floor(500000 / (select chars from n))) as bigint))) as copy) c
where doc_pos < n.n - 1 or (n.n = 1 and doc_pos = 0)"""))
def q_train_val_docs(spark, sf_dir):
    d = load(spark, sf_dir).documents
    d = C.train_val_docs(d, ["doc_id"])
    path = scratch_path(spark, "train_val")
    write_train_val(d.select("split", F.concat_ws("|", F.col("doc_id").cast("string"),
                                                  F.col("copy").cast("string"), "text").alias("text")), path)
    back = spark.read.parquet(path)
    parts = F.split("text", r"\|", 3)
    return back.select(parts.getItem(0).cast("long").alias("doc_id"), "split",
                       parts.getItem(1).cast("long").alias("copy"))


@query("pretrain_text", oracle("""
select id, md5('# ' || title || chr(10) || chr(10) || text) as doc_md5 from transcripts""", "transcripts"))
def q_pretrain_text(spark, sf_dir):
    d = C.pretrain_text(load(spark, sf_dir).transcripts)
    return d.select("id", F.md5("document").alias("doc_md5"))
