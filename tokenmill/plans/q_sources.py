"""Registered source / sink queries.

Each writes files derived from the given tables into the shared scratch
folder, reads them back with the source under test, and returns rows the
oracle can check.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.operators.conversations import nest_conversations, validate_conversations
from tokenmill.operators.corpus import pretrain_text
from tokenmill.plans.catalog import load, oracle
from tokenmill.plans.registry import query
from tokenmill.session import scratch_path
from tokenmill.sources import corpus as SC
from tokenmill.sources import files as SF
from tokenmill.sources.shards import assign_shards, write_shards

WS = r"[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
SHARD_CHARS = 200_000          # shard size for the registered check (reference: 250M)
TITLE_PREFIX = "Video "


@query("read_conversations_jsonl", oracle(f"""
with m as (select conv_id, turn, case when role is null then 'missing_role' when text is null then 'missing_content'
            when role <> case when turn % 2 = 0 then 'user' else 'assistant' end then 'bad_role' end as code
           from conversations_bad),
c as (select conv_id, count(*) as n, min(case when code is not null then turn end) as bad_turn,
             md5(min(case when turn = 0 then text end)) as first_md5 from m join conversations_bad using (conv_id, turn)
      group by conv_id)
select c.first_md5, cast(c.n as bigint) as n_messages, case when c.n < 2 then 'too_short' else m.code end as reason
from c left join m on m.conv_id = c.conv_id and m.turn = c.bad_turn""", "conversations_bad"))
def q_read_conversations_jsonl(spark, sf_dir):
    """conversations_bad written as plain JSONL (one array of messages per
    line, whitespace-only lines between), read back and validated. The file
    carries no id, so rows are identified by the first message's digest."""
    nested = nest_conversations(load(spark, sf_dir).conversations_bad)
    path = scratch_path(spark, "conversations_jsonl")
    nested.select(F.concat(F.to_json("messages"), F.lit("\n   ")).alias("value")).write.mode("overwrite").text(path)
    r = SF.read_conversations_jsonl(spark, path)
    v = validate_conversations(r, "strict")
    return v.select(F.md5(F.get(F.col("messages"), 0)["content"]).alias("first_md5"),
                    F.size("messages").cast("long").alias("n_messages"), "reason")


@query("read_delimited_corpus", oracle(rf"""
select md5(t) as text_md5, cast(length(t) as bigint) as n_chars from (
  select regexp_replace(text, '^{WS}+|{WS}+$', '', 'g') as t from documents) d where length(t) > 0"""))
def q_read_delimited_corpus(spark, sf_dir):
    path = scratch_path(spark, "delimited_corpus")
    SC.write_delimited_corpus(load(spark, sf_dir).documents, path)
    d = SC.read_delimited_corpus(spark, path)
    return d.select(F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars"))


@query("read_word_list", oracle("""
select word from words""", "words"))
def q_read_word_list(spark, sf_dir):
    path = scratch_path(spark, "word_list")
    load(spark, sf_dir).words.select(F.concat(F.lit("  "), "word", F.lit(" ")).alias("value")) \
        .write.mode("overwrite").text(path)
    return SF.read_word_list(spark, path)


@query("unwrap_rows", oracle("""
select item_id, subject, question, answer from mc_items""", "mc_items"))
def q_unwrap_rows(spark, sf_dir):
    nested = load(spark, sf_dir).mc_items.select(F.struct("*").alias("train"))
    return SF.unwrap_rows(nested, "train").select("item_id", "subject", "question", "answer")


@query("read_title_tsv", oracle(f"""
select cast(d.doc_id as varchar) as id,
       coalesce(case when d.doc_id % 3 <> 0 then t.title end, '{TITLE_PREFIX}' || cast(d.doc_id as varchar)) as title
from documents d left join transcripts t on t.id = d.doc_id""", "transcripts"))
def q_read_title_tsv(spark, sf_dir):
    """Titles written as ``id<TAB>title`` (every third id missing, plus junk
    lines without a tab); every document id gets a title or the default."""
    cat = load(spark, sf_dir)
    path = scratch_path(spark, "titles_tsv")
    tsv = cat.transcripts.filter(F.col("id") % 3 != 0).select(
        F.concat(F.col("id").cast("string"), F.lit("\t"), F.col("title")).alias("value"))
    junk = cat.transcripts.filter(F.col("id") % 50 == 1).select(F.lit("no tab on this line").alias("value"))
    tsv.unionByName(junk).write.mode("overwrite").text(path)
    titles = SF.read_title_tsv(spark, path)
    ids = cat.documents.select(F.col("doc_id").cast("string").alias("id"))
    return SF.title_lookup(ids, titles, TITLE_PREFIX).select("id", "title")


@query("write_jsonl", oracle("""
select id, md5('# ' || title || chr(10) || chr(10) || text) as doc_md5, cast(length(text) as bigint) as char_count
from transcripts""", "transcripts"))
def q_write_jsonl(spark, sf_dir):
    """Transcripts written as JSONL (non-ASCII kept) and read back."""
    t = load(spark, sf_dir).transcripts.withColumn("char_count", F.length("text"))
    path = scratch_path(spark, "transcripts_jsonl")
    SF.write_jsonl(t, path, ["id", "title", "text", "char_count"])
    back = spark.read.schema("id long, title string, text string, char_count long").json(path)
    back = pretrain_text(back)
    return back.select("id", F.md5("document").alias("doc_md5"), "char_count")


_SHARD_SQL = f"""
p as (select doc_id, length(text) as n,
             row_number() over (order by md5('42:' || cast(doc_id as varchar)), doc_id) - 1 as pos from documents),
c as (select pos // 1024 as chunk, sum(n) as chars from p group by 1),
c2 as (select chunk, chars, row_number() over (order by chunk) as rn from c),
f(rn, chunk, acc, shard, cut) as (
  select rn, chunk, chars, 0, chars >= {{cps}} from c2 where rn = 1
  union all
  select c2.rn, c2.chunk, case when f.cut then c2.chars else f.acc + c2.chars end,
         case when f.cut then f.shard + 1 else f.shard end,
         (case when f.cut then c2.chars else f.acc + c2.chars end) >= {{cps}}
  from f join c2 on c2.rn = f.rn + 1),
last_cut as (select max(case when cut then chunk end) as lc from f)"""


@query("write_balanced_shards", oracle(f"""
with recursive {_SHARD_SQL.format(cps=SHARD_CHARS)}
select f.shard, count(*) as docs, cast(sum(p.n) as bigint) as chars
from p join f on f.chunk = p.pos // 1024, last_cut
where f.chunk <= last_cut.lc group by f.shard"""))
def q_write_balanced_shards(spark, sf_dir):
    """Seeded order, 1024-doc chunks, cut at >= SHARD_CHARS; the tail after
    the last cut is not written. Returns per written shard docs and chars."""
    docs = load(spark, sf_dir).documents
    a = assign_shards(docs, chars_per_shard=SHARD_CHARS)
    path = scratch_path(spark, "balanced_shards")
    write_shards(a, path)
    back = spark.read.parquet(path)
    return back.groupBy("shard").agg(F.count("*").alias("docs"), F.sum(F.length("text")).cast("long").alias("chars"))
