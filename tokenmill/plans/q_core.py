"""Registered CORE prompt queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.operators import core_prompts as CP
from tokenmill.operators.tokenizer import byte_tokens
from tokenmill.plans.catalog import load, oracle
from tokenmill.plans.registry import query
from tokenmill.session import scratch_path
from tokenmill.sources.files import read_eval_jsonl, write_jsonl

CORE_SCHEMA = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("task", T.StringType()),
    T.StructField("task_type", T.StringType()), T.StructField("query", T.StringType()),
    T.StructField("c0", T.StringType()), T.StructField("c1", T.StringType()),
    T.StructField("gold", T.IntegerType()), T.StructField("context", T.StringType()),
    T.StructField("continuation", T.StringType()), T.StructField("num_fewshot", T.IntegerType()),
])
MAX_SEQ = 64


def _items(spark, sf_dir):
    """core_items written as JSONL and read back with the fixed schema."""
    path = scratch_path(spark, "core_items_jsonl")
    write_jsonl(load(spark, sf_dir).core_items, path)
    return read_eval_jsonl(spark, path, CORE_SCHEMA)


@query("read_eval_jsonl", oracle("""
select item_id, task, task_type, query, c0, c1, gold, context, continuation, num_fewshot from core_items""",
                                 "core_items"))
def q_read_eval_jsonl(spark, sf_dir):
    return _items(spark, sf_dir)


_H = "cast(('0x' || substr(md5(cast(idx + 1234 as varchar) || ':' || cast({j} as varchar)), 1, 8)) as bigint) % ({j} + 1)"
_FEW = f"""
it as (select *, row_number() over (partition by task order by item_id) - 1 as idx,
              count(*) over (partition by task) as n from core_items),
kk as (select *, least(num_fewshot, n - 1) as k, n - 1 as av from it),
s1 as (select *, case when k >= 1 then {_H.format(j='(av - k)')} end as t1,
                 case when k >= 2 then {_H.format(j='(av - k + 1)')} end as h2,
                 case when k >= 3 then {_H.format(j='(av - k + 2)')} end as h3 from kk),
s2 as (select *, case when h2 = t1 then av - k + 1 else h2 end as t2 from s1),
s3 as (select *, case when h3 = t1 or h3 = t2 then av - k + 2 else h3 end as t3 from s2),
shots as (select task, idx, item_id, shot_no, case when t < idx then t else t + 1 end as shot_idx
          from (select task, idx, item_id, unnest([t1, t2, t3][1:k]) as t,
                       unnest(generate_series(0, k - 1)) as shot_no from s3 where k > 0) u),
shot_items as (select s.item_id, s.shot_no, i.* exclude (item_id, idx, n) , i.item_id as shot_item_id
               from shots s join it i on i.task = s.task and i.idx = s.shot_idx)"""


@query("fewshot_sample", oracle(f"""
with {_FEW}
select item_id, cast(shot_no as bigint) as shot_no, shot_item_id from shot_items""", "core_items"))
def q_fewshot_sample(spark, sf_dir):
    d = CP.fewshot_sample(load(spark, sf_dir).core_items)
    return d.select("item_id", F.posexplode("shots").alias("shot_no", "s")).select(
        "item_id", F.col("shot_no").cast("long").alias("shot_no"), F.col("s.item_id").alias("shot_item_id"))


_WS = r"[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _trim(x: str) -> str:
    return "regexp_replace(" + x + ", '^" + _WS + "+|" + _WS + "+$', '', 'g')"


_PROMPTS = f"""
{_FEW},
txt as (select i.item_id, i.task_type, i.query, i.c0, i.c1, i.context, i.continuation,
          coalesce((select string_agg(s.query || ' ' || case when s.gold = 0 then s.c0 else s.c1 end || chr(10) || chr(10), ''
                                      order by s.shot_no) from shot_items s where s.item_id = i.item_id), '') as mc_shots,
          coalesce((select string_agg(case when s.gold = 0 then s.c0 else s.c1 end || ' ' || s.continuation || chr(10) || chr(10), ''
                                      order by s.shot_no) from shot_items s where s.item_id = i.item_id), '') as sc_shots,
          coalesce((select string_agg({_trim('s.context')} || ' ' || s.continuation || chr(10) || chr(10), ''
                                      order by s.shot_no) from shot_items s where s.item_id = i.item_id), '') as lm_shots
        from core_items i),
p as (
  select item_id, 0 as option, case task_type when 'multiple_choice' then mc_shots || query || ' ' || c0
         when 'schema' then sc_shots || c0 || ' ' || continuation
         else {_trim("lm_shots || " + _trim('context') + " || ' '")} end as prompt from txt
  union all
  select item_id, 1, case task_type when 'multiple_choice' then mc_shots || query || ' ' || c1
         when 'schema' then sc_shots || c1 || ' ' || continuation
         else lm_shots || {_trim('context')} || ' ' || continuation end from txt)"""


@query("render_core_prompts", oracle(f"""
with {_PROMPTS}
select item_id, cast(option as bigint) as option, md5(prompt) as prompt_md5 from p""", "core_items"))
def q_render_core_prompts(spark, sf_dir):
    d = CP.render_core_prompts(CP.fewshot_sample(load(spark, sf_dir).core_items))
    return d.select("item_id", F.posexplode("prompts").alias("option", "prompt")).select(
        "item_id", F.col("option").cast("long").alias("option"), F.md5("prompt").alias("prompt_md5"))


def _spans(spark, sf_dir):
    d = CP.render_core_prompts(CP.fewshot_sample(load(spark, sf_dir).core_items))
    d = d.withColumn("tokens", F.transform("prompts", lambda p: byte_tokens(p)))
    return CP.answer_spans(d.select("item_id", "task", "task_type", "gold", "tokens"))


# one token per byte after a BOS; shared bytes by bisection on the hex text
_SPANS = f"""{_PROMPTS},
hx as (select p.item_id, i.task_type, p.option, hex(encode(p.prompt)) as h, cast(octet_length(encode(p.prompt)) as bigint) as n
       from p join core_items i on i.item_id = p.item_id),
two as (select a.item_id, a.task_type, a.h as h0, a.n as n0, b.h as h1, b.n as n1
        from hx a join hx b on b.item_id = a.item_id where a.option = 0 and b.option = 1),
halves(item_id, lo, hi) as (
  select item_id, cast(0 as bigint), least(n0, n1) from two where task_type <> 'language_modeling'
  union all
  select item_id, case when same then mid else lo end, case when same then hi else mid - 1 end from (
    select h.item_id, lo, hi, (lo + hi + 1) // 2 as mid,
           case when task_type = 'schema' then right(h0, 2 * ((lo + hi + 1) // 2)) = right(h1, 2 * ((lo + hi + 1) // 2))
                else left(h0, 2 * ((lo + hi + 1) // 2)) = left(h1, 2 * ((lo + hi + 1) // 2)) end as same
    from halves h join two t on t.item_id = h.item_id where lo < hi) x),
shared as (select item_id, lo as k from halves where lo = hi),
spans as (
  select t.item_id, t.task_type, o.option, case when o.option = 0 then n0 else n1 end + 1 as n_tokens,
         case when t.task_type = 'schema'
              then case when o.option = 0 then n0 else n1 end + 1 - k - case when n0 = n1 and k = n0 then 1 else 0 end
              else k + 1 end as first, cast(null as varchar) as reason
  from two t join shared s on s.item_id = t.item_id, (select unnest([0, 1]) as option) o
  union all
  select item_id, task_type, 0, n1 + 1, n0 + 1,
         case when not (n0 < n1 and left(h1, 2 * n0) = h0) then 'lm_not_prefix' end
  from two where task_type = 'language_modeling')"""


@query("answer_span", oracle(f"""
with recursive {_SPANS}
select item_id, task_type, cast(option as int) as option, cast(first as int) as start, cast(n_tokens as int) as "end",
       reason, cast(n_tokens as int) as n_tokens from spans""", "core_items"))
def q_answer_span(spark, sf_dir):
    return _spans(spark, sf_dir).select("item_id", "task_type", "option", "start", "end", "reason",
                                        F.size("tokens").alias("n_tokens"))


@query("crop_left", oracle(f"""
with recursive {_SPANS}
select item_id, task_type, cast(option as int) as option, cast(first - greatest(n_tokens - {MAX_SEQ}, 0) as int) as start,
       cast(least(n_tokens, {MAX_SEQ}) as int) as "end", cast(least(n_tokens, {MAX_SEQ}) as int) as n_tokens
from spans""", "core_items"))
def q_crop_left(spark, sf_dir):
    c = CP.crop_left(_spans(spark, sf_dir), MAX_SEQ)
    return c.select("item_id", "task_type", "option", "start", "end", F.size("tokens").alias("n_tokens"))
