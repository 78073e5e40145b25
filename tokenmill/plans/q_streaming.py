"""Registered streaming queries: each runs the stream to
completion over files staged from the given tables and returns the sink,
so batch = stream can be checked against the batch oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.operators.conversations import nest_conversations, validate_conversations
from tokenmill.operators.packing import GROUP_DOCS
from tokenmill.plans.catalog import load, oracle
from tokenmill.plans.packing_report import byte_token_lengths
from tokenmill.plans.positions import global_position
from tokenmill.plans.q_packing import _BESTFIT_CROP_PLAN_SQL, _GREEDY_HEAD
from tokenmill.plans.registry import query
from tokenmill.streaming import jobs as S

STREAM_T = 256


@query("stream_shards", oracle("""
select source, count(*) as docs, cast(sum(length(text)) as bigint) as chars,
       cast(sum(octet_length(encode(text))) as bigint) as bytes
from documents group by source"""))
def q_stream_shards(spark, sf_dir):
    r = S.stream_shards(spark, load(spark, sf_dir).documents)
    return r.select("source", "docs", F.col("chars").cast("long").alias("chars"),
                    F.col("bytes").cast("long").alias("bytes"))


@query("stream_eval_progress", oracle("""
select task, cast(sum(case when passed then 1 else 0 end) as bigint) as passed, count(*) as total,
       avg(case when passed then 1.0e0 else 0.0e0 end) as accuracy
from (select task, idx, bool_or(is_correct) as passed from eval_outcomes group by task, idx) p group by task""",
                                    "eval_outcomes"))
def q_stream_eval_progress(spark, sf_dir):
    return S.stream_eval_progress(spark, load(spark, sf_dir).eval_outcomes)


@query("stream_validate", oracle("""
with m as (select conv_id, turn, case when role is null then 'missing_role' when text is null then 'missing_content'
            when role <> case when turn % 2 = 0 then 'user' else 'assistant' end then 'bad_role' end as code
           from conversations_bad),
c as (select conv_id, count(*) as n, min(case when code is not null then turn end) as bad_turn from m group by conv_id),
r as (select c.conv_id, case when c.n < 2 then 'too_short' else m.code end as reason
      from c left join m on m.conv_id = c.conv_id and m.turn = c.bad_turn)
select case when reason is null then 'good' else 'bad' end as status, reason, count(*) as conversations
from r group by 1, 2""", "conversations_bad"))
def q_stream_validate(spark, sf_dir):
    nested = nest_conversations(load(spark, sf_dir).conversations_bad)
    lines = nested.select(F.to_json(F.struct("conv_id", "messages")).alias("value"))
    return S.stream_validate(spark, lines, lambda d: validate_conversations(d, "strict"))


@query("stream_run_metrics", oracle("""
with recursive e(run_id, step, s) as (
  select run_id, step, 0.1e0 * loss from train_steps where step = 0
  union all
  select t.run_id, t.step, 0.9e0 * e.s + 0.1e0 * t.loss from e join train_steps t on t.run_id = e.run_id and t.step = e.step + 1)
select t.run_id, t.step, e.s / (1 - power(0.9e0, t.step + 1)) as smooth_loss,
       min(t.val_bpb) over (partition by t.run_id order by t.step rows between unbounded preceding and current row) as best_so_far,
       sum(case when t.step > 10 then t.dt else 0.0e0 end) over (partition by t.run_id order by t.step
           rows between unbounded preceding and current row) as total_time
from train_steps t join e on e.run_id = t.run_id and e.step = t.step""", "train_steps"))
def q_stream_run_metrics(spark, sf_dir):
    r = S.stream_run_metrics(spark, load(spark, sf_dir).train_steps)
    return r.filter(~F.col("late")).drop("late")


# the rule of a whole stream, for each pack group by itself
_GROUPED_HEAD = _GREEDY_HEAD.replace("d as (", "stream as (") + f""",
d as (select split || '|' || cast(i // {GROUP_DOCS} as varchar) as split, n, i % {GROUP_DOCS} as i from stream)"""


@query("stream_pack", oracle(f"""
with placed as ({_BESTFIT_CROP_PLAN_SQL.replace(_GREEDY_HEAD, _GROUPED_HEAD).format(cap=STREAM_T + 1)}),
numbered as (select split, doc_id, row_number() over (partition by split order by source, doc_id) - 1 as i from (
  select source, doc_id, case when source = (select max(source) from documents) then 'val' else 'train' end as split
  from documents) t),
p as (select split_part(split, '|', 1) as split, cast(split_part(split, '|', 2) as bigint) as pack_group, row_no, doc_pos,
             dst, take from placed)
select p.split, pack_group, row_no, doc_id, dst, take
from p join numbered d on d.split = p.split and d.i = pack_group * {GROUP_DOCS} + doc_pos"""))
def q_stream_pack(spark, sf_dir):
    lengths = byte_token_lengths(load(spark, sf_dir).documents)
    d = global_position(lengths, ["source", "doc_id"], ["split"], out="pos")
    return S.stream_pack(spark, d, STREAM_T + 1, group_docs=GROUP_DOCS)
