"""Derived input views.

Portable SQL (same text runs in Spark and DuckDB) that derives the
inputs of the reference's data shapes from the given tables. Both the
Spark jobs and the DuckDB oracles start from these views, so a check
compares operators, not input construction. Every view grows with the
table it reads.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}

VIEWS["shards"] = """
select doc_id, text, lang, source as shard,
       row_number() over (partition by source order by doc_id) - 1 as pos
from documents
"""

VIEWS["words"] = """
select distinct word from (
  select translate(lower(t.word), ',.;:!?' || chr(10), '') as word
  from (select unnest(string_split(text, ' ')) as word from documents) t) w
where length(word) between 3 and 12
"""

VIEWS["transcripts"] = """
select doc_id as id, 'Source ' || source || ': notes | ' || cast(doc_id as string) as title,
       '[Music] ' || text || '  [Applause]' as text
from documents
"""

VIEWS["conversations_bad"] = """
select conv_id, turn,
       case when conv_id % 10 = 4 and turn = 1 then 'user' else role end as role,
       case when conv_id % 10 = 7 and turn = 0 then ' ' else text end as text
from conversations
where not (conv_id % 10 = 2 and turn > 0)
"""

VIEWS["tool_convs"] = """
select o_orderkey as conv_id,
       case o_orderkey % 3
         when 0 then '[{"type":"text","text":"first"},"second",{"type":"image","text":"x"}]'
         when 1 then null else '[]' end as content_json
from orders
"""

VIEWS["tool_text"] = """
select o_orderkey as problem_id, a, b,
       case o_orderkey % 5
         when 0 then 'Buy <<' || cast(a as string) || '*' || cast(b as string) || '=' || cast(a*b as string) || '>>' || cast(a*b as string) || ' items.' || chr(10) || '#### ' || cast(a*b as string)
         when 1 then '<<' || cast(a as string) || '+' || cast(b as string) || '=' || cast(a+b+1 as string) || '>>' || chr(10) || '#### ' || cast(a+b as string)
         when 2 then 'Count <<''banana''.count(''a'')=3>><<7>> done' || chr(10) || '#### 3'
         when 3 then 'No call here. #### 1,' || cast(100 + a as string)
         else 'No marker at all' end as answer
from (select o_orderkey, o_orderkey % 50 as a, o_custkey % 9 + 1 as b from orders) o
"""

VIEWS["completions"] = """
select problem_id, k, answer,
       case (problem_id + k) % 6
         when 0 then answer
         when 1 then 'Result: #### ' || cast(a*b as string)
         when 2 then 'Result: #### 1,' || cast(100 + a as string) || '.'
         when 3 then 'nothing'
         when 4 then 'Sure:' || chr(10) || repeat(chr(96), 3) || 'python' || chr(10) || 'def f(x):' || chr(10) || '    return x' || chr(10) || repeat(chr(96), 3) || chr(10) || 'ok'
         else '  plain text  ' end as completion
from tool_text cross join (select 0 as k union all select 1 union all select 2 union all select 3) s
"""

VIEWS["mc_items"] = """
select p_partkey as item_id, p_type as subject, 'Which label fits ' || p_name || '?' as question,
       p_name as c0, p_brand as c1, p_type as c2, 'size ' || cast(p_size as string) as c3,
       cast(p_partkey % 4 as int) as answer
from part
"""

VIEWS["mc_answers"] = """
select item_id, subject, answer, letter_no, (item_id * 7 + letter_no * letter_no * 13) % 10 as score
from mc_items cross join (select 0 as letter_no union all select 1 union all select 2 union all select 3) l
"""

VIEWS["code_items"] = """
select p_partkey as item_id,
       case when p_partkey % 2 = 0 then 'import math' || chr(10) || '# note' || chr(10) || chr(10) || 'from os import path' || chr(10) else '' end
         || 'def f(x):' || chr(10) || '    import sys' || chr(10) as prompt,
       '    return x' as canonical_solution, 'f' as entry_point,
       'def check(c):' || chr(10) || '    assert c(1) == 1' as test
from part
"""

VIEWS["core_items"] = """
select p_partkey as item_id, p_brand as task,
       case p_partkey % 3 when 0 then 'multiple_choice' when 1 then 'schema' else 'language_modeling' end as task_type,
       'Q ' || p_name as query, p_name as c0, p_type as c1, cast(p_partkey % 2 as int) as gold,
       '  the ' || p_name || ' ' as context, 'is ' || p_brand as continuation,
       cast(p_size % 4 as int) as num_fewshot
from part
"""

VIEWS["option_losses"] = """
select o_orderkey as item_id, opt, pos, ((o_orderkey * 31 + opt * 17 + pos * 7) % 97) / 10.0e0 as loss,
       (o_orderkey + pos) % 3 as pred, case when o_orderkey % 2 = 0 then (o_orderkey + pos) % 3 else pos % 3 end as actual,
       cast(o_orderkey % 4 as int) as gold
from orders
cross join (select 0 as opt union all select 1 union all select 2 union all select 3) o
cross join (select 0 as pos union all select 1 union all select 2) p
"""

VIEWS["token_bytes"] = """
select cast(p_partkey as int) as token_id, cast(p_size % 8 as int) as n_bytes from part
"""

VIEWS["token_losses"] = """
select l_returnflag as split, l_orderkey as row_id, l_linenumber as pos,
       case when l_linenumber = 1 then -1 else cast(l_partkey % 200 as int) end as y,
       l_discount + l_tax + 0.5e0 as loss
from lineitem
"""

VIEWS["eval_outcomes"] = """
select task, idx, k, is_correct, seq_len from (
  select event_type as task, user_id as idx,
         row_number() over (partition by event_type, user_id order by event_id) - 1 as k,
         value < 15 as is_correct, cast(floor(value) as bigint) + 1 as seq_len
  from events) e
"""

VIEWS["task_accuracy"] = """
select t.task, t.accuracy, b.baseline from (
  select task, avg(case when is_correct then 1.0e0 else 0.0e0 end) as accuracy from eval_outcomes group by task) t
left join (select 'click' as task, 0.25e0 as baseline union all select 'view', 0.25e0 union all select 'error', 0.5e0 union all select 'signup', 0.0e0) b
  on t.task = b.task
"""

VIEWS["runs"] = """
select c_custkey as exp_id, flops_budget, depth,
       cast(depth as bigint) * depth * depth * 49152 as params_transformer,
       cast(depth as bigint) * 64 * 32768 as params_lm_head,
       floor(flops_budget / (6.0e0 * (cast(depth as bigint) * depth * depth * 49152 + cast(depth as bigint) * 64 * 32768))) as tokens_trained,
       case when (c_custkey + depth) % 29 = 0 then null when (c_custkey + depth) % 31 = 0 then 0.0e0
            else 0.7e0 + (depth - bestd) * (depth - bestd) / 500.0e0 + ((c_custkey * depth) % 7) / 2000.0e0 end as val_bpb
from customer
cross join (select 1e18 as flops_budget, 11 as bestd union all select 2.15e18, 13 union all select 4.64e18, 15 union all select 1e19, 17) f
cross join (select 8 as depth union all select 10 union all select 12 union all select 14 union all select 16 union all select 18 union all select 20) d
"""

VIEWS["train_steps"] = """
select run_id, step, loss, dt, case when step % 5 = 0 then loss / 3 else null end as val_bpb from (
  select user_id as run_id, row_number() over (partition by user_id order by ts, event_id) - 1 as step,
         value / 100 as loss, 0.25e0 + (event_id % 16) / 16.0e0 as dt
  from events) e
"""

VIEWS["train_runs"] = """
select 1 as run_no, 3.04e0 as hours, 0.2585e0 as core union all select 2, 2.91e0, 0.2578e0
union all select 3, 2.76e0, 0.2602e0 union all select 4, 2.02e0, 0.2571e0
"""

VIEWS["model_scores"] = """
select c_custkey as model_id, c_mktsegment as family, c_nationkey as size_bucket, x1, x2, x3,
       0.1e0 + 0.5e0 * x1 + 0.2e0 * x2 + 0.1e0 * x3 + (c_custkey % 3) / 100.0e0 as core
from (select c_custkey, c_mktsegment, c_nationkey, (c_custkey * 7 % 53) / 53.0e0 as x1,
             (c_custkey * 11 % 47) / 47.0e0 as x2, (c_custkey * 13 % 43) / 43.0e0 as x3 from customer) c
"""

VIEWS["report_lines"] = """
select cast(event_id as bigint) as line_no,
       case event_id % 3 when 0 then 'base' when 1 then 'sft' else 'rl' end as stage,
       case event_id % 4 when 0 then 'timestamp: 2024-01-0' || cast(event_id % 9 + 1 as string) || ' 10:00:0' || cast(event_id % 10 as string)
         when 1 then '- CORE: 0.' || cast(1000 + event_id % 900 as string)
         when 2 then '- GSM8K: 0.' || cast(event_id % 97 + 10 as string)
         else 'free text' end as line
from events
"""

VIEWS["run_logs"] = """
select file_no, line_no, case line_no % 10
         when 0 then 'lm_head                 : ' || cast(1 + file_no % 9 as string) || ',048,576'
         when 4 then 'wte                     : ' || cast(1 + line_no % 7 as string) || ',000,001'
         when 5 then 'bigram_embed            : ' || cast(line_no as string)
         when 6 then 'value_embeds            : 2,' || cast(100 + file_no as string)
         when 7 then 'transformer_matrices    : ' || cast(1 + file_no % 9 as string) || ',' || cast(100 + line_no % 800 as string) || ',000'
         when 8 then 'scalars                 : ' || cast(file_no as string)
         when 9 then 'total                   : ' || cast(3 + file_no % 9 as string) || ',999,999'
         when 1 then 'Step 00100 | Validation bpb: 0.8' || cast(10 + (file_no + line_no) % 89 as string)
         when 2 then 'Calculated number of iterations from target FLOPs: 1,' || cast(100 + file_no as string)
         else case when file_no % 7 = 0 then 'noise' else 'CORE metric: 0.2' || cast(10 + line_no % 89 as string) end end as line
from (select o_custkey % 100 as file_no, row_number() over (partition by o_custkey % 100 order by o_orderkey) - 1 as line_no from orders) o
"""

VIEWS["rules"] = """
select 1 as rule_no, 'red' as pattern_a, 'ring' as pattern_b, 9.0e0 as value union all select 2, 'red', '', 5.0e0
union all select 3, 'small', '', 3.0e0 union all select 4, 'anvil', '', 2.0e0
"""

VIEWS["responses"] = """
select o_orderkey as idx, case o_orderkey % 4
         when 0 then '{"messages":[{"role":"user","content":"hi"},{"role":"assistant","content":"hello"}]}'
         when 1 then '{"messages":[{"role":"assistant","content":"hello"}]}'
         when 2 then '{"error":"rate limit"}' else 'not json' end as body
from orders
"""


# Spark spellings of the views above that multiply rows by a small fixed
# list: a generator (``lateral view explode``) instead of a cross join with
# a union of literals. DuckDB keeps the portable text above; both give the
# same rows.
SPARK_VIEWS: dict[str, str] = {}

SPARK_VIEWS["words"] = """
select distinct word from (
  select translate(lower(t), ',.;:!?' || chr(10), '') as word
  from documents lateral view explode(split(text, ' ')) k as t) w
where length(word) between 3 and 12
"""

SPARK_VIEWS["completions"] = """
select problem_id, k, answer,
       case (problem_id + k) % 6
         when 0 then answer
         when 1 then 'Result: #### ' || cast(a*b as string)
         when 2 then 'Result: #### 1,' || cast(100 + a as string) || '.'
         when 3 then 'nothing'
         when 4 then 'Sure:' || chr(10) || repeat(chr(96), 3) || 'python' || chr(10) || 'def f(x):' || chr(10) || '    return x' || chr(10) || repeat(chr(96), 3) || chr(10) || 'ok'
         else '  plain text  ' end as completion
from tool_text lateral view explode(array(0, 1, 2, 3)) s as k
"""

SPARK_VIEWS["mc_answers"] = """
select item_id, subject, answer, letter_no, (item_id * 7 + letter_no * letter_no * 13) % 10 as score
from mc_items lateral view explode(array(0, 1, 2, 3)) l as letter_no
"""

SPARK_VIEWS["option_losses"] = """
select o_orderkey as item_id, opt, pos, ((o_orderkey * 31 + opt * 17 + pos * 7) % 97) / 10.0e0 as loss,
       (o_orderkey + pos) % 3 as pred, case when o_orderkey % 2 = 0 then (o_orderkey + pos) % 3 else pos % 3 end as actual,
       cast(o_orderkey % 4 as int) as gold
from orders
lateral view explode(array(0, 1, 2, 3)) o as opt
lateral view explode(array(0, 1, 2)) p as pos
"""

SPARK_VIEWS["runs"] = """
select c_custkey as exp_id, flops_budget, depth,
       cast(depth as bigint) * depth * depth * 49152 as params_transformer,
       cast(depth as bigint) * 64 * 32768 as params_lm_head,
       floor(flops_budget / (6.0e0 * (cast(depth as bigint) * depth * depth * 49152 + cast(depth as bigint) * 64 * 32768))) as tokens_trained,
       case when (c_custkey + depth) % 29 = 0 then null when (c_custkey + depth) % 31 = 0 then 0.0e0
            else 0.7e0 + (depth - bestd) * (depth - bestd) / 500.0e0 + ((c_custkey * depth) % 7) / 2000.0e0 end as val_bpb
from customer
lateral view inline(array(struct(1e18 as flops_budget, 11 as bestd), struct(2.15e18 as flops_budget, 13 as bestd),
                          struct(4.64e18 as flops_budget, 15 as bestd), struct(1e19 as flops_budget, 17 as bestd))) f
lateral view explode(array(8, 10, 12, 14, 16, 18, 20)) d as depth
"""
