"""Registered conversation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.operators import conversations as CV
from tokenmill.operators.packing import written
from tokenmill.plans.catalog import load, oracle
from tokenmill.plans.positions import global_position
from tokenmill.plans.registry import query

# Per-message failure code of the strict rule, in the reference's check order.
_CODE = """case when role is null then 'missing_role' when text is null then 'missing_content'
            when role <> case when turn % 2 = 0 then 'user' else 'assistant' end then 'bad_role' end"""


def _nested(spark, sf_dir, view="conversations"):
    cat = load(spark, sf_dir)
    return cat, CV.nest_conversations(getattr(cat, view))


def _tasks(spark, sf_dir):
    """Two tasks derived from the table: conversations with and without a
    leading system message; each with a dense ``row_id`` by conv_id."""
    _, nested = _nested(spark, sf_dir)
    sys_first = F.get(F.col("messages"), 0)["role"] == "system"
    plain = global_position(nested.filter(~sys_first), ["conv_id"], (), out="row_id")
    sysf = global_position(nested.filter(sys_first), ["conv_id"], (), out="row_id")
    return [("plain", plain), ("system_first", sysf), ("plain", plain)]


_TASKS_SQL = """
t0 as (select conv_id, min(case when turn = 0 then role end) as first_role, count(*) as n_messages
       from conversations group by conv_id),
tasks as (
  select conv_id, n_messages, case when first_role = 'system' then 'system_first' else 'plain' end as task,
         row_number() over (partition by first_role = 'system' order by conv_id) - 1 as row_id
  from t0),
u as (
  select 0 as task_no, * from tasks where task = 'plain'
  union all select 1, * from tasks where task = 'system_first'
  union all select 2, * from tasks where task = 'plain')"""


@query("validate_conversations", oracle(f"""
with m as (select conv_id, turn, {_CODE} as code from conversations_bad),
c as (select conv_id, count(*) as n, min(case when code is not null then turn end) as bad_turn from m group by conv_id)
select c.conv_id, case when c.n < 2 then 'too_short' else m.code end as reason,
       case when c.n < 2 then null else c.bad_turn end as bad_index
from c left join m on m.conv_id = c.conv_id and m.turn = c.bad_turn""", "conversations_bad"))
def q_validate_conversations(spark, sf_dir):
    _, d = _nested(spark, sf_dir, "conversations_bad")
    d = CV.validate_conversations(d, "strict")
    return d.select("conv_id", "reason", F.col("bad_index").cast("long").alias("bad_index"))


@query("validate_conversations_system_ok", oracle(f"""
with s as (select conv_id, max(case when turn = 0 and role = 'system' then 1 else 0 end) as sys
           from conversations_bad group by conv_id),
r as (select b.conv_id, b.turn - s.sys as turn, b.role, b.text from conversations_bad b join s using (conv_id)
      where b.turn >= s.sys),
m as (select conv_id, turn, {_CODE} as code from r),
c as (select s.conv_id, count(m.turn) as n, min(case when code is not null then m.turn end) as bad_turn
      from s left join m using (conv_id) group by s.conv_id)
select c.conv_id, case when c.n < 2 then 'too_short' else m.code end as reason,
       case when c.n < 2 then null else c.bad_turn end as bad_index
from c left join m on m.conv_id = c.conv_id and m.turn = c.bad_turn""", "conversations_bad"))
def q_validate_conversations_system_ok(spark, sf_dir):
    _, d = _nested(spark, sf_dir, "conversations_bad")
    d = CV.validate_conversations(d, "system_ok")
    return d.select("conv_id", "reason", F.col("bad_index").cast("long").alias("bad_index"))


@query("validate_conversations_nonblank", oracle(f"""
with m as (select conv_id, turn,
             case when role <> case when turn % 2 = 0 then 'user' else 'assistant' end then 'bad_role'
                  when trim(text) = '' then 'empty_content' end as code from conversations_bad),
c as (select conv_id, count(*) as n, min(case when code is not null then turn end) as bad_turn from m group by conv_id)
select c.conv_id, case when c.n < 2 then 'too_short' else m.code end as reason,
       case when c.n < 2 then null else c.bad_turn end as bad_index
from c left join m on m.conv_id = c.conv_id and m.turn = c.bad_turn""", "conversations_bad"))
def q_validate_conversations_nonblank(spark, sf_dir):
    _, d = _nested(spark, sf_dir, "conversations_bad")
    d = CV.validate_conversations(d, "nonblank")
    return d.select("conv_id", "reason", F.col("bad_index").cast("long").alias("bad_index"))


_LIMIT_ARGS = dict(max_messages=6, max_chars=1500, max_total=5000)


@query("validate_limits", oracle("""
with m as (select conv_id, turn, role, text,
             case when coalesce(length(text), 0) = 0 then 'empty_content'
                  when length(text) > 1500 then 'message_too_long' end as code,
             case when role not in ('user', 'assistant', 'system') then 'bad_role' end as rcode
           from conversations),
c as (select conv_id, count(*) as n, sum(coalesce(length(text), 0)) as total,
             min(case when code is not null then turn end) as bad_turn,
             min(case when rcode is not null then turn end) as bad_role_turn,
             (conv_id % 25) / 10.0e0 as temperature, (conv_id * 7) % 250 as top_k,
             (conv_id * 37) % 5000 as max_tokens
      from m group by conv_id)
select c.conv_id,
  case when n = 0 then 'no_messages' when n > 6 then 'too_many_messages'
       when bad_turn is not null then (select code from m where m.conv_id = c.conv_id and m.turn = c.bad_turn)
       when total > 5000 then 'total_too_long' when bad_role_turn is not null then 'bad_role'
       when temperature not between 0.0e0 and 2.0e0 then 'bad_temperature'
       when top_k not between 0 and 200 then 'bad_top_k'
       when max_tokens not between 1 and 4096 then 'bad_max_tokens' end as reason,
  case when n = 0 or n > 6 then null when bad_turn is not null then bad_turn
       when total > 5000 then null when bad_role_turn is not null then bad_role_turn end as bad_index
from c"""))
def q_validate_limits(spark, sf_dir):
    _, d = _nested(spark, sf_dir)
    d = d.select("conv_id", "messages",
                 ((F.col("conv_id") % 25) / 10.0).alias("temperature"),
                 ((F.col("conv_id") * 7) % 250).alias("top_k"),
                 ((F.col("conv_id") * 37) % 5000).alias("max_tokens"))
    d = CV.validate_limits(d, temperature="temperature", top_k="top_k", max_tokens="max_tokens", **_LIMIT_ARGS)
    return d.select("conv_id", "reason", F.col("bad_index").cast("long").alias("bad_index"))


@query("normalize_content", oracle("""
select conv_id, case when content_json is null then '' else
  array_to_string(list_transform(
    list_filter(json_extract(content_json, '$[*]'),
                lambda x: json_type(x) = 'VARCHAR' or coalesce(x ->> '$.type', '') = 'text'),
    lambda x: case when json_type(x) = 'VARCHAR' then x ->> '$' else coalesce(x ->> '$.text', '') end), chr(10)) end
  as content
from tool_convs""", "tool_convs"))
def q_normalize_content(spark, sf_dir):
    d = load(spark, sf_dir).tool_convs
    return d.select("conv_id", CV.normalize_content(F.col("content_json")).alias("content"))


@query("merge_system_message", oracle("""
with c as (select conv_id, count(*) as n,
             max(case when turn = 0 then role end) as r0, max(case when turn = 1 then role end) as r1,
             max(case when turn = 0 then text end) as t0, max(case when turn = 1 then text end) as t1
           from conversations group by conv_id)
select conv_id,
  case when r0 = 'system' and coalesce(r1, '') = 'user' then n - 1 else n end as n_messages,
  case when r0 = 'system' and coalesce(r1, '') = 'user' then 'user' else r0 end as first_role,
  md5(case when r0 = 'system' and coalesce(r1, '') = 'user' then t0 || chr(10) || chr(10) || t1 else t0 end) as first_md5,
  case when r0 = 'system' and coalesce(r1, '') <> 'user' then 'system_not_followed_by_user' end as reason
from c"""))
def q_merge_system_message(spark, sf_dir):
    _, d = _nested(spark, sf_dir)
    d = CV.merge_system_message(d)
    first = F.get(F.col("messages"), 0)
    return d.select("conv_id", F.size("messages").cast("long").alias("n_messages"),
                    first["role"].alias("first_role"), F.md5(first["content"]).alias("first_md5"), "reason")


@query("drop_last_assistant", oracle("""
with c as (select conv_id, count(*) as n, arg_max(role, turn) as last_role from conversations_bad group by conv_id)
select conv_id, case when last_role = 'assistant' then n - 1 else n end as n_messages,
       case when last_role = 'assistant' then null else 'last_not_assistant' end as reason
from c""", "conversations_bad"))
def q_drop_last_assistant(spark, sf_dir):
    _, d = _nested(spark, sf_dir, "conversations_bad")
    d = CV.drop_last_assistant(d)
    return d.select("conv_id", F.size("messages").cast("long").alias("n_messages"), "reason")


def _conv_rows(spark, sf_dir):
    _, d = _nested(spark, sf_dir)
    return global_position(d, ["conv_id"], (), out="row_id")


_ROWS = "rows as (select conv_id, row_number() over (order by conv_id) - 1 as row_id from (select distinct conv_id from conversations) c)"


@query("slice_view", oracle(f"""
with {_ROWS}
select conv_id, row_id, cast((row_id - 5) / 3 as bigint) as view_idx from rows
where row_id >= 5 and row_id < 90 and (row_id - 5) % 3 = 0"""))
def q_slice_view(spark, sf_dir):
    d = CV.slice_view(_conv_rows(spark, sf_dir), start=5, stop=90, step=3)
    return d.select("conv_id", "row_id", "view_idx")


@query("round_robin", oracle(f"""
with {_ROWS}
select conv_id, row_id, cast(row_id % 4 as int) as rank from rows"""))
def q_round_robin(spark, sf_dir):
    return CV.round_robin(_conv_rows(spark, sf_dir), 4).select("conv_id", "row_id", "rank")


@query("head_problems", oracle(f"""
with {_ROWS}
select conv_id, row_id from rows order by row_id limit 25"""))
def q_head_problems(spark, sf_dir):
    return CV.head_problems(_conv_rows(spark, sf_dir), 25).select("conv_id", "row_id")


@query("union_conversations", oracle(f"""
with {_TASKS_SQL}
select task_no, task, conv_id, row_id from u"""))
def q_union_conversations(spark, sf_dir):
    u = CV.union_tasks(_tasks(spark, sf_dir))
    return u.select(F.col("task_no").cast("int").alias("task_no"), "task", "conv_id", "row_id")


@query("mixture", oracle(f"""
with {_TASKS_SQL}
select task_no, task, conv_id, row_id,
       row_number() over (order by md5('42:' || cast(task_no as varchar) || ':' || cast(row_id as varchar)),
                          task_no, row_id) - 1 as mix_idx
from u"""))
def q_mixture(spark, sf_dir):
    m = CV.mixture(_tasks(spark, sf_dir), seed=42)
    return m.select(F.col("task_no").cast("int").alias("task_no"), "task", "conv_id", "row_id", "mix_idx")


@query("task_sequence", oracle(f"""
with {_TASKS_SQL}
select task_no, conv_id, row_id,
       coalesce((select count(*) from u u2 where u2.task_no < u.task_no), 0) + row_id as seq_idx
from u"""))
def q_task_sequence(spark, sf_dir):
    s = CV.task_sequence(_tasks(spark, sf_dir))
    return s.select(F.col("task_no").cast("int").alias("task_no"), "conv_id", "row_id", "seq_idx")


@query("mixture_composition", oracle(f"""
with {_TASKS_SQL}
select task, count(*) as rows, count(distinct task_no) as epochs,
       round(count(*) / (select count(*) from u), 6) as share
from u group by task"""))
def q_mixture_composition(spark, sf_dir):
    return CV.mixture_composition(_tasks(spark, sf_dir)).select("task", "rows", "epochs", "share")


@query("index_gather", oracle(f"""
with {_TASKS_SQL},
mix as (select task_no, row_id, conv_id, n_messages,
        row_number() over (order by md5('42:' || cast(task_no as varchar) || ':' || cast(row_id as varchar)),
                           task_no, row_id) - 1 as mix_idx from u)
select mix_idx, task_no, conv_id, n_messages from mix"""))
def q_index_gather(spark, sf_dir):
    tasks = _tasks(spark, sf_dir)
    idx = CV.mixture([(n, d.select("row_id")) for n, d in tasks], seed=42)
    # gather: (task_no, row_id) -> the task's row (equi-join, one task per union branch)
    rows = CV.union_tasks(tasks).select("task_no", "row_id", "conv_id",
                                        F.size("messages").cast("long").alias("n_messages"))
    g = idx.select("mix_idx", "task_no", "row_id").join(rows, ["task_no", "row_id"])
    return g.select("mix_idx", F.col("task_no").cast("int").alias("task_no"), "conv_id", "n_messages")


def _recipe_rows(spark, sf_dir):
    """All tasks of the recipes that the tables give, in one table: chat and
    identity conversations, choice items, math problems and words to spell."""
    cat, nested = _nested(spark, sf_dir)
    kind = F.when(F.get(F.col("messages"), 0)["role"] == "system", F.lit("identity")).otherwise(F.lit("chat"))
    parts = [nested.select(kind.alias("task"), F.col("conv_id").cast("long").alias("item_id")),
             cat.mc_items.select(F.lit("choice").alias("task"), F.col("item_id").cast("long").alias("item_id")),
             cat.tool_text.select(F.lit("math").alias("task"), F.col("problem_id").cast("long").alias("item_id"))]
    # written once: counts, cuts, sums and positions read the narrow rows
    rows = written(parts[0].unionByName(parts[1]).unionByName(parts[2]), "recipe-items")
    return global_position(rows, ["item_id"], ["task"], out="row_id")


_RECIPE_SQL = """
t0 as (select conv_id, min(case when turn = 0 then role end) as first_role from conversations group by conv_id),
items as (select case when first_role = 'system' then 'identity' else 'chat' end as task, cast(conv_id as bigint) as item_id from t0
          union all select 'choice', cast(p_partkey as bigint) from part
          union all select 'math', cast(o_orderkey as bigint) from orders),
rows as (select *, row_number() over (partition by task order by item_id) - 1 as row_id from items),
listed(recipe, task, first_no, times, stop) as (values
  ('full', 'chat', 0, 1, null), ('full', 'identity', 1, 2, null), ('full', 'choice', 11, 3, null), ('full', 'math', 14, 4, null),
  ('lite', 'identity', 20, 3, null), ('lite', 'math', 33, 2, null),
  ('val', 'chat', 0, 1, null), ('val', 'choice', 1, 1, 5200), ('val', 'math', 2, 1, 420)),
mixed as (select recipe, task, row_id, item_id, first_no + unnest(range(0, times)) as task_no
          from rows join listed using (task) where stop is null or row_id < stop)"""


@query("recipe_composition", oracle(f"""
with {_RECIPE_SQL}
select recipe, task, count(*) as rows, count(distinct task_no) as epochs,
       round(count(*) / sum(count(*)) over (partition by recipe), 6) as share
from mixed group by recipe, task"""))
def q_recipe_composition(spark, sf_dir):
    """Rows, epochs and shares of the full, lite and validation recipes."""
    return CV.recipe_composition(_recipe_rows(spark, sf_dir), {k: CV.sft_recipe(k) for k in ("full", "lite", "val")})


@query("recipe_mixture", oracle(f"""
with {_RECIPE_SQL}
select task, cast(task_no as int) as task_no, row_id, item_id,
       row_number() over (order by md5('42:' || cast(task_no as varchar) || ':' || cast(row_id as varchar)), task_no, row_id) - 1 as mix_idx
from mixed where recipe = 'full'"""))
def q_recipe_mixture(spark, sf_dir):
    """The full recipe, repeats and all, in seeded order."""
    m = CV.recipe_mixture(written(_recipe_rows(spark, sf_dir), "recipe-rows"), CV.sft_recipe("full"))
    return m.select("task", "task_no", "row_id", "item_id", "mix_idx")
