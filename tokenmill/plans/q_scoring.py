"""Registered scoring queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tokenmill.functions import grading as G
from tokenmill.operators import scoring as S
from tokenmill.plans.catalog import load, oracle
from tokenmill.plans.registry import query
from tokenmill.session import scratch_path
from tokenmill.sources.files import read_results_csv, write_results_csv

LN2 = f"{math.log(2.0)!r}e0"
_BASELINES = ("select 'click' as task, 0.25e0 as baseline union all select 'view', 0.25e0 "
              "union all select 'error', 0.5e0 union all select 'signup', 0.0e0")
CHAT_TASKS = ["click", "view", "error", "signup", "purchase"]
CATEGORICAL = ["click", "view"]


def _baselines(spark):
    """The chat baselines of the task_accuracy fixture, as a table."""
    return spark.createDataFrame([("click", 0.25), ("view", 0.25), ("error", 0.5), ("signup", 0.0)],
                                 "task string, baseline double")


def _bpb_input(spark, sf_dir):
    cat = load(spark, sf_dir)
    return S.lookup_token_bytes(cat.token_losses, cat.token_bytes)


@query("lookup_token_bytes", oracle("""
select l.split, l.row_id, l.pos, l.y, cast(coalesce(case when l.y >= 0 then b.n_bytes end, 0) as bigint) as n_bytes
from token_losses l left join token_bytes b on l.y >= 0 and b.token_id = l.y""", "token_losses", "token_bytes"))
def q_lookup_token_bytes(spark, sf_dir):
    return _bpb_input(spark, sf_dir).select("split", "row_id", "pos", "y", "n_bytes")


@query("bits_per_byte", oracle(f"""
with j as (select l.split, l.loss, coalesce(case when l.y >= 0 then b.n_bytes end, 0) as n_bytes
           from token_losses l left join token_bytes b on l.y >= 0 and b.token_id = l.y)
select split, sum(case when n_bytes > 0 then loss else 0.0e0 end) as total_nats,
       cast(sum(n_bytes) as bigint) as total_bytes,
       case when sum(n_bytes) = 0 then 'inf'::double
            else sum(case when n_bytes > 0 then loss else 0.0e0 end) / ({LN2} * sum(n_bytes)) end as bpb
from j group by split""", "token_losses", "token_bytes"))
def q_bits_per_byte(spark, sf_dir):
    return S.bits_per_byte(_bpb_input(spark, sf_dir), ["split"])


@query("masked_mean_loss", oracle("""
select split, case when sum(case when y >= 0 then 1 else 0 end) > 0
                   then sum(case when y >= 0 then loss else 0.0e0 end) / sum(case when y >= 0 then 1.0e0 else 0.0e0 end)
                   else 0.0e0 end as mean_loss,
       cast(sum(case when y >= 0 then 1 else 0 end) as bigint) as n_targets
from token_losses group by split""", "token_losses"))
def q_masked_mean_loss(spark, sf_dir):
    return S.masked_mean_loss(load(spark, sf_dir).token_losses, ["split"])


@query("task_accuracy", oracle("""
select task, avg(case when passed then 1.0e0 else 0.0e0 end) as accuracy, count(*) as problems
from (select task, idx, bool_or(is_correct) as passed from eval_outcomes group by task, idx) p
group by task""", "eval_outcomes"))
def q_task_accuracy(spark, sf_dir):
    return S.task_accuracy(load(spark, sf_dir).eval_outcomes)


_ACC = """acc as (select task, avg(case when passed then 1.0e0 else 0.0e0 end) as accuracy
  from (select task, idx, bool_or(is_correct) as passed from eval_outcomes group by task, idx) p group by task)"""


@query("join_baseline_default", oracle(f"""
with {_ACC}, b as ({_BASELINES})
select acc.task, acc.accuracy, coalesce(b.baseline, 0.0e0) as baseline,
       (acc.accuracy - coalesce(b.baseline, 0.0e0)) / (1.0e0 - coalesce(b.baseline, 0.0e0)) as centered
from acc left join b on acc.task = b.task""", "eval_outcomes"))
def q_join_baseline_default(spark, sf_dir):
    acc = S.task_accuracy(load(spark, sf_dir).eval_outcomes).drop("problems")
    j = S.join_baseline_default(acc, _baselines(spark))
    return j.withColumn("centered", S.centered(F.col("accuracy"), F.col("baseline")))


@query("chatcore_metric", oracle(f"""
with {_ACC}, b as ({_BASELINES}),
c as (select acc.task, (acc.accuracy - coalesce(b.baseline, 0.0e0)) / (1.0e0 - coalesce(b.baseline, 0.0e0)) as centered
      from acc left join b on acc.task = b.task)
select case when (select count(distinct task) from c where task in ('click', 'view', 'error', 'signup', 'purchase')) = 5
            then avg(centered) end as chatcore,
       case when (select count(distinct task) from c where task in ('click', 'view', 'error', 'signup', 'purchase')) = 5
            then avg(case when task in ('click', 'view') then centered end) end as chatcore_cat
from c""", "eval_outcomes"))
def q_chatcore_metric(spark, sf_dir):
    acc = S.task_accuracy(load(spark, sf_dir).eval_outcomes)
    c = S.join_baseline_default(acc, _baselines(spark)).withColumn(
        "centered", S.centered(F.col("accuracy"), F.col("baseline")))
    return S.chatcore_metric(c, CHAT_TASKS, CATEGORICAL)


# CORE-style evaluation on the multiple-choice fixture: one task per subject,
# random baseline (percent) = 100 / number of letters of the task.
def _mc_accuracy(spark, sf_dir):
    ans = load(spark, sf_dir).mc_answers
    pred = S.letter_argmax(ans, ("item_id",))
    items = ans.groupBy("item_id").agg(F.max("subject").alias("task"), F.max("answer").alias("answer"),
                                       F.count("*").alias("n_letters"))
    j = items.join(pred, "item_id").withColumn("is_correct", F.col("predicted") == F.col("answer"))
    return j


_MC_PRED = """pred as (select item_id, min(subject) as task, min(answer) as answer, count(*) as n_letters,
                      arg_max(letter_no, (score, -letter_no)) as predicted
               from mc_answers group by item_id)"""


@query("letter_argmax", oracle(f"""
with {_MC_PRED}
select item_id, cast(predicted as bigint) as predicted, predicted = answer as is_correct from pred""", "mc_answers"))
def q_letter_argmax(spark, sf_dir):
    j = _mc_accuracy(spark, sf_dir)
    return j.select("item_id", F.col("predicted").cast("long").alias("predicted"), "is_correct")


@query("accuracy_by_subject", oracle(f"""
with {_MC_PRED}
select task as subject, avg(case when predicted = answer then 1.0e0 else 0.0e0 end) as accuracy, count(*) as items
from pred group by rollup(task)""", "mc_answers"))
def q_accuracy_by_subject(spark, sf_dir):
    j = _mc_accuracy(spark, sf_dir)
    return j.rollup(F.col("task").alias("subject")).agg(
        F.avg(F.col("is_correct").cast("double")).alias("accuracy"), F.count("*").alias("items"))


@query("accuracy_rollup", oracle(f"""
with {_MC_PRED},
t as (select string_split(task, ' ')[1] as task, task as subject, predicted = answer as is_correct from pred)
select task, subject, avg(case when is_correct then 1.0e0 else 0.0e0 end) as accuracy, count(*) as items
from t group by rollup(task, subject)""", "mc_answers"))
def q_accuracy_rollup(spark, sf_dir):
    """Accuracy per task and subject, per task, and of all items."""
    j = _mc_accuracy(spark, sf_dir).withColumnRenamed("task", "subject")
    return S.accuracy_rollup(j.withColumn("task", F.get(F.split("subject", " "), F.lit(0))))


def _same_number(response, reference):
    return G.extract_answer(response).eqNullSafe(G.extract_answer(G.last_text_part(reference)))


def _outcomes(task):
    return lambda cat: cat.eval_outcomes.where(F.col("task") == task).select(
        "idx", "k", F.col("is_correct").cast("string").alias("response"), F.lit("true").alias("reference"))


#: Name -> how a task is read, graded and compared with guessing.
TASKS = {
    "choice": S.EvalTask(lambda cat: cat.mc_answers.select(F.col("item_id").alias("idx"), "letter_no", "score", "answer"), "categorical", 0.25),
    "math": S.EvalTask(lambda cat: cat.completions.select(F.col("problem_id").alias("idx"), "k", F.col("completion").alias("response"), F.col("answer").alias("reference")),
                       "generative", 0.0, _same_number),
    "click": S.EvalTask(_outcomes("click"), "generative", 0.25, lambda a, b: a == b),
    "signup": S.EvalTask(_outcomes("signup"), "generative", 0.0, lambda a, b: a == b),
}
_NUMBER = "case when regexp_matches({c}, '#### (-?[0-9.,]+)') then replace(regexp_extract({c}, '#### (-?[0-9.,]+)', 1), ',', '') end"
_EVALUATED = f"""{_MC_PRED},
passed as (
  select 'choice' as task, predicted = answer as ok from pred
  union all select 'math', bool_or({_NUMBER.format(c='completion')} is not distinct from {_NUMBER.format(c="regexp_split_to_array(answer, '<<[^>]+>>')[-1]")})
            from completions group by problem_id
  union all select task, bool_or(is_correct) from eval_outcomes where task in ('click', 'signup') group by task, idx),
acc as (select task, case when task = 'choice' then 'categorical' else 'generative' end as eval_type, count(*) as problems,
        avg(case when ok then 1.0e0 else 0.0e0 end) as accuracy, case when task in ('choice', 'click') then 0.25e0 else 0.0e0 end as baseline
        from passed group by task),
res as (select *, (accuracy - baseline) / (1.0e0 - baseline) as centered from acc)"""


@query("evaluate_tasks", oracle(f"""
with {_EVALUATED} select * from res""", "mc_answers", "completions", "eval_outcomes"))
def q_evaluate_tasks(spark, sf_dir):
    """Every registered task, categorical and generative, in one plan."""
    return S.evaluate(TASKS, load(spark, sf_dir))


@query("evaluate_chatcore", oracle(f"""
with {_EVALUATED} select avg(centered) as chatcore, avg(centered) filter (where eval_type = 'categorical') as chatcore_cat from res""",
                                    "mc_answers", "completions", "eval_outcomes"))
def q_evaluate_chatcore(spark, sf_dir):
    """ChatCORE of the registered tasks."""
    return S.chatcore_metric(S.evaluate(TASKS, load(spark, sf_dir)), list(TASKS), [n for n, t in TASKS.items() if t.eval_type == "categorical"])


def _core_results(spark, sf_dir):
    """Baselines CSV (written from the data) -> read back -> strict join ->
    centered (percent baselines) per task."""
    j = _mc_accuracy(spark, sf_dir)
    acc = j.groupBy("task").agg(F.avg(F.col("is_correct").cast("double")).alias("accuracy"),
                                (F.lit(100.0) / F.max("n_letters")).alias("random_baseline"))
    path = scratch_path(spark, "core_baselines_csv")
    acc.select(F.col("task").alias("Eval Task"), F.col("random_baseline").alias("Random baseline")) \
       .write.mode("overwrite").option("header", True).csv(path)
    base = read_results_csv(spark, path, key="Eval Task", value="Random baseline") \
        .select(F.col("Eval Task").alias("task"), F.col("Random baseline").alias("baseline"))
    res = S.join_baseline_strict(acc.select("task", "accuracy"), base)
    return res.withColumn("centered", S.centered(F.col("accuracy"), F.col("baseline"), percent=True))


_CORE_SQL = f"""with {_MC_PRED},
acc as (select task, avg(case when predicted = answer then 1.0e0 else 0.0e0 end) as accuracy,
               100.0e0 / max(n_letters) as baseline from pred group by task),
res as (select task, accuracy, baseline, (accuracy - 0.01e0 * baseline) / (1.0e0 - 0.01e0 * baseline) as centered from acc)"""


@query("join_baseline_strict", oracle(f"""
{_CORE_SQL}
select task, accuracy, baseline, centered from res""", "mc_answers"))
def q_join_baseline_strict(spark, sf_dir):
    return _core_results(spark, sf_dir).select("task", "accuracy", "baseline", "centered")


@query("core_metric", oracle(f"""
{_CORE_SQL}
select avg(centered) as core_metric, count(*) as tasks from res""", "mc_answers"))
def q_core_metric(spark, sf_dir):
    return S.core_metric(_core_results(spark, sf_dir))


@query("write_results_csv", oracle(f"""
{_CORE_SQL}
select task as "Task", printf('%.6f', accuracy) as "Accuracy", round(centered, 6) as "Centered" from res
union all
select 'CORE', '', round(avg(centered), 6) from res""", "mc_answers"))
def q_write_results_csv(spark, sf_dir):
    res = _core_results(spark, sf_dir)
    out = write_results_csv(res, scratch_path(spark, "core_results_csv"))
    return out


@query("pass_at_k", oracle("""
with per as (select task, idx, min(case when is_correct then k end) as first_ok, max(k) as maxk
             from eval_outcomes group by task, idx),
t as (select task, count(*) as problems, max(maxk) + 1 as n from per group by task),
ks as (select task, problems, unnest(generate_series(1, n)) as k from t)
select ks.task, cast(ks.k as bigint) as k,
       (select count(*) from per where per.task = ks.task and per.first_ok is not null and per.first_ok < ks.k)
         / ks.problems as pass_at_k
from ks""", "eval_outcomes"))
def q_pass_at_k(spark, sf_dir):
    return S.pass_at_k(load(spark, sf_dir).eval_outcomes)


@query("rollout_stats", oracle("""
select task, avg(r) as mean_reward, sum(l) / sum(n) as mean_seq_len from (
  select task, idx, avg(case when is_correct then 1.0e0 else 0.0e0 end) as r, sum(seq_len) as l, count(*) as n
  from eval_outcomes group by task, idx) p group by task""", "eval_outcomes"))
def q_rollout_stats(spark, sf_dir):
    return S.rollout_stats(load(spark, sf_dir).eval_outcomes)


@query("group_advantage", oracle("""
select task, idx, k, case when is_correct then 1.0e0 else 0.0e0 end as reward,
       case when is_correct then 1.0e0 else 0.0e0 end
         - avg(case when is_correct then 1.0e0 else 0.0e0 end) over (partition by task, idx) as advantage
from eval_outcomes""", "eval_outcomes"))
def q_group_advantage(spark, sf_dir):
    g = S.group_advantage(load(spark, sf_dir).eval_outcomes)
    return g.select("task", "idx", F.col("k").cast("long").alias("k"), "reward", "advantage")


@query("option_loss_choice", oracle("""
with per as (select item_id, opt, avg(loss) as mean_loss, max(gold) as gold from option_losses group by item_id, opt)
select item_id, cast(arg_min(opt, (mean_loss, opt)) as bigint) as predicted, max(gold) as gold,
       arg_min(opt, (mean_loss, opt)) = max(gold) as is_correct
from per group by item_id""", "option_losses"))
def q_option_loss_choice(spark, sf_dir):
    r = S.option_loss_choice(load(spark, sf_dir).option_losses)
    return r.select("item_id", F.col("predicted").cast("long").alias("predicted"), "gold", "is_correct")


@query("lm_exact_match", oracle("""
select item_id, opt, bool_and(pred = actual) as is_correct from option_losses group by item_id, opt""",
                                "option_losses"))
def q_lm_exact_match(spark, sf_dir):
    return S.lm_exact_match(load(spark, sf_dir).option_losses, ["item_id", "opt"])


@query("subsample_task", oracle("""
select task, idx from (
  select task, idx, row_number() over (partition by task order by md5('1337:' || cast(idx as varchar)), idx) as rn
  from (select distinct task, idx from eval_outcomes) d) t
where rn <= 40""", "eval_outcomes"))
def q_subsample_task(spark, sf_dir):
    items = load(spark, sf_dir).eval_outcomes.select("task", "idx").distinct()
    return S.subsample_task(items, 40).select("task", "idx")


@query("read_results_csv", oracle(f"""
{_CORE_SQL}
select task as "Task", round(accuracy, 6) as "Accuracy", round(centered, 6) as "Centered" from res
union all
select 'CORE', null, round(avg(centered), 6) from res""", "mc_answers"))
def q_read_results_csv(spark, sf_dir):
    """The CORE results CSV (S14) read back: header skipped, values trimmed,
    blank accuracy of the total row -> NULL."""
    res = _core_results(spark, sf_dir)
    path = scratch_path(spark, "core_results_read")
    write_results_csv(res, path)
    back = read_results_csv(spark, path, key="Task", value=["Accuracy", "Centered"])
    return back.select("Task", F.round("Accuracy", 6).alias("Accuracy"), F.round("Centered", 6).alias("Centered"))
