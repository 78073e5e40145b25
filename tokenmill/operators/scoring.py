"""Evaluation scoring over prediction tables.

The model stays outside: its outputs arrive as tables (token losses,
option losses, letter scores, sampled outcomes). Everything here is
partial + final aggregation, keyed joins and per-key windows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.plans.positions import seeded_key

LN2 = math.log(2.0)


# ---------------------------------------------------------------- joins --

def join_baseline_strict(acc: DataFrame, baselines: DataFrame, key: str = "task") -> DataFrame:
    """Inner join with baselines; a task without a baseline is an error."""
    missing = acc.select(key).join(baselines.select(key), key, "left_anti").limit(20).collect()
    if missing:
        raise ValueError(f"no baseline for: {[r[0] for r in missing]}")
    return acc.join(baselines, key, "inner")


def join_baseline_default(acc: DataFrame, baselines: DataFrame, key: str = "task",
                          col: str = "baseline", default: float = 0.0) -> DataFrame:
    """Left join; a missing baseline counts as ``default``."""
    j = acc.join(baselines.select(key, col), key, "left")
    return j.withColumn(col, F.coalesce(F.col(col), F.lit(default)))


def lookup_token_bytes(losses: DataFrame, token_bytes: DataFrame, y_col: str = "y") -> DataFrame:
    """``n_bytes`` per target: ignored targets (< 0) get 0 and are never looked
    up; unknown ids count 0."""
    tb = token_bytes.select(F.col("token_id").alias("_tid"), F.col("n_bytes").alias("_nb"))
    j = losses.join(tb, (F.col(y_col) >= 0) & (F.col(y_col) == F.col("_tid")), "left")
    return j.withColumn("n_bytes", F.coalesce(F.col("_nb"), F.lit(0)).cast("long")).drop("_tid", "_nb")


# --------------------------------------------------------- aggregations --

def bits_per_byte(losses_with_bytes: DataFrame, group_cols=("split",), loss_col: str = "loss") -> DataFrame:
    """``sum(loss where n_bytes > 0) / (ln 2 * sum(n_bytes))``; ``inf`` without bytes."""
    nats = F.sum(F.when(F.col("n_bytes") > 0, F.col(loss_col)).otherwise(F.lit(0.0)))
    nbytes = F.sum("n_bytes")
    g = losses_with_bytes.groupBy(*group_cols).agg(nats.alias("total_nats"), nbytes.alias("total_bytes"))
    bpb = F.when(F.col("total_bytes") == 0, F.lit(float("inf"))).otherwise(
        F.col("total_nats") / (F.lit(LN2) * F.col("total_bytes")))
    return g.withColumn("bpb", bpb)


def masked_mean_loss(losses: DataFrame, group_cols=("split",), loss_col: str = "loss",
                     mask: Column | None = None) -> DataFrame:
    """``sum(loss * mask) / sum(mask)`` over supervised targets; 0 when none."""
    m = (F.col("y") >= 0).cast("double") if mask is None else mask.cast("double")
    g = losses.groupBy(*group_cols).agg(F.sum(F.col(loss_col) * m).alias("_s"), F.sum(m).alias("_n"))
    return g.select(*group_cols, F.when(F.col("_n") > 0, F.col("_s") / F.col("_n")).otherwise(F.lit(0.0))
                    .alias("mean_loss"), F.col("_n").cast("long").alias("n_targets"))


def problem_outcomes(outcomes: DataFrame, keys=("task", "idx"), correct_col: str = "is_correct") -> DataFrame:
    """Generative eval: a problem passes when any of its samples is correct."""
    return outcomes.groupBy(*keys).agg(F.bool_or(correct_col).alias("passed"))


def task_accuracy(outcomes: DataFrame, task_col: str = "task", idx_col: str = "idx",
                  correct_col: str = "is_correct") -> DataFrame:
    p = problem_outcomes(outcomes, (task_col, idx_col), correct_col)
    return p.groupBy(task_col).agg(F.avg(F.col("passed").cast("double")).alias("accuracy"),
                                   F.count("*").alias("problems"))


def centered(acc: Column, baseline: Column, percent: bool = False) -> Column:
    """``(acc - b) / (1 - b)``; CORE baselines are percents (``0.01 * b``)."""
    b = baseline * 0.01 if percent else baseline
    return (acc - b) / (F.lit(1.0) - b)


def core_metric(centered_df: DataFrame, col: str = "centered") -> DataFrame:
    return centered_df.agg(F.avg(col).alias("core_metric"), F.count("*").alias("tasks"))


def chatcore_metric(centered_df: DataFrame, required: list[str], categorical: list[str],
                    task_col: str = "task", col: str = "centered") -> DataFrame:
    """Mean centered accuracy only when every required task was evaluated;
    ``chatcore_cat`` over the categorical tasks."""
    req = F.array(*[F.lit(t) for t in required])
    cat = [F.lit(t) for t in categorical]
    agg = centered_df.agg(
        F.avg(col).alias("_all"),
        F.avg(F.when(F.col(task_col).isin(*cat), F.col(col))).alias("_cat"),
        F.collect_set(task_col).alias("_seen"))
    complete = F.size(F.array_except(req, F.col("_seen"))) == 0
    return agg.select(F.when(complete, F.col("_all")).alias("chatcore"),
                      F.when(complete, F.col("_cat")).alias("chatcore_cat"))


def pass_at_k(outcomes: DataFrame, task_col: str = "task", idx_col: str = "idx", k_col: str = "k",
              correct_col: str = "is_correct") -> DataFrame:
    """For k = 1..n: share of problems with a correct sample among the first k.

    Per problem only the first correct sample index matters, so the job is
    a count per (task, first index) plus a running sum - no k x problems
    cross product.
    """
    per = outcomes.groupBy(task_col, idx_col).agg(
        F.min(F.when(F.col(correct_col), F.col(k_col))).alias("first_ok"),
        F.max(k_col).alias("_maxk"))
    tasks = per.groupBy(task_col).agg(F.count("*").alias("problems"), (F.max("_maxk") + 1).alias("n"))
    hits = per.filter(F.col("first_ok").isNotNull()).groupBy(task_col, (F.col("first_ok") + 1).alias("k")) \
              .agg(F.count("*").alias("_hits"))
    ks = tasks.select(task_col, "problems", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("k"))
    j = ks.join(hits, [task_col, "k"], "left").fillna(0, ["_hits"])
    w = Window.partitionBy(task_col).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    return j.select(task_col, F.col("k").cast("long").alias("k"),
                    (F.sum("_hits").over(w) / F.col("problems")).alias("pass_at_k"))


def letter_argmax(scores: DataFrame, keys=("item_id",), letter_col: str = "letter_no",
                  score_col: str = "score") -> DataFrame:
    """Highest-scoring letter per problem; the first letter wins ties."""
    tie = F.struct(F.col(score_col), (-F.col(letter_col)).alias("_neg"))
    return scores.groupBy(*keys).agg(F.max_by(letter_col, tie).alias("predicted"))


# ------------------------------------------------------- task registry --

@dataclass(frozen=True)
class EvalTask:
    """A task of the evaluation: ``load`` reads its rows from a catalog,
    ``baseline`` is what guessing gets. Categorical rows are (idx, letter_no,
    score, answer); generative ones are (idx, k, response, reference) and
    ``grade`` says from the latter two whether a sample is right."""

    load: Callable
    eval_type: str
    baseline: float = 0.0
    grade: Callable | None = None


def evaluate(registry: dict[str, EvalTask], catalog, names=None) -> DataFrame:
    """(task, eval_type, problems, accuracy, baseline, centered) of the named
    tasks (all by default), both kinds in one plan: the rows of all
    categorical tasks are one table, those of all generative tasks another,
    and one aggregation over the problems of both gives the accuracies."""
    names = list(registry if names is None else names)
    unknown = [n for n in names if n not in registry]
    if unknown:
        raise ValueError(f"not in the registry: {unknown}")
    kinds: dict[str, list[DataFrame]] = {"categorical": [], "generative": []}
    for name in names:
        task = registry[name]
        rows = task.load(catalog).withColumn("task", F.lit(name))
        if task.eval_type == "categorical":
            rows = rows.select("task", F.col("idx").cast("long").alias("idx"), F.col("letter_no").cast("long").alias("letter_no"),
                               F.col("score").cast("double").alias("score"), F.col("answer").cast("long").alias("answer"))
        elif task.eval_type == "generative":
            ok = F.coalesce(task.grade(F.col("response"), F.col("reference")), F.lit(False))
            rows = rows.select("task", F.col("idx").cast("long").alias("idx"), ok.alias("is_correct"))
        else:
            raise ValueError(f"{name}: no such eval_type: {task.eval_type}")
        kinds[task.eval_type].append(rows)
    problems = []
    if kinds["categorical"]:
        scores = reduce(DataFrame.unionByName, kinds["categorical"])
        best = scores.groupBy("task", "idx").agg(F.max_by("letter_no", F.struct("score", -F.col("letter_no"))).alias("_p"), F.max("answer").alias("_a"))
        problems.append(best.select("task", "idx", (F.col("_p") == F.col("_a")).alias("passed")))
    if kinds["generative"]:
        problems.append(problem_outcomes(reduce(DataFrame.unionByName, kinds["generative"])))
    per = reduce(DataFrame.unionByName, problems).groupBy("task").agg(F.count("*").alias("problems"), F.avg(F.col("passed").cast("double")).alias("accuracy"))
    facts = F.create_map(*[x for n in names for x in (F.lit(n), F.struct(F.lit(registry[n].eval_type).alias("t"), F.lit(registry[n].baseline).alias("b")))])
    per = per.withColumn("_f", F.element_at(facts, F.col("task")))
    return per.select("task", F.col("_f.t").alias("eval_type"), "problems", "accuracy", F.col("_f.b").alias("baseline"),
                      centered(F.col("accuracy"), F.col("_f.b")).alias("centered"))


def accuracy_rollup(items: DataFrame, dims=("task", "subject"), correct_col: str = "is_correct") -> DataFrame:
    """Accuracy per task and subject, per task, and of all."""
    return items.rollup(*dims).agg(F.avg(F.col(correct_col).cast("double")).alias("accuracy"), F.count("*").alias("items"))


def option_loss_choice(option_losses: DataFrame, item_col: str = "item_id", opt_col: str = "opt",
                       loss_col: str = "loss", gold_col: str = "gold") -> DataFrame:
    """Mean loss over the answer span per option; lowest wins (first on ties)."""
    per = option_losses.groupBy(item_col, opt_col).agg(F.avg(loss_col).alias("mean_loss"),
                                                       F.max(gold_col).alias("_gold"))
    pick = per.groupBy(item_col).agg(
        F.min_by(opt_col, F.struct("mean_loss", opt_col)).alias("predicted"),
        F.max("_gold").alias(gold_col))
    return pick.withColumn("is_correct", F.col("predicted") == F.col(gold_col))


def lm_exact_match(spans: DataFrame, span_cols=("item_id",), pred_col: str = "pred",
                   actual_col: str = "actual") -> DataFrame:
    """Every predicted token in the span (rows equal in ``span_cols``) equals
    the actual one."""
    return spans.groupBy(*span_cols).agg(F.bool_and(F.col(pred_col) == F.col(actual_col)).alias("is_correct"))


def rollout_stats(outcomes: DataFrame, task_col: str = "task", idx_col: str = "idx",
                  reward: Column | None = None, len_col: str = "seq_len") -> DataFrame:
    """Mean over examples of the per-example mean reward; mean sequence length."""
    r = F.col("is_correct").cast("double") if reward is None else reward
    per = outcomes.groupBy(task_col, idx_col).agg(F.avg(r).alias("_r"), F.sum(len_col).alias("_len"),
                                                  F.count("*").alias("_n"))
    return per.groupBy(task_col).agg(F.avg("_r").alias("mean_reward"),
                                     (F.sum("_len") / F.sum("_n")).alias("mean_seq_len"))


def group_advantage(outcomes: DataFrame, keys=("task", "idx"), reward: Column | None = None) -> DataFrame:
    """reward - mean reward of the same prompt (no std scaling)."""
    r = F.col("is_correct").cast("double") if reward is None else reward
    w = Window.partitionBy(*keys)
    return outcomes.withColumn("reward", r).withColumn("advantage", F.col("reward") - F.avg("reward").over(w))


def subsample_task(df: DataFrame, max_per_task: int, seed: int = 1337, task_col: str = "task",
                   id_col: str = "idx") -> DataFrame:
    """First ``max_per_task`` rows per task in seeded order (<= 0 keeps all).

    ``row_number() <= n`` lets Spark insert a per-partition group limit
    before the shuffle, so a large task never reaches one task whole.
    """
    if max_per_task <= 0:
        return df
    w = Window.partitionBy(task_col).orderBy(seeded_key(seed, id_col), F.col(id_col))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= max_per_task).drop("_rn")
