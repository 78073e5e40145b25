"""CORE-style evaluation prompts.

Few-shot sampling never builds item x item pairs: each item draws its k
positions with Floyd's algorithm from seeded hashes (k draws, all
distinct, self excluded), then an equi-join on (task, position) fetches
the examples. Prompts, token arrays and answer spans are column
expressions over arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.plans.positions import global_position

FEWSHOT_SEED = 1234
DELIM = " "


def _draw(idx: Column, j: Column) -> Column:
    """Deterministic draw for item ``idx`` (seed ``1234 + idx``) at step ``j``."""
    key = F.md5(F.concat((idx + FEWSHOT_SEED).cast("string"), F.lit(":"), j.cast("string")))
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long")


def fewshot_positions(idx: Column, n: Column, k: Column) -> Column:
    """k distinct positions in ``[0, n)`` other than ``idx`` (Floyd's algorithm
    over the n-1 others), in draw order."""
    avail = n - 1
    steps = F.sequence(avail - k, avail - 1)

    def step(acc, j):
        t = F.pmod(_draw(idx, j), j + 1)
        return F.when(F.array_contains(acc, t), F.array_append(acc, j)).otherwise(F.array_append(acc, t))

    picks = F.when((k > 0) & (k < n), F.aggregate(steps, F.array().cast("array<bigint>"), step)) \
             .otherwise(F.array().cast("array<bigint>"))
    return F.transform(picks, lambda t: F.when(t < idx, t).otherwise(t + 1))


def fewshot_sample(items: DataFrame, task_col: str = "task", id_col: str = "item_id",
                   k_col: str = "num_fewshot") -> DataFrame:
    """Adds ``idx`` (position in task) and ``shots ARRAY<STRUCT<...item...>>``.

    An item that asks for more shots than its task has other items is left
    out here and returned by ``fewshot_quarantine``.
    """
    d = global_position(items, [id_col], [task_col], out="idx")
    n = d.groupBy(task_col).agg(F.count("*").alias("_n"))
    d = d.join(n, task_col)
    k = F.col(k_col).cast("long")
    lookup_rows = d
    d = d.filter(k < F.col("_n")).withColumn("_pos", fewshot_positions(F.col("idx"), F.col("_n"), k))
    ex = d.select(task_col, "idx", id_col, F.posexplode("_pos").alias("shot_no", "shot_idx"))
    cols = [c for c in items.columns if c != task_col]
    lookup = lookup_rows.select(task_col, F.col("idx").alias("shot_idx"), F.struct(*cols).alias("shot"))
    shots = ex.join(lookup, [task_col, "shot_idx"]).groupBy(task_col, "idx").agg(
        F.array_sort(F.collect_list(F.struct("shot_no", "shot"))).alias("_s"))
    out = d.join(shots, [task_col, "idx"], "left").withColumn(
        "shots", F.coalesce(F.transform("_s", lambda s: s["shot"]), F.array()))
    return out.drop("_s", "_pos", "_n")


def fewshot_quarantine(items: DataFrame, task_col: str = "task", k_col: str = "num_fewshot") -> DataFrame:
    """Items that can't be given their shots, with ``reason``."""
    n = items.groupBy(task_col).agg(F.count("*").alias("_n"))
    bad = items.join(n, task_col).filter(F.col(k_col).isNull() | (F.col(k_col) >= F.col("_n")))
    return bad.withColumn("reason", F.lit("too_few_items")).drop("_n")


def _fewshot_text(parts) -> Column:
    return F.array_join(F.transform("shots", lambda s: F.concat(*parts(s), F.lit("\n\n"))), "")


def _trim(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def render_core_prompts(d: DataFrame, type_col: str = "task_type") -> DataFrame:
    """``prompts ARRAY<STRING>`` per item: MC one per choice, schema one per
    context option, LM two (without / with the continuation)."""
    delim = F.lit(DELIM)
    choices = F.array("c0", "c1")
    mc_shots = _fewshot_text(lambda s: (s["query"], delim, F.get(F.array(s["c0"], s["c1"]), s["gold"])))
    mc = F.transform(choices, lambda c: F.concat(mc_shots, F.col("query"), delim, c))
    sc_shots = _fewshot_text(lambda s: (F.get(F.array(s["c0"], s["c1"]), s["gold"]), delim, s["continuation"]))
    sc = F.transform(choices, lambda c: F.concat(sc_shots, c, delim, F.col("continuation")))
    lm_shots = _fewshot_text(lambda s: (_trim(s["context"]), delim, s["continuation"]))
    lm_base = F.concat(lm_shots, _trim(F.col("context")), delim)
    lm = F.array(_trim(lm_base), F.concat(lm_base, F.col("continuation")))
    t = F.col(type_col)
    prompts = F.when(t == "multiple_choice", mc).when(t == "schema", sc).otherwise(lm)
    return d.withColumn("prompts", prompts)


def common_length(seqs: Column, direction: str = "left") -> Column:
    """Shared prefix (``left``) or suffix (``right``) length of a row's token
    arrays, computed in the row. The arrays ride in the fold's state, so the
    (possibly expensive) expression that produced them is evaluated once,
    not once per position."""
    init = F.struct(seqs.alias("s"), F.lit(0).alias("n"), F.lit(True).alias("go"))

    def step(acc, i):
        ss = acc["s"]
        if direction == "right":
            at = lambda x: F.element_at(x, -(i + 1))
        else:
            at = lambda x: F.element_at(x, i + 1)
        first = F.get(ss, 0)
        same = F.forall(ss, lambda x: (F.size(x) > i) & (at(x) == at(first)))
        go = acc["go"] & same
        return F.struct(ss.alias("s"), (acc["n"] + F.when(go, 1).otherwise(0)).alias("n"), go.alias("go"))

    longest = F.aggregate(seqs, F.lit(0), lambda m, x: F.greatest(m, F.size(x)))
    return F.aggregate(F.sequence(F.lit(0), F.greatest(longest - 1, F.lit(0))), init, step,
                       lambda acc: acc["n"])


def answer_spans(d: DataFrame, key: str = "item_id", tokens_col: str = "tokens",
                 type_col: str = "task_type") -> DataFrame:
    """Per option ``start`` / ``end`` of the answer span (MC: common prefix;
    schema: common suffix; LM: length without continuation, which must be a
    prefix - ``reason`` otherwise). One row per option (LM keeps only the
    prompt with the continuation). Everything is per item row: no explode
    of tokens, no shuffle."""
    toks = F.col(tokens_col)
    t = F.col(type_col)
    j = d.withColumn("prefix", F.when(t == "multiple_choice", common_length(toks, "left"))) \
         .withColumn("suffix", F.when(t == "schema", common_length(toks, "right")))
    w0, w1 = F.get(toks, 0), F.get(toks, 1)
    lm_ok = (F.size(w0) < F.size(w1)) & (F.slice(w1, 1, F.size(w0)) == w0)
    j = j.withColumn("reason", F.when((t == "language_modeling") & ~lm_ok, F.lit("lm_not_prefix")))
    j = j.withColumn("_lm_start", F.size(w0))
    seqs = F.when(t == "language_modeling", F.array(w1)).otherwise(toks)
    ex = j.select("*", F.posexplode(seqs).alias("option", "_tok"))
    n = F.size("_tok")
    start = (F.when(t == "multiple_choice", F.col("prefix"))
              .when(t == "schema", n - F.col("suffix"))
              .otherwise(F.col("_lm_start")))
    keep = [c for c in d.columns if c != tokens_col]
    return ex.select(*keep, "reason", "option", F.col("_tok").alias(tokens_col),
                     start.cast("int").alias("start"), n.alias("end"))


def crop_left(d: DataFrame, max_tokens: int, tokens_col: str = "tokens") -> DataFrame:
    """Keep the last ``max_tokens`` tokens and shift the span by the crop."""
    n = F.size(tokens_col)
    crop = F.greatest(n - max_tokens, F.lit(0))
    return (d.withColumn("start", F.col("start") - crop).withColumn("end", F.col("end") - crop)
             .withColumn(tokens_col, F.when(crop > 0, F.slice(tokens_col, -max_tokens, max_tokens))
                         .otherwise(F.col(tokens_col))))
