"""Conversation jobs: nesting, validation, surgery, views and mixtures.

A conversation is ``messages ARRAY<STRUCT<role STRING, content STRING>>``
(nested form) or ``(conv_id, turn, role, text)`` (long form). Validation
never drops rows silently: it adds ``reason`` / ``bad_index`` so callers
split good rows from a quarantine output.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.plans.positions import global_position, seeded_key, seeded_position

ROLES = ("user", "assistant", "system")
# limits of the chat request checks (fixed values of the reference server)
MAX_MESSAGES = 500
MAX_MESSAGE_CHARS = 8000
MAX_TOTAL_CHARS = 32000
TEMPERATURE_RANGE = (0.0, 2.0)
TOP_K_RANGE = (0, 200)
MAX_TOKENS_RANGE = (1, 4096)


def nest_conversations(long_df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                       role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Long form -> ``(conv_id, messages)`` ordered by turn."""
    m = F.struct(F.col(turn_col).alias("t"), F.col(role_col).alias("role"), F.col(text_col).alias("content"))
    g = long_df.groupBy(id_col).agg(F.array_sort(F.collect_list(m)).alias("_m"))
    msgs = F.transform("_m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    return g.select(id_col, msgs.alias("messages"))


def _first_failure(n: Column, check) -> Column:
    """First ``(i, code)`` with a non-null ``check(i)`` over message indexes."""
    idx = F.sequence(F.lit(0), n - 1)
    fails = F.filter(F.transform(idx, lambda i: F.struct(i.alias("i"), check(i).alias("code"))),
                     lambda x: x["code"].isNotNull())
    return F.when(n > 0, F.get(fails, 0))


def validate_conversations(df: DataFrame, variant: str = "strict", messages_col: str = "messages") -> DataFrame:
    """Add ``reason`` and ``bad_index`` (NULL when the conversation is valid).

    variants: ``strict`` (>= 2 messages, user/assistant alternate from 0,
    string content), ``system_ok`` (an optional leading system message is
    skipped first), ``nonblank`` (strict roles, content must not be blank).
    """
    msgs = F.col(messages_col)
    if variant == "system_ok":
        msgs = F.when(F.get(msgs, 0)["role"] == "system", F.slice(msgs, 2, F.size(msgs))).otherwise(msgs)
    n = F.size(msgs)

    def check(i):
        m = F.get(msgs, i)
        expected = F.when(i % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
        c = (F.when(m["role"].isNull(), F.lit("missing_role"))
              .when(m["content"].isNull(), F.lit("missing_content"))
              .when(m["role"] != expected, F.lit("bad_role")))
        if variant == "nonblank":
            c = c.when(F.length(F.regexp_replace(m["content"], r"(?U)\s", "")) == 0, F.lit("empty_content"))
        return c

    ff = _first_failure(n, check)
    reason = F.when(msgs.isNull() | (n < 2), F.lit("too_short")).otherwise(ff["code"])
    bad = F.when(msgs.isNull() | (n < 2), F.lit(None).cast("int")).otherwise(ff["i"])
    return df.withColumn("reason", reason).withColumn("bad_index", bad)


def validate_limits(df: DataFrame, messages_col: str = "messages", max_messages: int = MAX_MESSAGES,
                    max_chars: int = MAX_MESSAGE_CHARS, max_total: int = MAX_TOTAL_CHARS,
                    temperature: str | None = None, top_k: str | None = None,
                    max_tokens: str | None = None) -> DataFrame:
    """Chat request checks; the first failing rule (in source order) wins."""
    msgs = F.col(messages_col)
    n = F.size(msgs)
    lens = F.transform(msgs, lambda m: F.coalesce(F.length(m["content"]), F.lit(0)))
    empty = _first_failure(n, lambda i: F.when(F.coalesce(F.length(F.get(msgs, i)["content"]), F.lit(0)) == 0,
                                               F.lit("empty_content"))
                                        .when(F.length(F.get(msgs, i)["content"]) > max_chars,
                                              F.lit("message_too_long")))
    total = F.aggregate(lens, F.lit(0).cast("long"), lambda acc, x: acc + x)
    bad_role = _first_failure(n, lambda i: F.when(~F.get(msgs, i)["role"].isin(*ROLES), F.lit("bad_role")))
    r = (F.when(n == 0, F.lit("no_messages"))
          .when(n > max_messages, F.lit("too_many_messages"))
          .when(empty.isNotNull(), empty["code"])
          .when(total > max_total, F.lit("total_too_long"))
          .when(bad_role.isNotNull(), bad_role["code"]))
    if temperature:
        t = F.col(temperature)
        r = r.when(t.isNotNull() & ~t.between(*TEMPERATURE_RANGE), F.lit("bad_temperature"))
    if top_k:
        k = F.col(top_k)
        r = r.when(k.isNotNull() & ~k.between(*TOP_K_RANGE), F.lit("bad_top_k"))
    if max_tokens:
        mt = F.col(max_tokens)
        r = r.when(mt.isNotNull() & ~mt.between(*MAX_TOKENS_RANGE), F.lit("bad_max_tokens"))
    idx = (F.when(n == 0, None).when(n > max_messages, None)
            .when(empty.isNotNull(), empty["i"])
            .when(total > max_total, None)
            .when(bad_role.isNotNull(), bad_role["i"]))
    return df.withColumn("reason", r).withColumn("bad_index", idx)


def normalize_content(content_json: Column) -> Column:
    """List content -> its text parts (and bare strings) joined by newlines;
    NULL -> ''. Uses VARIANT since the list mixes objects and strings."""
    v = F.parse_json(content_json)
    items = F.variant_get(v, "$", "array<variant>")
    kept = F.filter(items, lambda x: (F.schema_of_variant(x) == "STRING") | (
        F.coalesce(F.try_variant_get(x, "$.type", "string"), F.lit("")) == "text"))
    texts = F.transform(kept, lambda x: F.when(F.schema_of_variant(x) == "STRING", F.variant_get(x, "$", "string"))
                        .otherwise(F.coalesce(F.try_variant_get(x, "$.text", "string"), F.lit(""))))
    return F.when(content_json.isNull(), F.lit("")).otherwise(F.coalesce(F.array_join(texts, "\n"), F.lit("")))


def merge_system_message(df: DataFrame, messages_col: str = "messages") -> DataFrame:
    """A leading system message is prepended to the next (user) message with a
    blank line and removed. ``reason`` = 'system_not_followed_by_user' when
    the second message is not from the user."""
    msgs = F.col(messages_col)
    first, second = F.get(msgs, 0), F.get(msgs, 1)
    is_sys = first["role"] == "system"
    merged = F.concat(F.array(F.struct(F.lit("user").alias("role"),
                                       F.concat(first["content"], F.lit("\n\n"), second["content"]).alias("content"))),
                      F.slice(msgs, 3, F.greatest(F.size(msgs) - 2, F.lit(0))))
    bad = is_sys & (F.coalesce(second["role"], F.lit("")) != "user")
    return (df.withColumn("reason", F.when(bad, F.lit("system_not_followed_by_user")))
              .withColumn(messages_col, F.when(is_sys & ~bad, merged).otherwise(msgs)))


def drop_last_assistant(df: DataFrame, messages_col: str = "messages") -> DataFrame:
    """Prompt side of a conversation: the last message must be the
    assistant's and is removed; otherwise ``reason`` is set."""
    msgs = F.col(messages_col)
    ok = F.element_at(msgs, -1)["role"] == "assistant"
    return (df.withColumn("reason", F.when(~F.coalesce(ok, F.lit(False)), F.lit("last_not_assistant")))
              .withColumn(messages_col, F.when(ok, F.slice(msgs, 1, F.size(msgs) - 1)).otherwise(msgs)))


# ---------------------------------------------------------------- views --

def slice_view(df: DataFrame, start: int = 0, stop: int | None = None, step: int = 1,
               row_col: str = "row_id", out: str = "view_idx") -> DataFrame:
    """Rows ``start, start+step, ...`` below ``stop`` (clamped to the end)."""
    if start < 0 or step < 1 or (stop is not None and stop < start):
        raise ValueError("need start >= 0, step >= 1, stop >= start")
    r = F.col(row_col)
    cond = (r >= start) & (F.pmod(r - start, F.lit(step)) == 0)
    if stop is not None:
        cond = cond & (r < stop)
    return df.filter(cond).withColumn(out, ((r - start) / step).cast("long"))


def round_robin(df: DataFrame, world: int, row_col: str = "row_id", out: str = "rank") -> DataFrame:
    return df.withColumn(out, F.pmod(F.col(row_col), F.lit(world)).cast("int"))


def head_problems(df: DataFrame, n: int, row_col: str = "row_id") -> DataFrame:
    """First ``min(len, n)`` rows in row order (TakeOrdered)."""
    return df.orderBy(row_col).limit(n) if n > 0 else df


# -------------------------------------------------------------- mixtures --

def union_tasks(tasks: list[tuple[str, DataFrame]], row_col: str = "row_id") -> DataFrame:
    """Bag union of tasks in list order; a task listed twice appears twice.
    Adds ``task_no`` (list position) and ``task``."""
    parts = [df.withColumn("task_no", F.lit(i)).withColumn("task", F.lit(name))
             for i, (name, df) in enumerate(tasks)]
    return reduce(lambda a, b: a.unionByName(b), parts)


def mixture(tasks: list[tuple[str, DataFrame]], seed: int = 42, row_col: str = "row_id",
            out: str = "mix_idx") -> DataFrame:
    """Union + seeded order + dense index (index -> (task_no, row_id))."""
    u = union_tasks(tasks, row_col)
    u = u.withColumn("_k", seeded_key(seed, "task_no", row_col))
    return global_position(u, ["_k", "task_no", row_col], (), out=out,
                           block=F.substring("_k", 1, 4)).drop("_k")


def task_sequence(tasks: list[tuple[str, DataFrame]], row_col: str = "row_id",
                  out: str = "seq_idx") -> DataFrame:
    """Curriculum order: task after task; index = offset of the task + row."""
    u = union_tasks(tasks, row_col)
    sizes = u.groupBy("task_no").agg(F.count("*").alias("_n"))
    w = Window.orderBy("task_no").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select("task_no", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return u.join(offs, "task_no").withColumn(out, F.col("_off") + F.col(row_col)).drop("_off")


def mixture_composition(tasks: list[tuple[str, DataFrame]], recipe: DataFrame | None = None) -> DataFrame:
    """Rows per task, share of the mixture and epochs (times listed)."""
    u = union_tasks(tasks)
    per = u.groupBy("task").agg(F.count("*").alias("rows"), F.countDistinct("task_no").alias("epochs"))
    total = u.select(F.count("*")).scalar()
    return per.withColumn("share", F.round(F.col("rows") / total, 6))


# --------------------------------------------------------------- recipes --

@dataclass(frozen=True)
class Part:
    """A task of a recipe: how often it is listed, and where each listing
    stops (None: at the end of the task)."""

    task: str
    times: int = 1
    stop: int | None = None


def sft_recipe(kind: str, choice_epochs: int = 3, math_epochs: int = 4) -> list[Part]:
    """The chat training mixtures: ``full``, ``lite`` for small machines, and
    ``val`` for validation."""
    # fixed values: epochs, sizes and stops of the three mixtures
    if kind == "full":
        return [Part("chat"), Part("identity", 2), Part("custom", 3), Part("domain", 5), Part("choice", choice_epochs),
                Part("math", math_epochs), Part("spelling", 1, 200_000), Part("spelling_bee", 1, 80_000)]
    if kind == "lite":
        return [Part("custom", 20), Part("identity", 3), Part("domain", 10), Part("math", min(math_epochs, 2))]
    if kind == "val":
        return [Part("chat"), Part("choice", 1, 5200), Part("math", 1, 420)]
    raise ValueError(f"no such recipe: {kind}")


def _listings(recipe: list[Part]) -> dict[str, list[tuple[int, int | None]]]:
    """Per task its places in the recipe, in order, with their stops."""
    out: dict[str, list[tuple[int, int | None]]] = {}
    place = 0
    for part in recipe:
        for _ in range(part.times):
            out.setdefault(part.task, []).append((place, part.stop))
            place += 1
    return out


def recipe_rows(rows: DataFrame, recipe: list[Part], task_col: str = "task", row_col: str = "row_id") -> DataFrame:
    """Every row of ``rows`` (all tasks, one scan, ``row_id`` dense per task)
    once for each listing of its task that it does not lie beyond; tasks that
    the recipe doesn't list give nothing. Adds ``task_no``, the listing."""
    none = F.array().cast("array<int>")

    def places(listings):
        parts = [F.array(*[F.lit(place) for place, stop in listings if stop is None]).cast("array<int>")]
        return F.concat(*parts, *[F.when(F.col(row_col) < stop, F.array(F.lit(place))).otherwise(none) for place, stop in listings if stop is not None])

    # plain conditions, which Spark compiles
    mine = none
    for task, listings in _listings(recipe).items():
        mine = F.when(F.col(task_col) == task, places(listings)).otherwise(mine)
    return rows.withColumn("task_no", F.explode(mine))


def recipe_mixture(rows: DataFrame, recipe: list[Part], seed: int = 42, row_col: str = "row_id", out: str = "mix_idx") -> DataFrame:
    """The rows of a recipe in seeded order with a dense index. ``rows`` is
    read twice."""
    return seeded_position(recipe_rows(rows, recipe, row_col=row_col), seed, ["task_no", row_col], out)


def recipe_composition(rows: DataFrame, recipes: dict[str, list[Part]], task_col: str = "task") -> DataFrame:
    """(recipe, task, rows, epochs, share) from one count per task: a listing
    gives as many rows as the task has, up to its stop."""
    counts = rows.groupBy(task_col).agg(F.count("*").alias("_n"))
    parts = [(name, task, len(ls), [stop for _, stop in ls]) for name, recipe in recipes.items() for task, ls in _listings(recipe).items()]
    table = rows.sparkSession.createDataFrame(parts, f"recipe string, {task_col} string, epochs long, stops array<long>")
    per = table.join(counts, task_col).withColumn("rows", F.aggregate("stops", F.lit(0).cast("long"), lambda acc, stop: acc + F.least(F.col("_n"), F.coalesce(stop, F.col("_n")))))
    total = F.sum("rows").over(Window.partitionBy("recipe"))
    return per.select("recipe", task_col, "rows", "epochs", F.round(F.col("rows") / total, 6).alias("share"))
