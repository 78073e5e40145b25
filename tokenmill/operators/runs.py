"""Run analytics: sweeps, fits, step logs, reports and log scraping
(SURVEY §2.3 J5-J7, §2.4 A17-A26, §2.5 W2-W7, §2.8 F21-F23, P10).

Fits are grouped aggregates of power sums solved in closed form as
column expressions, so one job fits every (sweep, budget) group in
parallel; nothing is collected per group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.plans.positions import global_position, prefix_extreme

TOKENS_PER_ITER = 524288          # fixed batch the log scraper assumes
EMA_BETA = 0.9
CLOCK_WARMUP_STEPS = 10
STAGES = ("base", "sft", "rl")
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


# --------------------------------------------------------------- sweeps --

def effective_params(df: DataFrame, convention: str = "transformer+lm_head") -> DataFrame:
    """``effective_params`` and ``param_data_ratio = tokens / effective``."""
    if convention == "transformer+lm_head":
        eff = F.col("params_transformer") + F.col("params_lm_head")
    elif convention == "transformer":
        eff = F.col("params_transformer")
    elif convention == "total":
        eff = F.col("params_total")
    else:
        raise ValueError(convention)
    return (df.withColumn("effective_params", eff.cast("double"))
              .withColumn("param_data_ratio", F.col("tokens_trained") / F.col("effective_params")))


def valid_runs(df: DataFrame, metric: str = "val_bpb") -> DataFrame:
    """Keep runs whose metric is present, not NaN and positive."""
    m = F.col(metric)
    return df.filter(m.isNotNull() & ~F.isnan(m) & (m > 0))


def interpolate_at(points: DataFrame, at: DataFrame, keys, x: str, ys: dict, at_x: str) -> DataFrame:
    """``np.interp``: linear interpolation of several curves ``y(x)`` at
    ``at_x``, clamped to the first / last point. ``at`` has one row per key;
    ``ys`` maps output names to columns of ``points``.

    Each point meets its key's one query, and the two points around it are
    ``max_by`` / ``min_by`` of those on either side: map-side aggregates, no
    arrays, windows or sorts, whatever the number of points. Points without
    an ``x`` take no part; a key without points (or an ``at`` without ``at_x``)
    gives nulls. ``at`` has as many rows as there are keys, which the size of the
    files below it doesn't tell: it is merged, never sent whole to the driver.
    """
    keys = list(keys)
    px, q = F.col("_p.x"), F.col("_q")
    pts = points.filter(F.col(x).isNotNull()).select(*keys, F.struct(
        F.col(x).cast("double").alias("x"), *[F.col(c).cast("double").alias(o) for o, c in ys.items()]).alias("_p"))
    met = pts.join(at.select(*keys, F.col(at_x).cast("double").alias("_q")).hint("merge"), keys)
    near = met.groupBy(*keys).agg(
        F.max(F.when(px <= q, F.col("_p"))).alias("_a"), F.min(F.when(px >= q, F.col("_p"))).alias("_b"),
        F.first("_q").alias("_q"))
    t = (q - F.col("_a.x")) / (F.col("_b.x") - F.col("_a.x"))

    def value(o):
        a, b = F.col(f"_a.{o}"), F.col(f"_b.{o}")
        # outside the points only one side is there: the end itself
        return (F.when(F.col("_a").isNull(), b).when(F.col("_b").isNull(), a)
                 .when(F.col("_b.x") == F.col("_a.x"), a).otherwise(a + t * (b - a)))

    return at.join(near.select(*keys, *[value(o).alias(o) for o in ys]).hint("merge"), keys, "left")


def isoflop_fit(runs: DataFrame, keys=("exp_id", "flops_budget"), x_raw: str = "effective_params",
                y: str = "val_bpb") -> DataFrame:
    """Per group: least-squares quadratic of ``y`` on ``log10(x_raw)``.

    Closed form on centred power sums (``u = x - mean(x)``). When the
    parabola opens upward the optimum is ``mean(x) - b / 2a``; otherwise (or
    when the fit is degenerate) the raw minimum row is used.
    Output: keys, ``a, b, c`` (in centred coordinates), ``log_opt``,
    ``opt_params``, ``opt_bpb``, ``fitted`` (bool).
    """
    keys = list(keys)
    d = runs.withColumn("_x", F.log10(F.col(x_raw)))
    w = Window.partitionBy(*keys)
    d = d.withColumn("_u", F.col("_x") - F.avg("_x").over(w))
    u, yv = F.col("_u"), F.col(y)
    g = d.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg("_x").alias("xbar"),
        F.sum(u * u).alias("s2"), F.sum(u * u * u).alias("s3"), F.sum(u * u * u * u).alias("s4"),
        F.sum(yv).alias("sy"), F.sum(u * yv).alias("suy"), F.sum(u * u * yv).alias("suuy"),
        F.min_by(F.struct(F.col(x_raw).alias("p"), yv.alias("v")), F.struct(yv, F.col(x_raw))).alias("_best"))
    A = F.col("s4") - F.col("s2") * F.col("s2") / F.col("n")
    R1 = F.col("suuy") - F.col("s2") * F.col("sy") / F.col("n")
    D = A * F.col("s2") - F.col("s3") * F.col("s3")
    a = (R1 * F.col("s2") - F.col("s3") * F.col("suy")) / D
    b = (A * F.col("suy") - F.col("s3") * R1) / D
    c = (F.col("sy") - a * F.col("s2")) / F.col("n")
    g = g.withColumn("a", F.when((F.col("n") >= 3) & (D != 0), a)) \
         .withColumn("b", F.when((F.col("n") >= 3) & (D != 0), b)) \
         .withColumn("c", F.when((F.col("n") >= 3) & (D != 0), c))
    fitted = F.coalesce(F.col("a") > 0, F.lit(False))
    ustar = -F.col("b") / (2 * F.col("a"))
    log_opt = F.when(fitted, F.col("xbar") + ustar).otherwise(F.log10(F.col("_best.p")))
    opt_bpb = F.when(fitted, F.col("a") * ustar * ustar + F.col("b") * ustar + F.col("c")).otherwise(F.col("_best.v"))
    return g.select(*keys, "n", "a", "b", "c", fitted.alias("fitted"), log_opt.alias("log_opt"),
                    F.pow(F.lit(10.0), log_opt).alias("opt_params"), opt_bpb.alias("opt_bpb"))


def isoflop_optimum(runs: DataFrame, keys=("exp_id", "flops_budget")) -> DataFrame:
    """Fit + interpolated tokens and ratio at the optimum (raw row values
    when the fit fell back to the minimum)."""
    keys = list(keys)
    fit = isoflop_fit(runs, keys)
    pts = runs.withColumn("_lx", F.log10("effective_params"))
    return interpolate_at(pts, fit, keys, "_lx",
                          {"opt_tokens": "tokens_trained", "opt_ratio": "param_data_ratio"}, "log_opt")


def power_law_fit(opt: DataFrame, key: str = "exp_id", x: str = "flops_budget", y: str = "opt_params",
                  prefix: str = "n") -> DataFrame:
    """log10-log10 slope and intercept per key."""
    lx, ly = F.log10(F.col(x)), F.log10(F.col(y))
    return opt.groupBy(key).agg(F.regr_slope(ly, lx).alias(f"slope_{prefix}"),
                                F.regr_intercept(ly, lx).alias(f"intercept_{prefix}"))


def ratio_summary(opt: DataFrame, key: str = "exp_id", x: str = "flops_budget") -> DataFrame:
    """Predicted tokens/params at the geometric-mean budget from the two power
    laws, mean +- sample std of per-budget ratios, exponent gap. Needs >= 2
    budgets (else NULL)."""
    lx = F.log10(F.col(x))
    g = opt.groupBy(key).agg(
        F.count("*").alias("budgets"),
        F.regr_slope(F.log10("opt_params"), lx).alias("slope_n"),
        F.regr_intercept(F.log10("opt_params"), lx).alias("intercept_n"),
        F.regr_slope(F.log10("opt_tokens"), lx).alias("slope_d"),
        F.regr_intercept(F.log10("opt_tokens"), lx).alias("intercept_d"),
        F.min(x).alias("_fmin"), F.max(x).alias("_fmax"),
        F.avg("opt_ratio").alias("mean_ratio"), F.stddev_samp("opt_ratio").alias("std_ratio"))
    log_ref = F.log10(F.sqrt(F.col("_fmin") * F.col("_fmax")))
    pred_n = F.col("intercept_n") + F.col("slope_n") * log_ref
    pred_d = F.col("intercept_d") + F.col("slope_d") * log_ref
    ok = F.col("budgets") >= 2
    return g.select(key, "budgets",
                    F.when(ok, F.pow(F.lit(10.0), pred_d - pred_n)).alias("optimal_ratio"),
                    F.when(ok, F.col("mean_ratio")).alias("mean_ratio"),
                    F.when(ok, F.col("std_ratio")).alias("std_ratio"),
                    F.when(ok, F.col("slope_d") - F.col("slope_n")).alias("exponent_gap"))


def best_per_group(df: DataFrame, keys, metric: str = "val_bpb", tie: str = "depth") -> DataFrame:
    """The row with the smallest metric per group (ties: smallest ``tie``)."""
    cols = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*cols), F.struct(F.col(metric), F.col(tie)))
    return df.filter(F.col(metric).isNotNull()).groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def first_per_group(df: DataFrame, keys, order: str, cols) -> DataFrame:
    """pandas ``groupby().first()``: first non-null value per column in ``order``."""
    return df.groupBy(*keys).agg(*[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
                                   for c in cols])


# --------------------------------------------------------- regressions --

def linear_fits(df: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Per key: ``y = slope*x + intercept`` and R^2, ranked by R^2 desc."""
    g = df.groupBy(key).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                            F.regr_r2(y, x).alias("r2"), F.count("*").alias("n"))
    # ascending order of (no R^2, -R^2, key) is the ranking
    g = g.withColumn("_worse", F.struct(F.col("r2").isNull().alias("none"), (-F.col("r2")).alias("minus")))
    return global_position(g, ["_worse", key], (), out="rank").withColumn(
        "rank", (F.col("rank") + 1).cast("int")).drop("_worse")


def head_to_head(df: DataFrame, family_col: str, a: str, b: str, bucket: str, metric: str) -> DataFrame:
    """Pair two families by size bucket: Δ = b - a and % improvement over a."""
    per = df.filter(F.col(family_col).isin(a, b)).groupBy(bucket).pivot(family_col, [a, b]).agg(F.avg(metric))
    per = per.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    return per.select(bucket, F.col(a).alias("metric_a"), F.col(b).alias("metric_b"),
                      (F.col(b) - F.col(a)).alias("delta"),
                      (F.lit(100.0) * (F.col(b) - F.col(a)) / F.col(a)).alias("improvement_pct"))


def metric_spread(final: DataFrame, metric: str) -> DataFrame:
    return final.agg(F.avg(metric).alias("mean"), (F.max(metric) - F.min(metric)).alias("range"),
                     F.count(metric).alias("runs"))


# --------------------------------------------------------- step windows --

def running_min(steps: DataFrame, key: str = "run_id", order: str = "step", metric: str = "val_bpb",
                out: str = "best_so_far") -> DataFrame:
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return steps.withColumn(out, F.min(metric).over(w))


def ema_debiased(steps: DataFrame, key: str = "run_id", order: str = "step", x: str = "loss",
                 beta: float = EMA_BETA, offset: int = 0, block: int = 256,
                 out: str = "smooth_loss") -> DataFrame:
    """``s = beta*s + (1-beta)*x``; output ``s / (1 - beta^(step+1+offset))``.

    Exact and overflow-free: within blocks of ``block`` steps the EMA is a
    windowed sum with bounded exponents, and a block as a whole is the affine
    map ``s -> decay * s + end``. The maps of ``FAN`` neighbouring blocks are
    composed into one, level by level, and the states go down again the same
    way, so no array is longer than ``FAN`` (``EMA_LEVELS`` levels are enough
    for ``block * FAN ** EMA_LEVELS`` steps a run; the last takes what is
    left). ``offset=1`` is the SFT variant.
    """
    d = global_position(steps, [order], [key], out="_pos")
    d = d.withColumn("_blk", F.floor(F.col("_pos") / block)).withColumn("_j", F.col("_pos") % block)
    wb = Window.partitionBy(key, "_blk").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_P", F.sum(F.col(x) * F.pow(F.lit(beta), -F.col("_j"))).over(wb))
    d = d.withColumn("_local", F.lit(1 - beta) * F.pow(F.lit(beta), F.col("_j")) * F.col("_P"))
    maps = d.groupBy(key, "_blk").agg(F.pow(F.lit(beta), F.count("*")).alias("_a"),
                                      F.max_by("_local", "_pos").alias("_e"))
    d = d.join(_states_before(maps, key), [key, "_blk"])
    s = F.pow(F.lit(beta), F.col("_j") + 1) * F.col("_C") + F.col("_local")
    debiased = s / (F.lit(1.0) - F.pow(F.lit(beta), F.col(order) + 1 + offset))
    return d.withColumn(out, debiased).drop("_pos", "_blk", "_j", "_P", "_local", "_C")


FAN = 256
EMA_LEVELS = 3


def _states_before(maps: DataFrame, key: str, level: int = EMA_LEVELS) -> DataFrame:
    """``_C``: the state each block starts with, from 0 through the maps
    ``s -> _a * s + _e`` of the blocks ``_blk`` before it."""
    up = maps.select(key, "_blk", F.floor(F.col("_blk") / FAN if level else F.lit(0)).alias("_up"), "_a", "_e")
    groups = up.groupBy(key, "_up").agg(F.array_sort(F.collect_list(F.struct("_blk", "_a", "_e"))).alias("_kids"))

    def compose(first, kid):
        return F.struct((first["_a"] * kid["_a"]).alias("_a"), (kid["_a"] * first["_e"] + kid["_e"]).alias("_e"))

    nothing = F.struct(F.lit(1.0).alias("_a"), F.lit(0.0).alias("_e"))
    if level:
        whole = groups.select(key, F.col("_up").alias("_blk"), F.aggregate("_kids", nothing, compose).alias("_m"))
        above = _states_before(whole.select(key, "_blk", "_m._a", "_m._e"), key, level - 1)
        groups = groups.join(above.withColumnRenamed("_blk", "_up"), [key, "_up"])
    else:
        groups = groups.withColumn("_C", F.lit(0.0))
    # states within a group of at most FAN maps
    states = F.transform("_kids", lambda kid, i: F.struct(
        kid["_blk"].alias("_blk"),
        F.aggregate(F.slice("_kids", F.lit(1), i), F.col("_C"),
                    lambda c, k: k["_a"] * c + k["_e"]).alias("_C")))
    return groups.select(key, F.inline(states))


def training_clock(steps: DataFrame, num_iterations: int, batch_tokens: int, flops_per_token: float,
                   peak_flops: float, world: int = 1, key: str = "run_id", order: str = "step",
                   dt: str = "dt") -> DataFrame:
    """Cumulative training time (steps after the first 10), ETA from the
    average step time, tokens/s and MFU per step."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    d = steps.withColumn("total_time", F.sum(F.when(F.col(order) > CLOCK_WARMUP_STEPS, F.col(dt))
                                             .otherwise(F.lit(0.0))).over(w))
    done = F.col(order) - CLOCK_WARMUP_STEPS
    eta = F.when(done > 0, (F.lit(num_iterations) - F.col(order)) * F.col("total_time") / done)
    return (d.withColumn("eta_s", eta)
             .withColumn("tok_per_sec", F.floor(F.lit(batch_tokens) / F.col(dt)).cast("long"))
             .withColumn("mfu", F.lit(100.0) * F.lit(flops_per_token * batch_tokens) / F.col(dt)
                         / F.lit(peak_flops * world)))


def time_to_target(steps: DataFrame, target: float, metric: str = "val_bpb", key: str = "run_id",
                   order: str = "step", dt: str = "dt", below: bool = True) -> DataFrame:
    """Earliest step per run whose metric passes the target, with the elapsed
    time up to and including that step."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    d = steps.withColumn("elapsed", F.sum(dt).over(w))
    hit = F.col(metric) < target if below else F.col(metric) > target
    return d.filter(hit).groupBy(key).agg(F.min(order).alias("step"),
                                          F.min_by("elapsed", order).alias("elapsed"))


def record_improvement(runs: DataFrame, order: str, metric: str, lower_is_better: bool = True) -> DataFrame:
    """Runs that beat every earlier run, with the % gain on the previous
    record (the best value before it). The best-so-far is a block prefix
    min/max, so no window spans the whole table."""
    kind = "min" if lower_is_better else "max"
    d = prefix_extreme(runs, [order], metric, (), out="_prev_best", kind=kind)
    better = (F.col(metric) < F.col("_prev_best")) if lower_is_better else (F.col(metric) > F.col("_prev_best"))
    rec = d.filter(F.col("_prev_best").isNull() | better)
    gain = F.lit(100.0) * (F.col("_prev_best") - F.col(metric)) / F.col("_prev_best")
    if not lower_is_better:
        gain = -gain
    return rec.withColumn("gain_pct", gain).drop("_prev_best")


# ------------------------------------------------------------- reports --

def section_key(section) -> Column:
    """A section's name as its file is called: lower case, blanks to ``-``."""
    return F.translate(F.lower(F.col(section) if isinstance(section, str) else section), " ", "-")


def scrape_report_kv(lines: DataFrame, keys, section: str = "stage", order: str = "line_no",
                     line: str = "line") -> DataFrame:
    """Lines containing a key -> text between the first and second ``:``,
    stripped; the last match per (section, key) wins. A line with the key but
    no colon gives NULL."""
    ks = F.array(*[F.lit(k) for k in keys])
    d = lines.select(section, order, line, F.explode(F.filter(ks, lambda k: F.col(line).contains(k))).alias("key"))
    val = F.regexp_replace(F.get(F.split(F.col(line), ":"), F.lit(1)), r"(?U)^\s+|\s+$", "")
    return d.groupBy(section, "key").agg(F.max_by(val, F.col(order)).alias("value"))


def report_timestamps(lines: DataFrame, prefix: str = "timestamp:", section: str = "stage",
                      order: str = "line_no", line: str = "line") -> DataFrame:
    """First parseable ``prefix`` timestamp per section (bad ones skipped)."""
    txt = F.regexp_replace(F.regexp_extract(F.col(line), r"(?s)^[^:]*:(.*)$", 1), r"(?U)^\s+|\s+$", "")
    ts = F.try_to_timestamp(txt, F.lit(TS_FORMAT))
    d = lines.filter(F.col(line).startswith(prefix)).withColumn("ts", ts).filter(F.col("ts").isNotNull())
    return d.groupBy(section).agg(F.min_by("ts", order).alias("ts"))



def metric_pivot(kv: DataFrame, stages=STAGES, section: str = "stage", key: str = "key",
                 value: str = "value") -> DataFrame:
    """metric x stage table, '-' where missing; CORE first, ChatCORE last,
    others by name (``sort_key``)."""
    p = kv.groupBy(key).pivot(section, list(stages)).agg(F.max(value))
    for s in stages:
        p = p.withColumn(s, F.coalesce(F.col(s), F.lit("-")))
    sort_key = F.concat(F.when(F.col(key) == "CORE", "0").when(F.col(key) == "ChatCORE", "2").otherwise("1"),
                        F.col(key))
    return p.withColumn("sort_key", sort_key).withColumnRenamed(key, "metric")


def run_duration(ts: DataFrame, sections, section: str = "stage", present: DataFrame | None = None) -> DataFrame:
    """Start = first section's timestamp; end = timestamp of the last present
    non-RL section in list order - NULL when that section has none (it still
    "sets" the end); ``XhYm`` or 'unknown'. ``present`` lists the sections
    that exist (default: those with a timestamp)."""
    order = F.create_map(*[x for i, s in enumerate(sections) for x in (F.lit(s), F.lit(i))])
    non_rl = [s for s in sections if "rl" not in s]
    if present is not None:
        ts = present.select(section).distinct().join(ts, section, "left")
    present = ts.select(F.lit(0).alias("_k"), section, "ts")
    g = present.groupBy("_k").agg(
        F.max_by("ts", F.when(F.col(section) == sections[0], F.lit(1))).alias("start"),
        F.max_by(F.struct("ts"), F.when(F.col(section).isin(*non_rl), order[F.col(section)]))["ts"].alias("end"))
    secs = (F.unix_timestamp("end") - F.unix_timestamp("start")).cast("long")
    txt = F.when(F.col("start").isNotNull() & F.col("end").isNotNull(),
                 F.concat(F.floor(secs / 3600).cast("string"), F.lit("h"),
                          F.floor((secs % 3600) / 60).cast("string"), F.lit("m"))).otherwise(F.lit("unknown"))
    return g.select(F.col("start").cast("string").alias("start"), F.col("end").cast("string").alias("end"),
                    txt.alias("duration"))


# ---------------------------------------------------------- log scrape --

# fixed values: the lines of a run log and its parameter counts
_MARKERS = {"bpb": "Validation bpb:", "iters": "Calculated number of iterations", "core": "CORE metric:"}
PARAMETER_COUNTS = ("wte", "bigram_embed", "value_embeds", "lm_head", "transformer_matrices", "scalars", "total")


def scrape_run_logs(logs: DataFrame, file_col: str = "file_no", order: str = "line_no",
                    line: str = "line") -> DataFrame:
    """Per log file: the last line holding each marker, numbers extracted as
    the shell pipeline did (commas removed); tokens = iters x 524288;
    missing CORE -> 0.0; a number that can't be read is NULL."""
    ms = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("m")) for k, v in _MARKERS.items()])
    counts = F.array(*[F.struct(F.lit(f"params_{n}").alias("k"), F.lit(rf"\b{n}\s*:").alias("m")) for n in PARAMETER_COUNTS])
    found = F.concat(F.filter(ms, lambda s: F.col(line).contains(s["m"])), F.filter(counts, lambda s: F.regexp_like(F.col(line), s["m"])))
    d = logs.select(file_col, order, line, F.explode(found).alias("_m"))
    names = [f"params_{n}" for n in PARAMETER_COUNTS]
    last = d.groupBy(file_col).pivot("_m.k", [*_MARKERS, *names]).agg(F.max_by(line, order))
    files = logs.select(file_col).distinct()
    last = files.join(last, file_col, "left")
    number = lambda c: F.replace(F.regexp_extract(c, r":\s*([0-9,]+)", 1), F.lit(","), F.lit(""))
    iters = F.replace(F.regexp_extract("iters", r"^.*: (.*)$", 1), F.lit(","), F.lit(""))
    bpb = F.regexp_extract("bpb", r"([0-9.]+)$", 1)
    core = F.element_at(F.split(F.trim("core"), " +"), -1)
    out = last.select(
        file_col,
        *[F.when(F.col(n).isNotNull(), number(n)).try_cast("long").alias(n) for n in names],
        F.when(F.col("iters").isNotNull(), iters).try_cast("long").alias("num_iters"),
        F.when(F.col("bpb").isNotNull(), bpb).try_cast("double").alias("val_bpb"),
        F.coalesce(F.when(F.col("core").isNotNull(), core), F.lit("0.0")).try_cast("double").alias("core"))
    out = out.withColumn("tokens_trained", F.col("num_iters") * F.lit(TOKENS_PER_ITER))
    return out.withColumn("param_data_ratio", F.round(F.try_divide("tokens_trained", "params_lm_head"), 2))


# -------------------------------------------------------- rule lookup --

def match_first_rule(df: DataFrame, rules: DataFrame, name_col: str, patterns, value: str = "value",
                     order: str = "rule_no", out: str = "matched", default: float = float("inf")) -> DataFrame:
    """First rule (in ``order``) whose non-empty patterns all occur in the
    lower-cased name; none -> ``default``. The rules, a config table, become
    one sorted array inside the plan (no job, no join, no shuffle of the
    names)."""
    row = F.struct(order, F.struct(F.col(value).cast("double").alias("value"), *patterns).alias("rule"))
    table = rules.select(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["rule"]).alias("rules")).scalar()
    name = F.lower(F.col(name_col))

    def applies(rule):
        fits = [F.coalesce(rule[p], F.lit("")) for p in patterns]
        return reduce(lambda a, b: a & b, [(p == "") | name.contains(p) for p in fits], F.lit(True))

    hit = F.get(F.filter("_rules", applies), F.lit(0))["value"]
    return df.withColumn("_rules", table).withColumn(out, F.coalesce(hit, F.lit(default))).drop("_rules")
