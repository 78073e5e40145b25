"""Registered run-analytics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.operators import runs as R
from tokenmill.operators.regression import ensemble_predict, ridge_fit
from tokenmill.plans.catalog import load, oracle
from tokenmill.plans.registry import query
from tokenmill.sources.files import append_missing

KEYS = ["exp_id", "flops_budget"]

_VALID = """r as (select *, cast(params_transformer + params_lm_head as double) as effective_params,
                  tokens_trained / cast(params_transformer + params_lm_head as double) as param_data_ratio
           from runs where val_bpb is not null and not isnan(val_bpb) and val_bpb > 0)"""

_FIT = _VALID + """,
x as (select *, log10(effective_params) as lx from r),
c as (select *, lx - avg(lx) over (partition by exp_id, flops_budget) as u from x),
g as (select exp_id, flops_budget, count(*) as n, avg(lx) as xbar, sum(u*u) as s2, sum(u*u*u) as s3,
             sum(u*u*u*u) as s4, sum(val_bpb) as sy, sum(u*val_bpb) as suy, sum(u*u*val_bpb) as suuy,
             arg_min(effective_params, (val_bpb, effective_params)) as best_p, min(val_bpb) as best_v
      from c group by exp_id, flops_budget),
f1 as (select *, s4 - s2*s2/n as aa, suuy - s2*sy/n as r1 from g),
f2 as (select *, aa*s2 - s3*s3 as dd from f1),
f3 as (select *, case when n >= 3 and dd <> 0 then (r1*s2 - s3*suy)/dd end as a,
                 case when n >= 3 and dd <> 0 then (aa*suy - s3*r1)/dd end as b from f2),
f4 as (select *, case when n >= 3 and dd <> 0 then (sy - a*s2)/n end as c, coalesce(a > 0, false) as fitted from f3),
fit as (select exp_id, flops_budget, n, a, b, c, fitted,
               case when fitted then xbar - b/(2*a) else log10(best_p) end as log_opt,
               case when fitted then a*(b/(2*a))*(b/(2*a)) - b*b/(2*a) + c else best_v end as opt_bpb
        from f4)"""


def _interp_sql(name, ycol):
    return f"""
pts_{name} as (select exp_id, flops_budget, log10(effective_params) as lx, cast({ycol} as double) as yv from r),
seg_{name} as (select exp_id, flops_budget, lx as x0, yv as y0,
                 lead(lx) over (partition by exp_id, flops_budget order by lx) as x1,
                 lead(yv) over (partition by exp_id, flops_budget order by lx) as y1 from pts_{name}),
ends_{name} as (select exp_id, flops_budget, min(lx) as xlo, max(lx) as xhi, arg_min(yv, lx) as ylo,
                  arg_max(yv, lx) as yhi from pts_{name} group by exp_id, flops_budget),
{name} as (select f.exp_id, f.flops_budget, case when f.log_opt <= e.xlo then e.ylo when f.log_opt >= e.xhi then e.yhi
            else (select arg_min(y0 + (f.log_opt - x0) / (x1 - x0) * (y1 - y0), x0) from seg_{name} s
                  where s.exp_id = f.exp_id and s.flops_budget = f.flops_budget and x1 is not null
                    and f.log_opt >= x0 and f.log_opt <= x1) end as v
          from fit f join ends_{name} e on e.exp_id = f.exp_id and e.flops_budget = f.flops_budget)"""


_OPT = _FIT + "," + _interp_sql("itok", "tokens_trained") + "," + _interp_sql("irat", "param_data_ratio") + """,
opt as (select f.exp_id, f.flops_budget, f.log_opt, power(10, f.log_opt) as opt_params, t.v as opt_tokens,
               q.v as opt_ratio, f.opt_bpb
        from fit f join itok t on t.exp_id = f.exp_id and t.flops_budget = f.flops_budget
                   join irat q on q.exp_id = f.exp_id and q.flops_budget = f.flops_budget)"""


def _valid(spark, sf_dir):
    return R.effective_params(R.valid_runs(load(spark, sf_dir).runs))


def _opt(spark, sf_dir):
    return R.isoflop_optimum(_valid(spark, sf_dir), KEYS)


@query("valid_runs", oracle(f"""
with {_VALID}
select exp_id, flops_budget, depth, effective_params, param_data_ratio from r""", "runs"))
def q_valid_runs(spark, sf_dir):
    return _valid(spark, sf_dir).select("exp_id", "flops_budget", "depth", "effective_params", "param_data_ratio")


@query("isoflop_fit", oracle(f"""
with {_FIT}
select exp_id, flops_budget, n, a, b, c, fitted, log_opt, opt_bpb from fit""", "runs"))
def q_isoflop_fit(spark, sf_dir):
    f = R.isoflop_fit(_valid(spark, sf_dir), KEYS)
    return f.select(*KEYS, "n", "a", "b", "c", "fitted", "log_opt", "opt_bpb")


@query("bracket_interpolate", oracle(f"""
with {_OPT}
select exp_id, flops_budget, log10(opt_tokens) as log_opt_tokens, opt_ratio from opt""", "runs"))
def q_bracket_interpolate(spark, sf_dir):
    o = _opt(spark, sf_dir)
    return o.select(*KEYS, F.log10("opt_tokens").alias("log_opt_tokens"), "opt_ratio")


@query("power_law_fit", oracle(f"""
with {_OPT}
select exp_id, regr_slope(log10(opt_params), log10(flops_budget)) as slope_n,
       regr_intercept(log10(opt_params), log10(flops_budget)) as intercept_n,
       regr_slope(log10(opt_tokens), log10(flops_budget)) as slope_d,
       regr_intercept(log10(opt_tokens), log10(flops_budget)) as intercept_d
from opt group by exp_id""", "runs"))
def q_power_law_fit(spark, sf_dir):
    o = _opt(spark, sf_dir)
    n = R.power_law_fit(o, "exp_id", "flops_budget", "opt_params", "n")
    d = R.power_law_fit(o, "exp_id", "flops_budget", "opt_tokens", "d")
    return n.join(d.hint("merge"), "exp_id")       # a row per sweep: as many as the input has


@query("ratio_summary", oracle(f"""
with {_OPT},
s as (select exp_id, count(*) as budgets,
        regr_slope(log10(opt_params), log10(flops_budget)) as sn, regr_intercept(log10(opt_params), log10(flops_budget)) as i_n,
        regr_slope(log10(opt_tokens), log10(flops_budget)) as sd, regr_intercept(log10(opt_tokens), log10(flops_budget)) as i_d,
        log10(sqrt(min(flops_budget) * max(flops_budget))) as lref, avg(opt_ratio) as mr, stddev_samp(opt_ratio) as sr
      from opt group by exp_id)
select exp_id, budgets,
  case when budgets >= 2 then power(10, (i_d + sd * lref) - (i_n + sn * lref)) end as optimal_ratio,
  case when budgets >= 2 then mr end as mean_ratio, case when budgets >= 2 then sr end as std_ratio,
  case when budgets >= 2 then sd - sn end as exponent_gap
from s""", "runs"))
def q_ratio_summary(spark, sf_dir):
    return R.ratio_summary(_opt(spark, sf_dir))


@query("best_per_group", oracle(f"""
with {_VALID}
select exp_id, flops_budget, arg_min(depth, (val_bpb, depth)) as depth, min(val_bpb) as val_bpb
from r group by exp_id, flops_budget""", "runs"))
def q_best_per_group(spark, sf_dir):
    b = R.best_per_group(_valid(spark, sf_dir), KEYS, "val_bpb", "depth")
    return b.select(*KEYS, "depth", "val_bpb")


@query("first_per_group", oracle("""
select flops_budget,
       arg_min(val_bpb, exp_id * 100 + depth) filter (where val_bpb is not null) as val_bpb,
       arg_min(depth, exp_id * 100 + depth) as depth
from runs group by flops_budget""", "runs"))
def q_first_per_group(spark, sf_dir):
    d = load(spark, sf_dir).runs.withColumn("ord", F.col("exp_id") * 100 + F.col("depth"))
    return R.first_per_group(d, ["flops_budget"], "ord", ["val_bpb", "depth"])


@query("linear_fit", oracle("""
with t as (select model_id, 'x1' as task, x1 as x, core from model_scores
           union all select model_id, 'x2', x2, core from model_scores
           union all select model_id, 'x3', x3, core from model_scores),
g as (select task, regr_slope(core, x) as slope, regr_intercept(core, x) as intercept, regr_r2(core, x) as r2,
             count(*) as n from t group by task)
select *, row_number() over (order by r2 desc nulls last, task) as rank from g""", "model_scores"))
def q_linear_fit(spark, sf_dir):
    m = load(spark, sf_dir).model_scores
    t = m.select("model_id", "core", F.expr("stack(3, 'x1', x1, 'x2', x2, 'x3', x3) as (task, x)"))
    r = R.linear_fits(t, "task", "x", "core")
    return r.withColumn("rank", F.col("rank").cast("long"))


@query("linear_fit_by_family", oracle("""
select family, regr_slope(core, (x1 + x2 + x3) / 3) as slope, regr_intercept(core, (x1 + x2 + x3) / 3) as intercept,
       regr_r2(core, (x1 + x2 + x3) / 3) as r2, count(*) as n,
       row_number() over (order by regr_r2(core, (x1 + x2 + x3) / 3) desc nulls last, family) as rank
from model_scores group by family""", "model_scores"))
def q_linear_fit_by_family(spark, sf_dir):
    m = load(spark, sf_dir).model_scores.withColumn("xavg", (F.col("x1") + F.col("x2") + F.col("x3")) / 3)
    return R.linear_fits(m, "family", "xavg", "core").withColumn("rank", F.col("rank").cast("long"))


@query("head_to_head", oracle("""
with p as (select size_bucket, avg(case when family = 'BUILDING' then core end) as a,
                  avg(case when family = 'MACHINERY' then core end) as b
           from model_scores group by size_bucket)
select size_bucket, a as metric_a, b as metric_b, b - a as delta, 100 * (b - a) / a as improvement_pct
from p where a is not null and b is not null""", "model_scores"))
def q_head_to_head(spark, sf_dir):
    return R.head_to_head(load(spark, sf_dir).model_scores, "family", "BUILDING", "MACHINERY", "size_bucket", "core")


_X = ["x1", "x2", "x3"]


def _ridge_sql(rows: str, alphas) -> str:
    """CTEs ``sums`` and ``ridge`` over ``rows``: elimination of the penalised
    normal equations, one step per CTE, and back substitution."""
    f, k = ["1.0e0", *_X], len(_X) + 1
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    sums = ", ".join([*(f"sum({f[i]} * {f[j]}) as g{i}{j}" for i, j in upper),
                      *(f"sum({f[i]} * core) as b{i}" for i in range(k))])
    start = ", ".join([*(f"g{i}{j}" + (" + alpha" if i == j and i else "") + f" as m{i}{j}" for i, j in upper),
                       *(f"b{i} as c{i}" for i in range(k))])
    out = [f"sums as (select family, count(*) as n, sum(core * core) as yy, {sums} from {rows} group by family)",
           f"e0 as (select *, {start} from sums, (select unnest({alphas}) as alpha) a)"]
    for p in range(k - 1):
        new = [f"m{i}{j} - m{p}{i} * m{p}{j} / m{p}{p} as m{i}{j}" for i, j in upper if i > p]
        new += [f"c{i} - m{p}{i} * c{p} / m{p}{p} as c{i}" for i in range(p + 1, k)]
        out.append(f"e{p + 1} as (select * replace ({', '.join(new)}) from e{p})")
    last = f"e{k - 1}"
    for i in reversed(range(k)):
        known = "".join(f" - m{i}{j} * w{j}" for j in range(i + 1, k))
        out.append(f"s{i} as (select *, (c{i}{known}) / m{i}{i} as w{i} from {last})")
        last = f"s{i}"
    fit = " + ".join(f"w{i} * b{i}" for i in range(k))
    quad = " + ".join(f"{1 if i == j else 2} * w{i} * w{j} * g{i}{j}" for i, j in upper)
    norm = " + ".join(f"w{i} * w{i}" for i in range(1, k))
    weights = ", ".join(f"w{i + 1} as w_{x}" for i, x in enumerate(_X))
    out.append(f"ridge as (select family, alpha, w0 as intercept, {weights}, sqrt({norm}) as weight_norm, "
               f"1 - (yy - 2 * ({fit}) + {quad}) / (yy - b0 * b0 / n) as r2 from {last})")
    return ",\n".join(out)


@query("ridge_fit", oracle(f"""
with {_ridge_sql("model_scores", "[0.0e0, 0.01e0, 0.1e0, 1.0e0]")}
select * from ridge""", "model_scores"))
def q_ridge_fit(spark, sf_dir):
    m = load(spark, sf_dir).model_scores
    return ridge_fit(m, _X, "core", alphas=[0.0, 0.01, 0.1, 1.0], group_col="family")


@query("ensemble_predict", oracle(f"""
with cal as (select * from model_scores where family = 'BUILDING'),
{_ridge_sql("cal", "[0.1e0]")},
line as (select regr_slope(core, (x1 + x2 + x3) / 3) as s, regr_intercept(core, (x1 + x2 + x3) / 3) as i from cal),
est as (select model_id, m.family, size_bucket, s * (x1 + x2 + x3) / 3 + i as simple,
               intercept + w_x1 * x1 + w_x2 * x2 + w_x3 * x3 as ridge
        from model_scores m, line, ridge where m.family = 'MACHINERY')
select model_id, family, size_bucket, simple, ridge, (simple + ridge) / 2 as core, 'Estimated' as source from est
union all
select model_id, family, size_bucket, null, null, core, 'Measured' from cal""", "model_scores"))
def q_ensemble_predict(spark, sf_dir):
    m = load(spark, sf_dir).model_scores
    return ensemble_predict(m, _X, "core", family_col="family", calib="BUILDING",
                            target="MACHINERY", order_col="size_bucket", alpha=0.1)


_FINAL = """fin as (select run_id, arg_max(val_bpb, step) filter (where val_bpb is not null) as final_bpb
         from train_steps group by run_id)"""


def _final(spark, sf_dir):
    s = load(spark, sf_dir).train_steps
    return s.filter(F.col("val_bpb").isNotNull()).groupBy("run_id").agg(F.max_by("val_bpb", "step").alias("final_bpb"))


@query("metric_spread", oracle(f"""
with {_FINAL}
select avg(final_bpb) as mean, max(final_bpb) - min(final_bpb) as range, count(final_bpb) as runs from fin""",
                               "train_steps"))
def q_metric_spread(spark, sf_dir):
    return R.metric_spread(_final(spark, sf_dir), "final_bpb")


@query("record_improvement", oracle(f"""
with {_FINAL},
p as (select run_id, final_bpb, min(final_bpb) over (order by run_id rows between unbounded preceding and 1 preceding) as pb
      from fin)
select run_id, final_bpb, 100 * (pb - final_bpb) / pb as gain_pct from p where pb is null or final_bpb < pb""",
                                    "train_steps"))
def q_record_improvement(spark, sf_dir):
    r = R.record_improvement(_final(spark, sf_dir), "run_id", "final_bpb")
    return r.select("run_id", "final_bpb", "gain_pct")


@query("running_min_metric", oracle("""
select run_id, step, min(val_bpb) over (partition by run_id order by step rows between unbounded preceding and current row)
       as best_so_far
from train_steps""", "train_steps"))
def q_running_min_metric(spark, sf_dir):
    r = R.running_min(load(spark, sf_dir).train_steps)
    return r.select("run_id", F.col("step").cast("long").alias("step"), "best_so_far")


_EMA_SQL = """
with recursive e(run_id, step, s) as (
  select run_id, step, 0.1e0 * loss from train_steps where step = 0
  union all
  select t.run_id, t.step, 0.9e0 * e.s + 0.1e0 * t.loss from e join train_steps t on t.run_id = e.run_id and t.step = e.step + 1)
select run_id, step, s / (1 - power(0.9e0, step + 1 + {off})) as smooth_loss from e"""


@query("ema_debiased", oracle(_EMA_SQL.format(off=0), "train_steps"))
def q_ema_debiased(spark, sf_dir):
    e = R.ema_debiased(load(spark, sf_dir).train_steps, block=16)
    return e.select("run_id", F.col("step").cast("long").alias("step"), "smooth_loss")


@query("ema_debiased_sft", oracle(_EMA_SQL.format(off=1), "train_steps"))
def q_ema_debiased_sft(spark, sf_dir):
    e = R.ema_debiased(load(spark, sf_dir).train_steps, offset=1, block=16)
    return e.select("run_id", F.col("step").cast("long").alias("step"), "smooth_loss")


_CLOCK = dict(num_iterations=200, batch_tokens=524288, flops_per_token=3.0e9, peak_flops=989e12)


@query("training_clock", oracle("""
select run_id, step,
  sum(case when step > 10 then dt else 0.0e0 end) over (partition by run_id order by step rows between unbounded preceding and current row) as total_time,
  case when step - 10 > 0 then (200 - step) * sum(case when step > 10 then dt else 0.0e0 end)
       over (partition by run_id order by step rows between unbounded preceding and current row) / (step - 10) end as eta_s,
  cast(floor(524288 / dt) as bigint) as tok_per_sec,
  100.0e0 * (3.0e9 * 524288) / dt / 989e12 as mfu
from train_steps""", "train_steps"))
def q_training_clock(spark, sf_dir):
    c = R.training_clock(load(spark, sf_dir).train_steps, **_CLOCK)
    return c.select("run_id", F.col("step").cast("long").alias("step"), "total_time", "eta_s", "tok_per_sec", "mfu")


@query("time_to_target", oracle("""
with e as (select *, sum(dt) over (partition by run_id order by step rows between unbounded preceding and current row) as elapsed
           from train_steps)
select run_id, min(step) as step, arg_min(elapsed, step) as elapsed from e where val_bpb < 0.05e0 group by run_id""",
                                "train_steps"))
def q_time_to_target(spark, sf_dir):
    t = R.time_to_target(load(spark, sf_dir).train_steps, 0.05)
    return t.select("run_id", F.col("step").cast("long").alias("step"), "elapsed")


_KV = """kv as (select stage, key, arg_max(trim(split_part(line, ':', 2)), line_no) as value
       from (select stage, line_no, line, unnest(list_filter(['CORE', 'GSM8K'], lambda k: contains(line, k))) as key
             from report_lines) t group by stage, key)"""


@query("scrape_report_kv", oracle(f"""
with {_KV} select stage, key, value from kv""", "report_lines"))
def q_scrape_report_kv(spark, sf_dir):
    return R.scrape_report_kv(load(spark, sf_dir).report_lines, ["CORE", "GSM8K"])


@query("metric_pivot", oracle(f"""
with {_KV}
select key as metric, coalesce(max(case when stage = 'base' then value end), '-') as base,
       coalesce(max(case when stage = 'sft' then value end), '-') as sft,
       coalesce(max(case when stage = 'rl' then value end), '-') as rl,
       case when key = 'CORE' then '0' when key = 'ChatCORE' then '2' else '1' end || key as sort_key
from kv group by key""", "report_lines"))
def q_metric_pivot(spark, sf_dir):
    kv = R.scrape_report_kv(load(spark, sf_dir).report_lines, ["CORE", "GSM8K"])
    return R.metric_pivot(kv)


@query("report_timestamps", oracle("""
select stage, cast(arg_min(ts, line_no) as varchar) as ts from (
  select stage, line_no, try_strptime(trim(substr(line, strpos(line, ':') + 1)), '%Y-%m-%d %H:%M:%S') as ts
  from report_lines where starts_with(line, 'timestamp:')) t
where ts is not null group by stage""", "report_lines"))
def q_report_timestamps(spark, sf_dir):
    t = R.report_timestamps(load(spark, sf_dir).report_lines)
    return t.select("stage", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query("run_duration", oracle("""
with t as (select stage, arg_min(ts, line_no) as ts from (
  select stage, line_no, try_strptime(trim(substr(line, strpos(line, ':') + 1)), '%Y-%m-%d %H:%M:%S') as ts
  from report_lines where starts_with(line, 'timestamp:')) x where ts is not null group by stage),
se as (select (select ts from t where stage = 'base') as st, (select ts from t where stage = 'sft') as en)
select strftime(st, '%Y-%m-%d %H:%M:%S') as start, strftime(en, '%Y-%m-%d %H:%M:%S') as "end",
  case when st is not null and en is not null then
    cast(cast(floor(date_diff('second', st, en) / 3600) as bigint) as varchar) || 'h' ||
    cast(cast(floor((date_diff('second', st, en) % 3600) / 60) as bigint) as varchar) || 'm' else 'unknown' end as duration
from se""", "report_lines"))
def q_run_duration(spark, sf_dir):
    ts = R.report_timestamps(load(spark, sf_dir).report_lines)
    return R.run_duration(ts, ["base", "sft", "rl"], present=load(spark, sf_dir).report_lines)


@query("scrape_run_logs", oracle("""
with m as (select file_no, line_no, line, unnest(list_filter(
             [{'k': 'wte', 'm': 'wte '}, {'k': 'bi', 'm': 'bigram_embed '}, {'k': 've', 'm': 'value_embeds '}, {'k': 'tm', 'm': 'transformer_matrices '},
              {'k': 'sc', 'm': 'scalars '}, {'k': 'tot', 'm': 'total '}, {'k': 'lm', 'm': 'lm_head '}, {'k': 'bpb', 'm': 'Validation bpb:'},
              {'k': 'iters', 'm': 'Calculated number of iterations'}, {'k': 'core', 'm': 'CORE metric:'}],
             lambda s: contains(line, s.m))) as s from run_logs),
l as (select file_no,
        arg_max(line, line_no) filter (where s.k = 'wte') as wte, arg_max(line, line_no) filter (where s.k = 'bi') as bi,
        arg_max(line, line_no) filter (where s.k = 've') as ve, arg_max(line, line_no) filter (where s.k = 'tm') as tm,
        arg_max(line, line_no) filter (where s.k = 'sc') as sc, arg_max(line, line_no) filter (where s.k = 'tot') as tot,
        arg_max(line, line_no) filter (where s.k = 'lm') as lm, arg_max(line, line_no) filter (where s.k = 'bpb') as bpb,
        arg_max(line, line_no) filter (where s.k = 'iters') as iters, arg_max(line, line_no) filter (where s.k = 'core') as core
      from m group by file_no),
f as (select distinct file_no from run_logs),
v as (select f.file_no,
        cast(replace(regexp_extract(wte, ': ([0-9,]+)', 1), ',', '') as bigint) as params_wte,
        cast(replace(regexp_extract(bi, ': ([0-9,]+)', 1), ',', '') as bigint) as params_bigram_embed,
        cast(replace(regexp_extract(ve, ': ([0-9,]+)', 1), ',', '') as bigint) as params_value_embeds,
        cast(replace(regexp_extract(lm, ': ([0-9,]+)', 1), ',', '') as bigint) as params_lm_head,
        cast(replace(regexp_extract(tm, ': ([0-9,]+)', 1), ',', '') as bigint) as params_transformer_matrices,
        cast(replace(regexp_extract(sc, ': ([0-9,]+)', 1), ',', '') as bigint) as params_scalars,
        cast(replace(regexp_extract(tot, ': ([0-9,]+)', 1), ',', '') as bigint) as params_total,
        cast(replace(regexp_extract(iters, '^.*: (.*)$', 1), ',', '') as bigint) as num_iters,
        cast(regexp_extract(bpb, '([0-9.]+)$', 1) as double) as val_bpb,
        cast(coalesce(string_split(trim(core), ' ')[-1], '0.0') as double) as core
      from f left join l on l.file_no = f.file_no)
select *, num_iters * 524288 as tokens_trained, round(num_iters * 524288 / params_lm_head, 2) as param_data_ratio from v""",
                                 "run_logs"))
def q_scrape_run_logs(spark, sf_dir):
    return R.scrape_run_logs(load(spark, sf_dir).run_logs)


@query("match_first_rule", oracle("""
select p_partkey, coalesce((select arg_min(value, rule_no) from rules
                            where contains(lower(p_name), pattern_a) and (pattern_b = '' or contains(lower(p_name), pattern_b))),
                           'inf'::double) as matched
from part""", "rules"))
def q_match_first_rule(spark, sf_dir):
    cat = load(spark, sf_dir)
    m = R.match_first_rule(cat.part, cat.rules, "p_name", ["pattern_a", "pattern_b"])
    return m.select("p_partkey", "matched")


@query("append_missing", oracle("""
select c_custkey as exp_id, d.depth from customer cross join (select 8 as depth union all select 10 union all select 12
  union all select 14 union all select 16 union all select 18 union all select 20 union all select 22) d
where not exists (select 1 from runs r where r.exp_id = c_custkey and r.depth = d.depth and r.flops_budget = 1e18
                  and r.val_bpb is not null)""", "runs"))
def q_append_missing(spark, sf_dir):
    cat = load(spark, sf_dir)
    depths = F.array(*[F.lit(d) for d in (8, 10, 12, 14, 16, 18, 20, 22)])
    todo = cat.customer.select(F.col("c_custkey").alias("exp_id"), F.explode(depths).alias("depth"))
    done = cat.runs.filter((F.col("flops_budget") == 1e18) & F.col("val_bpb").isNotNull())
    return append_missing(todo, done, ["exp_id", "depth"]).select("exp_id", "depth")
