"""Moving averages through levels of blocks, interpolation by grouped lookup."""

import numpy as np
import pytest

from tokenmill.operators import runs as R


@pytest.mark.parametrize("fan,block", [(2, 4), (3, 5), (256, 256)])
def test_ema_through_levels_equals_the_loop(spark, monkeypatch, fan, block):
    monkeypatch.setattr(R, "FAN", fan)
    rng = np.random.default_rng(7)
    rows = [(r, s, float(x)) for r, n in ((1, 300), (2, 1), (3, 17)) for s, x in enumerate(rng.normal(size=n), 3 * r)]
    df = spark.createDataFrame(rows, "run_id long, step long, loss double").repartition(5)
    got = {(r.run_id, r.step): r.smooth_loss for r in R.ema_debiased(df, block=block).collect()}
    want = {}
    for run in (1, 2, 3):
        s = 0.0
        for _, step, x in sorted(r for r in rows if r[0] == run):
            s = 0.9 * s + 0.1 * x
            want[run, step] = s / (1 - 0.9 ** (step + 1))
    assert got == pytest.approx(want, abs=1e-12)


def test_ema_of_no_steps(spark):
    assert R.ema_debiased(spark.createDataFrame([], "run_id long, step long, loss double")).count() == 0


def test_interpolation_equals_numpy(spark):
    rng = np.random.default_rng(3)
    points, at = [], []
    for k in range(40):
        xs = np.sort(rng.choice(1000, size=1 + k % 9, replace=False)).astype(float)
        ys = rng.normal(size=len(xs))
        points += [(k, float(x), float(y), -float(y)) for x, y in zip(xs, ys)]
        at.append((k, float(xs[k % len(xs)] if k % 3 == 0 else rng.uniform(-50, 1050))))
    at += [(99, 5.0), (0 + 100, None)]
    points += [(100, 1.0, 2.0, 3.0), (3, None, 1.0, 1.0)]
    got = {r.k: (r.u, r.v) for r in R.interpolate_at(
        spark.createDataFrame(points, "k long, x double, y double, z double"),
        spark.createDataFrame(at, "k long, q double"), ["k"], "x", {"u": "y", "v": "z"}, "q").collect()}
    for k, q in at[:40]:
        mine = sorted((p for p in points if p[0] == k and p[1] is not None), key=lambda p: p[1])
        u = np.interp(q, [p[1] for p in mine], [p[2] for p in mine])
        assert got[k] == pytest.approx((u, -u))
    assert got[99] == (None, None) and got[100] == (None, None)


def test_interpolation_shuffles_the_points_once(spark):
    runs = spark.createDataFrame([(1, 1.0, 2.0)], "k long, x double, y double").repartition(3)
    at = runs.groupBy("k").agg({"x": "avg"}).withColumnRenamed("avg(x)", "q")
    plan = R.interpolate_at(runs, at, ["k"], "x", {"u": "y"}, "q")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Union" not in plan


def test_sweeps_are_not_broadcast(spark, tmp_path):
    """Files don't tell how many sweeps the runs have: nothing of one row a key
    may go to the driver, whatever the estimate."""
    from tokenmill.plans.registry import load_all
    spark.range(3).selectExpr("id + 1 as c_custkey").write.parquet(str(tmp_path / "customer.parquet"))
    for name in ("bracket_interpolate", "power_law_fit", "ratio_summary"):
        df = load_all()[0][name](spark, str(tmp_path))
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString(), name
        assert df.count() > 0


def test_runs_are_made_by_many_tasks(spark, tmp_path, monkeypatch):
    """One small file of sweeps gives many runs, not all in one task."""
    from tokenmill.plans import catalog
    monkeypatch.setattr(catalog, "_DEALT", {"runs": ("customer", "c_custkey", 10)})
    spark.range(100).selectExpr("id + 1 as c_custkey").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    runs = catalog.load(spark, str(tmp_path)).runs
    assert runs.rdd.getNumPartitions() == 10 and runs.count() == 100 * 4 * 7
