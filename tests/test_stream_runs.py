"""Run metrics of a stream: gaps, resumed runs, late steps."""

import time

import pytest

from tokenmill.operators.runs import ema_debiased
from tokenmill.streaming import jobs as S

SCHEMA = "run_id long, step long, loss double, dt double, val_bpb double, rows long"


def _row(run, step):
    return (run, step, 1.0 + step % 7, 0.5, 3.0 - step / 1000 if step % 3 == 0 else None, None)


def _model(steps, s=0.0, best=None, total=0.0):
    out = []
    for _, step, loss, dt, val, _ in sorted(steps, key=lambda r: r[1]):
        s = 0.9 * s + (1 - 0.9) * loss
        if val is not None:
            best = val if best is None else min(best, val)
        total += dt if step > 10 else 0.0
        out.append((step, s / (1 - 0.9 ** (step + 1)), best, total))
    return out


def _run(spark, files, **kw):
    src, out, ck = S._paths(spark, "runs_test")
    for f in files:
        spark.createDataFrame(f, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)                                  # files are read in the order of their times
    got = S.run_metrics(spark, src, out, ck, **kw).collect()
    taken, late = {}, set()
    for r in got:
        if r.late:
            late.add((r.run_id, r.step))
        else:
            taken.setdefault(r.run_id, []).append((r.step, r.smooth_loss, r.best_so_far, r.total_time))
    return {k: sorted(v) for k, v in taken.items()}, late, len(got)


def _same(got, want):
    assert [g[0] for g in got] == [w[0] for w in want]
    for g, w in zip(got, want):
        assert g[1:] == pytest.approx(w[1:])


def test_gaps_and_resumed_runs_give_every_row(spark):
    whole = [_row(0, i) for i in range(30)]
    resumed = [_row(1, i) for i in range(500, 520)]
    gap = [_row(2, i) for i in range(20) if i not in (0, 7, 8)]
    ends = [(r, None, None, None, None, len(x)) for r, x in ((0, whole), (1, resumed), (2, gap))]
    first = whole[1::2] + resumed[10:] + gap[::2] + ends[:2]
    second = whole[::2] + resumed[:10] + gap[1::2] + ends[2:] + whole[3:5]
    taken, late, n = _run(spark, [first, second])
    for run, rows in ((0, whole), (1, resumed), (2, gap)):
        _same(taken[run], _model(rows))
    assert not late and n == len(whole) + len(resumed) + len(gap)
    batch = ema_debiased(spark.createDataFrame(whole + resumed + gap, SCHEMA), block=8)
    for run in taken:
        want = {r.step: r.smooth_loss for r in batch.filter(f"run_id = {run}").collect()}
        assert {g[0]: g[1] for g in taken[run]} == pytest.approx(want)


def test_late_steps_are_reported_once_and_replays_are_not(spark):
    far = [_row(0, i) for i in range(40) if i not in (5, 6)]
    taken, late, n = _run(spark, [far, [_row(0, 5), _row(0, 3)], [_row(0, 5), _row(0, 6)]], reorder=16)
    _same(taken[0], _model(far))
    assert late == {(0, 5), (0, 6)} and n == len(far) + 2


def test_steps_wait_within_the_reordering_bound(spark):
    taken, late, n = _run(spark, [[_row(0, i) for i in range(10) if i != 5]], reorder=16)
    assert [t[0] for t in taken[0]] == [0, 1, 2, 3, 4] and n == 5 and not late


def test_a_resumed_run_goes_on_from_its_checkpoint(spark):
    rows = [_row(7, i) for i in range(40)]
    initial = spark.createDataFrame([(7, 20, 2.5, 2.9, 4.5)],
                                    "run_id long, next_step long, smooth double, best double, total_time double")
    taken, late, _ = _run(spark, [rows[20:]], initial=initial)
    _same(taken[7], _model(rows[20:], 2.5, 2.9, 4.5))
