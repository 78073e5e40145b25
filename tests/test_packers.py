"""Packers against their stated rules."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tokenmill.operators import packers as P


def follow_rule(lengths, cap, batch, buffer_size, crop):
    """Placements (doc, row, offset, source, taken) by the stated rule, for
    any row length: of the documents that have arrived, the longest that fits
    (the earliest of equals) is placed; if none fits, a crop packer cuts the
    shortest to the room left and a padding packer closes the row. Documents
    arrive ``batch`` at a time whenever fewer than ``buffer_size`` wait. Rows
    are returned whole or not."""
    arrivals = iter(range(0, len(lengths), batch))
    waiting, rows = set(), [[]]
    free = cap
    while True:
        while len(waiting) < buffer_size and (first := next(arrivals, None)) is not None:
            waiting.update(range(first, min(first + batch, len(lengths))))
        if not waiting:
            break
        order = sorted(waiting, key=lambda d: (lengths[d] > free, -lengths[d] if lengths[d] <= free else lengths[d], d))
        doc = order[0]
        if lengths[doc] > free and not crop:
            rows.append([])
            free = cap
            continue
        take = min(lengths[doc], free)
        rows[-1].append((doc, len(rows) - 1, cap - free, 0, take))
        waiting.remove(doc)
        free -= take
        if free == 0:
            rows.append([])
            free = cap
    kept = rows[:-1] if crop else rows
    return [x for row in kept for x in row]


def as_tuples(res):
    return list(zip(*[list(map(int, a)) for a in res]))


lengths_st = st.lists(st.integers(min_value=1, max_value=40), min_size=0, max_size=120)


@settings(max_examples=200, deadline=None)
@given(lengths_st, st.integers(min_value=5, max_value=50), st.integers(min_value=1, max_value=20),
       st.integers(min_value=1, max_value=8))
def test_bestfit_crop_follows_the_rule(lengths, cap, buffer_size, refill):
    assert as_tuples(P.bestfit_crop(lengths, cap, buffer_size, refill)) == \
        follow_rule(lengths, cap, refill, buffer_size, crop=True)


@settings(max_examples=200, deadline=None)
@given(lengths_st, st.integers(min_value=5, max_value=50), st.integers(min_value=1, max_value=20))
def test_bestfit_pad_follows_the_rule(lengths, cap, buffer_size):
    cut = [min(x, cap) for x in lengths]
    assert as_tuples(P.bestfit_pad(lengths, cap, buffer_size)) == follow_rule(cut, cap, 1, buffer_size, crop=False)


@settings(max_examples=200, deadline=None)
@given(lengths_st, st.integers(min_value=5, max_value=50))
def test_packer_invariants(lengths, cap):
    for name, fn in P.PACKERS.items():
        d, r, dst, src, take = fn(lengths, cap)
        rows = {}
        for di, ri, o, s, t in zip(d, r, dst, src, take):
            assert 0 < t <= lengths[di]
            assert s == 0
            rows.setdefault(int(ri), []).append((int(o), int(t)))
        for ri, segs in rows.items():
            segs.sort()
            pos = 0
            for o, t in segs:
                assert o == pos            # no gaps, no overlaps
                pos += t
            assert pos <= cap
            if name in P.CROPPING:
                assert pos == cap          # crop packers fill every row
        if rows:
            assert sorted(rows) == list(range(len(rows)))
        if name in ("greedy_pad", "ffd", "bestfit_pad"):
            # nothing is lost except the part of a doc longer than a row
            assert sum(int(t) for t in take) == sum(min(x, cap) for x in lengths)
        assert len(set(map(int, d))) == len(d)  # a doc is placed at most once


def test_ffd_is_first_fit_decreasing():
    lengths = [5, 9, 3, 7, 2, 8, 1]
    d, r, dst, src, take = P.first_fit_decreasing(lengths, 10)
    rows = {}
    for di, ri in zip(d, r):
        rows.setdefault(int(ri), []).append(lengths[di])
    # 9+1, 8+2, 7+3, 5
    assert sorted(sorted(v) for v in rows.values()) == [[1, 9], [2, 8], [3, 7], [5]]


def test_greedy_crop_last_row_dropped():
    d, r, dst, src, take = P.greedy_crop([4, 4, 4], 10)
    assert list(map(int, take)) == [4, 4, 2]
    assert set(map(int, r)) == {0}


def test_random_large_group_speed():
    rnd = random.Random(7)
    lengths = [rnd.randint(1, 5000) for _ in range(20000)]
    d, *_ = P.bestfit_crop(lengths, 2049)
    assert len(d) > 0
