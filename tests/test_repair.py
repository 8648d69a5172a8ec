"""Repairs in their order, and windows that widen."""

import math

import pytest

from uvspark.operators import repair

ROWS = "antenna int, spw int, hand int, field int, t double, id int, value double, flag boolean"
DECISIONS = "antenna int, spw int, hand int, source_hand int, scale double, window double, combine_fields boolean, exponent double"


def repaired(spark, rows, decisions=()):
    out = repair.repair(spark.createDataFrame(rows, ROWS), spark.createDataFrame(list(decisions), DECISIONS)).collect()
    return {r.id: (None if r.value is None else round(r.value, 6), r.flag, r.changed) for r in out}


def series(hand, values, flags=(), first=0, field=0, step=60.0):
    return [(0, 0, hand, field, i * step, first + i, float(v), i in flags) for i, v in enumerate(values)]


def test_a_noisy_hand_takes_the_other_one_scaled_then_smoothed(spark):
    """Hand 1 follows hand 0 (times their medians' ratio); its flagged value comes back; the unphysical value of hand 0 has no say."""
    steady = [10, 11, 12, 1, 14, 15, 16]
    noisy = [40, 2, 60, 50, 44, 90, 52]
    got = repaired(spark, series(0, steady) + series(1, noisy, flags={2}, first=100), [(0, 0, 0, None, None, 0.0, True, 1.0), (0, 0, 1, 0, None, 0.0, True, 1.0)])
    assert got[3] == (1.0, True, False) and got[0] == (10.0, False, False)
    # Good in both: 10, 14, 15, 16 against 40, 44, 90, 52 (2 is unphysical, 60 flagged, 1 unphysical).
    ratio = 48.0 / 14.5
    assert got[100] == (round(10 * ratio, 6), False, True) and got[102] == (round(12 * ratio, 6), False, True)
    assert got[103] == (50.0, False, False) and got[101][:2] == (round(11 * ratio, 6), False)


def test_scale_comes_before_smoothing_and_fields_apart(spark):
    rows = series(0, [10, 10, 10, 10], field=0, step=120.0) + [(0, 0, 0, 1, 60.0 + 120 * i, 10 + i, 30.0, False) for i in range(4)]
    apart = repaired(spark, rows, [(0, 0, 0, None, 2.0, 600.0, False, 1.0)])
    assert {v[0] for k, v in apart.items() if k < 10} == {20.0} and {v[0] for k, v in apart.items() if k >= 10} == {60.0}
    together = repaired(spark, rows, [(0, 0, 0, None, 2.0, 600.0, True, 1.0)])
    assert {v[0] for v in together.values()} != {20.0, 60.0}


def test_spikes_and_opacity(spark):
    values = [20, 21, 19, 20, 500, 20, 21, 19, 20, 21]
    got = repaired(spark, series(0, values, step=1000.0), [(0, 0, 0, None, None, 0.0, True, 1.0)])
    assert got[4][0] < 25 and got[0] == (20.0, False, False)
    slow = [10.0] * 6 + [40.0] * 5
    got = repaired(spark, series(0, slow, step=1000.0), [(0, 0, 0, None, None, 0.0, True, 2.0)])
    # Level 10: the factor is slow / level, at most 3.
    assert got[0][0] == 10.0 and got[10][0] == 120.0


def test_series_without_decisions_nulls_and_nothing(spark):
    rows = [(0, 0, 0, 0, 0.0, 1, None, False), (0, 0, 0, 0, 60.0, 2, 5.0, True), (1, 0, 0, 0, 0.0, 3, 7.0, False)]
    got = repaired(spark, rows)
    assert got[1][0] is None and got[2] == (5.0, True, False) and got[3] == (7.0, False, False)
    assert repaired(spark, []) == {}


@pytest.mark.parametrize("half,least", [(0.0, 1), (0.0, 3), (5.0, 3), (2.0, 4), (100.0, 2), (0.0, 30)])
def test_reach_holds_enough(spark, half, least):
    import random

    rng = random.Random(least)
    rows = [(k, i, float(rng.randint(0, 60)), None if rng.random() < 0.2 else float(rng.randint(0, 9))) for k in range(2) for i in range(k * 100, k * 100 + 25)]
    got = {r.id: (r.reach, r.n_used, r.mean) for r in repair.mean_of_enough(spark.createDataFrame(rows, "k int, id int, t double, x double"), ["k"], "t", "id", "x", half, least).collect()}
    for k, i, t, x in rows:
        good = sorted((abs(u - t), v) for q, _, u, v in rows if q == k and v is not None)
        if x is None or len(good) < least:
            assert got[i] == (None, None, None)
            continue
        reach = max(half, good[least - 1][0])
        inside = [v for d, v in good if d <= reach]
        assert got[i][0] == reach and got[i][1] == len(inside) and math.isclose(got[i][2], sum(inside) / len(inside))


def test_windows_follow_the_spacing(spark):
    rows = [(0, i, 100.0 * i, float(i)) for i in range(9)] + [(1, 100 + i, 1.0 * i, float(i)) for i in range(9)]
    got = {r.id: (r.width, r.smoothed) for r in repair.smooth_widened(spark.createDataFrame(rows, "k int, id int, t double, x double"), ["k"], "t", "x", 10.0, 4).collect()}
    assert got[4] == (500.0, 4.0) and got[0] == (500.0, 0.0) and got[104] == (10.0, 4.0) and got[100] == (10.0, 2.5)
