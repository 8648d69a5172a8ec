"""Planted truth for the solvers."""

import numpy as np
import pandas as pd

from uvspark.operators import fringefit, solve


def pairs(n):
    return np.array([(i, j) for i in range(n) for j in range(i + 1, n)]).T


def test_antenna_terms_survive_a_bad_baseline():
    rng = np.random.default_rng(1)
    truth = rng.normal(0, 0.3, 6)
    a, b = pairs(6)
    value = truth[a] + truth[b] + rng.normal(0, 0.01, len(a))
    value[3] += 1.0
    g, err, chi2 = solve.antenna_terms(value, np.full(len(a), 1e4), a, b, 7)
    assert np.abs(g[:6] - truth).max() < 0.03 and np.isnan(g[6]) and chi2 < 5


def test_gains_recovered_up_to_a_phase():
    rng = np.random.default_rng(2)
    g = rng.uniform(0.5, 2, 6) * np.exp(1j * rng.uniform(-3, 3, 6))
    w = np.full((6, 6), 10.0)
    np.fill_diagonal(w, 0)
    cross = w * np.outer(g, g.conj())
    noise = rng.normal(0, 0.05, (6, 6)) + 1j * rng.normal(0, 0.05, (6, 6))
    got, flagged = solve.antenna_gains(cross + np.triu(noise, 1) + np.triu(noise, 1).conj().T, w)
    got = solve.reference_gains(got, flagged, [0])
    want = g * np.conj(g[0]) / abs(g[0])
    assert not flagged.any() and np.abs(got - want).max() < 0.05


def test_gains_flag_an_antenna_with_too_few_baselines():
    w = np.ones((5, 5)) - np.eye(5)
    w[4, 1:] = w[1:, 4] = 0
    got, flagged = solve.antenna_gains(w.astype(complex), w, least=3)
    assert flagged.tolist() == [False] * 4 + [True] and np.isnan(got[4])
    assert solve.connected_groups(w * (np.arange(5)[:, None] < 4) * (np.arange(5) < 4)).tolist() == [0, 0, 0, 0, 4]


def test_gains_of_two_groups_without_a_common_baseline():
    w = np.zeros((9, 9))
    w[:5, :5] = w[5:, 5:] = 1
    np.fill_diagonal(w, 0)
    truth = np.array([2.0] * 5 + [1.0] * 4)
    got, flagged = solve.antenna_gains((w * np.outer(truth, truth)).astype(complex), w, least=3)
    assert not flagged.any() and np.allclose(np.abs(got), truth, atol=1e-6)


def test_terms_take_a_clipped_baseline_back():
    """Every round judges all baselines; a prior keeps an antenna of one noisy baseline near 0."""
    rng = np.random.default_rng(5)
    a, b = pairs(6)
    truth = rng.normal(0, 0.3, 6)
    value = truth[a] + truth[b] + rng.normal(0, 0.01, len(a))
    value[[0, 7]] += [3.0, 0.05]
    g, _, _ = solve.antenna_terms(value, np.full(len(a), 1e4), a, b, 6)
    assert np.abs(g - truth).max() < 0.05
    held, _, _ = solve.antenna_terms(np.append(value[:3], 9.0), np.append(np.full(3, 1e4), 1e-4), np.append(a[:3], 4), np.append(b[:3], 5), 6, prior=1.0)
    assert abs(held[5]) < 0.1


def test_fringe_peak():
    rng = np.random.default_rng(3)
    t, f = np.arange(40) * 2.0, np.arange(32) * 1e6
    delay, rate = 83e-9, 0.013
    vis = np.exp(2j * np.pi * (rate * t[:, None] + delay * f) + 0.4j) + rng.normal(0, 0.5, (40, 32)) + 1j * rng.normal(0, 0.5, (40, 32))
    d, r, p, snr = solve.fringe_peak(vis, np.ones(vis.shape), 2.0, 1e6)
    assert abs(d - delay) < 2e-9 and abs(r - rate) < 5e-4 and abs(p - 0.4) < 0.15 and snr > 20


def test_fringe_global():
    truth = np.array([0.0, 3.0, -2.0, 5.0])
    a, b = pairs(4)
    x = solve.fringe_global(truth[a] - truth[b], np.ones(len(a)), a, b, 5, 0)
    assert np.allclose(x[:4], truth) and np.isnan(x[4])


def test_crop_finds_spikes_on_a_sloped_band():
    rng = np.random.default_rng(4)
    plane = (1 + 0.3 * np.linspace(-1, 1, 64) ** 2)[None, :] * np.ones((50, 1)) + rng.normal(0, 0.02, (50, 64))
    plane[10, 20] += 3
    plane[30, 40:43] += 2
    flags = solve.crop_plane(plane, np.zeros(plane.shape, bool))
    assert flags[10, 20] and flags[30, 40:43].all() and flags.mean() < 0.03


def test_on_source_fraction():
    g = np.array([1, 1, 0.4, 1, 1.0])
    use = ~np.eye(5, dtype=bool)
    got = solve.on_source_fraction(np.outer(g, g), use)
    assert np.abs(got - g).max() < 0.06


def test_jitter():
    rng = np.random.default_rng(5)
    m2 = np.full(20000, 4.0)
    base = np.full(20000, 0.5)
    r2 = rng.exponential(base + 0.3**2 * m2)
    assert abs(solve.fit_jitter(r2, base, m2) - 0.3) < 0.03


def test_cover_plan():
    rows = [(1, 1, a, "r", 20.0) for a in "ABC"] + [(2, 1, a, "r", 15.0) for a in "CD"] + [(3, 1, a, "r", 2.0) for a in "DE"] + [(4, 1, a, "r", 9.0) for a in "EF"]
    stages = solve.cover_plan(pd.DataFrame(rows, columns=["scan", "source_rank", "antenna", "hand", "snr"]), {"A": 0}, 7.0)
    assert [s["scan"] for s in stages] == [1, 2, 4] and stages[1]["reference"] == "C"
    assert stages[0]["reference"] == "A" and {a for s in stages for a, _ in s["gained"]} == set("ABCDEF")


def planted_rows(spark, intervals, broken=None, noise=0.3, seed=3):
    """Five antennas, 8 channels of 1 MHz, 16 integrations of 2 s per interval; in the broken (interval, antenna) a false fringe outshines the true one."""
    rng = np.random.default_rng(seed)
    delay, rate = np.array([0, 40, -60, 25, 80]) * 1e-9, np.array([0, 2, -3, 1, 4]) * 1e-3
    f, rows = np.arange(8) * 1e6, []
    for k in range(intervals):
        for t in k * 100 + np.arange(16) * 2.0:
            for a, b in pairs(5).T:
                z = np.exp(2j * np.pi * ((delay[a] - delay[b]) * f + (rate[a] - rate[b]) * t))
                if broken and broken[0] == k and broken[1] in (a, b):
                    sign = 1 if a == broken[1] else -1
                    z = 0.3 * z + np.exp(sign * 2j * np.pi * (300e-9 * f + 0.09 * t))
                z = z + noise * (rng.normal(size=8) + 1j * rng.normal(size=8))
                rows.append((1, float(t), int(a), int(b), z.real.tolist(), z.imag.tolist(), 1.0, [False] * 8))
    rows += [(1, 0.0, 0, 0, [9.0] * 8, [0.0] * 8, 1.0, [False] * 8), (1, 2.0, 0, 1, [float("nan")] * 8, [0.0] * 8, 1.0, [False] * 8), (None, 0.0, 0, 1, [1.0] * 8, [0.0] * 8, 1.0, [True] * 8)]
    return spark.createDataFrame(rows, "scan int, time double, antenna1 int, antenna2 int, re array<double>, im array<double>, weight double, flag array<boolean>"), delay, rate


def test_fringefit_finds_planted_delays(spark):
    df, delay, rate = planted_rows(spark, 2)
    got = fringefit.fringefit(df, ["scan"], 6, [2, 0], 1e6, 100.0, 8).toPandas()
    assert len(got) == 10 and (got.reference == 2).all() and not got.flag.any() and set(got.scan) == {1}
    # Least errors of phases of 0.3 rad in 128 cells, fitted over five antennas' baselines; within four of them.
    share = 0.3 / (2 * np.pi * np.sqrt(128)) * np.sqrt(2 / 5)
    spread_f, spread_t = np.std(np.arange(8) * 1e6), np.std(np.arange(16) * 2.0)
    assert np.abs(got.delay - (delay[got.antenna] - delay[2])).max() < 4 * share / spread_f and np.abs(got.rate - (rate[got.antenna] - rate[2])).max() < 4 * share / spread_t
    # Phases are those of the middle of the band at the mid-time.
    want = 2 * np.pi * ((delay[got.antenna] - delay[2]) * 3.5e6 + (rate[got.antenna] - rate[2]) * got.time)
    assert np.abs(np.angle(np.exp(1j * (got.phase - want)))).max() < 0.1
    assert fringefit.fringefit(df, ["scan"], 6, [5], 1e6, 100.0, 8).count() == 0
    assert fringefit.fringefit(df.limit(0), ["scan"], 6, [0], 1e6, 100.0, 8).count() == 0
    assert set(fringefit.fringefit(df, ["scan"], 6, [0], 1e6, None, 8).toPandas().interval) == {0}


def test_fringefit_searches_again_about_predictions(spark):
    df, delay, rate = planted_rows(spark, 5, broken=(4, 3))
    wide = (10e-9, 2e-3)
    first = fringefit.fringefit(df, ["scan"], 5, [0], 1e6, 100.0, 8).toPandas().set_index(["interval", "antenna"])
    assert abs(first.delay[4, 3] - delay[3]) > 50e-9
    got = fringefit.fringefit_around(df, ["scan"], ["scan"], 5, [0], 1e6, 100.0, 8, window=wide).toPandas().set_index(["interval", "antenna"])
    assert abs(got.delay[4, 3] - delay[3]) < 15e-9 and abs(got.rate[4, 3] - rate[3]) < 3e-3 and got.from_prior[4, 3]
    assert len(got) == 25 and not got.sort_index().loc[:3].from_prior.any()  # rows come in no order; intervals before the broken one
