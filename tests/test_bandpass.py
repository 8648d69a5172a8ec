"""Gain solves of many channels: modes, groups and their chi-squared."""

import numpy as np

from uvspark.operators import bandpass


def made(n, channels, seed, noise=0.0):
    rng = np.random.default_rng(seed)
    g = rng.uniform(0.5, 2, (channels, n)) * np.exp(1j * rng.uniform(-3, 3, (channels, n)))
    w = np.full((channels, n, n), 10.0)
    w[:, np.arange(n), np.arange(n)] = 0
    e = rng.normal(0, noise, w.shape) + 1j * rng.normal(0, noise, w.shape)
    e = np.triu(e, 1) + np.triu(e, 1).conj().transpose(0, 2, 1)
    return g, w, w * (g[:, :, None] * g[:, None, :].conj() + e)


def test_modes():
    g, w, cross = made(6, 3, 1)
    got, flags, snr = bandpass.solve_gains(cross, w)
    turned = bandpass.turned_to(got, flags, w, [2])
    want = g * np.conj(g[:, 2:3]) / np.abs(g[:, 2:3])
    assert not flags.any() and np.allclose(turned, want, atol=1e-6) and (snr > 10).all()
    amp, *_ = bandpass.solve_gains(cross, w, "a")
    assert np.allclose(amp, np.abs(g), atol=1e-6)
    turn, *_ = bandpass.solve_gains(cross, w, "p")
    assert np.allclose(np.abs(turn), 1) and np.allclose(bandpass.turned_to(turn, flags, w, [2]), want / np.abs(want), atol=1e-6)


def test_groups_have_a_misfit_of_their_own():
    """Two groups of four: only the noisy one's signal-to-noise falls."""
    g, w, clean = made(8, 1, 2, 1e-3)
    _, _, noisy = made(8, 1, 2, 0.5)
    w[:, :4, 4:] = w[:, 4:, :4] = 0
    cross = np.where(w > 0, clean, 0)
    cross[:, 4:, 4:] = np.where(w > 0, noisy, 0)[:, 4:, 4:]
    got, flags, snr = bandpass.solve_gains(cross, w, least=3)
    assert not flags.any() and snr[0, :4].min() > 20 * snr[0, 4:].max()
    turned = bandpass.turned_to(got, flags, w, [1, 5])
    assert abs(np.angle(turned[0, 1])) < 1e-9 and abs(np.angle(turned[0, 5])) < 1e-9
    assert bandpass.solve_gains(cross, w, min_snr=float(snr[0, :4].min()) / 2, least=3)[1].tolist() == [[False] * 4 + [True] * 4]


def test_too_few_baselines_and_channels_without_data():
    g, w, cross = made(6, 2, 3)
    w[0, 5, 1:] = w[0, 1:, 5] = 0  # one baseline left
    w[1] = 0
    got, flags, snr = bandpass.solve_gains(np.where(w > 0, cross, 0), w)
    assert flags.tolist() == [[False] * 5 + [True], [True] * 6] and (got[1] == 1).all() and (snr[1] == 0).all()
    few = np.s_[:, :3, :3]
    assert not bandpass.solve_gains(cross[few][:1], w[few][:1])[1].any()  # three antennas: two baselines each do


def test_channel_sums_leave_out_flags_and_nan(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0, 0, 1, 2.0, [1.0, nan, 3.0], [0.0, 0.0, 1.0], [False, False, True]), (0, 0, 1, 1.0, [2.0, 5.0, 3.0], [1.0, 0.0, 1.0], [False, False, False]), (0, 1, 1, 1.0, [9.0] * 3, [9.0] * 3, [False] * 3), (0, 0, 1, 0.0, [9.0] * 3, [9.0] * 3, [False] * 3)], "k int, antenna1 int, antenna2 int, weight double, re array<double>, im array<double>, flag array<boolean>")
    got = {r.channel: (r.re, r.im, r.w) for r in bandpass.channel_sums(df, ["k"]).collect()}
    assert got == {0: (4.0, 1.0, 3.0), 1: (5.0, 0.0, 1.0), 2: (3.0, 1.0, 1.0)}
