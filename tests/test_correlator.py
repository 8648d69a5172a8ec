"""Decoded cells and the corrections for sampling, against sums written out."""

import numpy as np

from uvspark.sources import correlator as c


def cosine_sums(x):
    """y[k] = x[0] + (-1)^k x[n] + 2 sum x[j] cos(pi j k / n)."""
    n = len(x) - 1
    return np.array([x[0] + (-1) ** k * x[n] + 2 * sum(x[j] * np.cos(np.pi * j * k / n) for j in range(1, n)) for k in range(n + 1)])


def test_van_vleck_undoes_the_sampling():
    n, rho = 16, 0.6 ** np.arange(1, 16)
    taper = 1 - np.arange(1, n) / n
    lags = np.concatenate([[1.0], taper * 2 / np.pi * np.arcsin(rho), [0.0]])
    # The last lag is lost; choose it so that the extrapolated point is the true one.
    bend = lambda x: x[n] - 2 * x[n - 1] + x[n - 2]
    last = np.eye(n + 1)[n]
    lags = lags - last * bend(cosine_sums(lags)) / bend(cosine_sums(last))
    gain = c.GAMMA[2, 2] ** 2 / (c.A_COEF * c.RM[2, 2] * c.H_COEF)
    measured = cosine_sums(lags)[:n] / gain
    want = cosine_sums(np.concatenate([[1.0], taper * rho, [0.0]]))[:n]
    assert np.allclose(c.van_vleck(measured, 2), want)
    assert c.van_vleck(np.zeros(8), 4) is None
    assert np.allclose(c.rho_four(np.array([0.0, 1e-3])), [0, 1.1329552e-3], rtol=1e-5)


def test_autocorrelations_and_scales(spark):
    rng = np.random.default_rng(7)
    flux = rng.uniform(1, 2, (8, 2, 3))
    flux[3, 1, 2] = -0.5
    flat = flux.ravel().tolist()
    rows = [(0, 0, 4, 4, False, flat), (0, 1, 2, 2, True, flat), (0, 1, 3, 2, False, flat), (2, 2, None, None, False, flat)]
    df = spark.createDataFrame([(*r, 2.0) for r in rows], "antenna1 int, antenna2 int, levels1 int, levels2 int, swapped boolean, flux array<double>, interval double")
    setup = c.Setup(8, (0, 1), (1, 0), (True, False), scale=2.0, width=3.0, kind="VLBA")
    auto, two, odd, unknown = c.decode_cells(df, setup).collect()
    of = lambda x: np.array(x).reshape(8, 2)
    weight = np.abs(flux[:, :, 2])
    assert np.allclose(of(auto.re)[:, 0], c.van_vleck(flux[:, 0, 0], 4) * (1 + 0.125 * weight[:, 0])) and not of(auto.im)[:, 0].any()
    gain = lambda k: c.GAMMA[k] ** 2 / (c.A_COEF * c.RM[k] * c.ALFA[k] * c.H_COEF)
    assert np.allclose(of(auto.re)[:, 1], flux[:, 1, 0] * gain((4, 4))) and np.allclose(of(auto.im)[:, 1], -flux[:, 1, 1] * gain((4, 4)))
    assert np.allclose(of(two.re), flux[:, ::-1, 0] * gain((2, 2))) and np.allclose(of(two.im), flux[:, ::-1, 1] * gain((2, 2)))
    for r in (odd, unknown):  # levels without a model: the plain product of the constants is 1
        assert np.allclose(of(r.re), flux[:, :, 0])
    assert of(auto.flag).sum() == 1 and of(auto.flag)[3, 1] and not auto.flag_row
    assert np.allclose(of(two.weight_spectrum), weight[:, ::-1] * 2 * 2 * 3 * 2) and np.allclose(of(auto.weight_spectrum), weight * 2 * 2 * 3)
    assert np.allclose(auto.sigma, np.sort(of(auto.sigma_spectrum), axis=0)[3]) and np.allclose(auto.weight, 1 / np.array(auto.sigma) ** 2)
