"""Earth rotation against a published celestial-to-terrestrial matrix, and daily series across leap seconds."""

import numpy as np

from uvspark.functions import earth

# Published worked example of IAU 2006/2000A: 2007 April 5, 12h UTC, xp 0.0349282", yp 0.4833163", UT1 - UTC -0.072073685 s.
MATRIX = [[0.973104317697536, 0.230363826239128, -0.000703163481769], [-0.230363800456036, 0.973104570632801, 0.000118545368117], [0.000711560162594, 0.000046626402444, 0.999999745754024]]


def matrix(spark):
    eop = spark.createDataFrame([(54195.0, 0.0349282, 0.4833163, -0.072073685), (54196.0, 0.0349282, 0.4833163, -0.072073685)], "mjd double, x double, y double, ut1_utc double")
    axes = np.eye(3).tolist()
    rows = [(i, j, 54195.5, *[x * earth.LIGHT for x in axes[i]], *axes[j]) for i in range(3) for j in range(3)]
    df = spark.createDataFrame(rows, "i int, j int, mjd double, px double, py double, pz double, sx double, sy double, sz double")
    out = np.zeros((3, 3))
    for r in earth.delay_change(df, eop, eop).collect():
        out[r.i, r.j] = r.delay
        assert r.change == 0
    return out


def test_published_matrix(spark):
    assert np.abs(matrix(spark) - MATRIX).max() < 2e-7  # 0.04 arcseconds, that of the terms left out


def test_leap_seconds_are_taken_out(spark):
    eop = spark.createDataFrame([(57753.0, 0.0, 0.0, -0.4), (57754.0, 0.0, 0.0, 0.59), (57755.0, 0.1, 0.2, 0.58)], "mjd double, x double, y double, ut1_utc double")
    df = spark.createDataFrame([(57753.25,), (57754.5,), (57755.5,)], "mjd double")
    got = {r.mjd: r for r in earth.interpolated(df, eop, "mjd", "e_").collect()}
    assert abs(got[57753.25].e_ut1_utc + 0.4025) < 1e-12 and abs(got[57754.5].e_ut1_utc - 0.585) < 1e-12
    assert abs(got[57754.5].e_x / earth.ARCSEC - 0.05) < 1e-12 and got[57755.5].e_ut1_utc is None


def test_atomic_time(spark):
    days = {41317.0: 10, 41498.9: 10, 41499.0: 11, 57753.9: 36, 57754.0: 37, 60000.0: 37, 40000.0: 10}
    got = {r.d: r.x for r in spark.createDataFrame([(d,) for d in days], "d double").select("d", earth.tai_utc(earth.F.col("d")).alias("x")).collect()}
    assert got == days


def test_a_later_earth_is_further_round(spark):
    """UT1 - UTC of a millisecond more turns an equatorial antenna by 15 milliarcseconds: 0.465 m at the equator's radius."""
    series = lambda u: spark.createDataFrame([(54195.0, 0.0, 0.0, u), (54196.0, 0.0, 0.0, u)], "mjd double, x double, y double, ut1_utc double")
    rows = [(k, 54195.5, 6378137.0, 0.0, 0.0, float(np.cos(a)), float(np.sin(a)), 0.0) for k, a in enumerate(np.linspace(0, 2 * np.pi, 40))]
    df = spark.createDataFrame(rows, "k int, mjd double, px double, py double, pz double, sx double, sy double, sz double")
    most = max(abs(r.change) for r in earth.delay_change(df, series(0.0), series(0.001)).collect()) * earth.LIGHT
    assert abs(most - 6378137 * 2 * np.pi * 1.00273781 / 86400 * 0.001) < 0.005
