"""Gain curves in zenith angle."""

import numpy as np

from uvspark.operators import gaincurve


def test_polynomials_say_the_same_in_zenith_angle(spark):
    poly = [0.9, 2e-3, -3e-5, 1e-7, 0.0, 0.0, 1e-14, 1e-16, 5.0]  # the ninth term is cut
    df = spark.createDataFrame([(k, [poly, poly[:2]], [0.1, 2.0]) for k in ("POWER(EL)", "POWER(ZA)", "VOLTAGE(EL)", "VOLTAGE(ZA)", "OTHER")], "kind string, gains array<array<double>>, sensitivities array<double>")
    for r in gaincurve.power_curves(df).collect():
        if r.kind == "OTHER":
            assert r.curves is None
            continue
        for curve, p, f in zip(r.curves, (poly[:8], poly[:2]), (0.1, 2.0)):
            assert len(curve) == 8
            for za in (0.0, 20.0, 60.0):
                y = np.polyval(p[::-1], 90 - za if "EL" in r.kind else za)
                want = f * (y * y if "VOLTAGE" in r.kind else y)
                if not ("VOLTAGE" in r.kind and len(p) == 8):  # a square of 15 terms doesn't fit
                    assert np.isclose(np.polyval(curve[::-1], za), want, rtol=1e-9)


def test_flat_stations_and_negative_power(spark):
    df = spark.createDataFrame([("POWER(EL)", [[1.0], [-1.0]], [1.0, 1.0])], "kind string, gains array<array<double>>, sensitivities array<double>")
    r = gaincurve.gains_at(gaincurve.power_curves(df), gaincurve.F.lit(45.0)).first()
    assert r.curves[0] == [1.0] + [0.0] * 7 and r.voltage == [1.0, None]
