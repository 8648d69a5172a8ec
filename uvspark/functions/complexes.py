"""Complex numbers as pairs of columns, or pairs of array columns: Spark has no complex type."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Pair = tuple[Column, Column]


def cmul(a: Pair, b: Pair) -> Pair:
    return a[0] * b[0] - a[1] * b[1], a[0] * b[1] + a[1] * b[0]


def conj(a: Pair) -> Pair:
    return a[0], -a[1]


def cdiv(a: Pair, b: Pair) -> Pair:
    """a / b; null where b is zero."""
    power = F.nullif(b[0] * b[0] + b[1] * b[1], F.lit(0.0))
    re, im = cmul(a, conj(b))
    return re / power, im / power


def amplitude(a: Pair) -> Column:
    return F.hypot(*a)


def phase(a: Pair) -> Column:
    return F.atan2(a[1], a[0])


def polar(amp: Column, angle: Column) -> Pair:
    return amp * F.cos(angle), amp * F.sin(angle)


def wrap(angle: Column) -> Column:
    """Angle in (-pi, pi]."""
    return angle - 2 * math.pi * F.ceil((angle - math.pi) / (2 * math.pi))


def blend_polar(a: Pair, b: Pair, w: Column) -> Pair:
    """Amplitude and shortest-arc phase interpolated on their own."""
    turn = phase(cmul(b, conj(a)))
    return polar(amplitude(a) * (1 - w) + amplitude(b) * w, phase(a) + w * turn)


def array_correct(re: Column, im: Column, gain: Pair) -> Column:
    """Array of structs re, im: every cell divided by a scalar complex gain."""
    return F.zip_with(re, im, lambda x, y: F.struct(*[c.alias(n) for c, n in zip(cdiv((x.cast("double"), y.cast("double")), gain), ("re", "im"))]))


def horner(coefficients: Column, x: Column) -> Column:
    """Polynomial with coefficients from the constant term up."""
    return F.aggregate(F.reverse(coefficients), F.lit(0.0), lambda acc, c: acc * x + c)


def dispersion(freq: Column, fmin: float, fmax: float) -> Column:
    """Dispersive basis over a band: 1/f made free of a constant and a slope at the band's ends."""
    lo, hi = 1 / fmin, 1 / fmax
    return 1 / freq - (lo + (hi - lo) * (freq - fmin) / (fmax - fmin))
