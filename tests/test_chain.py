"""Deferred calibration: both ways to meet solutions, cuts below the gains, fringes as parameters, kept chains."""

import math

import pytest

from uvspark.operators import chain


def rows_of(df):
    return {r.vec_id: r for r in df.collect()}


@pytest.mark.parametrize("in_bucket", [64, 2])
def test_time_buckets_equal_broadcast(spark, sf_dir, monkeypatch, in_bucket):
    want = rows_of(chain._summed(chain._view(spark, sf_dir).read()))
    monkeypatch.setattr(chain, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(chain, "IN_BUCKET", in_bucket)
    got = rows_of(chain._summed(chain._view(spark, sf_dir).read()))
    assert got == want and len({r.re for r in got.values()}) > 100


def test_a_cut_is_made_below_the_gains(spark, sf_dir, capsys):
    view = chain._view(spark, sf_dir)
    view.read(chain.F.col("field") == 1, [5]).explain("extended")
    plan = capsys.readouterr().out.split("== Physical Plan ==")[1]
    assert "sequence(0, 15" not in plan and "sequence(0, 31" not in plan
    view.read(chain.F.col("field") == 1).explain("extended")
    assert "PushedFilters" in plan
    one, all_ = rows_of(view.read(None, [5])), rows_of(view.read())
    for k, r in one.items():
        assert len(r.re) == 2 and [round(x, 9) for x in r.re] == [round(x, 9) for x in all_[k].re[10:12]] and r.flags == all_[k].flags[10:12]


def made(spark, times, fields=("phase", "delay", "rate", "disp")):
    return spark.createDataFrame([(0, a, float(t), 0, bad, *map(float, v)) for a, t, bad, *v in times], "spw int, antenna int, t double, hand int, flag boolean, " + ", ".join(f"{c} double" for c in fields))


@pytest.mark.parametrize("interp", ["linear", "nearest"])
def test_fringes_are_parameters(spark, interp):
    """Phases many turns apart are joined by their rates; a flagged solution doesn't count; a missing antenna flags."""
    ref, rate = 5e9, 3e-13
    phase = lambda t: 0.4 + 2 * math.pi * ref * rate * t  # noqa: E731  1.5 turns a second per 1000 s
    wrapped = lambda x: math.remainder(x, 2 * math.pi)
    solutions = made(spark, [(0, 0, False, 0, 0, 0, 0), (1, 0, False, wrapped(phase(0)), 4.0, rate, 0.02), (1, 500, True, 3, 9, 9, 9), (1, 1000, False, wrapped(phase(1000)), 6.0, rate, 0.02)])
    windows = chain.spectral_windows(spark, {0: [5e9, 5.01e9, 5.02e9]})
    cells = [(i, 0, 0, b, float(t), [1.0] * 3, [0.0] * 3, [False] * 3, [1.0]) for i, (b, t) in enumerate([(1, 0), (1, 250), (1, 900), (1, 2000), (2, 0), (1, -100)])]
    df = spark.createDataFrame(cells, "id int, spw int, antenna1 int, antenna2 int, t double, re array<double>, im array<double>, flags array<boolean>, weight array<double>")
    out = {r.id: r for r in chain.apply_chain(df, [chain.Step(solutions, "fringe", interp, reference={0: ref})], windows, 3, 1).collect()}
    for i, (b, t) in enumerate([(1, 0), (1, 250), (1, 900), (1, 2000), (2, 0), (1, -100)]):
        if b == 2:
            assert out[i].flags == [True] * 3 and out[i].re == [1.0] * 3
            continue
        delay = 4 + 2 * min(max(t / 1000, 0), 1) if interp == "linear" else 4.0 if t < 500 else 6.0
        for c, f in enumerate((5e9, 5.01e9, 5.02e9)):
            angle = phase(t) + 2e-9 * math.pi * delay * (f - ref) + 0.02 * 2e6 * math.pi * (1 / f + (f - 5e9 - 5.02e9) / (5e9 * 5.02e9))
            assert abs(out[i].re[c] - math.cos(angle)) < 1e-6 and abs(out[i].im[c] - math.sin(angle)) < 1e-6


def test_channels_are_joined_across_flagged_ones(spark):
    row = spark.createDataFrame([([1.0, 2.0, 4.0], [1.0, 9.0, 4.0], [3.0, 0.0, -3.0], [False, True, False], [0.0, 1.0, 2.0, 4.0, 5.0]), ([1.0, 2.0, 4.0], [0.0, 9.0, 1.0], [0.0, 0.0, 0.0], [False, True, True], [1.0])], "f array<double>, a array<double>, p array<double>, b array<boolean>, at array<double>")
    one, none = row.select(chain.on_channels(*[chain.F.col(c) for c in "fapb"], chain.F.col("at")).alias("c")).collect()
    assert [round(c.a, 9) for c in one.c] == [1, 1, 2, 4, 4] and none.c is None
    turn = 2 * math.pi - 6
    assert [round(c.p, 9) for c in one.c] == [round(x, 9) for x in (3, 3, 3 + turn / 3, 3 + turn, 3 + turn)] or round(one.c[3].p + 3, 6) in (0, round(2 * math.pi, 6))


def test_flags_can_stay(spark, sf_dir):
    view = chain._view(spark, sf_dir)
    kept = chain.CalibratedView(view.rows, view.windows, view.chains, view.nchan, keep_flags=(0, 1))
    before, after = rows_of(view.rows), rows_of(kept.read())
    assert all(after[k].flags == before[k].flags for k in before) and any(after[k].re != before[k].re for k in before)


def test_the_chain_in_phase_alone(spark, sf_dir):
    view = chain._view(spark, sf_dir)
    steps = [chain.reference_only(view.chains[0][0])]
    before, after = rows_of(view.rows.filter("field = 0")), rows_of(chain.apply_chain(view.rows.filter("field = 0"), steps, view.windows, chain.NCHAN))
    for k, r in after.items():
        for i, bad in enumerate(r.flags):
            if not bad:
                assert math.isclose(math.hypot(r.re[i], r.im[i]), math.hypot(before[k].re[i], before[k].im[i]), abs_tol=1e-9)
        assert r.weight == before[k].weight
