"""Phases carried to one reference through intervals that lack it."""

import math

from uvspark.operators import rereference as r


def solutions(spark, rows):
    return spark.createDataFrame([(0, float(t), a, ref, float(p), 0.0, rate, bad) for t, a, ref, p, rate, bad in rows], "hand int, t double, antenna int, reference int, phase double, delay double, rate double, flag boolean")


def test_a_tree_through_time(spark):
    """Interval 2 hangs on 1 by antenna 1, interval 3 on 2 by antenna 2; interval 9 has no path and keeps its reference."""
    rows = [(1, 0, 0, 0, 0.0, False), (1, 1, 0, 0.5, 1e-11, False), (2, 1, 1, 0, 0.0, False), (2, 2, 1, 0.25, 0.0, False), (3, 2, 2, 0, 0.0, False), (3, 3, 2, -1, 0.0, False), (9, 5, 5, 0, 0.0, False), (9, 6, 5, 1.5, 0.0, False)]
    got = {(x.t, x.antenna): (x.reference, x.phase) for x in r.to_one_reference(solutions(spark, rows), ["hand"], "t", 0, 5e9).collect()}
    step = 2 * math.pi * 5e9 * 1e-11
    want = {(1, 0): 0, (1, 1): 0.5, (2, 1): 0.5 + step, (2, 2): 0.75 + step}
    # Antenna 2 carries its own rate, which in interval 2 is that of antenna 1 added.
    want |= {(3, 2): 0.75 + 2 * step, (3, 3): -0.25 + 2 * step}
    for k, p in want.items():
        assert got[k][0] == 0 and abs(math.remainder(got[k][1] - p, 2 * math.pi)) < 1e-9
    assert got[9, 5] == (5, 0.0) and got[9, 6] == (5, 1.5)


def test_flagged_solutions_carry_nothing(spark):
    rows = [(1, 0, 0, 0, 0.0, False), (1, 1, 0, 0.5, 0.0, True), (1, 2, 0, 1.0, 0.0, False), (2, 1, 1, 0, 0.0, False), (2, 2, 1, 0.2, 0.0, False), (3, 0, 0, 0, 0.0, True), (3, 2, 0, 0.7, 0.0, False)]
    got = {(x.t, x.antenna): (x.reference, round(x.phase, 9), x.flag) for x in r.to_one_reference(solutions(spark, rows), ["hand"], "t", 0, 5e9).collect()}
    assert got[2, 2] == (0, 1.0, False) and got[2, 1] == (0, 0.8, False)
    # The reference itself is flagged in interval 3: it hangs on antenna 2, known before.
    assert got[3, 2] == (0, 1.0, False) and got[3, 0] == (0, 0.3, True) and got[1, 1] == (0, 0.5, True)


def test_two_references_agree(spark):
    """Solved on either of two references, the solutions are the same after it."""
    truth = {0: 0.3, 1: -1.2, 2: 2.0, 3: 0.9}
    one = [(t, a, 0 if t % 2 else 1, truth[a] - truth[0 if t % 2 else 1], 0.0, False) for t in range(6) for a in truth if t % 2 or a]
    two = [(t, a, 3, truth[a] - truth[3], 0.0, False) for t in range(6) for a in truth if t % 2 or a]
    a, b = ({(x.t, x.antenna): round(x.phase, 9) for x in r.to_one_reference(solutions(spark, rows), ["hand"], "t", 0, 5e9).collect()} for rows in (one, two))
    assert a == b and len(a) == 21


def test_origin(spark):
    df = spark.createDataFrame([(0, 0.5, 3.0, 1e-12, 10.0)], "antenna int, phase double, delay double, rate double, centroid double")
    x = r.move_origin(df, 5e9, r.F.lit(0.0), 5.002e9, r.F.col("centroid")).first()
    want = 0.5 + 2 * math.pi * (2e6 * 3e-9 + 5.002e9 * 10 * 1e-12)
    assert abs(math.remainder(x.phase - want, 2 * math.pi)) < 1e-9 and x.rate == 1e-12
    assert r.move_origin(df, 5e9, r.F.lit(0.0), 5e9, r.F.col("centroid"), zero_rates=True).first().rate == 0


def test_no_base_no_row_and_no_rebase(spark):
    main = solutions(spark, [(1, 0, 0, 0, 0.0, False), (1, 1, 0, 0.5, 0.0, False)])
    stage = solutions(spark, [(1, 1, 1, 0, 0.0, False), (1, 2, 1, 0.25, 0.0, False), (2, 2, 1, 0.25, 0.0, False)])
    got = {(x.t, x.antenna): (x.reference, round(x.phase, 6)) for x in r.append_stage(main, stage, ["hand", "t"], 1, [2]).collect()}
    assert got == {(1, 0): (0, 0.0), (1, 1): (0, 0.5), (1, 2): (0, 0.75)}
    got = {(x.t, x.antenna): (x.reference, round(x.phase, 6)) for x in r.append_stage(main, stage, ["hand", "t"], 1, [2], rebase=False).collect()}
    assert got[2, 2] == (1, 0.25) and got[1, 2] == (1, 0.25)
