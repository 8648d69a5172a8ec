"""Outliers traced to antennas; arrivals measured on bright fields and carried to others; bandpass gaps."""

import numpy as np

from uvspark.operators import arrivals, blame


def matrix(n, pairs):
    out = np.zeros((1, n, n), bool)
    for i, j in pairs:
        out[0, i, j] = out[0, j, i] = True
    return out


def test_the_worst_antenna_explains_first():
    has = ~np.eye(6, dtype=bool)[None]
    found, left = blame.greedy(matrix(6, [(2, i) for i in range(6) if i != 2] + [(0, 4)]), has)
    assert found[0].tolist() == [False, False, True, False, False, False] and np.argwhere(np.triu(left[0])).tolist() == [[0, 4]]
    found, left = blame.greedy(matrix(6, [(2, i) for i in range(6) if i != 2] + [(5, i) for i in (0, 1, 3)]), has)
    assert np.flatnonzero(found[0]).tolist() == [2, 5] and not left.any()
    # One bad baseline blames nobody; two of five are less than half.
    found, left = blame.greedy(matrix(6, [(1, 3)]), has)
    assert not found.any() and left.sum() == 2
    found, left = blame.greedy(matrix(6, [(1, 3), (1, 4)]), has)
    assert not found.any() and left.sum() == 4


def test_planted_faults_and_nothing_else(spark):
    rng = np.random.default_rng(3)
    lost, burst = {(3, b) for b in range(20, 24)}, {(1, b) for b in (40, 41)}
    rows = [(0, i, j, b, float(rng.normal(0, 0.02) - 3 * ((i, b) in lost or (j, b) in lost) + 1.2 * ((i, b) in burst or (j, b) in burst))) for i in range(6) for j in range(i + 1, 6) for b in range(80)]
    cells = blame.departures(spark.createDataFrame(rows, "hand int, antenna1 int, antenna2 int, bin int, value double"), ["hand", "antenna1", "antenna2"], "bin", "value", threshold=8.0)
    got = {(r.antenna, r.bin, r.other) for r in blame.blame(cells, ["hand"], "bin", "strong", 6).collect()}
    assert got == {(a, b, None) for a, b in lost | burst}


def test_edges_grow_and_scans_are_carried(spark):
    strong = spark.createDataFrame([(3, 5), (3, 6)], "antenna int, bin int")
    weak = spark.createDataFrame([(3, b) for b in (4, 5, 7, 9, 10)] + [(4, 5)], "antenna int, bin int")
    assert sorted((r.antenna, r.bin) for r in blame.grown(strong, weak, ["antenna"], "bin").collect()) == [(3, 4), (3, 5), (3, 6), (3, 7)]
    scans = spark.createDataFrame([(1, 0, "calibrator", 1.0), (2, 0, "target", 2.0), (3, 0, "target", 3.0), (4, 0, "calibrator", 4.0), (5, 0, "target", 5.0), (6, 0, "calibrator", 6.0), (7, 0, "target", 7.0), (8, 9, "target", 4.5)], "scan int, calibrator int, role string, t_min double")
    lost = spark.createDataFrame([(3, 4)], "antenna int, scan int")
    assert sorted((r.antenna, r.scan) for r in blame.scans_between(scans, lost).collect()) == [(3, 2), (3, 3), (3, 5)]
    cells = spark.createDataFrame([(1, b, 3) for b in range(10)] + [(2, b, 3) for b in range(10)], "scan int, bin int, antenna int")
    hit = cells.filter("scan = 1 AND bin > 0 OR scan = 2 AND bin > 1")
    assert [(r.scan, r.antenna) for r in blame.lost_scans(cells, hit, [], "scan").collect()] == [(1, 3)]


def test_arrivals(spark):
    scans = arrivals.scan_kinds(spark.createDataFrame([(1, 0.0, 100.0), (2, 105.0, 200.0), (3, 300.0, 400.0)], "scan int, start double, end double"))
    assert {r.scan: r.kind for r in scans.collect()} == {1: "gap", 2: "gapless", 3: "gap"}
    sample = lambda a, s, t, f, n=3: (a, s, float(t), f, n)
    rows = [sample(0, 2, 105 + 2 * i, 0.2 if i < 4 else 1.0) for i in range(8)]  # late by four samples
    rows += [sample(1, 2, 105 + 2 * i, 1.0 if i != 4 else 0.1) for i in range(8)]  # off once, later
    rows += [sample(2, 2, 105 + 2 * i, 0.1, 1) for i in range(8)]  # one baseline: not judged
    rows += [sample(3, 2, 105 + 2 * i, 0.1) for i in range(4)]  # too few samples
    rows += [sample(4, 2, 105 + 2 * i, 0.1) for i in range(6)]  # never there
    df = spark.createDataFrame(rows, "antenna int, scan int, t double, factor double, n_baselines int")
    assert {r.antenna: (r.kind, r.arrival) for r in arrivals.arrivals(df, scans, 2.0).collect()} == {0: ("gapless", 8.0), 1: ("gapless", 0.0), 4: ("gapless", 12.0)}


def test_typical_arrivals_and_their_transfer(spark):
    rows = [(0, "gap", x) for x in (0.0, 10.0, 20.0, 30.0, 40.0)] + [(1, "gap", x) for x in (0.0, 0.0, 0.0, 0.0, 0.0, 9.0)] + [(2, "gap", 5.0)] * 4
    typical = arrivals.typical_arrivals(spark.createDataFrame([(a, i, k, x) for i, (a, k, x) in enumerate(rows)], "antenna int, scan int, kind string, arrival double"))
    assert [(r.antenna, r.kind, r.seconds) for r in typical.collect()] == [(0, "gap", 36.0)]
    scans = spark.createDataFrame([(7, 100.0, 300.0, "gap", [0, 1]), (8, 400.0, 420.0, "gap", [0]), (9, 500.0, 600.0, "gapless", [0]), (10, 700.0, 800.0, "gap", [1])], "scan int, start double, end double, kind string, antennas array<int>")
    assert sorted((r.antenna, r.scan, r.begin, r.end) for r in arrivals.transfer(typical, scans, 2.0).collect()) == [(0, 7, 99.0, 137.0), (0, 8, 399.0, 421.0)]


def test_bandpass_gaps(spark):
    t, f = True, False
    rows = [(0, 0, [1.0, 0.4, 1.0, 1.0], [t, f, f, f]), (0, 1, [1.0, 1.0, 1.0, 0.1], [f, f, f, f]), (1, 0, [1.0] * 4, [t] * 4), (1, 1, [1.0, 1.0, 0.2, 0.2], [f] * 4), (2, 0, [1.0] * 4, [t] * 4), (2, 1, [1.0] * 4, [t] * 4), (3, 0, [1.0] * 4, [f] * 4)]
    got = arrivals.bandpass_gaps(spark.createDataFrame(rows, "antenna int, hand int, amp array<double>, flag array<boolean>"), ["antenna"])
    assert sorted(((r.antenna, r.hand, r.first, r.last) for r in got.collect()), key=str) == sorted([(0, None, 0, 1), (0, None, 3, 3), (1, 0, None, None), (1, None, 2, 3)], key=str)
