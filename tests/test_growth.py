"""Work that has to grow no faster than its input: what a task holds, and what each row or group costs."""

import glob
import time
import types

import pandas as pd
from pyspark.sql import functions as F

from uvspark.operators import decide, fringefit
from uvspark.sources import store
from uvspark.streaming import last_n


def test_roles_of_many_groups_share_a_batch(spark):
    """One data frame per group isn't made; unknown places, undetected sources and declared roles are judged as by roles_of."""
    scans = [("f", 300.0), *[("c", 60.0), ("t", 180.0)] * 8, ("f", 300.0)]
    place = {"c": (10.0, 50.0), "t": (12.0, None), "f": (200.0, 10.0)}
    snr, said = {"c": 9.0, "t": None, "f": 0.0}, {"c": "target"}
    rows = [(g, i, s, x, *place[s], snr[s], said.get(s) if g % 2 else None) for g in range(40) for i, (s, x) in enumerate(scans)]
    df = spark.createDataFrame(rows, "g int, t int, source string, duration double, ra double, dec double, snr double, declared string")
    out = decide.infer_roles(df, "g")
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().toString()
    got = {(r.g, r.source): (r.n_scans, r.role, r.calibrator) for r in out.collect()}
    seen = {s: x for s, x in snr.items() if x is not None}
    want = {(g, s): (sum(x == s for x, _ in scans), *r) for g in range(40) for s, r in decide.roles_of(scans, seen, place, said if g % 2 else {}).items()}
    assert got == want


def test_rows_stay_where_they_are_for_intervals(spark, sf_dir):
    """First times of keys are sent to the rows: no join brings all rows of a key to one task, whatever the session's limit for broadcasts."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fringefit.interval_sums(fringefit.planted(spark, sf_dir), ["hand"], 500.0, 8)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_store_files_are_bounded(spark, tmp_path):
    rows = spark.range(2000).select("id", F.when(F.col("id") < 1800, 1).when(F.col("id") < 1900, 2).alias("part"))
    store.write_store(rows, str(tmp_path / "s"), ["part"], rows_per_file=100)
    read = spark.read.parquet(str(tmp_path / "s"))
    sizes = {tuple(r)[:2]: r[2] for r in read.groupBy("part", F.input_file_name()).count().collect()}
    assert read.count() == 2000 and {r.id for r in read.filter("part IS NULL").collect()} == set(range(1900, 2000))
    # One value in many files of about equal size, a small one in one file.
    assert len(glob.glob(str(tmp_path / "s/part=1/*.parquet"))) > 6 and len(glob.glob(str(tmp_path / "s/part=2/*.parquet"))) == 1
    assert max(sizes.values()) < 700


def test_last_solutions_cost_little_a_row():
    kept = types.SimpleNamespace(get=lambda: iter([]), exists=lambda: False, put=lambda x: None)
    expiry = types.SimpleNamespace(exists=lambda: False, update=lambda x: None)
    p = last_n.LastSolutions(3, 1000)
    p.init(types.SimpleNamespace(getListState=lambda *a: kept, getValueState=lambda *a: expiry, registerTimer=lambda t: None))
    n = 60_000
    rows = pd.DataFrame({"event_id": range(n), "ts": pd.date_range("2024-01-01", periods=n, freq="s"), "value": [None if i % 5 == 0 else float(i) for i in range(n)], "good": [i % 4 != 0 for i in range(n)]})
    start = time.process_time()
    out = next(iter(p.handleInputRows((1,), iter([rows]), None)))
    assert time.process_time() - start < 2  # a pandas series a row takes some 5 s
    assert out["predicted"].tolist()[8:10] == [6.5, 6.5] and pd.isna(out["predicted"][0])
