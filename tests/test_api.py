import pytest

from uvspark import api


def test_config_layers():
    assert api.merge_config({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}, "d": 4}, None) == {"a": {"b": 3, "c": 2}, "d": 4}
    assert api.overrides(flag__min_points=9, calibrate__min_snr=None) == {"flag": {"min_points": 9}}


def test_session(spark, sf_dir):
    s = api.Session(spark, sf_dir, flag__min_points=9)
    assert s.config["flag"]["min_points"] == 9 and s.config["flag"]["outlier_sigma"] == 6.0
    assert s.supports("scan_summary") and s.run("scan_summary") is s.run("scan_summary")
    with pytest.raises(NotImplementedError):
        s.run("nothing of the sort")


def test_registry_and_failures(spark, sf_dir, tmp_path):
    api.register("probe", lambda sp, d: sp.read.parquet(f"{d}/region.parquet"))
    with pytest.raises(ValueError):
        api.register("probe", lambda sp, d: None)
    done, failed = api.run_each(spark, [sf_dir, str(tmp_path)], "probe")
    assert list(done) == [sf_dir] and list(failed) == [str(tmp_path)] and "probe" in api.capabilities()
