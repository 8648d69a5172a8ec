"""Results that hang on the last digit: halves in rounding, ratios at a limit; logarithms and ratios of zero. Each query against its SQL on events chosen for that."""

import datetime as dt

import duckdb
import pytest
from test_queries import rows_of

import __spark_entry__ as entry


def event(i, user, kind, value):
    return (i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), user, kind, value, "{}")


# Levels of 10.35 / 24 and 140.01 / 200: halves at the fourth digit, below them as numbers; a rule's limit is 0.7.
LEVELS = [(1, "click", 10.35), (1, "view", 24.0), (1, "error", 30.0), (2, "click", 140.01), (2, "view", 200.0), (2, "error", 300.0)]
LISTED = [event(i, *x) for i, x in enumerate(LEVELS)]


def both(spark, tmp_path, name, rows=None, users=None):
    """rows as events, or the events of sf0.1 of some users."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR)")
    if rows:
        con.executemany("INSERT INTO events VALUES (?, ?, ?, ?, ?, ?)", rows)
    else:
        con.execute(f"INSERT INTO events SELECT event_id, ts, user_id, event_type, value, props FROM '/root/testdata/sf0.1/events.parquet' WHERE {users}")
    con.execute(f"COPY events TO '{tmp_path}/events.parquet'")
    df, want = entry.queries()[name](spark, str(tmp_path)), con.sql(entry.oracle_sql()[name])
    return rows_of(df.columns, df.collect()), rows_of(want.columns, want.fetchall())


@pytest.mark.parametrize("name", ["tsys_assess", "rule_labels", "feature_rows"])
def test_halves_of_levels(spark, tmp_path, name):
    got, want = both(spark, tmp_path, name, LISTED)
    assert got == want


def test_rounded_totals(spark, tmp_path):
    got, want = both(spark, tmp_path, "feature_rows", users="user_id IN (893, 454, 870, 315)")
    assert got == want


def test_ratio_at_the_limit(spark, tmp_path):
    got, want = both(spark, tmp_path, "level_gains", users="user_id % 10 = 8")
    assert got == want


# Series that fall to zero (user 1, high among its siblings), rise from it, and whose median, or that of all siblings, is zero.
ZEROS = [(1, "click", v) for v in (9.0, 8.0, 7.0, 0.0)] + [(1, "view", 2.0), (1, "error", 1.0)]
ZEROS += [(2, "click", v) for v in (0.0, 8.0, 7.0, 6.0)] + [(2, "view", v) for v in (0.0, 0.0, 0.0, 4.0, 0.0, 9.0)] + [(3, "click", 0.0), (4, "click", 0.0), (4, "view", 0.0), (4, "error", 5.0)]


@pytest.mark.parametrize("name", ["tsys_assess", "rule_labels", "feature_rows"])
@pytest.mark.parametrize("users", [{1}, {1, 2, 3, 4}])
def test_series_at_zero(spark, tmp_path, name, users):
    got, want = both(spark, tmp_path, name, [event(i, *x) for i, x in enumerate(ZEROS) if x[0] in users])
    assert str(got) == str(want)  # NaN equals NaN
