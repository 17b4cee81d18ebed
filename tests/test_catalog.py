"""Every SQL-backed catalog query equals its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01), and the entry point runs."""

import pytest

import __spark_entry__ as entry_mod
import oracle_check
from tests.conftest import SF_SMALL

ORACLE_NAMES = sorted(entry_mod.oracle_sql())


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.fixture(scope="module")
def report(spark):
    return oracle_check.check(spark, SF_SMALL, ORACLE_NAMES)


@pytest.mark.parametrize("name", ORACLE_NAMES)
def test_query_matches_oracle(report, name):
    r = report[name]
    assert "error" not in r, r.get("error")
    assert r["rows"] == r["oracle_rows"]
    assert r["schema_ok"], r.get("cols")
    assert r["round9"], (r.get("only_spark"), r.get("only_oracle"))


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["title", "percentage"]
    assert len(rows) <= 10


def test_time_queries_ignore_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rep = oracle_check.check(
            spark, SF_SMALL, ["sentiment_by_day", "day_filter", "comment_submission_join", "daily_csv_roundtrip"]
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    for name, r in rep.items():
        assert "error" not in r and r["round9"] and r["schema_ok"], (name, r)
