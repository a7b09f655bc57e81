"""Every registered query against its SQL, over the whole tables."""

import os

import pytest
from compare import database, differences

import __spark_entry__ as registry
from relocate import checks

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = dict(checks.QUERIES), dict(checks.ORACLES)


@pytest.fixture(scope="module")
def duck():
    return database(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, SQL[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_runs(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["partition_catalog", "status_time_format", "day_bucket", "reconcile_full", "stage_delimited", "incremental_extract"])
def test_session_zone_does_not_matter(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert differences(QUERIES[name](spark, FOLDER), duck, SQL[name]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_times_in_a_daylight_saving_gap_stay(spark):
    from relocate.functions import times

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:01.5' AS t")
        got = row.select(times.status_time(row.t), times.period_name(row.t, "day"), times.period_start(row.t)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (got[0], got[1], str(got[2])) == ("2024-03-10 02:30:01", "p20240310", "2024-03-10 00:00:00")
