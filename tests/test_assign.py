"""Rows to partitions against brute force, on both join strategies."""

import datetime as dt
import random

import pytest

from relocate.functions import bounds
from relocate.operators import assign
from relocate.sources import catalog


@pytest.fixture(params=["broadcast", "shuffle"])
def strategy(request, spark, monkeypatch):
    if request.param == "shuffle":
        monkeypatch.setattr(assign, "BROADCAST_ROWS", 0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def brute(key, ranges):
    found = [name for name, low, high in ranges if key is not None and low <= key < high]
    assert len(found) < 2
    return found[0] if found else "unassigned"


def check(spark, keys, kind, ranges, strategy):
    rows = spark.createDataFrame([(i, key) for i, key in enumerate(keys)], f"i int, k {kind}")
    listed = spark.createDataFrame(ranges, f"name string, start {kind}, end {kind}")
    assigned = assign.assign_ranges(rows, "k", listed)
    text = assigned._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in text) == (strategy == "broadcast")
    got = {row["i"]: row["pt"] for row in assigned.collect()}
    assert got == {i: brute(key, ranges) for i, key in enumerate(keys)}


def test_integers(spark, strategy):
    chance = random.Random(1)
    cuts = sorted(chance.sample(range(-500, 500), 40)) + [10_000]
    ranges = [(f"p{i}", low, high) for i, (low, high) in enumerate(zip(cuts, cuts[1:])) if i % 5]
    keys = [chance.randint(-600, 11_000) for _ in range(2000)] + cuts + [None] * 50
    check(spark, keys, "bigint", ranges, strategy)


def test_large_integers_are_exact(spark, strategy):
    big = 2**60
    ranges = [("a", big - 3, big), ("b", big, big + 1), ("c", big + 1, big + 5)]
    check(spark, [big + d for d in range(-6, 8)], "bigint", ranges, strategy)


def test_one_range_holds_most_rows(spark, strategy):
    ranges = [(f"p{i}", i * 10, i * 10 + 10) for i in range(20)]
    keys = [55] * 3000 + list(range(200))
    check(spark, keys, "int", ranges, strategy)


def test_times_within_a_day(spark, strategy):
    start = dt.datetime(1969, 12, 30)
    cuts = [start + dt.timedelta(hours=h) for h in (0, 7, 24, 30, 31, 96)]
    ranges = [(f"p{i}", low, high) for i, (low, high) in enumerate(zip(cuts, cuts[1:]))]
    keys = [start + dt.timedelta(minutes=30 * m) for m in range(-10, 220)] + [None]
    check(spark, keys, "timestamp_ntz", ranges, strategy)


def test_far_end_and_hourly_ranges_meet_few_rows(spark, strategy):
    start = dt.datetime(2020, 1, 1)
    cuts = [start + dt.timedelta(hours=h) for h in range(400)] + [dt.datetime(9999, 1, 1)]
    ranges = [(f"p{i}", low, high) for i, (low, high) in enumerate(zip(cuts, cuts[1:]))]
    keys = [start + dt.timedelta(minutes=17 * m) for m in range(-10, 1500)] + [dt.datetime(5000, 1, 1), None]
    check(spark, keys, "timestamp_ntz", ranges, strategy)
    bounds = spark.createDataFrame(ranges, "_name string, _start timestamp_ntz, _end timestamp_ntz")
    listed = assign.listed_ranges(bounds, bounds.schema["_start"].dataType)
    assert listed.count() <= 3 * len(ranges)
    assert max(row["count"] for row in listed.groupBy("_level", "_bucket").count().collect()) <= 3


def test_empty_catalog_assigns_nothing(spark):
    rows = spark.range(3)
    listed = spark.createDataFrame([], "name string, start bigint, end bigint")
    assert {r["pt"] for r in assign.assign_ranges(rows, "id", listed).collect()} == {"unassigned"}


def test_text_keys_have_no_ranges(spark):
    with pytest.raises(TypeError):
        assign.assign_ranges(
            spark.createDataFrame([("a",)], "k string"), "k", spark.createDataFrame([("p", "a", "b")], "name string, start string, end string")
        )


def test_lists(spark, strategy):
    keys = ["F", "O", "P", None, "X"] + ["F"] * 500
    rows = spark.createDataFrame([(i, key) for i, key in enumerate(keys)], "i int, k string")
    listed = spark.createDataFrame([("closed", ["F", "O"]), ("open", ["P"])], "name string, values array<string>")
    got = {row["i"]: row["pt"] for row in assign.assign_lists(rows, "k", listed).collect()}
    names = {"F": "closed", "O": "closed", "P": "open"}
    assert got == {i: names.get(key, "unassigned") for i, key in enumerate(keys)}


def test_numeric_catalog_below_zero(spark):
    rows = spark.createDataFrame([(v,) for v in (-11, -10, -1, 0, 9, 10, None)], "k int")
    found = {(r["start"], r["end"], r["rowcount"]) for r in catalog.numeric_catalog(rows, "k", 10).collect()}
    assert found == {(-20, -10, 1), (-10, 0, 2), (0, 10, 2), (10, 20, 1)}


def test_texts_of_a_listing(spark):
    rows = spark.createDataFrame(
        [
            ("a", "k", "[types: [INT]; keys: [1]; ..types: [INT]; keys: [11]; )", None, "7"),
            ("b", "k", "", "((x, y))", "1"),
            ("c", "k", None, "('z')", "2"),
            ("d", "k", "", "", "0"),
            ("e", "k", "INT keys: [1];", None, "0"),
        ],
        "name string, key string, range string, list string, rowcount string",
    )
    got = {row["name"]: row for row in catalog.parsed_catalog(rows).collect()}
    assert set(got) == {"a", "b", "c", "e"}
    assert (got["a"]["ptype"], got["a"]["dtype"], got["a"]["start"], got["a"]["end"]) == ("range", "number", "1", "11")
    assert got["b"]["values"] == ["x", "y"] and got["c"]["values"] == ["z"]
    # The mark of an integer bound counts only after the first character.
    assert (got["e"]["dtype"], got["e"]["start"], got["e"]["end"]) == ("str", "1", None)


def test_key_of_several_columns_raises(spark):
    rows = spark.createDataFrame(
        [("a", "k, l", "", "((1, 2))", "7")], "name string, key string, range string, list string, rowcount string"
    )
    with pytest.raises(Exception, match="several columns: k, l"):
        catalog.parsed_catalog(rows).collect()


def test_sizes(spark):
    rows = spark.createDataFrame([("12.5GB",), ("3MB",), ("0B",), ("2 tb",), ("?",), (None,)], "s string")
    got = rows.select(bounds.size_in_bytes(rows.s), bounds.gigabytes_only(rows.s)).collect()
    assert [row[0] for row in got] == [12.5 * 2**30, 3 * 2**20, 0.0, 2.0 * 2**40, None, None]
    assert [row[1] for row in got] == [12.5, 0.0, 0.0, 0.0, 0.0, 0.0]
