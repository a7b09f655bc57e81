"""Ranges of any key against brute force: assignment, faults of a catalog, and running values."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.operators import assign, intervals, sweep


def brute(key, ranges):
    """Name of the range that holds a key; None stands for an open end."""
    found = [n for n, low, high in ranges if None not in key and (low is None or key >= low) and (high is None or key < high)]
    assert len(found) < 2
    return found[0] if found else "unassigned"


def text_of(bound):
    return None if bound is None else ",".join(str(v) for v in bound)


def check(spark, keys, kinds, ranges, extra=()):
    names = [f"k{i}" for i in range(len(kinds))]
    schema = "i int, " + ", ".join(f"{n} {k}" for n, k in zip(names, kinds))
    rows = spark.createDataFrame([(i, *key) for i, key in enumerate(keys)], schema)
    listed = [(n, text_of(low), text_of(high)) for n, low, high in ranges]
    random.Random(3).shuffle(listed)
    catalog = spark.createDataFrame([*listed, *extra], "name string, start string, end string")
    got = {r["i"]: r["pt"] for r in intervals.assign_by_bounds(rows, names, catalog).collect()}
    assert got == {i: brute(key, ranges) for i, key in enumerate(keys)}


def cut(points, skip=5, ends=True):
    """Ranges between the points, some left out, with open ends."""
    points = sorted(set(points))
    ranges = [(f"p{i}", low, high) for i, (low, high) in enumerate(zip(points, points[1:])) if i % skip != skip - 1]
    return [("first", None, points[0]), *ranges, ("last", points[-1], None)] if ends else ranges


@pytest.mark.parametrize("count", [2, 63, 64, 300, 4200])
def test_texts(spark, count):
    chance = random.Random(count)
    letters = "aB~é漢🙂 -"
    word = lambda: "http://" + "".join(chance.choice(letters) for _ in range(chance.randint(1, 9))).strip() + "."
    points = {(word(),) for _ in range(count)}
    keys = [(word(),) for _ in range(1500)] + list(points)[:500] + [(None,), ("",), ("~~~",)]
    check(spark, keys, ["string"], cut(points))


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_decimals(spark, strategy, monkeypatch):
    if strategy == "shuffle":
        monkeypatch.setattr(intervals, "BROADCAST_ENTRIES", 0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    chance = random.Random(2)
    number = lambda: decimal.Decimal(chance.randint(-(10**12), 10**12)) / 100
    points = {(number(),) for _ in range(150)}
    keys = [(number(),) for _ in range(1000)] + [(next(iter(points))[0],)] * 3000 + list(points) + [(None,)] * 20
    try:
        check(spark, keys, ["decimal(18,2)"], cut(points))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_two_columns(spark):
    chance = random.Random(5)
    pair = lambda: (chance.choice("abcdef"), chance.randint(0, 40))
    points = {pair() for _ in range(80)}
    keys = [pair() for _ in range(800)] + [("a", None), (None, 1), ("A", 0), ("g", 0)]
    check(spark, keys, ["string", "int"], cut(points))


def test_times_and_dates(spark):
    start = dt.datetime(1969, 12, 31, 23)
    points = {(start + dt.timedelta(minutes=37 * i),) for i in range(100)}
    keys = [(start + dt.timedelta(minutes=11 * i),) for i in range(-20, 400)] + [(None,)]
    check(spark, keys, ["timestamp_ntz"], cut(points, ends=False))
    days = {(dt.date(2020, 1, 1) + dt.timedelta(days=9 * i),) for i in range(70)}
    check(spark, [(dt.date(2019, 12, 1) + dt.timedelta(days=i),) for i in range(800)], ["date"], cut(days))


def test_entries_that_hold_nothing(spark):
    faulty = [("reversed", "9", "1"), ("empty", "5", "5"), ("unreadable", "x", "7"), ("huge", "99999999999", None)]
    check(spark, [(i,) for i in range(-5, 30)], ["int"], [("a", (0,), (10,)), ("b", (12,), (20,))], faulty)
    check(spark, [(1,)], ["int"], [], faulty)
    check(spark, [], ["int"], [("a", (0,), (10,))])


def test_quoted_words_are_values(spark):
    rows = spark.createDataFrame([(k,) for k in ("A", "MIN", "MAXVALUE", "Z")], "k string")
    listed = spark.createDataFrame([("a", "MINVALUE", "'MIN'"), ("b", '"MIN"', "'MIN0'"), ("c", "'MIN0'", "max")], "name string, start string, end string")
    got = {r["k"]: r["pt"] for r in intervals.assign_by_bounds(rows, ["k"], listed).collect()}
    assert got == {"A": "a", "MIN": "b", "MAXVALUE": "a", "Z": "c"}


def test_overlapping_ranges_raise(spark):
    rows, listed = spark.range(3), spark.createDataFrame([("a", 0, 10), ("b", 9, 12)], "name string, start bigint, end bigint")
    with pytest.raises(ValueError, match="a and b overlap"):
        intervals.assign_by_bounds(rows, ["id"], listed)


def test_open_and_reversed_ranges_of_whole_numbers(spark):
    rows = spark.range(-5, 40)
    listed = [("low", None, 0), ("a", 0, 10), ("turned", 9999, -1970), ("high", 20, None)]
    catalog = spark.createDataFrame(listed, "name string, start bigint, end bigint")
    got = {r["id"]: r["pt"] for r in assign.assign_ranges(rows, "id", catalog).collect()}
    assert got == {i: "low" if i < 0 else "a" if i < 10 else "high" if i >= 20 else "unassigned" for i in range(-5, 40)}
    closed = catalog.where("start IS NOT NULL AND end IS NOT NULL")
    assert {r["pt"] for r in assign.assign_ranges(rows, "id", closed).collect()} == {"a", "unassigned"}


def brute_faults(rows):
    found, valid = set(), []
    for name, low, high in rows:
        if low >= high:
            found.add(("reversed" if low > high else "empty", name, None, str(low), str(high)))
        else:
            valid.append((low, high, name))
    reach = None
    for low, high, name in sorted(valid):
        if reach and reach[0] > low:
            found.add(("overlap", name, reach[1], str(low), str(min(high, reach[0]))))
        elif reach and reach[0] < low:
            found.add(("gap", name, reach[1], str(reach[0]), str(low)))
        reach = max(reach or (high, name), (high, name))
    return found


@pytest.mark.parametrize("pieces", [1, 7])
def test_faults_against_a_sweep_in_one_place(spark, monkeypatch, pieces):
    monkeypatch.setattr(sweep, "PIECES", pieces)
    chance = random.Random(pieces)
    rows = [(f"p{i}", chance.randint(0, 4000), 0) for i in range(400)]
    rows = [(n, low, low + chance.choice([-3, 0, 2, 9, 9, 9, 40])) for n, low, _ in rows] + [("wide", 100, 900)]
    listed = spark.createDataFrame(rows, "name string, start bigint, end bigint")
    got = intervals.catalog_faults(listed, [T.LongType()]).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute_faults(rows)
    whole = spark.createDataFrame([("a", None, "5"), ("b", "5", "9"), ("c", "9", "MAX")], "name string, start string, end string")
    assert intervals.catalog_faults(whole, [T.IntegerType()]).collect() == []
    odd = spark.createDataFrame([("a", "x", "5"), ("b", "7", None), ("c", "6", "7")], "name string, start string, end string")
    assert [tuple(r) for r in intervals.catalog_faults(odd, [T.IntegerType()]).collect()] == [("unreadable", "a", None, None, None)]


def test_list_values_claimed_twice(spark):
    listed = spark.createDataFrame([("a", ["1", "01", "2"]), ("b", ["2", "x"]), ("c", ["3", "2"])], "name string, values array<string>")
    got = {tuple(r) for r in intervals.list_faults(listed, T.IntegerType()).collect()}
    assert got == {("claimed twice", "a", "c", "2", None), ("unreadable", "b", None, "x", None)}


def test_numbers_and_running_values(spark):
    rows = spark.range(1000).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(97)))
    got = sweep.running_max(sweep.numbered(rows, ["v", "id"], "n", "t"), ["id"], F.col("v"), "most", "t").orderBy("id").collect()
    plain = [(r["id"], r["v"]) for r in rows.collect()]
    place = {i: n for n, (i, v) in enumerate(sorted(plain, key=lambda r: (r[1], r[0])))}
    most = None
    for r, (i, v) in zip(got, plain):
        assert (r["id"], r["n"], r["most"]) == (i, place[i], most)
        most = v if most is None else max(most, v)
