from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from relocate import Selector, Store, TableSpec
from relocate.checks import fixtures as fx
from relocate.operators import metrics, reconcile

FOLDER = "/root/testdata/sf0.001"
SPEC = TableSpec("t", partition="p", metrics={"v": "v"})


def statuses(report):
    return {row["name"]: row["status"] for row in report.collect()}


def table(spark, rows):
    return spark.createDataFrame(rows, "p string, v double")


@pytest.mark.parametrize(
    "scale, expected",
    [("sf0.001", (75, 4, 1, 1)), ("sf0.01", (74, 5, 1, 1)), ("sf0.1", (74, 5, 1, 1))],
)
def test_damage_is_found(spark, scale, expected):
    folder = f"/root/testdata/{scale}"
    report = reconcile.reconcile(
        fx.table(spark, folder, "orders"), fx.damaged_orders(spark, folder), fx.ORDERS, both_sides=True
    )
    found = Counter(statuses(report).values())
    assert tuple(found[s] for s in ("MATCH", "NOT MATCH", "LOST", "EXTRA")) == expected


def test_a_table_matches_itself(spark):
    lines = fx.table(spark, FOLDER, "lineitem")
    assert set(statuses(reconcile.reconcile(lines, lines, fx.LINEITEM, both_sides=True)).values()) == {"MATCH"}


def test_verdicts(spark):
    source = table(spark, [("same", 1.0), ("same", None), ("null", None), ("sum", 1.0), ("count", 0.0), ("lost", 1.0)])
    target = table(
        spark, [("same", 1.0), ("same", None), ("null", None), ("sum", 2.0), ("count", 0.0), ("count", 0.0), ("extra", 1.0)]
    )
    expected = {"same": "MATCH", "null": "MATCH", "sum": "NOT MATCH", "count": "NOT MATCH", "lost": "LOST"}
    assert statuses(reconcile.reconcile(source, target, SPEC)) == expected
    both = reconcile.reconcile(source, target, SPEC, both_sides=True)
    assert statuses(both) == {**expected, "extra": "EXTRA"}
    apart = reconcile.compare_metrics(
        metrics.partition_metrics(source, SPEC), metrics.partition_metrics(target, SPEC), both_sides=True
    )
    assert statuses(apart) == statuses(both)


def test_null_sum_is_not_zero(spark):
    assert statuses(reconcile.reconcile(table(spark, [("a", None)]), table(spark, [("a", 0.0)]), SPEC)) == {
        "a": "NOT MATCH"
    }


def test_order_of_rows_does_not_change_sums(spark):
    values = [("a", 0.1), ("a", 1e12), ("a", 0.2), ("a", -1e12)]
    report = reconcile.reconcile(table(spark, values), table(spark, values[::-1]), SPEC)
    assert statuses(report) == {"a": "MATCH"}


def test_no_metrics_compares_counts(spark):
    spec = replace(SPEC, metrics={})
    report = reconcile.reconcile(table(spark, [("a", 1.0)]), table(spark, [("a", 9.0)]), spec)
    assert statuses(report) == {"a": "MATCH"}


def test_row_filter_and_selector_hold_for_both_sides(spark):
    source = table(spark, [("a", 1.0), ("a", -1.0), ("b", 5.0)])
    target = table(spark, [("a", 1.0)])
    spec = replace(SPEC, row_filter="v > 0", selector=Selector.parse("EACH(a)"))
    assert statuses(reconcile.reconcile(source, target, spec, both_sides=True)) == {"a": "MATCH"}


def test_missing_side_raises(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        reconcile.reconcile(table(spark, [("a", 1.0)]), Store(root="/nowhere").read(spark, "t"), SPEC)


def test_metric_types(spark):
    rows = spark.sql("SELECT 'a' AS p, 9223372036854775807L AS big, CAST(1.005 AS DECIMAL(10,3)) AS exact, 2.5D AS v, 3 AS n")
    spec = TableSpec("t", partition="p", metrics={"big": "big", "exact": "exact", "twice": F.col("v") * 2, "n": "n"})
    result = metrics.partition_metrics(rows.union(rows), spec, prints=False)
    types = {f.name: f.dataType.simpleString() for f in result.schema}
    assert types == {
        "name": "string",
        "row_count": "bigint",
        "big": "decimal(38,0)",
        "exact": "decimal(38,3)",
        "twice": "decimal(38,6)",
        "n": "decimal(38,0)",
    }
    row = result.first()
    assert [str(row[c]) for c in ("big", "exact", "twice", "n")] == ["18446744073709551614", "2.010", "10.000000", "6"]


def test_summary_of_several_tables(spark):
    good, bad = table(spark, [("a", 1.0), ("b", 2.0)]), table(spark, [("a", 1.0), ("b", 3.0), ("c", 1.0)])
    report = reconcile.reconcile_tables(
        [(SPEC, good, good), (replace(SPEC, name="u", metrics={"v": "v", "w": "v * 2"}), good, bad)], both_sides=True
    )
    rows = {r["table"]: (r["checked"], r["mismatched"], r["all_right"]) for r in reconcile.summary(report).collect()}
    assert rows == {"t": (2, 0, True), "u": (3, 2, False)}
    named = {r["table"]: (r["checked"], r["all_right"]) for r in reconcile.summary(report, ["t", "gone"]).collect()}
    assert named == {"t": (2, True), "u": (3, False), "gone": (0, False)}
    wrong = reconcile.mismatches(report)
    assert {(r["name"], r["status"], r["src_metrics"], r["tgt_metrics"]) for r in wrong.collect()} == {
        ("b", "NOT MATCH", "2.000000,4.000000", "3.000000,6.000000"),
        ("c", "EXTRA", None, "1.000000,2.000000"),
    }
    with pytest.raises(ValueError):
        reconcile.reconcile_tables([])


@pytest.mark.parametrize("kind", ["orc", "json", "parquet"])
def test_stores_of_other_formats(spark, tmp_path, kind):
    from relocate.operators import load

    rows = table(spark, [("a", 1.5), ("b", None)])
    target = Store(format=kind, root=f"{tmp_path}/{kind}")
    load.direct_copy(rows, replace(SPEC, row_filter="p <> 'c'"), target)
    load.direct_copy(rows, SPEC, target)
    assert target.read(spark, "t", rows.schema).count() == 4
    assert statuses(reconcile.reconcile(rows.union(rows), target.read(spark, "t", rows.schema), SPEC)) == {
        "a": "MATCH",
        "b": "MATCH",
    }
    named = Store(format=kind, options={"path": f"{tmp_path}/{kind}/t"}, table_option="note", database="db")
    assert named.read(spark, "t", rows.schema).count() == 4


def verdict(spark, source, target, kinds="double"):
    kinds = kinds if isinstance(kinds, tuple) else (kinds, kinds)
    sides = [
        spark.createDataFrame([("a", None if v is None else str(v)) for v in values], "p string, v string").withColumn("v", F.col("v").cast(kind))
        for values, kind in zip((source, target), kinds)
    ]
    return statuses(reconcile.reconcile(*sides, SPEC, both_sides=True))["a"]


@pytest.mark.parametrize(
    "source, target, kinds, expected",
    [
        ([1.001], [1.004], "double", "NOT MATCH"),
        ([1e-12, 1.0], [2e-12, 1.0], "double", "NOT MATCH"),
        ([float("nan"), 1.0], [None, 1.0], "double", "NOT MATCH"),
        ([float("nan"), 1.0], [1.0, float("nan")], "double", "MATCH"),
        ([float("inf")], [float("-inf")], "double", "NOT MATCH"),
        ([1e17, 1e300], [1e300, 1e17], "double", "MATCH"),
        ([1e17], [1e17 + 16], "double", "NOT MATCH"),
        ([0.0], [-0.0], "double", "MATCH"),
        ([1.0, 3.0], [2.0, 2.0], "double", "NOT MATCH"),
        ([1.5], [1.5], ("float", "double"), "MATCH"),
        ([10], [10.4], ("int", "double"), "NOT MATCH"),
        ([10], [10.0], ("int", "double"), "MATCH"),
        (["1.00"], ["1.0049"], ("decimal(18,2)", "decimal(18,4)"), "NOT MATCH"),
        (["1.10"], ["1.1000"], ("decimal(18,2)", "decimal(18,4)"), "MATCH"),
        (["1.10"], [1.1], ("decimal(18,2)", "double"), "MATCH"),
        ([2**62 + 1], [2**62], "bigint", "NOT MATCH"),
        ([7], [7], ("bigint", "decimal(38,0)"), "MATCH"),
    ],
)
def test_verdicts_see_every_digit(spark, source, target, kinds, expected):
    assert verdict(spark, source, target, kinds) == expected


def saved_verdict(spark, source, target, **how):
    tables = [table(spark, [("a", v) for v in values]) for values in (source, target)]
    prints = not how.get("sums_only", False)
    return statuses(reconcile.compare_metrics(*[metrics.partition_metrics(df, SPEC, prints) for df in tables], **how))["a"]


@pytest.mark.parametrize(
    "source, target, expected",
    [
        ([1.0, 3.0], [2.0, 2.0], "NOT MATCH"),
        ([1e25, 1.0], [2e25, 1.0], "NOT MATCH"),
        ([float("nan"), 1.0], [5e30, 1.0], "NOT MATCH"),
        ([1e-7], [2e-7], "NOT MATCH"),
        ([float("nan"), 1.0], [1.0, float("nan")], "MATCH"),
        ([None, 1.0], [1.0], "NOT MATCH"),
        ([None, None], [None, None], "MATCH"),
    ],
)
def test_saved_metrics_see_every_digit(spark, source, target, expected):
    assert saved_verdict(spark, source, target) == expected


def test_saved_sums_alone_give_no_verdict(spark):
    bare = metrics.partition_metrics(table(spark, [("a", 1.0)]), SPEC, prints=False)
    with pytest.raises(ValueError, match="no prints of v"):
        reconcile.compare_metrics(bare, bare)
    assert saved_verdict(spark, [1.0, 3.0], [2.0, 2.0], sums_only=True) == "MATCH"


def test_sum_with_a_value_that_does_not_fit_is_null(spark):
    for values in ([1e25, 1.0], [float("nan"), 1.0], [float("inf"), 1.0]):
        rows = table(spark, [("a", v) for v in values])
        assert metrics.partition_metrics(rows, SPEC).first()["v"] is None
        assert metrics.table_metrics(rows, SPEC).first()["v"] is None
        row = reconcile.reconcile(rows, rows, SPEC).first()
        assert (row["src_v"], row["tgt_v"], row["status"]) == (None, None, "MATCH")
    fits = table(spark, [("a", None), ("a", 2.5)])
    assert str(metrics.partition_metrics(fits, SPEC).first()["v"]) == "2.500000"


def test_differing_types_are_named(spark):
    target = table(spark, [("a", 1.0)])
    assert reconcile.type_differences(target.withColumn("v", F.col("v").cast("int")), target, SPEC) == {"v": ("int", "double")}
    assert reconcile.type_differences(target, target, SPEC) == {}
