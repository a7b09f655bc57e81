from dataclasses import replace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from relocate import Selector, TableSpec, split_selectors
from relocate.checks import fixtures as fx
from relocate.operators import select

NAMES = [f"p1996{month:02d}" for month in range(1, 13)]


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame([(name, 1) for name in NAMES], "name string, rowcount bigint").cache()


def names(df):
    return sorted(row["name"] for row in df.select("name").collect())


def test_words():
    assert Selector.parse(None) == Selector.parse("  ") == Selector()
    assert Selector.parse("ALL").whole_table
    assert Selector.parse("EACH( a , b,a)").names == ("a", "b")
    assert Selector.parse("RANGE(a,x,b)") == Selector(begin="a", end="b")
    assert Selector.parse("STARTWITH(a)") == Selector(begin="a")
    assert Selector.parse("ENDWITH(b)") == Selector(end="b")


@pytest.mark.parametrize("text", ["p20211111", "EACH", "EACH()", "BETWEEN(a,b)", "each(a)", "RANGE(a", "RANGE( , )"])
def test_unknown_text_raises(text):
    with pytest.raises(ValueError):
        Selector.parse(text)


@settings(max_examples=12, deadline=None)
@given(low=st.sampled_from(NAMES), high=st.sampled_from(NAMES))
def test_range_is_from_and_until(catalog, low, high):
    ranged = names(select.select_partitions(catalog, Selector.parse(f"RANGE({low},{high})")))
    assert ranged == [name for name in NAMES if low <= name < high]
    start = names(select.select_partitions(catalog, Selector.parse(f"STARTWITH({low})")))
    end = names(select.select_partitions(catalog, Selector.parse(f"ENDWITH({high})")))
    assert ranged == sorted(set(start) & set(end))


def test_nothing_selected_is_nothing(catalog):
    assert names(select.select_partitions(catalog, Selector.parse("EACH(typo)"))) == []
    assert names(select.select_partitions(catalog, Selector.parse("RANGE(p199603)"))) == []
    with pytest.raises(ValueError):
        select.select_partitions(catalog, Selector.parse("ALL"))


def test_selectors_by_position():
    chosen = split_selectors("EACH(p1,p2),ALL, RANGE(a,b)", ["t", "u", "v", "w"])
    assert chosen["t"].names == ("p1", "p2")
    assert chosen["u"].whole_table
    assert chosen["v"] == Selector(begin="a", end="b")
    assert chosen["w"] == Selector()
    assert split_selectors(None, ["t"]) == {"t": Selector()}
    with pytest.raises(ValueError):
        split_selectors("ALL,ALL", ["t"])


def test_tables_read_whole_select_no_partitions(spark):
    both = spark.createDataFrame([("t", "p1"), ("t", "p2"), ("u", "p1"), ("v", "p1")], "table string, name string")
    kept = select.select_for_tables(both, {"t": Selector.parse("EACH(p2)"), "u": Selector.parse("ALL")})
    assert sorted(map(tuple, kept.collect())) == [("t", "p2"), ("v", "p1")]


@pytest.mark.parametrize(
    "text", ["RANGE(p199605,p199702)", "EACH(p199605,p200101)", "STARTWITH(p2000)", "ENDWITH(p1996)", "RANGE(p1995,p199603)"]
)
def test_bounds_select_what_names_select(spark, text):
    orders = fx.table(spark, "/root/testdata/sf0.001", "orders")
    selector = Selector.parse(text)
    by_spec = replace(fx.ORDERS, selector=selector).rows(orders)
    by_name = orders.where(selector.keeps(fx.ORDERS.partition_column()))
    assert by_spec.count() == by_name.count() > 0
    assert by_spec.exceptAll(by_name).count() == 0


def test_rows_without_a_key_are_named_but_never_selected(spark):
    rows = spark.sql("SELECT CAST(NULL AS TIMESTAMP_NTZ) AS t UNION ALL SELECT TIMESTAMP_NTZ'1996-05-03'")
    spec = TableSpec("t", key="t", unit="month")
    assert {row[0] for row in rows.select(spec.partition_column()).collect()} == {"unassigned", "p199605"}
    assert spec.rows(rows).count() == 2
    assert replace(spec, selector=Selector.parse("STARTWITH(p1996)")).rows(rows).count() == 1
    by_text = TableSpec("t", partition="date_format(t, 'yyyyMM')", selector=Selector.parse("STARTWITH(1)"))
    assert by_text.rows(rows).count() == 1


def test_a_spec_has_one_way_to_its_partitions():
    for settings_ in ({}, {"partition": "x", "key": "k", "unit": "day"}, {"key": "k"}):
        with pytest.raises(ValueError):
            TableSpec("t", **settings_)


def test_row_filter_with_or_stays_inside(spark):
    rows = spark.range(10).select(F.col("id"), (F.col("id") % 2).cast("string").alias("p"))
    spec = TableSpec("t", partition="p", row_filter="id = 1 OR id = 2", selector=Selector.parse("EACH(1)"))
    assert [row["id"] for row in spec.rows(rows).collect()] == [1]
