import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from relocate import Layout, TableSpec
from relocate.operators import stage
from relocate.sources import listing, staged

SPEC = TableSpec("t", partition="p")


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def files(folder):
    return sorted(str(path) for path in Path(folder).rglob("part-*"))


def hot_rows(spark, n=200_000):
    """Two thirds of the rows in one partition, spread over many map tasks."""
    name = F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("p"), (F.col("id") % 30).cast("string")))
    return spark.range(0, n, 1, 16).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), name.alias("p"))


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_partition_is_written_by_many_tasks(spark, tmp_path, adaptive):
    rows = hot_rows(spark)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        stage.stage_rows(stage.staged_rows(rows, SPEC), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = staged.read_staged(spark, str(tmp_path), rows.schema)
    hot = [file for file in files(tmp_path) if "pt=hot" in file]
    assert len(hot) >= 4
    assert same(back.select(*rows.columns), rows)


def test_row_cap(spark, tmp_path):
    rows = hot_rows(spark, 3000)
    stage.stage_rows(stage.staged_rows(rows, SPEC), str(tmp_path), 70)
    back = staged.with_file(staged.read_staged(spark, str(tmp_path), rows.schema))
    assert back.groupBy("task_name").count().agg(F.max("count")).first()[0] <= 70
    assert back.count() == 3000


def test_staging_again_changes_nothing_and_keeps_other_partitions(spark, tmp_path):
    rows = hot_rows(spark, 3000)
    out = str(tmp_path)
    stage.stage_rows(stage.staged_rows(rows, SPEC), out)
    stage.stage_rows(stage.staged_rows(rows, SPEC), out)
    assert same(staged.read_staged(spark, out, rows.schema).select(*rows.columns), rows)
    stage.stage_rows(stage.staged_rows(rows.where("p = 'hot'").withColumn("text", F.lit("new")), SPEC), out)
    back = staged.read_staged(spark, out, rows.schema)
    assert back.where("pt = 'hot' AND text <> 'new'").isEmpty()
    assert same(back.where("pt <> 'hot'").select(*rows.columns), rows.where("p <> 'hot'"))


def test_rows_without_partition_are_staged_apart(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (2, "a")], "id int, p string")
    stage.stage_rows(stage.staged_rows(rows, SPEC), str(tmp_path))
    back = staged.read_staged(spark, str(tmp_path), rows.schema)
    assert {(r["id"], r["pt"]) for r in back.collect()} == {(1, "unassigned"), (2, "a")}


def test_numbers_as_partition_names_stay_text(spark, tmp_path):
    rows = spark.createDataFrame([(1, "007"), (2, "1-URGENT"), (3, "a b=c/d")], "id int, p string")
    stage.stage_rows(stage.staged_rows(rows, SPEC), str(tmp_path))
    back = staged.read_staged(spark, str(tmp_path), rows.schema)
    assert {r["pt"] for r in back.collect()} == {"007", "1-URGENT", "a b=c/d"}


AWKWARD = [
    (1, None, dt.datetime(2024, 1, 2, 3, 4, 5, 678901), 0.1),
    (2, "", None, None),
    (3, "line\nbreak\r\nand |# and | and \"quotes\" and 'single'", dt.datetime(1969, 12, 31, 23, 59, 59, 1), -1e-300),
    (4, "\\N", dt.datetime(1900, 1, 1), 1e300),
    (5, "  blanks \t ", dt.datetime(9999, 12, 31), 3.0),
    (6, '"', dt.datetime(2024, 1, 1), 1.0),
    (7, 'ends with backslash \\', dt.datetime(2024, 1, 1), 1.0),
    (8, "ünïcode ✓", dt.datetime(2024, 1, 1), 1.0),
]


@pytest.mark.parametrize("separator", [staged.STAGE_SEPARATOR, staged.PLAIN_SEPARATOR])
def test_text_returns_what_was_written(spark, tmp_path, separator):
    rows = spark.createDataFrame(AWKWARD, "id int, s string, t timestamp_ntz, d double").withColumn("p", F.lit("x"))
    # The null mark itself cannot be told from NULL in text files.
    rows = rows.where("id <> 4")
    text = staged.text_format(separator)
    stage.stage_rows(stage.staged_rows(rows, SPEC), str(tmp_path), stage_format=text)
    back = staged.read_staged(spark, str(tmp_path), rows.schema, text)
    assert same(back.select(*rows.columns), rows)


def test_malformed_text_raises(spark, tmp_path):
    (tmp_path / "pt=a").mkdir()
    (tmp_path / "pt=a" / "part-0.csv").write_text("1|#x|#extra\n")
    schema = spark.createDataFrame([], "id int, s string").schema
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        staged.read_staged(spark, str(tmp_path), schema, staged.text_format()).collect()


def test_layout(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = hot_rows(spark, 3000)
    layout = Layout(compression="lz4_raw", bloom_columns=("text",))
    stage.stage_rows(stage.staged_rows(rows, SPEC), str(tmp_path), layout=layout)
    column = pq.ParquetFile(files(tmp_path)[0]).metadata.row_group(0).column(1)
    assert column.path_in_schema == "text" and column.compression in ("LZ4", "LZ4_RAW")


def test_listing_skips_unfinished_and_keeps_empty_files(spark, tmp_path):
    out = tmp_path / "t"
    rows = spark.createDataFrame([(1, "a")], "id int, p string")
    stage.stage_rows(stage.staged_rows(rows, SPEC), str(out))
    rows.limit(0).select("id").coalesce(1).write.parquet(str(out / "pt=b"))
    for name in ("pt=a/_temporary/x.parquet", "pt=a/.hidden.parquet", "pt=a/x.json"):
        (out / name).parent.mkdir(exist_ok=True)
        (out / name).write_text("x")
    found = [row["task_name"] for row in listing.list_files(spark, str(out)).collect()]
    assert len(found) == 2 and all(name.endswith(".parquet") and "/part-" in name for name in found)
