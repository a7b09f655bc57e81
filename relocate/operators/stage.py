"""Writers of staged files: one folder per partition, a row cap per file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from relocate.functions.paths import PARTITION_FIELD
from relocate.sources.staged import PARQUET, StageFormat
from relocate.specs import Layout, TableSpec

# Pieces a partition is cut into when AQE is switched off and cannot split a large one itself.
FIXED_PIECES = 16


# Column that holds a row's partition by a catalog; it is not staged.
CATALOG_FIELD = "_catalog_partition"

# Names of columns that staging and loading add themselves.
RESERVED = {PARTITION_FIELD, "task_name", "load_id", "loaded_at", "_rank", "_newer", "_group"}


def staged_rows(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that the spec covers, with their partition name in ``pt``. A table with a reserved column name raises."""
    if clash := sorted(RESERVED & {column.lower() for column in df.columns}):
        raise ValueError(f"{spec.name} has columns of reserved names: {', '.join(clash)}")
    return spec.rows(df).withColumn(PARTITION_FIELD, spec.partition_column()).drop(CATALOG_FIELD)


def gathered(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of equal ``columns`` together for writing, without a task for each value.

    AQE sizes the write tasks from the shuffle: small values share a task, a value that
    holds much of the table is split over many.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", *[F.col(column) for column in columns])
    piece = F.pmod(F.xxhash64(*df.columns), F.lit(FIXED_PIECES))
    return df.repartition(*[F.col(column) for column in columns], piece)


def partition_writer(
    df: DataFrame, max_rows_per_file: int = 0, gather: bool = True, within: Sequence[str] = ()
) -> DataFrameWriter:
    """Writer that replaces the partitions present in ``df`` and leaves the others.

    ``within`` names columns of folders above those of the partitions.
    """
    writer = (
        (gathered(df, *within, PARTITION_FIELD) if gather else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*within, PARTITION_FIELD)
    )
    return writer.option("maxRecordsPerFile", max_rows_per_file) if max_rows_per_file else writer


def stage_rows(
    df: DataFrame,
    folder: str,
    max_rows_per_file: int = 0,
    layout: Layout = Layout(),
    gather: bool = True,
    stage_format: StageFormat = PARQUET,
    within: Sequence[str] = (),
) -> None:
    """Write staged rows in one job: Parquet, or headerless text with columns in the order of ``df``.

    ``gather`` shuffles the rows once so that a partition is not scattered over a small
    file from every task. Without it each task writes what it scanned: the choice for
    sources whose files already hold few partitions each, such as partition folders. Only
    the partitions present in ``df`` are replaced, so a repeated run gives the same files'
    content and other partitions stay. ``within`` names columns of folders above the partitions'.
    """
    writer = partition_writer(df, max_rows_per_file, gather, within).options(**layout.options())
    writer.format(stage_format.name).options(**stage_format.options).save(folder)


def save_bucketed(df: DataFrame, table: str, path: str, layout: Layout) -> None:
    """Save as a table bucketed by hash, so that later joins and upserts on those columns need no shuffle."""
    (
        gathered(df, *layout.bucket_columns)
        .write.mode("overwrite")
        .options(**layout.options())
        .option("path", path)
        .bucketBy(layout.buckets, *layout.bucket_columns)
        .saveAsTable(table)
    )
