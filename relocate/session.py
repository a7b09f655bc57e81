"""Shared folder and size checks."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="relocate-")


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``; a local one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = _local_folder()
    return f"{root.rstrip('/')}/relocate/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that its plan is run once and survives lost executors."""
    path = work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_or_empty(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Parquet files of a folder, no rows when the folder does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def few_values(df: DataFrame, column: str, limit: int) -> list | None:
    """Distinct values of ``column`` when there are at most ``limit`` of them, else None."""
    found = df.select(column).distinct().limit(limit + 1).collect()
    return None if len(found) > limit else [row[0] for row in found]


def broadcast_below(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Broadcast ``df`` when its known row count is within ``limit``; otherwise leave the join to Spark."""
    return F.broadcast(df) if rows <= limit else df
