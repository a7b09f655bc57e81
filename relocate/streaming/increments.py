"""Increments by insert key: rows newer than the last high-water mark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.session import read_or_empty


def _as_text(value: Column, kind: T.DataType) -> Column:
    """A key as text that names one value in every session zone."""
    return (F.unix_micros(value) if isinstance(kind, T.TimestampType) else value).cast("string")


def _as_key(text: Column, kind: T.DataType) -> Column:
    return F.timestamp_micros(text.cast("bigint")) if isinstance(kind, T.TimestampType) else text.cast(kind)


def high_water(df: DataFrame, key: str) -> str | None:
    """Largest insert key, as text; None for an empty table."""
    return df.agg(_as_text(F.max(key), df.schema[key].dataType)).first()[0]


def extract_increment(df: DataFrame, key: str, low: str | None, high: str | None) -> DataFrame:
    """Rows with ``low < key <= high``, both as ``high_water`` gives them.

    The bounds are literals, so they reach the scan.
    """
    kind = df.schema[key].dataType
    if high is None:
        return df.where(F.lit(False))
    df = df.where(F.col(key) <= _as_key(F.lit(high), kind))
    return df if low is None else df.where(F.col(key) > _as_key(F.lit(low), kind))


def late_rows(df: DataFrame, done: DataFrame, key: str, low: str | None) -> DataFrame:
    """Rows with the key ``low``, or with none, that ``done`` does not hold as often."""
    chosen = F.col(key).isNull()
    if low is not None:
        chosen = chosen | (F.col(key) == _as_key(F.lit(low), df.schema[key].dataType))
    return df.where(chosen).exceptAll(done.where(chosen).select(*df.columns))


class HighWater:
    """High-water marks per table, added to a small Parquet folder after each increment."""

    SCHEMA = "table string, mark string"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def last(self, df: DataFrame, key: str, table: str) -> str | None:
        kind = df.schema[key].dataType
        marks = read_or_empty(self.spark, self.folder, self.SCHEMA).where(F.col("table") == table)
        return marks.agg(_as_text(F.max(_as_key(F.col("mark"), kind)), kind)).first()[0]

    def steps(self, table: str) -> int:
        """How often the mark was set."""
        return read_or_empty(self.spark, self.folder, self.SCHEMA).where(F.col("table") == table).count()

    def advance(self, table: str, mark: str | None) -> None:
        row = self.spark.range(1).select(F.lit(table).alias("table"), F.lit(mark).cast("string").alias("mark"))
        row.write.mode("append").parquet(self.folder)
