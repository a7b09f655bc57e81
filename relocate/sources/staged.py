"""Readers for staged Parquet and delimited text."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.functions.paths import PARTITION_FIELD

# Separators of staged text.
STAGE_SEPARATOR = "|#"
PLAIN_SEPARATOR = "|"


def text_options(separator: str = STAGE_SEPARATOR, line_breaks: bool = True) -> dict[str, str]:
    """CSV options that return every value as it was written, used by the reader and the writer.

    ``line_breaks`` lets values hold line breaks, at the price that a file is one task;
    the row cap of the staged files keeps that task small.
    """
    return {
        "sep": separator,
        "header": "false",
        "nullValue": "\\N",
        "escape": '"',
        "multiLine": str(line_breaks).lower(),
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "mode": "FAILFAST",
    }


@dataclass(frozen=True)
class StageFormat:
    """A Spark file format and the options that its reader and writer share."""

    name: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)


PARQUET = StageFormat()


def text_format(separator: str = STAGE_SEPARATOR, line_breaks: bool = True) -> StageFormat:
    return StageFormat("csv", text_options(separator, line_breaks))


def staged_schema(schema: T.StructType) -> T.StructType:
    """Schema of a staged table: the table's columns and the partition name."""
    return T.StructType([*schema.fields, T.StructField(PARTITION_FIELD, T.StringType())])


def read_staged(
    spark: SparkSession, folder: str, schema: T.StructType, stage_format: StageFormat = PARQUET
) -> DataFrame:
    """All staged files of a table in one scan, with the partition name in ``pt``.

    For text without a header ``schema`` gives the columns in the order of the files.
    """
    reader = spark.read.format(stage_format.name).schema(staged_schema(schema))
    return reader.options(**stage_format.options).load(folder)


def with_file(df: DataFrame) -> DataFrame:
    """Add the path of the file that a row came from as ``task_name``."""
    return df.withColumn("task_name", F.col("_metadata.file_path"))
