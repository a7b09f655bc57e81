"""Finished files: from a folder listing or from storage events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relocate.functions import messages, paths


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths and sizes of the finished files below ``folder``, empty ones included. No file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.col("_metadata.file_path").alias("task_name"), "length").where(
        paths.is_landed(F.col("task_name"))
    )


def event_keys(events: DataFrame, body: str = "body") -> DataFrame:
    """One row per record of a storage event: bucket, encoded object key and both joined."""
    record = events.select(
        F.explode(F.from_json(body, messages.STORAGE_EVENT_SCHEMA)["Records"]).alias("record")
    )
    bucket, key = F.col("record.s3.bucket.name"), F.col("record.s3.object.key")
    return record.select(bucket.alias("bucket"), key.alias("key"), F.concat_ws("/", bucket, key).alias("raw_path"))


def landed_files(keys: DataFrame, raw_path: str = "raw_path") -> DataFrame:
    """Distinct finished files. Keys are decoded before their endings are tested."""
    return (
        keys.select(F.concat(F.lit("s3://"), paths.decoded_key(F.col(raw_path))).alias("task_name"))
        .where(paths.is_landed(F.col("task_name")))
        .distinct()
    )
