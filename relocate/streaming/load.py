"""Continuous load of staged files."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.operators import ledger
from relocate.operators.load import append_once
from relocate.operators.loads import LoadLog
from relocate.sources.staged import PARQUET, StageFormat, staged_schema, with_file


def stream_load(
    spark: SparkSession,
    stage_folder: str,
    schema: T.StructType,
    target_folder: str,
    checkpoint: str,
    record: ledger.Ledger | None = None,
    max_bytes_per_trigger: int | None = None,
    max_files_per_trigger: int | None = None,
    drain: bool = True,
    stage_format: StageFormat = PARQUET,
):
    """Load staged files as they arrive; with ``drain`` stop when none is left.

    The checkpoint remembers which files were read. Each micro-batch writes into a folder
    named after the checkpoint and the batch, so a batch that is replayed after a failure
    replaces its own rows; they are shown all at once. Files are recorded as loaded after that.
    """
    reader = spark.readStream.format(stage_format.name).schema(staged_schema(schema)).options(**stage_format.options)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = with_file(reader.load(stage_folder))
    stream_name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def load(batch: DataFrame, batch_id: int) -> None:
        log, label = LoadLog(spark, target_folder), f"{stream_name}-{batch_id}"
        log.begin(log.named(label))
        append_once(batch.drop("task_name"), target_folder, label)
        log.publish(log.named(label))
        if record is not None:
            counts = batch.groupBy("task_name").agg(F.count("*").alias("row_count"))
            record.append(counts, ledger.LOADED, F.col("row_count").cast("string"))

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer).start()
