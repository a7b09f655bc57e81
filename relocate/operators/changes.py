"""Tables that follow a log of changes: rows set and rows deleted, in whatever order they arrive.

The state of a key is its change of the highest sequence. A delete is kept as a marker, so that an earlier change that
arrives later does not bring the row back; markers go when they are older than the watermark, and changes older than
that are refused. So the table depends on the changes alone and not on their order or batches, as long as none is late.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.functions.paths import PARTITION_FIELD
from relocate.operators.load import LOAD_FIELD, LOAD_TIME, append_once, counting_rows, latest_per_key, raw_rows
from relocate.operators.loads import LoadLog
from relocate.operators.stage import gathered
from relocate.session import few_values, read_or_empty, saved

# Columns of the stored state beside those of the changes.
DELETED, BUCKET = "_deleted", "_bucket"

# Up to this many buckets are named to the scan as literals; more are joined.
LITERAL_BUCKETS = 1000


@dataclass(frozen=True)
class ChangeTable:
    """A table of keyed rows at ``folder``, kept in ``buckets`` of its key.

    ``sequence`` orders the changes of a key and rises with ``time``, which says when one was made; ``keep`` is for how
    long after the newest time seen a change may still arrive, an interval text such as ``2 days``. One batch may be applied at a time.
    """

    spark: SparkSession
    folder: str
    schema: T.StructType
    key: Sequence[str]
    sequence: Sequence[str]
    time: str
    keep: str
    buckets: int = 256

    @property
    def _state(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(DELETED, T.BooleanType())])

    @property
    def _marks(self) -> str:
        return f"{self.folder.rstrip('/')}/_marks"

    def _seen(self, without: str | None = None) -> DataFrame:
        """``batch, newest``: the newest time of each batch so far."""
        kind = self.schema[self.time].dataType.simpleString()
        marks = read_or_empty(self.spark, self._marks, f"batch string, newest {kind}")
        return marks if without is None else marks.where(F.col("batch") != without)

    def watermark(self, without: str | None = None):
        """Times below this are past; None before the first batch."""
        newest = F.max("newest") - F.expr(f"INTERVAL {self.keep}")
        return self._seen(without).agg(newest.cast(self.schema[self.time].dataType).cast("string")).first()[0]

    def _stored(self) -> DataFrame:
        return counting_rows(raw_rows(self.spark, self.folder, self._state), LoadLog(self.spark, self.folder))

    def rows(self) -> DataFrame:
        """The rows that are there, one for each key."""
        if LoadLog(self.spark, self.folder).published().isEmpty():
            return self.spark.createDataFrame([], self.schema)
        return self._stored().where(f"NOT {DELETED}").select(*self.schema.names)

    def apply(self, changes: DataFrame, batch: str, deleted: str | Column) -> DataFrame:
        """Apply a batch of changes, those for which ``deleted`` holds as deletes. Returns the late ones, not applied.

        Only the buckets with changed keys are read and written. Their new state is shown in one step; a batch that is
        cut short and applied again under its name replaces its own rows, and one that was applied changes nothing.
        """
        log = LoadLog(self.spark, self.folder)
        label = f"batch-{hashlib.sha256(batch.encode()).hexdigest()[:24]}"
        past, kind = self.watermark(without=batch), self.schema[self.time].dataType
        gone = F.expr(deleted) if isinstance(deleted, str) else deleted
        marked = changes.select(*self.schema.names, F.coalesce(gone, F.lit(False)).alias(DELETED))
        late = F.lit(False) if past is None else F.coalesce(F.col(self.time) < F.lit(past).cast(kind), F.lit(False))
        marked = saved(marked.withColumn("_late", late), "changes")
        due = marked.where("NOT _late").drop("_late")
        # of many changes of a key one leaves each task
        due = latest_per_key(due, self.key, self.sequence).withColumn(BUCKET, self._bucket_of())
        shown = [row["load_id"] == label for row in log.published().orderBy(F.col("load_id") != label).limit(1).collect()]
        # a batch that was shown has been merged, and its rows may have been merged further
        if True not in shown:
            due = saved(due, "due-changes")
            touched = few_values(due, BUCKET, LITERAL_BUCKETS)
            if touched != []:
                self._merge(due, touched, label, log, past, bool(shown))
        newest = marked.agg(F.max(self.time).alias("newest")).select(F.lit(batch).alias("batch"), "newest")
        newest.where("newest IS NOT NULL").coalesce(1).write.mode("append").parquet(self._marks)
        return marked.where("_late").select(*self.schema.names)

    def _bucket_of(self) -> Column:
        number = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("string")
        return F.concat(F.lit("b"), F.lpad(number, 6, "0"))

    def _merge(self, due: DataFrame, touched: list | None, label: str, log: LoadLog, past: str | None, stored: bool) -> None:
        both, replaced = due, None
        if stored:
            old = self._stored()
            if touched is None:
                old = old.join(due.select(F.col(BUCKET).alias(PARTITION_FIELD)).distinct(), PARTITION_FIELD, "left_semi")
            else:
                old = old.where(F.col(PARTITION_FIELD).isin(*touched))
            replaced = saved(old.select(F.col(LOAD_FIELD).alias("load_id"), F.col(PARTITION_FIELD).alias("pt")).distinct(), "replaced")
            both = old.withColumnRenamed(PARTITION_FIELD, BUCKET).drop(LOAD_FIELD, LOAD_TIME).unionByName(due)
        merged = latest_per_key(both, self.key, self.sequence)
        if past is not None:
            expired = F.col(DELETED) & (F.col(self.time) < F.lit(past).cast(self.schema[self.time].dataType))
            merged = merged.where(~F.coalesce(expired, F.lit(False)))
        log.begin(log.named(label))
        rows = merged.withColumnRenamed(BUCKET, PARTITION_FIELD)
        append_once(gathered(rows, PARTITION_FIELD), self.folder, label)
        log.publish(log.named(label), replaced)
