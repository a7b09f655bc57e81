"""Which loads of a target table count: a log beside their folders.

The rows of a load lie in a folder of its label. The log says when a load was begun, published or withdrawn, as a whole
or in one partition; entries are only added, and all entries of one step are one file, so a step is seen whole or not
at all. A load that was begun and not published is hidden, and so is what was withdrawn later than it was published.
Loads that the log does not name are shown.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relocate.session import read_or_empty

# Folder of the log in a table's folder; the mark in front keeps it out of reads of the table.
LOG_FOLDER = "_loads"

# Steps of a load.
BEGUN, PUBLISHED, WITHDRAWN = "begun", "published", "withdrawn"

SCHEMA = "load_id string, pt string, step string, seq bigint, settled boolean"


class LoadLog:
    """The log of the table at ``folder``. One writer at a time."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = f"{folder.rstrip('/')}/{LOG_FOLDER}"

    def entries(self) -> DataFrame:
        return read_or_empty(self.spark, self.folder, SCHEMA)

    def _add(self, rows: DataFrame) -> None:
        rows.withColumn("seq", F.lit(time.time_ns())).select("load_id", "pt", "step", "seq", "settled").coalesce(1).write.mode(
            "append"
        ).parquet(self.folder)

    def _rows(self, loads: DataFrame, step: str, settled: bool = False) -> DataFrame:
        """Entries for ``load_id`` and, where there is one, ``pt``."""
        part = F.col("pt") if "pt" in loads.columns else F.lit(None)
        return loads.select("load_id", part.cast("string").alias("pt"), F.lit(step).alias("step"), F.lit(settled).alias("settled"))

    def begin(self, loads: DataFrame) -> None:
        """Hide the named loads while their rows are written."""
        self._add(self._rows(loads, BEGUN))

    def publish(self, loads: DataFrame, instead_of: DataFrame | None = None, settled: bool = False) -> None:
        """Show the named loads and withdraw ``(load_id, pt)`` of others, in one step.

        ``settled`` loads hold one row of each key of the whole table.
        """
        rows = self._rows(loads, PUBLISHED, settled)
        self._add(rows if instead_of is None else rows.unionByName(self._rows(instead_of.distinct(), WITHDRAWN)))

    def withdraw(self, loads: DataFrame) -> None:
        """Hide the named loads, or partitions of them, for good; a load of the same label may be published again."""
        self._add(self._rows(loads, WITHDRAWN))

    def published(self) -> DataFrame:
        """Labels of the loads that were published since they were last begun, with ``settled``."""
        return self._states().where("shown > hidden").select("load_id", "settled")

    def is_settled(self) -> bool:
        """Whether a single load counts, and that one is settled."""
        first = self.published().limit(2).collect()
        return len(first) == 1 and bool(first[0]["settled"])

    def named(self, *labels: str) -> DataFrame:
        return self.spark.createDataFrame([(label,) for label in labels], "load_id string")

    def _states(self) -> DataFrame:
        def last(step: str):
            return F.max(F.when((F.col("step") == step) & F.col("pt").isNull(), F.col("seq")))

        shown = F.coalesce(last(PUBLISHED), F.lit(-1))
        hidden = F.coalesce(F.greatest(last(BEGUN), last(WITHDRAWN)), F.lit(-1))
        settled = F.max_by("settled", F.when(F.col("step") == PUBLISHED, F.col("seq")))
        return self.entries().groupBy("load_id").agg(shown.alias("shown"), hidden.alias("hidden"), settled.alias("settled"))

    def hidden(self) -> DataFrame:
        """``(load_id, pt)`` of what does not count; ``pt`` is NULL for a whole load."""
        states = self._states()
        whole = states.where("hidden > shown").select("load_id", F.lit(None).cast("string").alias("pt"))
        parts = self.entries().where(f"step = '{WITHDRAWN}' AND pt IS NOT NULL").groupBy("load_id", "pt").agg(F.max("seq").alias("seq"))
        in_part = parts.join(states.where("shown >= hidden"), "load_id", "left").where("seq > coalesce(shown, -1)")
        return whole.unionByName(in_part.select("load_id", "pt"))
