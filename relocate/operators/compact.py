"""Merging the loads of a target table: chosen by size, published in one step of the table's log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.functions import paths
from relocate.functions.paths import PARTITION_FIELD
from relocate.operators.load import (
    BROADCAST_FILES,
    LITERAL_LIMIT,
    LOAD_FIELD,
    LOAD_TIME,
    counting_rows,
    latest_per_key,
    raw_rows,
)
from relocate.operators.loads import BEGUN, PUBLISHED, WITHDRAWN, LoadLog
from relocate.session import broadcast_below, saved
from relocate.sources import listing

# Loads of a partition are of one tier when their sizes lie between neighbouring powers of this.
TIER_BASE = 4

# Smallest size that counts: smaller loads are all of the lowest tier.
TIER_FLOOR = 1 << 20


def load_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """``(load_id, pt, bytes)`` of each load and partition that counts. From a listing: no file is opened."""
    files = listing.list_files(spark, folder)
    name = paths.decoded(paths.decoded("task_name"))
    found = files.select(
        F.regexp_extract(name, f"/{LOAD_FIELD}=([^/]*)/", 1).alias(LOAD_FIELD),
        paths.folder_value("task_name").alias(PARTITION_FIELD),
        F.col("length").alias("bytes"),
    )
    sizes = found.groupBy(LOAD_FIELD, PARTITION_FIELD).agg(F.sum("bytes").alias("bytes"))
    return counting_rows(sizes, LoadLog(spark, folder))


def size_tiers(sizes: DataFrame, min_loads: int = 4) -> DataFrame:
    """The rows of ``sizes`` to merge: at least ``min_loads`` loads of one partition and one tier.

    A row is rewritten once for each tier that it climbs, so a table that grows by equal loads is rewritten a number of
    times that grows with the logarithm of its size.
    """
    level = F.log(F.greatest(F.col("bytes"), F.lit(TIER_FLOOR)) / F.lit(float(TIER_FLOOR))) / F.log(F.lit(float(TIER_BASE)))
    tiered = sizes.withColumn("tier", F.floor(level).cast("int"))
    merged = tiered.groupBy(PARTITION_FIELD, "tier").agg(F.count("*").alias("n")).where(F.col("n") >= min_loads)
    return tiered.join(merged.select(PARTITION_FIELD, "tier"), [PARTITION_FIELD, "tier"], "left_semi").select(*sizes.columns)


def compact(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    key: Sequence[str] = (),
    version: Sequence[str] = (),
    min_loads: int = 4,
    file_bytes: int = 256 << 20,
    everything: bool = False,
) -> DataFrame:
    """Merge loads of a table filled by ``append_once`` into one, partition by partition. Returns what was merged.

    Loads are chosen by ``size_tiers``, or all of them with ``everything``. With a key, of rows that share it one stays,
    as ``read_loaded`` would choose it; after ``everything`` the table then holds one row a key and is read without a
    shuffle until the next load. Files are of about ``file_bytes``. The merged rows are written to a new load, named
    after what it merges, and shown in the step that withdraws the others: a run that is cut short changes nothing and
    is repeated under the same name. Withdrawn files stay for readers that began before, until ``vacuum``.
    """
    sizes = saved(load_sizes(spark, folder), "load-sizes")
    chosen = sizes if everything else saved(size_tiers(sizes, min_loads), "merged-loads")
    log = LoadLog(spark, folder)
    first, second, count = chosen.agg(
        F.bit_xor(F.xxhash64(LOAD_FIELD, PARTITION_FIELD)),
        F.bit_xor(F.xxhash64(F.lit("compact"), LOAD_FIELD, PARTITION_FIELD)),
        F.count("*"),
    ).first()
    if not count or everything and chosen.select(LOAD_FIELD).distinct().count() == 1 and (not key or log.is_settled()):
        return chosen.limit(0)
    label = f"merged-{count}-{first & (2**64 - 1):016x}{second & (2**64 - 1):016x}"

    names = chosen.select(LOAD_FIELD, PARTITION_FIELD)
    rows = raw_rows(spark, folder, schema)
    if count <= LITERAL_LIMIT:
        listed = [f"{row[0]}/{row[1]}" for row in names.collect()]
        rows = rows.where(F.concat_ws("/", LOAD_FIELD, PARTITION_FIELD).isin(*listed))
    else:
        rows = rows.join(broadcast_below(names, count, BROADCAST_FILES), [LOAD_FIELD, PARTITION_FIELD], "left_semi")
    if key:
        rows = latest_per_key(rows, [*key] if everything else [*key, PARTITION_FIELD], [*version, LOAD_TIME])
    pieces = chosen.groupBy(PARTITION_FIELD).agg(F.ceil(F.sum("bytes") / F.lit(file_bytes)).cast("int").alias("_pieces"))
    piece = F.pmod(F.xxhash64(*(key or [LOAD_TIME, LOAD_FIELD, F.monotonically_increasing_id()])), F.col("_pieces"))
    packed = rows.join(broadcast_below(pieces, count, BROADCAST_FILES), PARTITION_FIELD).withColumn("_piece", piece)
    log.begin(log.named(label))
    (
        packed.repartition(PARTITION_FIELD, "_piece")
        .select(*schema.names, LOAD_TIME, PARTITION_FIELD)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(PARTITION_FIELD)
        .parquet(f"{folder}/{LOAD_FIELD}={label}")
    )
    log.publish(log.named(label), names.select(LOAD_FIELD) if everything else names, settled=bool(key) and everything)
    return chosen


def withdrawn_folders(spark: SparkSession, folder: str, before: int) -> DataFrame:
    """``path`` of the partition folders that the log withdrew before a time, in nanoseconds since 1970.

    Loads that were begun or shown again since are not among them.
    """
    log = LoadLog(spark, folder)
    last = [F.max(F.when(F.col("step") == step, F.col("seq"))).alias(step) for step in (BEGUN, PUBLISHED)]
    loads = log.entries().groupBy("load_id").agg(*last)
    gone = log.entries().where((F.col("step") == WITHDRAWN) & (F.col("seq") < before))
    gone = gone.groupBy("load_id", "pt").agg(F.max("seq").alias("seq")).join(loads, "load_id")
    gone = gone.where(f"seq > coalesce({BEGUN}, -1) AND seq > coalesce({PUBLISHED}, -1)")
    files = listing.list_files(spark, folder)
    path = paths.decoded("task_name")
    found = files.select(
        F.regexp_extract(paths.decoded(path), f"/{LOAD_FIELD}=([^/]*)/", 1).alias("load_id"),
        paths.folder_value("task_name").alias("pt"),
        paths.parent_folder(path).alias("path"),
    ).distinct()
    whole = found.join(gone.where("pt IS NULL"), "load_id", "left_semi")
    parts = found.join(gone.where("pt IS NOT NULL"), ["load_id", "pt"], "left_semi")
    return whole.unionByName(parts).select("path").distinct()


def vacuum(spark: SparkSession, folder: str, before: int) -> int:
    """Remove the folders of ``withdrawn_folders``; how many. No reader may have begun before that time."""
    make, settings, removed = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration(), 0
    for row in withdrawn_folders(spark, folder, before).toLocalIterator():
        path = make(row["path"])
        removed += path.getFileSystem(settings).delete(path, True)
    return removed
