"""Loading staged rows: append once per load, or upsert by key."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.functions.paths import PARTITION_FIELD, WAVE_FIELD, folder_value, parent_folder, same_file
from relocate.operators import ledger
from relocate.operators.loads import LoadLog
from relocate.operators.stage import partition_writer
from relocate.session import broadcast_below, few_values
from relocate.sources.staged import with_file
from relocate.specs import UNASSIGNED, Selector, Store, TableSpec

# Folder column of a target table: the load that wrote the rows.
LOAD_FIELD = "load_id"

# Column of a target table: when its load ran, in nanoseconds since 1970.
LOAD_TIME = "loaded_at"

# Up to this many files or partitions are named to the scan as literals; more are joined.
LITERAL_LIMIT = 1000

# Longest list of file names that is sent to every executor.
BROADCAST_FILES = 500_000


def file_counts(staged: DataFrame) -> DataFrame:
    """Row count of each staged file; Parquet answers from its footers."""
    return with_file(staged).groupBy("task_name").agg(F.count("*").alias("row_count"))


def file_load_status(landed: DataFrame, counts: DataFrame) -> DataFrame:
    """Outcome of each landed file. A file without rows is a success with nothing written.

    Where ``landed`` has ``found``, a file for which it is false was announced and does not exist: it failed.
    """
    rows = F.coalesce("row_count", F.lit(0).cast("bigint"))
    status = F.lit(ledger.LOADED)
    if "found" in landed.columns:
        status = F.when(F.col("found"), status).otherwise(ledger.FAILED)
    return landed.join(counts, "task_name", "left").select(
        "task_name", rows.alias("row_count"), (rows > 0).alias("written"), status.alias("status")
    )


def existing_files(landed: DataFrame, present: DataFrame) -> DataFrame:
    """``landed`` under the names that ``present``, a listing, has for the same files, and whether they are ``found``.

    Names may differ in scheme and percent-encoding.
    """
    listed = present.select(F.col("task_name").alias("_listed"), same_file("task_name").alias("_same"))
    return (
        landed.withColumn("_same", same_file("task_name"))
        .join(listed, "_same", "left")
        .select(F.coalesce("_listed", "task_name").alias("task_name"), F.col("_listed").isNotNull().alias("found"))
        .distinct()
    )


def wanted_files(counts: DataFrame, pending: DataFrame) -> DataFrame:
    """The files of a staged table with ``wanted`` true for those that are to be loaded."""
    flag = pending.select("task_name", F.lit(True).alias("wanted"))
    return counts.join(flag, "task_name", "left").withColumn("wanted", F.coalesce("wanted", F.lit(False)))


def load_plan(marked: DataFrame) -> tuple[str, int, int]:
    """Label of a load, files to take and files to leave out.

    The label is the same whenever the same files are loaded.
    """
    label, taken, total = marked.agg(_label(F.col("wanted")), F.count_if("wanted"), F.count("*")).first()
    return label, taken, total - taken


def _label(wanted: Column) -> Column:
    """Label of a load of the ``wanted`` files, as an aggregate: their number and sums of hashes of their names."""
    hashes = [F.xxhash64("task_name"), F.xxhash64(F.lit("label"), F.col("task_name"))]
    sums = [F.coalesce(F.bit_xor(F.when(wanted, value)), F.lit(0).cast("bigint")) for value in hashes]
    return F.concat(F.count_if(wanted).cast("string"), F.lit("-"), *[F.lower(F.lpad(F.hex(s), 16, "0")) for s in sums])


def rows_of_files(staged: DataFrame, marked: DataFrame, taken: int, left_out: int) -> DataFrame:
    """Rows of the wanted files of a staged table.

    Nothing is filtered where every file is wanted. A short list of files to take, or to
    leave out, goes to the scan as literals, which opens no other file. Between two long
    lists the shorter is broadcast while it is within ``BROADCAST_FILES``, and joined by
    a shuffle beyond.
    """
    rows = with_file(staged)
    if not left_out:
        return rows
    take = taken <= left_out
    shorter = marked.where(F.col("wanted") if take else ~F.col("wanted")).select("task_name")
    names = few_values(shorter, "task_name", LITERAL_LIMIT)
    if names is None:
        shorter = broadcast_below(shorter, min(taken, left_out), BROADCAST_FILES)
        return rows.join(shorter, "task_name", "left_semi" if take else "left_anti")
    listed = F.col("task_name").isin(*names) if names else F.lit(False)
    return rows.where(listed if take else ~listed)


def append_once(df: DataFrame, folder: str, load_id: str) -> None:
    """Append staged rows in a folder of their load, keeping their partition folders.

    No shuffle: each task writes what it scanned. Running the load again replaces all of
    its own rows, written in full or in part, and no others.
    """
    (
        df.withColumn(LOAD_TIME, F.lit(time.time_ns()))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(PARTITION_FIELD)
        .parquet(f"{folder}/{LOAD_FIELD}={load_id}")
    )


def read_loaded(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    key: Sequence[str] = (),
    version: Sequence[str] = (),
    partitions: Selector | None = None,
    without: str | None = None,
) -> DataFrame:
    """Rows of a table that was filled by ``append_once``, or of some of its partitions; those of load ``without`` not.

    What the table's log hides is left out, by folder. With a key the table shows one row per key: the highest
    version, and of equal ones the row that was loaded last. A table that was compacted by that key, and not loaded
    since, needs no shuffle for it.
    """
    log = LoadLog(spark, folder)
    rows = counting_rows(raw_rows(spark, folder, schema), log)
    if partitions is not None and partitions != Selector():
        rows = rows.where(partitions.keeps(PARTITION_FIELD) & (F.col(PARTITION_FIELD) != UNASSIGNED))
    if without is not None:
        rows = rows.where(F.col(LOAD_FIELD) != without)
    if key and not log.is_settled():
        rows = latest_per_key(rows, key, [*version, LOAD_TIME])
    return rows.select(*schema.names)


def raw_rows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All rows in the folders of a table's loads, with load time, load and partition."""
    fields = [T.StructField(LOAD_TIME, T.LongType())]
    fields += [T.StructField(name, T.StringType()) for name in (LOAD_FIELD, PARTITION_FIELD)]
    return spark.read.schema(T.StructType([*schema.fields, *fields])).parquet(folder)


def counting_rows(rows: DataFrame, log: LoadLog) -> DataFrame:
    """Rows of loads without those that the log hides. A short list is pruned by folder, a longer one joined."""
    hidden = log.hidden()
    first = hidden.limit(LITERAL_LIMIT + 1).collect()
    if len(first) <= LITERAL_LIMIT:
        whole = [row["load_id"] for row in first if row["pt"] is None]
        parts = [f"{row['load_id']}/{row['pt']}" for row in first if row["pt"] is not None]
        if whole:
            rows = rows.where(~F.col(LOAD_FIELD).isin(*whole))
        if parts:
            rows = rows.where(~F.concat_ws("/", LOAD_FIELD, PARTITION_FIELD).isin(*parts))
        return rows
    whole = hidden.where("pt IS NULL").select(F.col("load_id").alias(LOAD_FIELD))
    parts = hidden.where("pt IS NOT NULL").select(F.col("load_id").alias(LOAD_FIELD), F.col("pt").alias(PARTITION_FIELD))
    count = hidden.count()
    rows = rows.join(broadcast_below(whole, count, BROADCAST_FILES), LOAD_FIELD, "left_anti")
    return rows.join(broadcast_below(parts, count, BROADCAST_FILES), [LOAD_FIELD, PARTITION_FIELD], "left_anti")


def direct_copy(df: DataFrame, spec: TableSpec, target: Store, table: str | None = None) -> None:
    """Copy the rows a spec covers straight into another store, without staging."""
    target.append(spec.rows(df), table or spec.name)


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString()


def latest_per_key(df: DataFrame, key: Sequence[str], version: Sequence[str | Column]) -> DataFrame:
    """The row with the highest version for each key; NULL keys count as equal.

    Spark keeps one row per key in every map task before the shuffle (a window group
    limit), so a key that holds much of the table costs one row per task.
    """
    order = [(F.col(v) if isinstance(v, str) else v).desc_nulls_last() for v in version]
    # rows of equal version are told apart by what they hold, so that each read gives the same one
    order.append(F.xxhash64(*[F.to_json(F.struct(f.name)) if _has_map(f.dataType) else F.col(f.name) for f in df.schema]).desc())
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*key).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def upsert_by_key(
    base: DataFrame, increment: DataFrame, key: Sequence[str], version: Sequence[str] = ()
) -> DataFrame:
    """``base`` with the rows of ``increment`` replacing those of the same key.

    With ``version`` columns the highest version wins and the increment wins ties;
    without, the increment always wins.
    """
    both = base.withColumn("_newer", F.lit(0)).unionByName(increment.withColumn("_newer", F.lit(1)))
    return latest_per_key(both, key, [*version, "_newer"]).drop("_newer")


def upsert_table(
    spark: SparkSession,
    folder: str,
    increment: DataFrame,
    key: Sequence[str],
    version: Sequence[str] = (),
    max_rows_per_file: int = 0,
) -> None:
    """Upsert into a table of partition folders, rewriting only the partitions that the increment touches.

    ``increment`` has the table's columns and ``pt``. A key must stay in its partition, as
    it does where the partition is derived from key columns.
    """
    base = spark.read.schema(increment.schema).parquet(folder)
    touched = few_values(increment, PARTITION_FIELD, LITERAL_LIMIT)
    if touched is None:
        base = base.join(increment.select(PARTITION_FIELD).distinct(), PARTITION_FIELD, "left_semi")
    elif touched:
        base = base.where(F.col(PARTITION_FIELD).isin(*touched))
    else:
        return
    merged = upsert_by_key(base, increment, [*key, PARTITION_FIELD], version)
    partition_writer(merged, max_rows_per_file).parquet(folder)


@dataclass(frozen=True)
class _Target:
    """Where files are loaded to, and what their loads replace: rows of ``replaced`` ``(load_id, pt, place)``."""

    spark: SparkSession
    staged: DataFrame
    folder: str
    record: ledger.Ledger
    replaced: DataFrame | None = None

    @property
    def log(self) -> LoadLog:
        return LoadLog(self.spark, self.folder)

    def instead_of(self, files: DataFrame, labels: DataFrame) -> DataFrame | None:
        """What is withdrawn when the files are published under the labels."""
        if self.replaced is None:
            return None
        places = files.select(parent_folder("task_name").alias("place")).distinct()
        return self.replaced.join(places, "place", "left_semi").join(labels, "load_id", "left_anti").select("load_id", "pt")


def _load(pending: DataFrame, target: _Target, label: str | None = None) -> DataFrame:
    record, log = target.record, target.log
    marked = record.hold(wanted_files(file_counts(target.staged), pending))
    own_label, taken, left_out = load_plan(marked)
    label = label or own_label
    record.append(pending, ledger.LOADING, load_id=label)
    log.begin(log.named(label))
    try:
        rows = rows_of_files(target.staged, marked, taken, left_out)
        append_once(rows.drop("task_name", WAVE_FIELD), target.folder, label)
    except Exception as error:
        record.append(pending, ledger.FAILED, str(error), label)
        raise
    log.publish(log.named(label), target.instead_of(pending, log.named(label)))
    status = file_load_status(pending, marked.select("task_name", "row_count"))
    record.append(status, ledger.LOADED, F.col("row_count").cast("string"), label)
    return status


def _record_published(begun: DataFrame, target: _Target) -> None:
    """Outcomes of loads that were published before their record was written in full."""
    counts = file_counts(target.staged).join(begun, "task_name", "left_semi")
    status = file_load_status(begun.select("task_name"), counts).join(begun.select("task_name", "load_id"), "task_name")
    target.record.append(target.record.hold(status), ledger.LOADED, F.col("row_count").cast("string"), F.col("load_id"))


def settle_open_loads(unloaded: DataFrame, target: _Target) -> bool:
    """Finish loads that failed or were cut short, each with its own files under its own label.

    ``unloaded`` comes from ``ledger.unloaded_files`` and is held. Loads that were published are only recorded; the
    others run again, all labels in one job, which replaces the partition folders that they write. Tells whether there
    were any.
    """
    begun = unloaded.where(F.col("load_id").isNotNull())
    if few_values(begun, "load_id", 1) == []:
        return False
    published = target.log.published().select("load_id")
    finished = target.record.hold(begun.join(published, "load_id", "left_semi"))
    if not finished.isEmpty():
        _record_published(finished, target)
        begun = target.record.hold(begun.join(finished, "task_name", "left_anti").select(*begun.columns))
    first = few_values(begun, "load_id", 1)
    if first == []:
        return True
    if first is not None:
        _load(begun.select("task_name"), target, first[0])
        return True
    counts = target.record.hold(file_counts(target.staged).join(begun, "task_name", "left_semi"))
    names = broadcast_below(begun.select("task_name", "load_id"), begun.count(), BROADCAST_FILES)
    rows = with_file(target.staged).join(names, "task_name").drop("task_name", WAVE_FIELD)
    labels = begun.select("load_id").distinct()
    target.log.begin(labels)
    try:
        (
            rows.withColumn(LOAD_TIME, F.lit(time.time_ns()))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(LOAD_FIELD, PARTITION_FIELD)
            .parquet(target.folder)
        )
    except Exception as error:
        target.record.append(begun, ledger.FAILED, str(error), F.col("load_id"))
        raise
    target.log.publish(labels, target.instead_of(begun, labels))
    status = file_load_status(begun.select("task_name"), counts).join(begun.select("task_name", "load_id"), "task_name")
    target.record.append(status, ledger.LOADED, F.col("row_count").cast("string"), F.col("load_id"))
    return True


def load_files(
    spark: SparkSession,
    landed: DataFrame,
    staged: DataFrame,
    folder: str,
    record: ledger.Ledger,
    present: DataFrame | None = None,
    replaces: bool = False,
    apart: Column | None = None,
) -> DataFrame:
    """Load the landed files that the ledger does not show as loaded, and record every outcome.

    ``landed`` must be listed before ``staged`` is read: a file that arrives in between is
    then left to the next load. Where it is no listing, as with announced files, ``present``
    is one: names are matched whatever their scheme and encoding, and a file that does not
    exist is recorded as failed. All files go in one job, into a folder named after the
    load's label. The label is in the ledger before the rows are written, and they are shown
    all at once when they are written; a load that was cut short at any point is first
    finished with the same files and label, so that no row is lost or doubled. One load per
    target table may run at a time. Returns the status of the files that were not loaded
    when it began.

    With ``replaces``, for tables without a unique key, a load takes the place of what was
    loaded before from the same partition folders of the stage and is no longer there, or is
    loaded again: those rows are withdrawn in the step that shows the new ones. Files that
    were loaded together with them, and still exist, are loaded again as well.

    With ``apart``, files for which it has different values are different loads, each with a label of its own, written
    in one job.
    """
    missing, listed = None, landed
    if present is not None:
        known = record.hold(existing_files(landed, present))
        missing = known.where("NOT found")
        record.append(missing, ledger.FAILED, "no such file")
        landed, listed = known.where("found"), present
    status = _load_files(landed, listed if replaces else None, _Target(spark, staged, folder, record), apart)
    if missing is None:
        return status
    nothing = missing.select("task_name", F.lit(0).cast("bigint").alias("row_count")).limit(0)
    return status.unionByName(file_load_status(missing, nothing))


def _load_files(landed: DataFrame, listed: DataFrame | None, target: _Target, apart: Column | None = None) -> DataFrame:
    record = target.record
    unloaded = record.hold(ledger.unloaded_files(landed, record.current()))
    if unloaded.isEmpty():
        return file_load_status(unloaded, unloaded.select("task_name", F.lit(0).cast("bigint").alias("row_count")))
    if listed is not None:
        unloaded, target = _replacing(unloaded, listed, target)
    if apart is not None:
        unloaded = _begun_apart(unloaded, apart, record)
    if not settle_open_loads(unloaded, target):
        return _load(unloaded.select("task_name"), target)
    pending = unloaded.where(F.col("load_id").isNull()).select("task_name")
    if not pending.isEmpty():
        _load(pending, target)
    counts = record.current().select("task_name", F.col("msg").cast("bigint").alias("row_count"))
    return record.hold(file_load_status(unloaded.select("task_name"), counts.join(unloaded, "task_name", "left_semi")))


def _begun_apart(unloaded: DataFrame, apart: Column, record: ledger.Ledger) -> DataFrame:
    """``unloaded`` with a load begun for each value of ``apart`` of the files that are in none."""
    fresh = unloaded.where(F.col("load_id").isNull()).select("task_name", apart.alias("_apart"))
    labels = fresh.groupBy("_apart").agg(_label(F.lit(True)).alias("load_id"))
    named = record.hold(fresh.join(labels, fresh["_apart"].eqNullSafe(labels["_apart"])).select("task_name", "load_id"))
    record.append(named, ledger.LOADING, load_id=F.col("load_id"))
    return record.hold(unloaded.where(F.col("load_id").isNotNull()).unionByName(named))


def _replacing(unloaded: DataFrame, listed: DataFrame, target: _Target) -> tuple[DataFrame, _Target]:
    """The files to load, with those that have to be loaded again beside them, and the target with what they replace."""
    record = target.record
    places = unloaded.select(parent_folder("task_name").alias("place")).distinct()
    earlier = ledger.loaded_by(record.events()).withColumn("place", parent_folder("task_name"))
    earlier = record.hold(earlier.join(places, "place", "left_semi"))
    if earlier.isEmpty():
        return unloaded, target
    again = unloaded.select("task_name", F.lit(True).alias("again"))
    here = listed.select("task_name", F.lit(True).alias("here"))
    judged = earlier.join(again, "task_name", "left").join(here, "task_name", "left")
    stale = judged.where("again OR here IS NULL").select("load_id", "place", folder_value("task_name").alias("pt")).distinct()
    stale = record.hold(stale)
    beside = judged.where("again IS NULL AND here").join(stale, ["load_id", "place"], "left_semi").select("task_name")
    more = beside.select("task_name", F.lit(None).cast("string").alias("load_id"))
    return record.hold(unloaded.unionByName(more)), replace(target, replaced=stale)
