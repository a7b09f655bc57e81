"""A relocation job: export to the stage, load, retry, sync and validate."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.functions import paths
from relocate.functions.paths import PARTITION_FIELD, WAVE_FIELD, stage_folder
from relocate.operators import ledger, load, reconcile, stage
from relocate.operators.loads import LoadLog
from relocate.sources import listing, staged
from relocate.specs import Layout, TableSpec
from relocate.streaming.increments import HighWater, extract_increment, high_water, late_rows
from relocate.streaming.load import stream_load


@dataclass(frozen=True)
class Job:
    """Names and folders of a job. All folders must be reachable by every executor.

    ``gather`` is off where the source's files already hold few partitions each, which
    spares the export its only shuffle.
    """

    name: str
    db: str
    stage_root: str
    target_root: str
    ledger_folder: str
    max_rows_per_file: int = 0
    layout: Layout = Layout()
    gather: bool = True
    stage_format: staged.StageFormat = staged.PARQUET
    step: str = ""  # of a sync, which stages beside the table's own files

    @property
    def folder(self) -> str:
        return f"{self.stage_root.rstrip('/')}/{self.name}"

    def stage(self, table: str) -> str:
        return stage_folder(self.stage_root, self.name, self.db, f"{table}@{self.step}" if self.step else table)

    def target(self, table: str) -> str:
        return f"{self.target_root.rstrip('/')}/{self.db}/{table}"

    def ledger(self, spark: SparkSession) -> ledger.Ledger:
        return ledger.Ledger(spark, self.ledger_folder)


def export_table(df: DataFrame, spec: TableSpec, job: Job) -> DataFrame:
    """Stage the selected partitions of a table and record their files.

    Returns rows staged per partition. An empty partition writes nothing. Files that this
    run replaced before they were loaded leave the ledger.
    """
    folder = job.stage(spec.name)
    rows = stage.staged_rows(df, spec)
    within = [WAVE_FIELD] if WAVE_FIELD in df.columns else []
    stage.stage_rows(rows, folder, job.max_rows_per_file, job.layout, job.gather, job.stage_format, within)
    record = job.ledger(df.sparkSession)
    files = record.hold(listing.list_files(df.sparkSession, folder).select("task_name"))
    known = record.hold(ledger.scan(record.current(), folder).select("task_name", "status"))
    record.append(files.join(known, "task_name", "left_anti"), ledger.UPLOADED)
    replaced = known.where(~F.col("status").eqNullSafe(F.lit(ledger.LOADED))).join(files, "task_name", "left_anti")
    record.append(replaced, ledger.PURGED)
    return staged_counts(df.sparkSession, df.drop(stage.CATALOG_FIELD).schema, spec, job)


def staged_counts(spark: SparkSession, schema: T.StructType, spec: TableSpec, job: Job) -> DataFrame:
    """Rows per staged partition."""
    rows = staged.read_staged(spark, job.stage(spec.name), schema, job.stage_format)
    return rows.groupBy(F.col(PARTITION_FIELD).alias("partition")).agg(F.count("*").alias("row_count"))


def import_table(spark: SparkSession, schema: T.StructType, spec: TableSpec, job: Job) -> DataFrame:
    """Load every staged file of a table that is not loaded yet. Returns the status per file."""
    folder = job.stage(spec.name)
    landed = listing.list_files(spark, folder)
    rows = staged.read_staged(spark, folder, schema, job.stage_format)
    return load.load_files(spark, landed, rows, job.target(spec.name), job.ledger(spark), replaces=not spec.unique_key)


def import_announced(
    spark: SparkSession, announced: DataFrame, schema: T.StructType, spec: TableSpec, job: Job
) -> DataFrame:
    """Load the staged files of a table that storage events announced, as ``listing.landed_files`` names them.

    A file that was announced and is not there fails. Returns the status per file.
    """
    folder = job.stage(spec.name)
    own = announced.where(F.regexp_replace(paths.same_file("task_name"), "/+", "/").contains(_tail(folder)))
    rows = staged.read_staged(spark, folder, schema, job.stage_format)
    present, target = listing.list_files(spark, folder), job.target(spec.name)
    return load.load_files(spark, own, rows, target, job.ledger(spark), present, replaces=not spec.unique_key)


def _tail(folder: str) -> str:
    """Job, database and table of a stage folder, as they stand in the names of its files."""
    return "/" + "/".join(folder.rstrip("/").split("/")[-3:]) + "/"


def import_stream(spark: SparkSession, schema: T.StructType, spec: TableSpec, job: Job, checkpoint: str, **limits):
    """Load staged files as they arrive; see ``stream_load``."""
    source, target = job.stage(spec.name), job.target(spec.name)
    return stream_load(
        spark, source, schema, target, checkpoint, job.ledger(spark), stage_format=job.stage_format, **limits
    )


def loaded_table(spark: SparkSession, schema: T.StructType, spec: TableSpec, job: Job) -> DataFrame:
    """The selected partitions of the target table; with a unique key, the latest row of each key."""
    chosen = None if spec.selector.whole_table else spec.selector
    return load.read_loaded(spark, job.target(spec.name), schema, spec.unique_key, spec.version, chosen)


def move_wave(rows: DataFrame, spec: TableSpec, job: Job, wave: int) -> DataFrame:
    """Stage and load one wave of a table; ``rows`` come from ``waves.wave_rows``. Returns the status per file."""
    return move_waves(rows.withColumn(WAVE_FIELD, F.lit(wave).cast("bigint")), spec, job, range(wave, wave + 1))


def move_waves(rows: DataFrame, spec: TableSpec, job: Job, waves: range) -> DataFrame:
    """Stage and load neighbouring waves of a table; ``rows`` come from ``waves.round_rows``. Returns the status per file.

    Each wave has a stage folder and a load of its own beside the table's, whether it is moved alone or with others;
    all share the jobs. A wave that is moved again replaces its own rows.
    """
    spark, own = rows.sparkSession, replace(job, step="waves")
    export_table(rows, spec, own)
    folder, wave = own.stage(spec.name), paths.wave_of("task_name")
    landed = listing.list_files(spark, folder).where(wave.between(waves[0], waves[-1]))
    files = staged.read_staged(spark, folder, rows.schema, job.stage_format)
    files = files.where(F.col(WAVE_FIELD).between(waves[0], waves[-1]))
    record = job.ledger(spark)
    return load.load_files(spark, landed, files, job.target(spec.name), record, replaces=not spec.unique_key, apart=wave)


def retry(
    spark: SparkSession,
    schema: T.StructType,
    spec: TableSpec,
    job: Job,
    partition: str | None = None,
    force: bool = False,
) -> DataFrame:
    """Load files again: those not loaded, all of them (``force``), or all of one partition.

    Files keep their rows apart by load. A file that was loaded before is loaded again as a further copy; tables with a
    unique key show each row once, and in others the earlier copy is withdrawn in the step that shows the new one.
    """
    folder = job.stage(spec.name)
    record = job.ledger(spark)
    rows = staged.read_staged(spark, folder, schema, job.stage_format)
    known = ledger.scan(record.current(), folder)
    present = listing.list_files(spark, folder)
    target, replaces = job.target(spec.name), not spec.unique_key
    begun = record.hold(ledger.unloaded_files(known, known).where(F.col("load_id").isNotNull()).select("task_name"))
    if not begun.isEmpty():
        load.load_files(spark, begun, rows, target, record, present, replaces)
    if partition is not None:
        chosen = ledger.folder_files(ledger.scan(record.current(), folder), partition)
    else:
        chosen = ledger.scan(record.current(), folder, None if force else ledger.LOADED)
    files = record.hold(chosen.select("task_name"))
    if partition is not None and files.isEmpty():
        raise ValueError(f"{spec.name} has no files of partition {partition!r}")
    record.append(files, ledger.RETRY)
    return load.load_files(spark, files, rows, target, record, present, replaces)


def sync_table(
    df: DataFrame, spec: TableSpec, insert_key: str, job: Job, marks: HighWater, high: str | None = None
) -> DataFrame:
    """Stage and load the rows inserted since the last call, then move the high-water mark.

    ``high`` bounds the increment from above, as text like that of ``high_water``; a bound some time in the past
    leaves rows out that may still get company. Rows that came later with the very key of the mark, or with none, are
    taken when the target does not hold them yet. Rows with a key below the mark are not looked for.

    Stage folder and load are named after the mark and the number of syncs so far. A run
    that is cut short leaves both, so the next one replaces its files and its rows.
    Returns rows per partition of the increment.
    """
    spark, rows = df.sparkSession, spec.rows(df)
    low, high = marks.last(df, insert_key, spec.name), high or high_water(rows, insert_key)
    steps = marks.steps(spec.name)
    mark = hashlib.sha256(f"{steps} {low}".encode()).hexdigest()[:16]
    step, label, target = replace(job, step=mark), f"{job.name}-{mark}", job.target(spec.name)
    # what a cut-short run of this very step loaded is replaced below
    done = load.read_loaded(spark, target, df.schema, without=label) if steps else df.limit(0)
    increment = extract_increment(rows, insert_key, low, high).unionByName(late_rows(rows, done, insert_key, low))
    if high == low and increment.isEmpty():
        return increment.groupBy(spec.partition_column().alias("partition")).agg(F.count("*").alias("row_count"))
    report = export_table(increment, spec, step)
    files = staged.read_staged(spark, step.stage(spec.name), df.schema, job.stage_format)
    log = LoadLog(spark, target)
    log.begin(log.named(label))
    load.append_once(files, target, label)
    log.publish(log.named(label))
    landed = listing.list_files(spark, step.stage(spec.name))
    job.ledger(spark).append(landed, ledger.LOADED)
    marks.advance(spec.name, high if high is not None else low)
    return report


def validate(tables: Sequence[tuple[TableSpec, DataFrame, DataFrame]]) -> DataFrame:
    """Two-sided comparison of the source and target of every table; a table that cannot be read raises."""
    return reconcile.reconcile_tables(tables, both_sides=True)


def purge(spark: SparkSession, job: Job) -> None:
    """Take a job's files out of the ledger, and the rows that it imported out of the target tables.

    The rows are withdrawn first, so that files that are imported again never double them. A job that was cut short in
    between is purged again. Rows that a sync loaded stay, as does its high-water mark.
    """
    record = job.ledger(spark)
    loads = ledger.loaded_by(record.events()).join(ledger.scan(record.current(), job.folder), "task_name", "left_semi")
    table = F.regexp_extract(paths.same_file("task_name"), f"/{re.escape(job.name)}/{re.escape(job.db)}/([^/]+)/", 1)
    loads = record.hold(loads.select(table.alias("table"), "load_id").distinct())
    for row in loads.select("table").distinct().collect():
        LoadLog(spark, job.target(row["table"])).withdraw(loads.where(F.col("table") == row["table"]).select("load_id"))
    record.purge(job.folder)
