"""Paths, keys, labels and times."""

from pyspark.sql import functions as F

from relocate.checks import fixtures as fx
from relocate.checks import query
from relocate.functions import messages, paths, times
from relocate.sources import listing

_TASKS = f"SELECT DISTINCT task_name FROM ({fx.SQL_LEDGER})"

# Fixed value: stands for the time of a load, so that a repeated run gives the same rows.
_LOADED_AT = "2024-02-01 00:00:00"


def _tasks(spark, folder):
    return fx.ledger_events(spark, folder).select("task_name").distinct()


@query(
    "task_path_parse",
    f"""
SELECT task_name, p[3] AS bucket, p[4] AS prefix, p[5] AS job, p[6] AS db, p[7] AS "table", p[8] AS "partition",
       p[9] AS file
FROM (SELECT task_name, string_split(task_name, '/') AS p FROM ({_TASKS}))""",
)
def task_path_parse(spark, folder):
    return _tasks(spark, folder).select("task_name", *paths.task_fields("task_name"))


@query(
    "task_path_build",
    """
SELECT DISTINCT 's3://b/stage/job' || (user_id % 12) || '/db/' || event_type || '/p' || strftime(ts, '%Y%m%d')
       || '/f' || user_id || '.parquet' AS task_name
FROM events""",
)
def task_path_build(spark, folder):
    """Roots with and without a slash at the end build the same path."""
    root = F.when(F.col("user_id") % 2 == 0, "s3://b/stage/").otherwise("s3://b/stage")
    name = F.concat(F.lit("f"), F.col("user_id").cast("string"), F.lit(".parquet"))
    job = F.concat(F.lit("job"), (F.col("user_id") % 12).cast("string"))
    day = F.concat(F.lit("p"), F.date_format("ts", "yyyyMMdd"))
    built = paths.task_path(root, job, F.lit("db"), F.col("event_type"), day, name)
    return fx.table(spark, folder, "events").select(built.alias("task_name")).distinct()


@query(
    "path_scheme_rewrite",
    f"SELECT task_name, 's3a:' || task_name[4:] AS path FROM ({_TASKS})",
)
def path_scheme_rewrite(spark, folder):
    return _tasks(spark, folder).select("task_name", paths.hadoop_scheme(F.col("task_name")).alias("path"))


@query(
    "url_decode_key",
    f"SELECT event_id, 's3://b/' || url_decode(replace(key, '+', ' ')) AS task_name FROM ({fx.SQL_KEYS})",
)
def url_decode_key(spark, folder):
    keys = fx.object_keys(spark, folder)
    return keys.select("event_id", F.concat(F.lit("s3://b/"), paths.decoded_key(F.col("key"))).alias("task_name"))


def _storage_events(spark, folder):
    """A storage event per row, with the object and its checksum file as two records."""

    def record(key):
        return F.struct(
            F.struct(F.struct(F.lit("b").alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object")).alias(
                "s3"
            )
        )

    key = F.col("key")
    records = F.array(record(key), record(F.concat(key, F.lit(".crc"))))
    return fx.object_keys(spark, folder).select(F.to_json(F.struct(records.alias("Records"))).alias("body"))


_SQL_RECORDS = f"""
SELECT 'b' AS bucket, key || suffix AS key, 'b/' || key || suffix AS raw_path
FROM ({fx.SQL_KEYS}), (VALUES (''), ('.crc')) v(suffix)"""


@query("storage_event_explode", _SQL_RECORDS)
def storage_event_explode(spark, folder):
    return listing.event_keys(_storage_events(spark, folder))


@query(
    "landed_files",
    f"""
SELECT DISTINCT task_name
FROM (SELECT 's3://' || url_decode(replace(raw_path, '+', ' ')) AS task_name FROM ({_SQL_RECORDS}))
WHERE regexp_matches(task_name, '\\.(csv|parquet)$') AND NOT contains(task_name, '_temporary')
  AND NOT starts_with(split_part(task_name, '/', -1), '.')""",
)
def landed_files(spark, folder):
    return listing.landed_files(listing.event_keys(_storage_events(spark, folder)))


@query(
    "load_label",
    f"""
SELECT task_name, p[7] || '_' || left(sha256(p[5] || '#' || p[7] || '#' || p[9]), 32) AS label
FROM (SELECT task_name, string_split(task_name, '/') AS p FROM ({_TASKS}))""",
)
def load_label(spark, folder):
    parsed = _tasks(spark, folder).select("task_name", *paths.task_fields("task_name"))
    return parsed.select("task_name", messages.load_label(F.col("job"), F.col("table"), F.col("file")).alias("label"))


@query("status_time_format", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS update_time FROM events")
def status_time_format(spark, folder):
    return fx.table(spark, folder, "events").select("event_id", times.status_time(F.col("ts")).alias("update_time"))


@query("day_bucket", "SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM events")
def day_bucket(spark, folder):
    return fx.table(spark, folder, "events").select("event_id", times.period_start(F.col("ts")).alias("day"))


@query(
    "default_insert_time",
    f"""
SELECT event_id, CASE WHEN event_type = 'error' THEN TIMESTAMP '{_LOADED_AT}' ELSE ts END AS insert_time FROM events""",
)
def default_insert_time(spark, folder):
    """Errors stand for rows without an insert time."""
    given = F.when(F.col("event_type") != "error", F.col("ts"))
    loaded_at = F.lit(_LOADED_AT).cast("timestamp_ntz")
    return fx.table(spark, folder, "events").select(
        "event_id", times.with_default_time(given, loaded_at).alias("insert_time")
    )


@query(
    "task_info_json",
    f"SELECT o_orderkey, 'orders' AS tbl, {fx.SQL_MONTH.format('o_orderdate')} AS \"partition\" FROM orders",
)
def task_info_json(spark, folder):
    text = F.concat(F.lit('{"tbl":"orders","partitions":["'), fx.ORDERS.partition_column(), F.lit('"]}'))
    table, partition = messages.task_info(text)
    return fx.table(spark, folder, "orders").select("o_orderkey", table.alias("tbl"), partition.alias("partition"))
