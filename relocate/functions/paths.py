"""Staged paths: ``scheme://bucket/prefix/job/db/table/partition/file``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Position of each segment when a path is split on "/".
BUCKET, PREFIX, JOB, DB, TABLE, PARTITION = 2, 3, 4, 5, 6, 7

# Scheme at the start of a path, with or without the slashes of an empty host.
SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:/*"

# Accepted file endings and the marks of unfinished files.
LANDED_SUFFIX = r"\.(csv|parquet)$"
UNFINISHED_FOLDER = "_temporary"
HIDDEN_MARK = "."

# Folder name in front of a partition value, as Spark's partitioned writers lay files out.
PARTITION_FIELD = "pt"

# Folder name above it where waves are staged together.
WAVE_FIELD = "_wave"


def segment(path: Column | str, position: int) -> Column:
    """One segment of a path, NULL when the path is shorter."""
    return F.get(F.split(path, "/"), F.lit(position))


def job_of(path: Column | str) -> Column:
    return segment(path, JOB)


def partition_of(path: Column | str) -> Column:
    """Partition segment, with or without the ``pt=`` that Spark writes in front."""
    return F.regexp_replace(segment(path, PARTITION), f"^{PARTITION_FIELD}=", "")


def decoded(path: Column | str) -> Column:
    """A path without percent-encoding; a text that is not encoded stays as it is."""
    path = F.col(path) if isinstance(path, str) else path
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def same_file(path: Column | str) -> Column:
    """A text that is equal for all spellings of one file: without scheme and percent-encoding."""
    return F.regexp_replace(decoded(path), SCHEME, "/")


def folder_value(path: Column | str) -> Column:
    """Partition that a staged file's folder is named after, with or without ``pt=`` in front.

    The writer escapes some characters in folder names, and a path is encoded as a whole after that.
    """
    return decoded(decoded(F.regexp_extract(path, f"/(?:{PARTITION_FIELD}=)?([^/]*)/[^/]*$", 1)))


def wave_of(path: Column | str) -> Column:
    """Wave that a staged file belongs to, NULL where there is none."""
    return F.regexp_extract(path, f"/{WAVE_FIELD}=([0-9]+)/[^/]*/[^/]*$", 1).try_cast("bigint")


def parent_folder(path: Column | str) -> Column:
    """Folder of a file."""
    return F.regexp_replace(path, "/[^/]*$", "")


def task_fields(path: Column | str) -> list[Column]:
    """Bucket, prefix, job, db, table, partition and file of a path."""
    rest = F.regexp_extract(path, r"^(?:[^/]*/){8}(.+)$", 1)
    return [
        segment(path, BUCKET).alias("bucket"),
        segment(path, PREFIX).alias("prefix"),
        job_of(path).alias("job"),
        segment(path, DB).alias("db"),
        segment(path, TABLE).alias("table"),
        partition_of(path).alias("partition"),
        F.nullif(rest, F.lit("")).alias("file"),
    ]


def task_path(root: Column, *segments: Column) -> Column:
    """Join a stage root and path segments with single slashes, whether or not the root ends in one."""
    return F.concat_ws("/", F.regexp_replace(root, "/+$", ""), *segments)


def stage_folder(root: str, job: str, db: str, table: str) -> str:
    return f"{root.rstrip('/')}/{job}/{db}/{table}"


def hadoop_scheme(path: Column) -> Column:
    """``s3:`` rewritten to ``s3a:``, the name of Hadoop's object store file system."""
    return F.regexp_replace(path, "^s3:", "s3a:")


def decoded_key(key: Column) -> Column:
    """URL-decoded object key; ``+`` stands for a blank."""
    return F.url_decode(key)


def is_landed(path: Column) -> Column:
    """True for finished data files: right ending, no temporary folder, not hidden."""
    name = F.substring_index(path, "/", -1)
    return path.rlike(LANDED_SUFFIX) & ~path.contains(UNFINISHED_FOLDER) & ~name.startswith(HIDDEN_MARK)


def below(path: Column, folder: str) -> Column:
    """Paths inside a folder, whichever scheme either is written with.

    The folder is closed with a slash, so ``job1`` does not hold the files of ``job10``.
    """
    return F.regexp_replace(path, SCHEME, "/").startswith(re.sub(SCHEME, "/", folder).rstrip("/") + "/")
