"""Operators for language-model training data, their registered queries and the SQL to check them with."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from importlib import import_module
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where SQL can say the same."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def load_all() -> None:
    import_module("relocate.llm.queries")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shipped(spark: SparkSession) -> SparkSession:
    """Give this package to the executors, as ``--py-files`` would; Spark copies it from the driver. Once per context."""
    context = spark.sparkContext
    if not getattr(context, "_relocate_shipped", False):
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="relocate-code-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        context._relocate_shipped = True
    return spark
