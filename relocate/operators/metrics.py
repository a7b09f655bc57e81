"""Row counts and metric sums, per partition and per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.functions.prints import joined_sum, limb_sums
from relocate.specs import TableSpec, as_column

# Fraction digits of the sums of floating-point metrics. Verdicts do not depend on it: they compare prints.
FLOAT_SCALE = 6


def sum_type(kind: T.DataType) -> T.DecimalType:
    """Type in which values of a numeric type are added without regard to their order."""
    if isinstance(kind, T.DecimalType):
        return kind
    return T.DecimalType(20, 0) if isinstance(kind, T.IntegralType) else T.DecimalType(30, FLOAT_SCALE)


def common_sum_type(one: T.DataType, other: T.DataType) -> T.DecimalType:
    """The narrowest type that holds the values of both sum types; with whole digits given up beyond 38."""
    one, other = sum_type(one), sum_type(other)
    scale = max(one.scale, other.scale)
    return T.DecimalType(min(38, scale + max(one.precision - one.scale, other.precision - other.scale)), scale)


def common_type(one: T.DataType, other: T.DataType) -> T.DataType:
    """Type in which equal values of both types are equal: exact where either is exact."""
    floating = [isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) for kind in (one, other)]
    if all(floating):
        return T.DoubleType()
    exact = [sum_type(kind) for kind, is_floating in zip((one, other), floating) if not is_floating]
    return T.DecimalType(38, max(kind.scale for kind in exact))


def value_print(value: Column, kind: T.DataType) -> Column:
    """A number that stands for a value compared as ``kind``; NULL for NULL.

    Values that ``kind`` cannot hold exactly, NaN and infinities included, stand for themselves.
    """
    if isinstance(kind, T.DoubleType):
        return F.when(value.isNotNull(), F.xxhash64(value.cast("double") + F.lit(0.0)))
    held = value.try_cast(kind)
    exact = held.isNotNull() & (held.cast("double") == value.cast("double"))
    return F.when(value.isNotNull(), F.when(exact, F.xxhash64(held)).otherwise(F.xxhash64(F.lit("apart"), value.cast("string"))))


def _total(column: Column, kind: T.DecimalType) -> Column:
    """Sum of a column of any numeric type; NULL where the sum, or one of the values, does not fit."""
    held = column.try_cast(kind)
    return F.when(F.count(column) == F.count(held), F.try_sum(held)).cast(T.DecimalType(38, kind.scale))


def metric_columns(df: DataFrame, spec: TableSpec) -> dict[str, tuple[Column, T.DataType]]:
    """Per metric of the spec: its column and type."""
    columns = {metric: as_column(expression) for metric, expression in spec.metrics.items()}
    return {metric: (column, df.select(column).schema[0].dataType) for metric, column in columns.items()}


def metric_sums(df: DataFrame, spec: TableSpec) -> list[Column]:
    """Aggregates of a spec: ``row_count`` and one sum per metric."""
    sums = [_total(column, sum_type(kind)).alias(metric) for metric, (column, kind) in metric_columns(df, spec).items()]
    return [F.count("*").alias("row_count"), *sums]


def partition_metrics(df: DataFrame, spec: TableSpec, prints: bool = True) -> DataFrame:
    """Count and sums of every partition in one job; partial sums per task go through the shuffle.

    ``prints`` adds ``<metric>_print``, a sum over the values' prints that tells apart what equal sums hide, or what
    does not fit a sum. Tables saved at different times are compared by it; their metrics must have the same types.
    """
    rows = spec.rows(df)
    extra = {
        f"{metric}_print": joined_sum(limb_sums(value_print(column, common_type(kind, kind)), F.lit(1)))
        for metric, (column, kind) in metric_columns(rows, spec).items()
        if prints
    }
    aggregates = [*metric_sums(rows, spec), *[value.alias(name) for name, value in extra.items()]]
    sums = rows.groupBy(spec.group_column().alias("_group")).agg(*aggregates)
    return sums.select(spec.name_of(F.col("_group")).alias("name"), "row_count", *spec.metrics, *extra)


def table_metrics(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Count and sums of the whole table."""
    rows = spec.rows(df)
    return rows.agg(*metric_sums(rows, spec)).select(F.lit(spec.name).alias("name"), "*")


def named_for_table(metrics: DataFrame, table: str) -> DataFrame:
    """``{table}_{partition}`` as the name of each partition."""
    return metrics.withColumn("name", F.concat_ws("_", F.lit(table), "name"))


def fingerprint(*values: Column) -> Column:
    """Values joined with commas for a report; a missing sum reads ``NULL``."""
    return F.concat_ws(",", *[F.coalesce(value.cast("string"), F.lit("NULL")) for value in values])
