"""Comparison of source and target, partition by partition."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.functions.prints import limb_sums
from relocate.operators.metrics import common_sum_type, common_type, fingerprint, metric_columns, value_print
from relocate.specs import TableSpec

# Verdicts on a partition.
MATCH, NOT_MATCH, LOST, EXTRA = "MATCH", "NOT MATCH", "LOST", "EXTRA"


def _verdict(pairs: Sequence[tuple[Column, Column]], src_rows: Column, tgt_rows: Column) -> Column:
    same = reduce(lambda left, right: left & right, [src.eqNullSafe(tgt) for src, tgt in pairs])
    return (
        F.when(tgt_rows.isNull(), LOST).when(src_rows.isNull(), EXTRA).when(same, MATCH).otherwise(NOT_MATCH)
    )


def compare_metrics(
    source: DataFrame, target: DataFrame, both_sides: bool = False, sums_only: bool = False
) -> DataFrame:
    """Match two metric tables by name, such as ones saved at different times.

    Columns: ``name, src_<column>, tgt_<column>, status``. Partitions of the target alone
    are reported (EXTRA) with ``both_sides``. The verdict rests on the prints of the values;
    tables without them raise, as equal sums may hide differences, unless ``sums_only``.
    """
    values = [column for column in source.columns if column != "name"]
    shown = [column for column in values if not column.endswith("_print")]
    if not sums_only and (bare := [c for c in shown if c != "row_count" and f"{c}_print" not in {*values} & {*target.columns}]):
        raise ValueError(f"no prints of {', '.join(bare)}: equal sums prove nothing")
    src = source.select("name", *[F.col(column).alias(f"src_{column}") for column in values])
    tgt = target.select("name", *[F.col(column).alias(f"tgt_{column}") for column in values])
    pairs = [(F.col(f"src_{column}"), F.col(f"tgt_{column}")) for column in values]
    both = src.join(tgt, "name", "full_outer" if both_sides else "left")
    status = _verdict(pairs, F.col("src_row_count"), F.col("tgt_row_count")).alias("status")
    sides = [f"{side}_{column}" for side in ("src", "tgt") for column in shown]
    return both.select("name", *sides, status)


def reconcile(source: DataFrame, target: DataFrame, spec: TableSpec, both_sides: bool = False) -> DataFrame:
    """Compare two tables under one spec.

    Both sides are read in one pass and meet in a single aggregation by partition name:
    each task sends one partial row per partition, however large the partition, and no
    join follows. Columns: ``name, src_rows, tgt_rows, src_<metric>, tgt_<metric>, status``.

    The verdict rests on the rows and on prints of the values, so it sees a difference in any
    digit, in NULLs, NaN and infinities. Values of different types are compared in a type
    that is exact for both. The sums are for the reader; one that does not fit is NULL.
    """
    ours, theirs = metric_columns(source, spec), metric_columns(target, spec)
    kinds = {metric: (ours[metric][1], theirs[metric][1]) for metric in ours}

    def side(df: DataFrame, metrics: dict, of_source: bool) -> DataFrame:
        columns = []
        for metric, (column, _) in metrics.items():
            columns.append(column.try_cast(common_sum_type(*kinds[metric])).alias(metric))
            columns.append(value_print(column, common_type(*kinds[metric])).alias(f"_print_{metric}"))
        weight = F.lit(1 if of_source else -1).cast("bigint")
        return spec.rows(df).select(spec.group_column().alias("_group"), weight.alias("_weight"), *columns)

    def total(metric: str, own: Column) -> Column:
        unfit = F.coalesce(F.bool_or(own & F.col(f"_print_{metric}").isNotNull() & F.col(metric).isNull()), F.lit(False))
        return F.when(~unfit, F.try_sum(F.when(own, F.col(metric)))).cast(T.DecimalType(38, common_sum_type(*kinds[metric]).scale))

    def surplus(metric: str) -> list[Column]:
        """What the source has more than the target, in values and in their prints: all 0 where both hold the same."""
        value, weight = F.col(f"_print_{metric}"), F.col("_weight")
        return [F.sum(F.when(value.isNotNull(), weight)), *limb_sums(value, weight)]

    both = side(source, ours, True).union(side(target, theirs, False)).groupBy("_group")
    sides = (("src", F.col("_weight") > 0), ("tgt", F.col("_weight") < 0))
    sums = [total(metric, own).alias(f"{prefix}_{metric}") for metric in kinds for prefix, own in sides]
    prints = [F.array(*[F.coalesce(s, F.lit(0).cast("bigint")) for s in surplus(metric)]).alias(f"_off_{metric}") for metric in kinds]
    counted = both.agg(
        *[F.nullif(F.count_if(own), F.lit(0)).alias(f"{prefix}_rows") for prefix, own in sides], *sums, *prints
    )
    shown = counted.columns[1 : 3 + len(sums)]
    pairs = [(F.col("src_rows"), F.col("tgt_rows"))]
    pairs += [(F.array_max(F.transform(f"_off_{metric}", F.abs)), F.lit(0).cast("bigint")) for metric in kinds]
    if not both_sides:
        counted = counted.where(F.col("src_rows").isNotNull())
    status = _verdict(pairs, F.col("src_rows"), F.col("tgt_rows"))
    return counted.select(
        spec.name_of(F.col("_group")).alias("name"), *shown, status.alias("status")
    )


def type_differences(source: DataFrame, target: DataFrame, spec: TableSpec) -> dict[str, tuple[str, str]]:
    """Metrics whose types differ: the source's and the target's."""
    ours, theirs = metric_columns(source, spec), metric_columns(target, spec)
    kinds = {metric: (ours[metric][1].simpleString(), theirs[metric][1].simpleString()) for metric in ours}
    return {metric: pair for metric, pair in kinds.items() if pair[0] != pair[1]}


def reconcile_tables(
    tables: Sequence[tuple[TableSpec, DataFrame, DataFrame]], both_sides: bool = False
) -> DataFrame:
    """One report over several tables, each with its own metrics.

    ``tables`` holds spec, source and target. Metric vectors are shown as text so that
    tables with different metrics fit one report; they were compared as numbers.
    """
    if not tables:
        raise ValueError("no tables to compare")
    reports = []
    for spec, source, target in tables:
        report = reconcile(source, target, spec, both_sides)
        vectors = [
            F.when(F.col(f"{side}_rows").isNotNull(), fingerprint(*[F.col(f"{side}_{m}") for m in spec.metrics]))
            .alias(f"{side}_metrics")
            for side in ("src", "tgt")
        ]
        reports.append(
            report.select(F.lit(spec.name).alias("table"), "name", "src_rows", "tgt_rows", *vectors, "status")
        )
    return reduce(DataFrame.unionByName, reports)


def summary(report: DataFrame, tables: Sequence[str] = ()) -> DataFrame:
    """Per table: partitions checked, partitions that do not match and whether all is right.

    Of the named ``tables``, one without any partition in the report is shown as not right.
    """
    status = report.select("table", "status")
    if tables:
        named = report.sparkSession.createDataFrame([(table, None) for table in tables], "table string, status string")
        status = status.union(named)
    matches = F.col("status") == MATCH
    return status.groupBy("table").agg(
        F.count("status").alias("checked"),
        F.count_if(~matches).alias("mismatched"),
        F.coalesce(F.bool_and(matches), F.lit(False)).alias("all_right"),
    )


def mismatches(report: DataFrame) -> DataFrame:
    """The partitions that do not match, one row each."""
    return report.where(F.col("status") != MATCH)
