"""The rows in which two tables differ, found by descending a tree of sums.

Rows fall into buckets by partition and by a hash of their key. Counts and sums of row prints are compared from the
partitions down, and only buckets that differ are read further; in the last ones rows are compared key by key. Sums of
prints are added in three parts that fit whole numbers, so they are exact whatever the order of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relocate.functions.prints import limb_sums, limbs
from relocate.operators.reconcile import EXTRA, LOST, NOT_MATCH
from relocate.session import broadcast_below, saved
from relocate.specs import UNASSIGNED, Selector, TableSpec

# Bits of the key's hash that a level of the tree adds, rows that a last bucket may hold, and the deepest level.
LEVEL_BITS, LEAF_ROWS, DEEPEST = 8, 4096, 6

# Up to this many differing partitions are named to the scan as literals, and so many buckets sent to every executor.
LITERAL_PARTITIONS, BROADCAST_BUCKETS = 200, 500_000


def _printed(df: DataFrame, spec: TableSpec, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``_pt, _hash``, the key and the columns of the rows a spec covers."""
    rows = spec.rows(df)
    hashed = F.xxhash64(*[F.col(c) for c in key]).alias("_hash")
    return rows.select(spec.partition_column().alias("_pt"), hashed, *[F.col(c) for c in dict.fromkeys([*key, *columns])])


def _bucket(level: int) -> Column:
    """The bucket of a row on a level: the leading bits of its hash, none of them at the top."""
    # shifted in two steps, as a shift by all 64 bits is none; always an expression of the row, which keeps joins hashed
    return F.shiftrightunsigned(F.shiftrightunsigned("_hash", 63 - LEVEL_BITS * level), 1)


def _differing(source: DataFrame, target: DataFrame, columns: Sequence[str], level: int) -> DataFrame:
    """``_pt, _at, _rows`` of the buckets of a level whose rows differ."""
    sides = [df.select("_pt", _bucket(level).alias("_at"), F.lit(w).alias("_w"), F.xxhash64(*columns).alias("_print")) for df, w in ((source, 1), (target, -1))]
    both = sides[0].unionByName(sides[1])
    parts = limb_sums(F.col("_print"), F.col("_w"))
    counted = both.groupBy("_pt", "_at").agg(F.sum("_w").alias("_off"), F.count("*").alias("_rows"), *[p.alias(f"_l{i}") for i, p in enumerate(parts)])
    same = reduce(lambda a, b: a & b, [F.col(f"_l{i}") == 0 for i in range(limbs())], F.col("_off") == 0)
    return counted.where(~same).select("_pt", "_at", "_rows")


def _narrowed(spec: TableSpec, buckets: DataFrame) -> TableSpec:
    """The spec limited to the partitions of the buckets, so that the scan is pruned; as it is where they are many."""
    names = [row[0] for row in buckets.select("_pt").distinct().limit(LITERAL_PARTITIONS + 1).collect()]
    if len(names) > LITERAL_PARTITIONS or UNASSIGNED in names or not names:
        return spec
    return replace(spec, selector=Selector(names=tuple(names)))


def _inside(rows: DataFrame, buckets: DataFrame, count: int, level: int) -> DataFrame:
    """Rows of the given buckets."""
    named = buckets.select(F.col("_pt").alias("_p"), F.col("_at").alias("_a"))
    named = broadcast_below(named, count, BROADCAST_BUCKETS)
    return rows.join(named, (F.col("_pt") == F.col("_p")) & (_bucket(level) == F.col("_a")), "left_semi")


def differing_rows(
    source: DataFrame, target: DataFrame, spec: TableSpec, key: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """``partition``, the key, ``src_rows, tgt_rows, status, columns`` of every key whose rows differ.

    ``status`` is LOST for keys of the source alone, EXTRA for those of the target alone, else NOT MATCH, with the
    columns whose values differ. Both tables have the same columns of the same types; keys may be NULL and may repeat,
    as rows of one key are compared as a whole. ``columns`` limits what is compared. Each level reads the partitions
    that still differ once; rows move only in the last step, and only those of the buckets that differ.
    """
    compared = list(columns or source.columns)

    def of(spec: TableSpec) -> tuple[DataFrame, DataFrame]:
        return _printed(source, spec, key, compared), _printed(target, spec, key, compared)

    level = 0
    found = saved(_differing(*of(spec), compared, level), "differing-partitions")
    while True:
        most, count = found.agg(F.coalesce(F.max("_rows"), F.lit(0)), F.count("*")).first()
        left, right = (_inside(rows, found, count, level) for rows in of(_narrowed(spec, found)))
        if most <= LEAF_ROWS or level == DEEPEST:
            break
        level += 1
        found = saved(_differing(left, right, compared, level), "differing-buckets")

    def keyed(df: DataFrame, side: str) -> DataFrame:
        prints = [F.struct(F.count(c), *limb_sums(F.xxhash64(c), F.lit(1))).alias(f"{side}_{i}") for i, c in enumerate(compared)]
        own = [F.col(c).alias(f"_k{i}") for i, c in enumerate(key)]
        return df.groupBy("_pt", *own).agg(F.count("*").alias(f"{side}_rows"), *prints)

    src, tgt = keyed(left, "src"), keyed(right, "tgt")
    # a struct of its columns meets a key with NULL in it
    names = [f"_k{i}" for i in range(len(key))]
    src, tgt = (df.withColumn("_id", F.to_json(F.struct("_pt", *names), {"ignoreNullFields": "false"})) for df in (src, tgt))
    pairs = src.join(tgt.withColumnsRenamed({n: f"t{n}" for n in [*names, "_pt"]}), "_id", "full_outer")
    off = [F.when(~F.col(f"src_{i}").eqNullSafe(F.col(f"tgt_{i}")), F.lit(c)) for i, c in enumerate(compared)]
    status = F.when(F.col("tgt_rows").isNull(), LOST).when(F.col("src_rows").isNull(), EXTRA).otherwise(NOT_MATCH)
    both = F.col("src_rows").isNotNull() & F.col("tgt_rows").isNotNull()
    judged = pairs.withColumn("_off", F.array_compact(F.array(*off))).where(~both | (F.size("_off") > 0))
    return judged.select(
        F.coalesce("_pt", "t_pt").alias("partition"),
        *[F.coalesce(n, f"t{n}").alias(c) for n, c in zip(names, key)],
        "src_rows",
        "tgt_rows",
        status.alias("status"),
        F.when(both, F.concat_ws(",", "_off")).alias("columns"),
    )
