"""Range partitions of any ordered key: bounds ranked once, rows find their range by descending a tree of them.

A bound has one value for each key column, or an open end in its place. Bounds compare column by column. The valid
ranges of a catalog are ranked by their starts and laid out as a tree of nodes with up to ``FAN`` starts each. A row
meets one node on each level by an equality join and finds its place there by halving, so it is compared with a few
bounds, whatever their type and however many there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.operators.sweep import numbered, running_max
from relocate.session import broadcast_below, saved
from relocate.specs import UNASSIGNED

# Words that stand for an open end.
LOWEST, HIGHEST = ("MINVALUE", "MIN"), ("MAXVALUE", "MAX")

# Starts in one node: what six halvings tell apart.
FAN = 63
STEPS = (32, 16, 8, 4, 2, 1)

# Largest catalog whose nodes are sent to every executor; beyond it the lowest level is joined by a shuffle.
BROADCAST_ENTRIES = 100_000

# Faults of catalog entries.
UNREADABLE, REVERSED, EMPTY, OVERLAP, GAP, CLAIMED_TWICE = "unreadable", "reversed", "empty", "overlap", "gap", "claimed twice"

_QUOTES = r"""^[\s"']+|[\s"']+$"""


def _part(column: Column, index: int, several: bool) -> Column:
    return F.get(F.split(column, ","), F.lit(index)) if several else column


def _sided(text: Column, kind: T.DataType, missing: int) -> tuple[Column, Column]:
    """One column of a bound: -1 or 1 for an open end, 0 beside a value; and the value."""
    word = F.upper(F.trim(text))
    open_side = F.when(text.isNull(), missing).when(word.isin(*LOWEST), -1).when(word.isin(*HIGHEST), 1).otherwise(0)
    value = F.regexp_replace(text, _QUOTES, "").try_cast(kind)
    return open_side.cast("tinyint"), F.when(open_side == 0, value)


def _bound(column: Column, kinds: Sequence[T.DataType], is_text: bool, missing: int) -> tuple[Column, Column]:
    """A bound in the order of the keys, and whether it can be read."""
    fields, readable = [], F.lit(True)
    for i, kind in enumerate(kinds):
        if is_text:
            # a column that a bound leaves out is below every value, so that (a) is the first of all (a, ...)
            part = _part(column, i, len(kinds) > 1)
            side, value = _sided(part, kind, missing if i == 0 else -1)
        else:
            side, value = F.when(column.isNull(), missing).otherwise(0).cast("tinyint"), column.try_cast(kind)
        readable = readable & ((side != 0) | value.isNotNull())
        fields += [side.alias(f"s{i}"), value.alias(f"v{i}")]
    return F.struct(*fields), readable


def read_ranges(catalog: DataFrame, kinds: Sequence[T.DataType]) -> DataFrame:
    """``name, start, end, fault`` of range entries: comparable bounds, and what is wrong with an entry by itself.

    ``start`` and ``end`` of the catalog are texts, of several columns joined by commas, or values of a single key.
    ``MINVALUE`` and ``MAXVALUE`` (``MIN``, ``MAX``) without quotes, and a NULL bound, are open ends.
    """
    types = dict(catalog.dtypes)
    if len(kinds) > 1 and {types["start"], types["end"]} != {"string"}:
        raise TypeError("bounds of several columns are texts")
    (start, low), (end, high) = (
        _bound(F.col(name), kinds, types[name] == "string", side) for name, side in (("start", -1), ("end", 1))
    )
    read = catalog.select("name", start.alias("start"), end.alias("end"), (low & high).alias("_readable"))
    fault = F.when(~F.col("_readable"), UNREADABLE)
    fault = fault.when(F.col("start") > F.col("end"), REVERSED).when(F.col("start") == F.col("end"), EMPTY)
    return read.select("name", "start", "end", fault.alias("fault"))


def _key_of(keys: Sequence[str]) -> Column:
    fields = []
    for i, key in enumerate(keys):
        fields += [F.lit(0).cast("tinyint").alias(f"s{i}"), F.col(key).alias(f"v{i}")]
    return F.struct(*fields)


def _tree(ranked: DataFrame, count: int) -> list[tuple[DataFrame, int]]:
    """Levels of the tree from the root down: nodes ``_at, _starts`` and, on the lowest, ``_entries``; and their entries."""
    at = F.floor(F.col("rank") / FAN).cast("bigint").alias("_at")
    entry = F.struct("rank", "start", "end", "name")
    lowest = ranked.groupBy(at).agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
    levels = [(lowest.withColumn("_starts", F.transform("_entries", lambda e: e["start"])), count)]
    rows, left = ranked.select("rank", "start"), count
    while left > FAN:
        left = -(-left // FAN)
        rows = rows.where(F.col("rank") % FAN == 0).select(F.floor(F.col("rank") / FAN).cast("bigint").alias("rank"), "start")
        first = F.array_sort(F.collect_list(F.struct("rank", "start")))
        nodes = rows.groupBy(at).agg(F.transform(first, lambda e: e["start"]).alias("_starts"))
        levels.insert(0, (nodes, left))
    return levels


def assign_by_bounds(df: DataFrame, keys: Sequence[str], catalog: DataFrame, name: str = "pt") -> DataFrame:
    """Add the name of the range partition ``start <= key < end`` that holds each row.

    ``keys`` may be of any types that Spark orders, and of different ones; ``catalog`` is read by ``read_ranges``.
    Entries that are unreadable, reversed or empty hold no rows (``catalog_faults`` names them); ranges that overlap
    raise. Rows outside every range, or with a NULL in the key, are named ``unassigned``.
    """
    kinds = [df.schema[key].dataType for key in keys]
    valid = read_ranges(catalog, kinds).where("fault IS NULL").select("name", "start", "end")
    ranked = saved(numbered(valid, ["start", "end", "name"], "rank", "ranges"), "ranked")
    count = ranked.count()
    if not count:
        return df.withColumn(name, F.lit(UNASSIGNED))
    following = ranked.select((F.col("rank") - 1).alias("rank"), F.col("start").alias("_next"), F.col("name").alias("_other"))
    crossing = ranked.join(following, "rank").where(F.col("end") > F.col("_next")).select("name", "_other").first()
    if crossing:
        raise ValueError(f"partitions {crossing[0]} and {crossing[1]} overlap")

    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    # a row without a key is at no node
    out = df.withColumn("_key", _key_of(keys)).withColumn("_node", F.when(missing, -1).otherwise(0).cast("bigint"))
    for nodes, entries in _tree(ranked, count):
        out = out.join(broadcast_below(nodes, entries, BROADCAST_ENTRIES), F.col("_node") == F.col("_at"), "left")
        out = out.withColumn("_place", F.lit(0))
        for step in STEPS:
            # the place is how many starts are not above the key
            further = F.get("_starts", F.col("_place") + (step - 1)) <= F.col("_key")
            out = out.withColumn("_place", F.col("_place") + F.when(further, step).otherwise(0))
        if "_entries" not in nodes.columns:
            child = F.when(F.col("_place") > 0, F.col("_node") * FAN + F.col("_place") - 1).otherwise(-1)
            out = out.withColumn("_node", child.cast("bigint")).drop("_at", "_starts", "_place")
    found = F.get("_entries", F.col("_place") - 1)
    inside = F.when(F.col("_key") < found["end"], found["name"])
    return out.select(*[F.col(c) for c in df.columns], F.coalesce(inside, F.lit(UNASSIGNED)).alias(name))


# -- audit ---------------------------------------------------------------------------------


def _shown(bound: Column, kinds: Sequence[T.DataType]) -> Column:
    """A bound as text."""
    fields = [
        F.when(bound[f"s{i}"] < 0, LOWEST[0]).when(bound[f"s{i}"] > 0, HIGHEST[0]).otherwise(bound[f"v{i}"].cast("string"))
        for i in range(len(kinds))
    ]
    return F.concat_ws(",", *fields)


def catalog_faults(catalog: DataFrame, kinds: Sequence[T.DataType]) -> DataFrame:
    """What is wrong with the range entries of one table: ``fault, name, other, start, end``, a row for each fault.

    - ``unreadable``: a bound that is no value of the key's type. ``reversed`` and ``empty``: bounds in the wrong order, or equal.
    - ``overlap``: an entry that begins inside earlier ones; ``other`` is the one of them that reaches furthest, and the
      bounds are those of what both hold.
    - ``gap``: nothing holds the keys between the bounds, from where ``other`` ends to where ``name`` starts.

    Ranges are swept in the order of their starts, with the furthest end so far carried along; the sweep is cut into
    ranges of that order, so no task sees the whole catalog.
    """
    read = saved(read_ranges(catalog, kinds), "catalog-read")
    shown = lambda bound: _shown(bound, kinds)
    start, end, before = F.col("start"), F.col("end"), F.col("_before")
    alone = read.where("fault IS NOT NULL").select(
        "fault",
        "name",
        F.lit(None).cast("string").alias("other"),
        F.when(F.col("fault") != UNREADABLE, shown(start)).alias("start"),
        F.when(F.col("fault") != UNREADABLE, shown(end)).alias("end"),
    )
    reach = F.struct(end.alias("end"), F.col("name").alias("name"))
    swept = running_max(read.where("fault IS NULL"), ["start", "end", "name"], reach, "_before", "catalog-sweep")
    fault = F.when(before["end"] > start, OVERLAP).when(before["end"] < start, GAP)
    low = F.when(before["end"] < start, before["end"]).otherwise(start)
    high = F.when(before["end"] < start, start).otherwise(F.least(end, before["end"]))
    between = swept.select(fault.alias("fault"), "name", before["name"].alias("other"), shown(low).alias("start"), shown(high).alias("end"))
    return alone.unionByName(between.where("fault IS NOT NULL"))


def list_faults(catalog: DataFrame, kind: T.DataType) -> DataFrame:
    """What is wrong with the list entries of one table, in the columns of ``catalog_faults``; ``start`` is the value.

    ``claimed twice``: a value of several entries, the first and last of which are ``name`` and ``other``.
    ``unreadable``: a value that is none of the key's type.
    """
    listed = catalog.select("name", F.explode("values").alias("text")).withColumn("value", F.col("text").try_cast(kind))
    none = F.lit(None).cast("string")
    unreadable = listed.where("value IS NULL AND text IS NOT NULL").select(
        F.lit(UNREADABLE).alias("fault"), "name", none.alias("other"), F.col("text").alias("start"), none.alias("end")
    )
    claims = listed.groupBy("value").agg(F.min("name").alias("name"), F.max("name").alias("other"))
    twice = claims.where("name <> other AND value IS NOT NULL").select(
        F.lit(CLAIMED_TWICE).alias("fault"), "name", "other", F.col("value").cast("string").alias("start"), none.alias("end")
    )
    return unreadable.unionByName(twice)
