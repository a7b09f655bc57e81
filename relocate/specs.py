"""Plan-time settings: which partitions, which table, which store, which file layout."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.functions import times

# The selector words and the partition name of a whole-table run.
SELECTOR_WORDS = ("ALL", "EACH", "RANGE", "STARTWITH", "ENDWITH")
WHOLE_TABLE = "default"

# Name given to rows that belong to no partition (NULL key, or key outside every bound).
UNASSIGNED = "unassigned"


@dataclass(frozen=True)
class Selector:
    """Chooses partitions by name. Names compare as text, so they should have fixed width.

    ``begin`` is inclusive and ``end`` exclusive; ``names`` is an exact set.
    An empty selector keeps every partition, ``whole_table`` ignores partitions.
    """

    names: tuple[str, ...] | None = None
    begin: str = ""
    end: str = ""
    whole_table: bool = False

    @classmethod
    def parse(cls, text: str | None) -> Selector:
        """Read ``ALL``, ``EACH(a,b)``, ``RANGE(a,b)``, ``STARTWITH(a)``, ``ENDWITH(b)`` or empty text."""
        text = (text or "").strip()
        if not text:
            return cls()
        found = re.fullmatch(r"([A-Z]+)\s*(?:\((.*)\))?", text, re.DOTALL)
        word = found.group(1) if found else ""
        if word not in SELECTOR_WORDS or (word != "ALL" and found.group(2) is None):
            raise ValueError(f"unknown partition selector: {text!r}")
        if word == "ALL":
            return cls(whole_table=True)
        items = tuple(item.strip() for item in found.group(2).split(","))
        if not any(items):
            raise ValueError(f"partition selector without names: {text!r}")
        if word == "EACH":
            return cls(names=tuple(dict.fromkeys(item for item in items if item)))
        return cls(
            begin=items[0] if word in ("RANGE", "STARTWITH") else "",
            end=items[-1] if word in ("RANGE", "ENDWITH") else "",
        )

    def keeps(self, name: Column | str) -> Column:
        """Predicate over the partition name."""
        name = F.col(name) if isinstance(name, str) else name
        kept = F.lit(True)
        if self.names is not None:
            kept = name.isin(*self.names)
        if self.begin:
            kept = kept & (name >= F.lit(self.begin))
        if self.end:
            kept = kept & (name < F.lit(self.end))
        return kept


def split_selectors(text: str | None, tables: list[str]) -> dict[str, Selector]:
    """Give the i-th selector of a comma separated text to the i-th table; the rest keep everything."""
    parts = re.findall(r"[^,()]+\([^()]*\)|[^,()]+", text or "")
    parts = [part for part in parts if part.strip()]
    if len(parts) > len(tables):
        raise ValueError(f"{len(parts)} selectors for {len(tables)} tables")
    parts += [""] * (len(tables) - len(parts))
    return {table: Selector.parse(part) for table, part in zip(tables, parts)}


@dataclass(frozen=True)
class TableSpec:
    """One table of a job. Export, load and validation all read the same spec.

    The partition of a row is either the day, month or year (``unit``) of the column
    ``key``, or the name that the SQL expression ``partition`` gives. ``metrics`` maps a
    report column to the expression that is summed. ``row_filter`` limits what is moved
    and what is compared.
    """

    name: str
    partition: str | Column | None = None
    key: str = ""
    unit: str = ""
    metrics: Mapping[str, str | Column] = field(default_factory=dict)
    row_filter: str | Column | None = None
    selector: Selector = Selector()
    unique_key: tuple[str, ...] = ()
    version: tuple[str, ...] = ()

    def __post_init__(self):
        if (self.partition is None) == (not (self.key and self.unit)):
            raise ValueError(f"{self.name}: give either a partition expression or a key and its unit")

    def group_column(self) -> Column:
        """What rows of one partition have in common, in its cheapest form: the first day for calendar units."""
        return times.first_day(F.col(self.key), self.unit) if self.unit else as_column(self.partition).cast("string")

    def name_of(self, group: Column) -> Column:
        """Partition name of a ``group_column`` value."""
        name = times.period_name(group, self.unit) if self.unit else group
        return F.coalesce(name, F.lit(UNASSIGNED))

    def partition_column(self) -> Column:
        return self.name_of(self.group_column())

    def rows(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` that this job covers: row filter and partition selector applied.

        Rows without a partition are covered unless a selector names partitions.
        """
        if self.row_filter is not None:
            df = df.where(as_column(self.row_filter))
        if self.selector == Selector() or self.selector.whole_table:
            return df
        if not self.unit:
            return df.where(self.selector.keeps(self.group_column()))
        return df.where(self._keeps_period(df.schema[self.key].dataType))

    def _keeps_period(self, kind: T.DataType) -> Column:
        """The selector as bounds of the key, which a scan can use; by name where a name is no period."""
        chosen, key = self.selector, F.col(self.key)
        named = [name for name in (*(chosen.names or ()), chosen.begin, chosen.end) if name]
        periods = {name: times.named_period(name, self.unit) for name in named}
        if not all(periods.values()):
            return chosen.keeps(times.period_name(self.group_column(), self.unit))
        kept = key.isNotNull()
        if chosen.names is not None:
            days = [F.lit(periods[name][0]).cast("date") for name in chosen.names]
            first = min(periods[name][0] for name in chosen.names)
            last = max(periods[name][1] for name in chosen.names)
            kept = self.group_column().isin(*days) & (key >= F.lit(first).cast(kind)) & (key < F.lit(last).cast(kind))
        if chosen.begin:
            kept = kept & (key >= F.lit(periods[chosen.begin][0]).cast(kind))
        if chosen.end:
            kept = kept & (key < F.lit(periods[chosen.end][0]).cast(kind))
        return kept


@dataclass(frozen=True)
class Store:
    """Where tables live: a Spark format, its options, and a root folder or a table option.

    Path formats keep ``table`` under ``root``. Others name it through ``table_option``,
    such as ``dbtable`` for JDBC.
    """

    format: str = "parquet"
    root: str = ""
    options: Mapping[str, str] = field(default_factory=dict)
    table_option: str = ""
    database: str = ""

    def path(self, table: str) -> str | None:
        return f"{self.root.rstrip('/')}/{table}" if self.root else None

    def _options(self, table: str) -> dict[str, str]:
        options = dict(self.options)
        if self.table_option:
            options[self.table_option] = f"{self.database}.{table}" if self.database else table
        return options

    def read(self, spark: SparkSession, table: str, schema: T.StructType | None = None) -> DataFrame:
        reader = spark.read.format(self.format).options(**self._options(table))
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(self.path(table)) if self.root else reader.load()

    def append(self, df: DataFrame, table: str) -> None:
        writer = df.write.format(self.format).options(**self._options(table)).mode("append")
        writer.save(self.path(table)) if self.root else writer.save()


@dataclass(frozen=True)
class Layout:
    """Physical options of written files."""

    compression: str = ""
    bloom_columns: tuple[str, ...] = ()
    bucket_columns: tuple[str, ...] = ()
    buckets: int = 0

    def options(self) -> dict[str, str]:
        options = {f"parquet.bloom.filter.enabled#{name}": "true" for name in self.bloom_columns}
        if self.compression:
            options["compression"] = self.compression
        return options


def as_column(expression: str | Column) -> Column:
    return F.expr(expression) if isinstance(expression, str) else expression


def typed_literal(value: object, kind: T.DataType) -> Column:
    """A literal of the given type; Python times go by their text, so no session zone shifts them."""
    return F.lit(str(value) if isinstance(value, dt.date) else value).cast(kind)
