"""Mixing sources to target weights along a curriculum.

Each source has a weight schedule over the course of training. Its integral up to a moment is the source's cumulative
token demand; a document that stands at some token of its source is placed at the moment when the demand reaches that
token. Documents are then range-sorted by position, so the mix follows the schedules at every moment.

Places within a source are running sums in a fixed random order. They are added up in three steps, by bucket of the
order, by group of equal documents and task, and by document, so no task sees more than a bucket of a source.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from relocate.session import saved

#: Documents in one bucket of the order of all.
BUCKET_ROWS = 16_384
_BLANKS = r"[\x20\x09-\x0D]+"
_EXACT = "decimal(38,0)"


@dataclass(frozen=True)
class Schedule:
    """Weight over the course of training, from moment 0 to 1: straight lines between ``(moment, weight)`` points."""

    points: tuple[tuple[float, float], ...]

    def __post_init__(self):
        moments = [m for m, _ in self.points]
        if moments != sorted(set(moments)) or moments[:1] != [0.0] or moments[-1] != 1.0 or min(w for _, w in self.points) < 0:
            raise ValueError("points go from moment 0 to 1 with weights of 0 or more")
        if self.demand(1.0) <= 0:
            raise ValueError("a schedule needs some weight")

    def demand(self, moment: float) -> float:
        """Integral of the weight from 0 up to a moment."""
        total = 0.0
        for (a, u), (b, v) in zip(self.points, self.points[1:]):
            width = min(max(moment - a, 0.0), b - a)
            total += width * u + (v - u) / (b - a) * width * width / 2
        return total

    def moment(self, share: Column) -> Column:
        """The moment by which the given share of the whole demand is reached."""
        want = share * F.lit(self.demand(1.0))
        found = F.lit(1.0)
        for (a, u), (b, v) in reversed(list(zip(self.points, self.points[1:]))):
            rest = want - F.lit(self.demand(a))
            slope = (v - u) / (b - a)
            root = F.sqrt(F.greatest(F.lit(u * u) + F.lit(2 * slope) * rest, F.lit(0.0)))
            inside = F.when(rest > 0, F.lit(2.0) * rest / (F.lit(u) + root)).otherwise(F.lit(0.0))
            found = F.when(want < F.lit(self.demand(b)), F.lit(a) + inside).otherwise(found)
        return F.least(found, F.lit(1.0))


EVEN = Schedule(((0.0, 1.0), (1.0, 1.0)))
EARLY = Schedule(((0.0, 2.0), (1.0, 1.0)))
LATE = Schedule(((0.0, 0.0), (0.5, 1.0), (1.0, 2.0)))


def words_in(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    padded = F.regexp_replace(F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" ")), _BLANKS, " ")
    return (F.length(padded) - F.length(F.replace(padded, F.lit(" "), F.lit(""))) - 1).cast("long")


def numbered(df: DataFrame, order: str, name: str, label: str, pieces: int = 64) -> DataFrame:
    """``df`` with ``name``: 0 for its first row by ``order``, 1 for the next, without one task that sees all rows."""
    ranged = saved(df.repartitionByRange(pieces, order).withColumn("_piece", F.spark_partition_id()), label)
    sizes = ranged.groupBy("_piece").agg(F.count("*").alias("_n"))  # at most one row for each piece
    begins = sizes.select("_piece", _before("_n", Window.orderBy("_piece")).alias("_begin"))
    inside = F.row_number().over(Window.partitionBy("_piece").orderBy(order)) - 1
    return ranged.join(F.broadcast(begins), "_piece").withColumn(name, F.col("_begin") + inside).drop("_piece", "_begin")


def _before(column: str, window: WindowSpec) -> Column:
    """Sum of ``column`` over the rows before."""
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def targets(sources: DataFrame, weights: Sequence[int], percent: int, most: int) -> DataFrame:
    """``(source, source_size, rank, target)`` of sources ``(source, source_size)``, all of them non-null.

    Sources in order of code points take ``weights`` in turn. They share ``percent`` of all sizes by weight; a target
    stops at ``most`` times its source's size, and what lies above is shared again by weight among the others until none
    is above. If all stop, less than ``percent`` is given out.
    """
    ranked = numbered(sources, "source", "rank", "curriculum-ranked")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    weighed = saved(ranked.withColumn("weight", weight.cast("long")), "curriculum-sources")
    none = F.lit(0).cast(_EXACT)
    whole = int(weighed.agg(F.coalesce(F.sum(F.col("source_size").cast(_EXACT)), none)).first()[0])
    full = F.col("source_size").cast(_EXACT) * most
    shared, stopped = None, F.lit(False)
    while True:
        free, held = weighed.agg(
            F.coalesce(F.sum(F.when(~stopped, F.col("weight").cast(_EXACT))), none),
            F.coalesce(F.sum(F.when(stopped, full)), none),
        ).first()
        # a hundred times the words left to share, and the weight of those that share them
        left, now = percent * whole - 100 * int(held), int(free)
        if now == shared or now == 0:
            break
        shared = now
        stopped = F.col("source_size") * F.lit(float(100 * most * shared)) <= F.col("weight") * F.lit(float(left))
    share = F.col("weight") * F.lit(float(left)) / F.lit(float(100 * max(1, now)))
    target = F.when(stopped, (F.col("source_size") * most).cast("double")).otherwise(share)
    return weighed.select("source", "source_size", "rank", target.alias("target"))


def _key(docs: DataFrame, id_col: str, text_col: str, seed: str) -> Column:
    said = [F.coalesce(docs[c].cast("string"), F.lit("")) for c in (id_col, text_col)]
    return F.md5(F.concat(F.lit(seed), said[0], F.lit("\n"), said[1]))


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    schedules: Sequence[Schedule] = (EARLY, EVEN, LATE),
    percent: int = 150,
    most: int = 2,
    seed: str = "",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row for each document, with what the mix takes of it and when.

    Returns ``id_col``, the columns of ``keep``, and ``size`` (words of the text, 0 for null), ``source_size`` and
    ``target`` of its source (see :func:`targets`), ``taken`` and ``takes``, an array of ``(position, words)``: the
    moments between 0 and 1 at which its first ``words`` words go into training, one for each time.

    A source is gone through in an order that a hash of ids and texts fixes, again from the start until its target,
    rounded to whole words, is reached; so a document is taken at most ``most`` times, and the last one is cut where
    the target is reached. Positions are those of the middle of what is taken. Sources take ``schedules`` in turn, as
    they do ``weights``. Empty documents are never taken. Rows of equal id and text, and null ids, are documents of
    their own; a null source is a source. Files, tasks and reruns make no difference. An empty table gives no rows.
    """
    own = [docs[c] for c in (id_col, *keep)]
    names = [f"_keep{i}" for i in range(len(own))]
    given = docs[source_col].cast("string")
    rows = docs.select(
        *[c.alias(n) for c, n in zip(own, names)],
        # never null, and in the order of code points with null last
        F.when(given.isNull(), "b").otherwise(F.concat(F.lit("a"), given)).alias("source"),
        words_in(docs[text_col]).alias("size"),
        _key(docs, id_col, text_col, seed).alias("key"),
        F.spark_partition_id().alias("piece"),
    )
    rows = saved(rows, "curriculum-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sizes = saved(sizes, "curriculum-sizes")
    buckets = max(1, math.ceil((sizes.agg(F.sum("n")).first()[0] or 0) / BUCKET_ROWS))
    aims = targets(sizes.drop("n"), weights, percent, most)
    # the first 32 bits of the key, as a share of all buckets
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.lit(buckets)
    rows = rows.withColumn("bucket", F.shiftright(place, 32))

    # words before each bucket of a source, before each group in its bucket, and before each document in its group
    group = ["source", "bucket", "key", "size", "piece"]
    groups = rows.groupBy(*group).agg((F.count("*") * F.col("size")).alias("words"))
    in_source = groups.groupBy("source", "bucket").agg(F.sum("words").alias("words"))
    before = _before("words", Window.partitionBy("source").orderBy("bucket"))
    in_source = in_source.select("source", "bucket", before.alias("before_bucket")).join(aims, "source")
    before = _before("words", Window.partitionBy("source", "bucket").orderBy("key", "size", "piece"))
    groups = groups.select(*group, before.alias("before_group")).join(in_source, ["source", "bucket"])
    turn = F.row_number().over(Window.partitionBy(*group).orderBy(F.lit(1))) - 1
    placed = rows.withColumn("turn", turn).join(groups, group)
    begin = F.col("before_bucket") + F.col("before_group") + F.col("turn") * F.col("size")
    placed = placed.withColumn("begin", begin).withColumn("aim", F.round("target").cast("long"))

    takes = F.filter(F.array(*[_take(schedules, time) for time in range(most)]), lambda t: t["words"] > 0)
    placed = placed.withColumn("takes", takes)
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda s, t: s + t["words"]).alias("taken")
    kept = [F.col(n).alias(c) for n, c in zip(names, (id_col, *keep))]
    return placed.select(*kept, "size", "source_size", "target", taken, "takes")


def _take(schedules: Sequence[Schedule], time: int) -> Column:
    """What the mix takes of a document the given time around: ``(position, words)``, no words for nothing."""
    first = F.col("begin") + F.lit(time) * F.col("source_size")
    some = F.greatest(F.least(F.col("size"), F.col("aim") - first), F.lit(0).cast("long"))
    share = (first.cast("double") + some / F.lit(2.0)) / F.greatest(F.col("aim"), F.lit(1).cast("long"))
    at = F.coalesce(*[F.when(F.col("rank") % len(schedules) == i, s.moment(share)) for i, s in enumerate(schedules)])
    return F.struct(at.alias("position"), some.alias("words"))


def in_order(rows: DataFrame) -> DataFrame:
    """The training order: rows of :func:`mixed` once for each time they are taken, range-sorted by ``position``.

    Adds ``position`` and ``words`` in place of ``takes``. Written to files, the sorted tasks follow one another.
    """
    each = rows.select(*[c for c in rows.columns if c != "takes"], F.explode("takes").alias("_take"))
    each = each.select(*[c for c in each.columns if c != "_take"], "_take.position", "_take.words")
    return each.orderBy("position", *[c for c in each.columns if c not in ("position", "words")])
