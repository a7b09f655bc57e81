"""Export in waves: what is staged at one time stays under a size, however unequal the partitions are.

A table is measured by steps of its key inside each partition. Partitions that are too large are cut into slices of
neighbouring steps, a single step that is too large into parts by a hash of its rows. Slices are put into waves in the
order of partition and step, by the sum of what comes before them: no list is walked through, and a wave is one range
of that order.

Neighbouring waves are moved in rounds that share their jobs, so that many small waves cost few jobs and reads of the
table. A wave keeps its size, its stage folder and its load; a round stages at most the size of all its waves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relocate.functions.paths import WAVE_FIELD
from relocate.operators.sweep import running_sum
from relocate.session import broadcast_below, saved

# A slice holds less than two of so many parts of a wave.
GRAIN = 16

# Waves that are moved together.
ROUND = 1024

# Steps of a wave, or of a round, that are broadcast when its rows are read; a step with its names takes some 100 bytes.
BROADCAST_STEPS = 100_000


def key_steps(df: DataFrame, partition: Column, step: Column, size: Column) -> DataFrame:
    """``(partition, step, bytes)``: sizes added up before the shuffle. Rows without size weigh nothing."""
    steps = df.groupBy(partition.alias("partition"), step.alias("step"))
    return steps.agg(F.sum(F.coalesce(size.cast("bigint"), F.lit(0))).alias("bytes"))


def _times_over(value: Column, times: Column, by: Column) -> Column:
    """``value * times / by`` rounded down, in whole numbers of any size."""
    wide = value.cast("decimal(20,0)") * times.cast("decimal(18,0)")
    return F.call_function("div", wide, by.cast("decimal(20,0)"))


def _share(begin: Column, pieces: Column, total: Column) -> Column:
    """Which of ``pieces`` equal shares of ``total`` holds ``begin``, from 0."""
    return F.least(_times_over(begin, pieces, F.greatest(total, F.lit(1))), pieces.cast("bigint") - 1)


def _pieces(size: Column, limit: int) -> Column:
    """How many pieces of at most ``limit`` a size takes: 1 at least."""
    return F.greatest(F.call_function("div", size + F.lit(limit - 1), F.lit(limit)), F.lit(1)).cast("bigint")


def place(steps: DataFrame, cap: int) -> DataFrame:
    """Steps with the ``slice`` of their partition and the ``wave`` they are exported in, both from 0.

    ``steps`` has unique ``partition, step`` and ``bytes`` of 0 or more. A step above ``cap / GRAIN`` comes as several
    rows, ``part`` 0 to ``parts - 1``; others have one part. No wave holds more than ``cap`` bytes as measured, and two
    waves differ by less than ``cap / 4``; there are at most 8 / 7 of the least number, and one. Steps of NULL are a
    slice of their own. Partitions of NULL are a partition.
    """
    if cap < GRAIN:
        raise ValueError(f"a wave holds {GRAIN} bytes at least")
    limit = cap // GRAIN
    begun = running_sum(steps.select("partition", "step", "bytes"), ["partition", "step"], F.col("bytes"), "begin", "steps")
    whole = begun.groupBy(F.col("partition").alias("of")).agg(F.sum("bytes").alias("total"), F.min("begin").alias("first"))
    size, part, parts = F.col("bytes"), F.col("part"), F.col("parts")
    cut = (
        begun.join(whole, F.col("partition").eqNullSafe(F.col("of")))
        .withColumn("share", _share(F.col("begin") - F.col("first"), _pieces(F.col("total"), limit), F.col("total")))
        .withColumn("parts", _pieces(size, limit))
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
        .withColumn("bytes", _times_over(size, part + 1, parts) - _times_over(size, part, parts))
        .withColumn("_hot", parts > 1)
        .withColumn("_bare", F.col("step").isNull())
        .drop("of", "total", "first", "begin")
    )
    # a step above the limit is wider than a share, so that no other step of its share comes after it
    same = ["partition", "share", "_hot", "_bare", "part"]
    cut = saved(cut, "cut-steps")
    slices = saved(cut.groupBy(*same).agg(F.min("step").alias("low"), F.sum("bytes").alias("held")), "slices")
    total, largest = slices.agg(F.coalesce(F.sum("held"), F.lit(0)), F.coalesce(F.max("held"), F.lit(0))).first()
    waves = max(1, -(-total // (cap - largest)))
    number = F.row_number().over(Window.partitionBy("partition").orderBy("low", "part")) - 1
    found = running_sum(slices, ["partition", "low", "part"], F.col("held"), "before", "slice-sums").select(
        *(F.col(name).alias(f"s_{name}") for name in same),
        number.cast("bigint").alias("slice"),
        _share(F.col("before"), F.lit(waves), F.lit(total)).alias("wave"),
    )
    on = [F.col(name).eqNullSafe(F.col(f"s_{name}")) for name in same]
    return cut.join(found, on).select("partition", "step", "part", "parts", "bytes", "slice", "wave")


def slices(placed: DataFrame) -> DataFrame:
    """One row per slice: its first and last step, part, size and wave."""
    return placed.groupBy("wave", "partition", "slice", "part", "parts").agg(
        F.min("step").alias("low"), F.max("step").alias("high"), F.sum("bytes").alias("bytes")
    )


def numbers(placed: DataFrame) -> range:
    """The numbers of the waves."""
    last = placed.agg(F.max("wave")).first()[0]
    return range(0 if last is None else last + 1)


def rounds(placed: DataFrame, size: int | None = None) -> list[range]:
    """The waves in rounds of ``size``, ``ROUND`` if not given; with 1, one wave after the other is staged and loaded.

    Each round is read and moved by the same few jobs, whatever the number of its waves.
    """
    all_waves, size = numbers(placed), size or ROUND
    return [all_waves[at : at + size] for at in range(0, len(all_waves), size)]


def wave_rows(
    df: DataFrame, partition: Column, step: Column, key: Sequence[str], placed: DataFrame, wave: int
) -> DataFrame:
    """The rows of one wave. Over all waves each row comes once. Arguments are those of ``round_rows``."""
    return round_rows(df, partition, step, key, placed, range(wave, wave + 1)).drop(WAVE_FIELD)


def round_rows(
    df: DataFrame, partition: Column, step: Column, key: Sequence[str], placed: DataFrame, waves: range
) -> DataFrame:
    """The rows of neighbouring waves, with the number of their wave in ``paths.WAVE_FIELD``. Each row comes once.

    ``placed`` is saved. ``key`` names columns that tell rows of one step apart. The waves' range of partitions, and of
    steps where they lie in one partition, goes to the scan as literals.
    """
    mine = placed.where(F.col("wave").between(waves[0], waves[-1])).select("partition", "step", "part", "parts", "wave")
    ends = mine.agg(
        F.count("*").alias("n"), F.min("partition"), F.max("partition"), F.min("step"), F.max("step"),
        F.coalesce(F.bool_or(F.col("partition").isNull()), F.lit(False)),
        F.coalesce(F.bool_or(F.col("step").isNull()), F.lit(False)),
    ).first()
    count, first, last, low, high, no_partition, no_step = ends
    if not no_partition and first is not None:
        df = df.where(partition.between(F.lit(first), F.lit(last)))
        if first == last and not no_step:
            df = df.where(step.between(F.lit(low), F.lit(high)))
    names = {name: f"_wave_{name}" for name in mine.columns} | {"wave": WAVE_FIELD}
    mine = broadcast_below(mine.withColumnsRenamed(names), count, BROADCAST_STEPS)
    part = F.pmod(F.xxhash64(*key), F.col(names["parts"]))
    on = partition.eqNullSafe(F.col(names["partition"])) & step.eqNullSafe(F.col(names["step"]))
    # steps and their parts are unique in ``placed``, so no row comes twice
    return df.join(mine, on & (part == F.col(names["part"]))).select(*df.columns, WAVE_FIELD)
