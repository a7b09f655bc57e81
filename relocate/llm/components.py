"""Connected components of a graph whose edges do not fit in one place.

Each task first contracts its own edges by union-find, so that at most one edge per node leaves it. What is left is
contracted across tasks by alternating large-star and small-star steps, until every node points at the smallest node
of its component. Only two numbers come to the driver after each step.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relocate.llm import shipped
from relocate.llm.memory import lean
from relocate.session import saved

FOREST_NODES = 500_000


class Forest:
    """Union-find whose roots are the least members."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = up.setdefault(y, y)
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def edges(self) -> list[tuple[int, int]]:
        return [(x, r) for x in self.up if (r := self.root(x)) != x]


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()

    def out() -> pa.RecordBatch:
        rows = forest.edges()
        return pa.RecordBatch.from_pydict(
            {"u": pa.array([r[0] for r in rows], pa.int64()), "v": pa.array([r[1] for r in rows], pa.int64())}
        )

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
        if len(forest.up) > FOREST_NODES:
            yield out()
            forest = Forest()
    yield out()


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``edges`` (two long columns); the component is its smallest node.

    Edges may repeat, in either direction; a node linked with itself alone, or with a null, is left out. No edges: no rows.
    """
    shipped(edges.sparkSession)
    a, b = edges.columns
    pairs = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u <> v")
    now = saved(pairs.mapInArrow(lean(contracted), "u long, v long").distinct(), "components")
    last, mark = None, _fingerprint(now)
    while mark != last:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = saved(rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "components")
        last, mark = mark, _fingerprint(now)
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
