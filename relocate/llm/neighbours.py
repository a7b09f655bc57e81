"""Near-duplicate vectors through an inverted multi-index.

Two codebooks, one for each half of the vectors, make a grid of cells. A vector is posted in the cell of its two nearest
codewords. As a query it visits cells in the order of how close they can be to it, by multi-sequence traversal of its
two sorted lists, and stops where no link can lie that is not also met from its other side. What it meets there is
verified by exact cosine.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relocate.llm import shipped
from relocate.llm.components import Forest, components
from relocate.session import saved

#: Vectors of a label that a cell should hold.
CELL_VECTORS = 64
MOST_CODEWORDS = 1024
BLOCK_VECTORS = 2048


@dataclass
class Index:
    """Codebooks of both halves, unit vectors assumed, and how far from a query a cell may begin."""

    halves: tuple[np.ndarray, np.ndarray]
    reach: float

    @property
    def width(self) -> int:
        return len(self.halves[1])

    @cached_property
    def gaps(self) -> list[np.ndarray]:
        """Distances between the codewords of a half."""
        return [np.array([np.sqrt(((book - word) ** 2).sum(1)) for word in book]) for book in self.halves]

    def bounds(self, vectors: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Least possible distance to the cells of each codeword, by half; and the own cell."""
        low, own = [], []
        middle = self.halves[0].shape[1]
        for part, book, gaps in zip((vectors[:, :middle], vectors[:, middle:]), self.halves, self.gaps):
            far = ((part**2).sum(1)[:, None] - 2 * part @ book.T + (book**2).sum(1)[None, :]).clip(0)
            nearest = far.argmin(axis=1)
            # distance to the plane half-way between the own codeword and the other
            apart = np.maximum(gaps[nearest], 1e-12)
            # less than what rounding can add, which close codewords would make large
            low.append(np.where(gaps[nearest] > 1e-12, (far - far.min(axis=1)[:, None] - 1e-12) / (2 * apart), 0).clip(0))
            own.append(nearest)
        return low, own[0] * self.width + own[1]

    def visits(self, vectors: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """The own cell of each vector, and all cells it visits, nearest first."""
        (first, second), own = self.bounds(vectors)
        most = self.reach**2
        out = []
        for i in range(len(vectors)):
            out.append(self._traverse(first[i], second[i], most))
        return own, out

    def _traverse(self, first: np.ndarray, second: np.ndarray, most: float) -> list[int]:
        rows, columns = (np.flatnonzero(x**2 <= most) for x in (first, second))
        rows, columns = rows[np.argsort(first[rows], kind="stable")], columns[np.argsort(second[columns], kind="stable")]
        a, b = first[rows] ** 2, second[columns] ** 2
        heap, seen, found = [(a[0] + b[0], 0, 0)], {(0, 0)}, []
        while heap:
            distance, i, j = heapq.heappop(heap)
            if distance > most:
                break
            found.append(int(rows[i]) * self.width + int(columns[j]))
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(a) and y < len(b) and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (a[x] + b[y], x, y))
        return found


def _unit(points: np.ndarray) -> np.ndarray:
    """Vectors of length 1; those whose squares are out of range are brought into it first."""
    with np.errstate(over="ignore", under="ignore"):
        size = np.linalg.norm(points, axis=1, keepdims=True)
        odd = ((size < 1e-140) | (size > 1e140))[:, 0]
        points[odd] /= np.abs(points[odd]).max(axis=1, keepdims=True)
        size[odd] = np.linalg.norm(points[odd], axis=1, keepdims=True)
    return points / size


def _codebook(points: np.ndarray, size: int, random: np.random.Generator) -> np.ndarray:
    """k-means with ten rounds."""
    points = np.unique(points, axis=0)
    book = points[random.choice(len(points), min(size, len(points)), replace=False)]
    for _ in range(10):
        far = (book**2).sum(1)[None, :] - 2 * points @ book.T
        nearest = far.argmin(axis=1)
        sums = np.zeros_like(book)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(book))
        book = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], book)
    return book


def fitted(sample: np.ndarray, labels: np.ndarray, codewords: int, cosine: float, recall: float, seed: int = 1) -> Index:
    """Codebooks from a sample of unit vectors, and a reach that finds every link, so any ``recall`` is met.

    Vectors as alike as ``cosine`` are at most ``r = sqrt(2 - 2 * cosine)`` apart. The plane between their codewords in
    a half lies between them, so what the two sides need to reach each other's cell adds up to their distance there at
    most. Over both halves the squares of the two ways add up to ``r ** 2`` at most, and one way is within
    ``r / sqrt(2)``. Nothing is read off the pairs of the sample (``labels``): large groups have nearly all of them.
    """
    random = np.random.Generator(np.random.PCG64(seed))
    middle = sample.shape[1] // 2
    halves = tuple(_codebook(part, codewords, random) for part in (sample[:, :middle], sample[:, middle:]))
    return Index(halves, math.sqrt(max(0.0, 1 - cosine)) + 1e-6)


def near_vectors(
    rows: DataFrame,
    cosine: float = 0.98,
    recall: float = 0.999,
    sample: int = 10_000,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``(id_col, n_links, component_id, kept)``: groups of vectors of equal labels with a cosine of ``cosine`` or more.

    The index is fitted on ``sample`` vectors, those with the least hashes of their ids; every vector is posted and is
    a query. Every link is found, whatever ``recall`` asks for. ``n_links`` counts the other ids linked directly, ``component_id`` is the smallest id reachable. Vectors
    that are null, empty, zero or hold a null or a number that is not finite, and those without label, are linked with
    nothing, as are vectors of different lengths. Equal vectors are compared once. Repeated rows get the same answer.
    Rows with a null id have a null component and are kept. An empty table gives no rows; other columns are ignored.
    """
    spark = shipped(rows.sparkSession)
    vector = rows[vector_col].cast("array<double>")
    numbered = rows.select(rows[id_col].cast("long").alias("id"), rows[label_col].alias("label"), vector.alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & sound, F.lit(False))
    marked = numbered.withColumn("usable", usable)
    keys = ["label", "k1", "k2"]
    own = marked.filter("usable").select(
        "id", "label", "v", F.xxhash64("v").alias("k1"), F.xxhash64(F.lit("again"), F.col("v")).alias("k2")
    )
    classes = saved(
        own.groupBy(*keys).agg(F.min("id").alias("rep"), F.count_distinct("id").alias("weight"), F.first("v").alias("v")), "vector-classes"
    )
    total, labels = classes.agg(F.count("*"), F.count_distinct("label")).first()
    links, edges = _linked(spark, classes, total, labels, cosine, recall, sample)
    members = components(edges).select(F.col("node").alias("rep"), "component")
    answered = (
        classes.select(*keys, "rep", "weight")
        .join(links, "rep", "left")
        .join(members, "rep", "left")
        .select(
            *keys, (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
        )
    )
    alone = marked.filter("NOT usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return (
        own.select("id", *keys)
        .join(answered, keys)
        .select("id", "n_links", "component_id")
        .unionByName(alone)
        .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
        .withColumnRenamed("id", id_col)
    )


def _linked(spark, classes: DataFrame, total: int, labels: int, cosine: float, recall: float, sample: int) -> tuple[DataFrame, DataFrame]:
    """Links of each class, as ``(rep, links)``, and edges that connect the same classes."""
    # a bounded sample of each length of vector
    drawn = classes.select("rep", "label", "v").orderBy(F.xxhash64("rep")).limit(sample).collect()
    codewords = int(min(MOST_CODEWORDS, max(4, math.ceil(math.sqrt(total / max(1, labels) / CELL_VECTORS)))))
    indexes: dict[int, Index] = {}
    for size in {len(r["v"]) for r in drawn}:
        some = [r for r in drawn if len(r["v"]) == size]
        points = np.array([r["v"] for r in some])
        points = _unit(points)
        names = np.unique([str(r["label"]) for r in some], return_inverse=True)[1]
        indexes[size] = fitted(points, names, codewords, cosine, recall)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch["v"].to_pylist()]) if batch.num_rows else np.zeros(0, int)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                part = batch.take(pa.array(at))
                points = np.array(part["v"].to_pylist())
                points = _unit(points)
                # a length that the sample lacks has one cell
                index = indexes.get(int(size))
                cells, visits = index.visits(points) if index else (np.zeros(len(at), int), [[0]] * len(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        part["label"], pa.array(np.full(len(at), size), pa.int32()), part["rep"], part["weight"],
                        pa.array([p.tobytes() for p in points], pa.binary()),
                        pa.array(cells, pa.int32()), pa.array(visits, pa.list_(pa.int32())),
                    ],
                    ["label", "size", "rep", "weight", "v", "own", "visits"],
                )

    kind = classes.schema["label"].dataType.simpleString()
    posted = saved(
        classes.select("label", "rep", "weight", "v").mapInArrow(
            post, f"label {kind}, size int, rep long, weight long, v binary, own int, visits array<int>"
        ),
        "vector-cells",
    )
    cell = ["label", "size", "cell"]
    held = posted.groupBy("label", "size", F.col("own").alias("cell")).agg(F.count("*").alias("m"))
    asked = posted.select("label", "size", F.explode("visits").alias("cell")).groupBy(*cell).agg(F.count("*").alias("q"))
    sizes = saved(
        held.join(asked, cell).select(
            *cell,
            F.ceil(F.col("m") / BLOCK_VECTORS).cast("int").alias("blocks"),
            F.ceil(F.col("q") / BLOCK_VECTORS).cast("int").alias("parts"),
        ),
        "vector-blocks",
    )
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block")
    part = F.pmod(F.xxhash64("rep", F.lit("query")), F.col("parts")).cast("int").alias("part")
    names = [*cell, "rep", "weight", "v", "own", "visits"]
    held = posted.withColumn("cell", F.col("own")).join(sizes, cell)
    held = held.select(*names, F.lit(False).alias("query"), block, F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
    asked = posted.withColumn("cell", F.explode("visits")).withColumn("visits", F.lit(None).cast("array<int>")).join(sizes, cell)
    asked = asked.select(*names, F.lit(True).alias("query"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), part)
    met = held.unionByName(asked).groupBy(*cell, "block", "part").applyInArrow(_met(cosine), "a long, b long, links long")
    met = saved(met, "vector-links")
    links = met.filter("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    return links, met.filter("b IS NOT NULL").select("a", "b")


def _met(cosine: float):
    """Links between the queries and the members of a cell.

    A pair is met from one side or from both. Met from both, each side counts its own link where it is the query; met
    from one, that side counts for both.
    """

    def meet(group: pa.Table) -> pa.Table:
        query = group["query"].to_numpy()
        ids, weights, own = (group[c].to_numpy() for c in ("rep", "weight", "own"))
        blobs = group["v"].to_pylist()
        stack = lambda rows: np.frombuffer(b"".join(blobs[i] for i in rows), np.float64).reshape(len(rows), -1)
        left, right = np.flatnonzero(query), np.flatnonzero(~query)
        forest, links = Forest(), np.zeros(len(ids), np.int64)
        if len(left) and len(right):
            visits = group["visits"].to_pylist()
            cells = 1 + max(int(own.max()), max(max(visits[j]) for j in right))
            back = np.array([j * cells + c for j in right for c in visits[j]])
            q, m = stack(left), stack(right)
            for at in range(0, len(left), 512):
                x, y = np.nonzero(q[at : at + 512] @ m.T >= cosine)
                x, y = left[x + at], right[y]
                apart = ids[x] != ids[y]
                x, y = x[apart], y[apart]
                np.add.at(links, x, weights[y])
                once = ~np.isin(y * cells + own[x], back)
                np.add.at(links, y[once], weights[x[once]])
                for a, b in zip(ids[x].tolist(), ids[y].tolist()):
                    forest.join(a, b)
        edges, counted = forest.edges(), np.flatnonzero(links)
        return pa.table(
            {
                "a": pa.array([e[0] for e in edges] + ids[counted].tolist(), pa.int64()),
                "b": pa.array([e[1] for e in edges] + [None] * len(counted), pa.int64()),
                "links": pa.array([None] * len(edges) + links[counted].tolist(), pa.int64()),
            }
        )

    return meet
