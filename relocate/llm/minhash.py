"""Near-duplicate documents by SuperMinHash signatures, banding, exact verification and union-find grouping.

Texts with equal shingle sets are one class and go on as its smallest id. Classes that share a band meet in a bucket.
All members of a bucket are first compared with its centre, the member that meets most others. Buckets with the same
centre then form a group. Members that are not yet in the centre's component are compared with all others of the group
that are in another component, in blocks of a bounded size inside tasks, which emit the links of a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relocate.llm import shipped, words
from relocate.llm.components import Forest, components
from relocate.llm.memory import lean
from relocate.session import saved

BANDS, ROWS = 30, 5
BROADCAST_ROWS = 2_000_000
#: Shingles in one block of a group: of members, and of those that are compared with them.
BLOCK_SHINGLES, REST_SHINGLES = 1 << 20, 1 << 18
#: Text that is signed at once: shingles of short texts take some 600 bytes each there.
SIGNED_BYTES = 1 << 19
_UNSET = np.uint64(2**64 - 1)
_STEP = 0x9E3779B97F4A7C15
_DIRECT = 4


def shingle_sets(found: words.Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text's runs of ``size`` lower-cased words, their second hashes, and borders by text.

    A text of fewer words is one run; one without words has none.
    """
    counts = np.diff(found.bounds)
    sizes = np.maximum(counts - size + 1, (counts > 0).astype(np.int64))
    borders = np.concatenate([[0], np.cumsum(sizes)])
    long, short = np.repeat(counts >= size, sizes), np.flatnonzero((counts > 0) & (counts < size))
    halves = []
    for second in (False, True):
        hashes = found.hashes(lower=True, second=second)
        out = np.empty(borders[-1], np.uint64)
        out[long] = words.runs_of(hashes, size)[words.starts_inside(found.bounds, size, len(hashes))]
        for i in short:
            out[borders[i]] = words.runs_of(hashes[found.bounds[i] : found.bounds[i + 1]], int(counts[i]))[0]
        halves.append(out)
    first, other = halves
    for a, b in zip(borders[:-1], borders[1:]):
        order = np.argsort(first[a:b])
        first[a:b], other[a:b] = first[a:b][order], other[a:b][order]
    fresh = np.ones(len(first), bool)
    fresh[1:] = first[1:] != first[:-1]
    fresh[borders[:-1][sizes > 0]] = True
    return first[fresh], other[fresh], np.concatenate([[0], np.cumsum(fresh)])[borders]


def superminhash(elements: np.ndarray, borders: np.ndarray, size: int) -> np.ndarray:
    """SuperMinHash signatures, one row of ``size`` numbers for each set ``elements[borders[i]:borders[i + 1]]``.

    Each element is ranked at every place by a random permutation of its own: step ``j`` gives its ``j``-th place the
    value ``j`` plus a random fraction. A set is done at the step that fills its last place, since later steps only
    bring larger values. All sets take each step together.
    """
    count = len(borders) - 1
    signature = np.full(count * size, _UNSET)
    owners = np.repeat(np.arange(count), np.diff(borders))
    drawn: list[np.ndarray] = []
    order = None
    for j in range(size):
        if not len(elements):
            break
        random = words.mixed(elements + np.uint64((j + 1) * _STEP % 2**64))
        at = (j + ((random >> np.uint64(32)) * np.uint64(size - j) >> np.uint64(32))).astype(np.int64)
        if j == _DIRECT:
            order = np.tile(np.arange(size, dtype=np.int16), (len(elements), 1))
            rows = np.arange(len(elements))
            for t, other in enumerate(drawn):
                order[rows, t], order[rows, other] = order[rows, other], order[rows, t]
        if j < _DIRECT:
            place = at
            for t in reversed(range(j)):
                place = np.where(drawn[t] == place, t, place)
        else:
            rows = np.arange(len(elements))
            place = order[rows, at].astype(np.int64)
            order[rows, at] = order[rows, j]
        value = np.uint64(j << 32) | (random & np.uint64(0xFFFFFFFF))
        np.minimum.at(signature, owners * size + place, value)
        unfinished = (signature.reshape(count, size) == _UNSET).any(axis=1)[owners]
        if j < _DIRECT:
            drawn.append(at)
        if not unfinished.all():
            elements, owners = elements[unfinished], owners[unfinished]
            drawn = [d[unfinished] for d in drawn]
            order = order[unfinished] if order is not None else None
    return signature.reshape(count, size)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(signatures), bands), np.uint64)
    parts = signatures.reshape(len(signatures), bands, rows)
    for r in range(rows):
        keys = words.mixed(keys * np.uint64(_STEP) + parts[:, :, r])
    return words.mixed(keys + np.arange(bands, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _sums(first: np.ndarray, second: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers that stand for a set, one of each half of its members' hashes."""
    out = []
    for half in (first, second):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words.mixed(half))])
        out.append((sums[borders[1:]] - sums[borders[:-1]]).view(np.int64))
    return out[0], out[1]


def _signed(shingle: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, found in words.slices(batch.column(1), SIGNED_BYTES):
                elements, second, borders = shingle_sets(found, shingle)
                keys = band_keys(superminhash(elements, borders, bands * rows), bands, rows)
                offsets = pa.array(np.arange(to - at + 1, dtype=np.int32) * bands)
                set_a, set_b = _sums(elements, second, borders)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch.column(0).slice(at, to - at),
                        "n": pa.array(np.diff(borders)),
                        "set_a": pa.array(set_a),
                        "set_b": pa.array(set_b),
                        "bands": pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1).view(np.int64))),
                    }
                )

    return lean(sign)


def _listed(shingle: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, found in words.slices(batch.column(1)):
                elements, second, borders = shingle_sets(found, shingle)
                set_a, set_b = _sums(elements, second, borders)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch.column(0).slice(at, to - at),
                        "set_a": pa.array(set_a),
                        "set_b": pa.array(set_b),
                        "shingles": pa.ListArray.from_arrays(
                            pa.array(borders.astype(np.int32)), pa.array(elements.view(np.int64))
                        ),
                    }
                )

    return lean(sets)


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` of each row of ``docs``: groups of documents that resemble each other.

    Two documents are linked when ``100 * |A & B| >= percent * |A | B|`` for their sets of distinct runs of ``shingle``
    lower-cased words. The component is the smallest id reachable by links; that document is kept. Null and empty texts
    have no set and are linked with nothing; rows with a null id too, and are kept with a null component. Repeated rows
    get the same answer. An empty table gives no rows. Other columns of ``docs`` are ignored. A link of exactly
    ``percent`` is missed with a chance of ``(1 - (percent / 100) ** rows) ** bands``, 7 in a million as set.
    """
    spark = shipped(docs.sparkSession)
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    signed = saved(
        texts.mapInArrow(_signed(shingle, bands, rows), "id long, n long, set_a long, set_b long, bands array<long>"),
        "minhash-signatures",
    )
    linkable = signed.filter("n > 0 AND id IS NOT NULL")
    classes = saved(
        linkable.groupBy("set_a", "set_b").agg(
            F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")
        ),
        "minhash-classes",
    )
    posted = classes.select("rep", "n", F.explode("bands").alias("key"))
    buckets = posted.groupBy("key").agg(F.count("*").alias("met")).filter("met > 1")
    meetings = saved(posted.join(buckets, "key"), "minhash-meetings")

    centrality = meetings.groupBy("rep").agg(F.sum("met").alias("score"))
    centres = (
        meetings.join(centrality, "rep")
        .groupBy("key")
        .agg(F.max(F.struct("score", F.negative("rep").alias("rep"), "n")).alias("c"))
        .select("key", F.negative("c.rep").alias("a"), F.col("c.n").alias("n_a"))
    )
    members = saved(
        meetings.join(centres, "key").select("a", "n_a", F.col("rep").alias("b"), "n").distinct(), "minhash-members"
    )
    stars = members.filter(f"a <> b AND 100 * least(n, n_a) >= {percent} * greatest(n, n_a)").select("a", "b")
    sets = _candidate_sets(texts, classes, meetings, shingle)
    links = saved(_verified(stars, sets, percent), "minhash-links")
    more = _across(members, components(links), sets, percent)
    labels = components(links.unionByName(more))

    known = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_a", "set_b", F.coalesce("component", "rep").alias("component")
    )
    alone = signed.filter("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("component"))
    grouped = linkable.select("id", "n", "set_a", "set_b").join(known, ["set_a", "set_b"]).select("id", "n", "component")
    return grouped.unionByName(alone).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def _candidate_sets(texts: DataFrame, classes: DataFrame, meetings: DataFrame, shingle: int) -> DataFrame:
    """Shingle sets of the classes that meet another: ``(id, shingles)``."""
    wanted = classes.join(meetings.select("rep").distinct(), "rep").select(
        F.col("rep").alias("id"), F.col("set_a").alias("own_a"), F.col("set_b").alias("own_b")
    )
    wanted = saved(wanted, "minhash-wanted")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    rows = texts.join(wanted, "id").select("id", "text", "own_a", "own_b")
    keys = rows.select("id", "text")
    sets = keys.mapInArrow(_listed(shingle), "id long, set_a long, set_b long, shingles array<long>")
    # of rows that share an id, those of another text are left out
    own = sets.join(wanted, "id").filter("set_a = own_a AND set_b = own_b")
    return saved(own.select("id", "shingles"), "minhash-sets")


def _across(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components within the groups of the centres, as far as they connect anything."""
    own = labels.select(F.col("node").alias("b"), F.col("component").alias("c"))
    centre = labels.select(F.col("node").alias("a"), F.col("component").alias("c_a"))
    labelled = (
        members.join(own, "b", "left")
        .join(centre, "a", "left")
        .select("a", "b", "n", F.coalesce("c", "b").alias("c"), F.coalesce("c_a", "a").alias("c_a"))
        .withColumn("rest", F.col("c") != F.col("c_a"))
    )
    sizes = (
        labelled.groupBy("a")
        .agg(F.sum("n").alias("all"), F.sum(F.when(F.col("rest"), F.col("n"))).alias("open"))
        .filter("open > 0")
        .select(
            "a",
            F.ceil(F.col("all") / BLOCK_SHINGLES).cast("int").alias("blocks"),
            F.ceil(F.col("open") / REST_SHINGLES).cast("int").alias("rests"),
        )
    )
    placed = saved(labelled.join(sizes, "a").select("a", "b", "c", "rest", "blocks", "rests"), "minhash-groups")
    block = F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int")
    part = F.pmod(F.xxhash64("b", F.lit("rest")), F.col("rests")).cast("int")
    every = placed.select(
        "a", "b", "c", F.lit(False).alias("rest"), block.alias("block"), F.explode(F.expr("sequence(0, rests - 1)")).alias("part")
    )
    rest = placed.filter("rest").select(
        "a", "b", "c", "rest", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), part.alias("part")
    )
    full = every.unionByName(rest).join(sets.withColumnRenamed("id", "b"), "b")
    return full.groupBy("a", "part", "block").applyInArrow(_compared(percent), "a long, b long")


def _compared(percent: int):
    def compare(group: pa.Table) -> pa.Table:
        rest = group["rest"].to_numpy()
        ids, found = group["b"].to_numpy(), group["c"].to_numpy()
        lists = group["shingles"].combine_chunks()
        elements, borders = lists.flatten().to_numpy().view(np.uint64), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        sizes = np.diff(borders)
        left, right = np.flatnonzero(rest), np.flatnonzero(~rest)
        forest = Forest()
        # places of each shingle among the left sets
        mine = np.concatenate([elements[:0]] + [elements[borders[i] : borders[i + 1]] for i in left])
        owners = np.repeat(np.arange(len(left)), sizes[left])
        order = np.argsort(mine, kind="stable")
        mine, owners = mine[order], owners[order]
        for j in right if len(left) else ():
            other = elements[borders[j] : borders[j + 1]]
            first, last = np.searchsorted(mine, other, "left"), np.searchsorted(mine, other, "right")
            spans = last - first
            hit = np.repeat(first - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
            common = np.bincount(owners[hit], minlength=len(left))
            union = sizes[left] + sizes[j] - common
            alike = (100 * common >= percent * union) & ((100 - percent) * union >= 100) & (found[left] != found[j])
            for i in left[alike]:
                forest.join(int(ids[i]), int(ids[j]))
        edges = forest.edges()
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return compare


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are alike enough.

    Equal sets are one class already, so a pair needs a union in which one member more or less leaves it alike enough;
    below that, only a clash of hashes could make it seem so.
    """
    with_b = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b")
    both = with_b.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    both = both.select("a", "b", common.alias("common"), (F.size("set_a") + F.size("set_b")).alias("total"))
    alike = f"100 * common >= {percent} * (total - common) AND (100 - {percent}) * (total - common) >= 100"
    return both.filter(alike).select("a", "b")
