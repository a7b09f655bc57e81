"""Sums over all blocks of a data set, handed back to each block.

A block is a row that stands for some documents. It brings its distinct 64-bit keys, each with a number. Keys are dealt
to tasks by their leading bits, so each task adds up a fixed share of them, and each block gets the totals of its own
keys in its own order. A key, however frequent, comes once from each block, so none is hot.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS_PER_RANGE = 1 << 20


def packed(keys: np.ndarray, counts: np.ndarray | None = None, most: int | None = None) -> tuple[bytes, bytes]:
    """Sorted distinct keys and their summed counts (at most ``most``) as bytes."""
    if counts is None:
        distinct, counts = np.unique(keys, return_counts=True)
    else:
        distinct, where = np.unique(keys, return_inverse=True)
        counts = np.bincount(where, weights=counts, minlength=len(distinct))
    counts = counts.astype(np.int64)
    return distinct.tobytes(), (np.minimum(counts, most).astype(np.uint8) if most else counts.astype(np.uint32)).tobytes()


def ranges_for(keys: int) -> int:
    """Power of two of ranges that leaves about ``KEYS_PER_RANGE`` incoming keys to each."""
    return 1 << max(6, math.ceil(math.log2(max(1, keys) / KEYS_PER_RANGE)))


def dealt(blocks: DataFrame, ranges: int, width: int) -> DataFrame:
    """``(range, block_id, keys, counts)`` of blocks ``(block_id, keys, counts)`` with counts of ``width`` bytes."""
    shift = np.uint64(64 - int(math.log2(ranges)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                array = np.frombuffer(keys, np.uint64)
                edges = np.searchsorted(array >> shift, np.arange(ranges + 1, dtype=np.uint64))
                full = np.flatnonzero(np.diff(edges))
                if len(full):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(full, pa.int32()),
                            pa.array([block] * len(full), pa.int64()),
                            pa.array([keys[8 * edges[r] : 8 * edges[r + 1]] for r in full], pa.binary()),
                            pa.array([counts[width * edges[r] : width * edges[r + 1]] for r in full], pa.binary()),
                        ],
                        ["range", "block_id", "keys", "counts"],
                    )

    return blocks.select("block_id", "keys", "counts").mapInArrow(deal, "range int, block_id long, keys binary, counts binary")


def added(keys: list[bytes], counts: list[bytes], kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of a range, their totals, and for the incoming keys in their order: place among them, and borders by block."""
    sizes = np.array([len(k) // 8 for k in keys])
    distinct, where = np.unique(np.frombuffer(b"".join(keys), np.uint64), return_inverse=True)
    totals = np.bincount(where, weights=np.frombuffer(b"".join(counts), kind), minlength=len(distinct))
    return distinct, totals.astype(np.int64), where, np.concatenate([[0], np.cumsum(sizes)])


def repeated(blocks: DataFrame, ranges: int) -> DataFrame:
    """``(block_id, range, flags)``: one bit for each key of the block in the range, set when its total is two or more.

    Counts are single bytes, cut at two by the blocks.
    """

    def add(rows: pa.Table) -> pa.Table:
        _, totals, where, borders = added(rows["keys"].to_pylist(), rows["counts"].to_pylist(), np.uint8)
        again = totals[where] > 1
        flags = [np.packbits(again[a:b]).tobytes() for a, b in zip(borders[:-1], borders[1:])]
        return pa.table(
            {"block_id": rows["block_id"], "range": rows["range"], "flags": pa.array(flags, pa.binary())}
        )

    return dealt(blocks, ranges, 1).groupBy("range").applyInArrow(add, "block_id long, range int, flags binary")


def gathered(parts: DataFrame, value: str) -> DataFrame:
    """One row per block with its ranges in order: ``(block_id, parts array<struct<range, value>>)``."""
    return parts.groupBy("block_id").agg(F.sort_array(F.collect_list(F.struct("range", value))).alias("parts"))


def flags_of(keys: np.ndarray, ranges: int, parts: list[dict]) -> np.ndarray:
    """The flags of a block's keys from what :func:`repeated` returned for it."""
    shift = np.uint64(64 - int(math.log2(ranges)))
    edges = np.searchsorted(keys >> shift, np.arange(ranges + 1, dtype=np.uint64))
    out = np.zeros(len(keys), bool)
    for part in parts:
        a, b = edges[part["range"]], edges[part["range"] + 1]
        out[a:b] = np.unpackbits(np.frombuffer(part["flags"], np.uint8), count=b - a)
    return out


def summed(blocks: DataFrame, ranges: int, entry: np.dtype, propose: int) -> DataFrame:
    """Totals of the keys of each block, and what each range says of all its keys.

    ``counts`` of the blocks hold entries of type ``entry`` with fields ``count`` and ``bucket``. Rows with a block have
    ``totals``, the corpus-wide counts of its keys in the range as zstd-compressed 64-bit numbers. One row for each range
    without a block has ``sums`` and ``kinds``: total and number of counted keys by bucket, and ``top``: the ``propose``
    most frequent keys with their counts and buckets.
    """
    buckets = 1 + np.iinfo(entry["bucket"]).max
    schema = "range int, block_id long, totals binary, sums binary, kinds binary, top binary"

    def add(rows: pa.Table) -> pa.Table:
        entries = np.frombuffer(b"".join(rows["counts"].to_pylist()), entry)
        borders = np.concatenate([[0], np.cumsum([len(k) // 8 for k in rows["keys"].to_pylist()])]).astype(np.int64)
        keys = np.frombuffer(b"".join(rows["keys"].to_pylist()), np.uint64)
        distinct, first, where = np.unique(keys, return_index=True, return_inverse=True)
        totals = np.bincount(where, weights=entries["count"], minlength=len(distinct)).astype(np.int64)
        own = entries["bucket"][first]
        seen = totals > 0
        sums = np.bincount(own, weights=totals, minlength=buckets).astype(np.int64)
        kinds = np.bincount(own[seen], minlength=buckets).astype(np.int64)
        best = np.lexsort((distinct, -totals))[:propose]
        best = best[totals[best] > 0]
        top = np.rec.fromarrays([distinct[best], totals[best], own[best]], dtype=TOP)
        back = totals[where]
        size = rows.num_rows
        packs = [pa.compress(back[a:b].tobytes(), "zstd", asbytes=True) for a, b in zip(borders[:-1], borders[1:])]
        squeezed = [pa.compress(x.tobytes(), "zstd", asbytes=True) for x in (sums, kinds)]
        return pa.table(
            {
                "range": pa.array([rows["range"][0].as_py()] * (size + 1), pa.int32()),
                "block_id": pa.array([*rows["block_id"].to_pylist(), None], pa.int64()),
                "totals": pa.array([*packs, None], pa.binary()),
                "sums": pa.array([None] * size + [squeezed[0]], pa.binary()),
                "kinds": pa.array([None] * size + [squeezed[1]], pa.binary()),
                "top": pa.array([None] * size + [top.tobytes()], pa.binary()),
            }
        )

    return dealt(blocks, ranges, entry.itemsize).groupBy("range").applyInArrow(add, schema)


TOP = np.dtype([("key", "<u8"), ("count", "<i8"), ("bucket", "<u2")])


def totals_of(keys: np.ndarray, ranges: int, parts: list[dict]) -> np.ndarray:
    """The totals of a block's keys from what :func:`summed` returned for it."""
    shift = np.uint64(64 - int(math.log2(ranges)))
    edges = np.searchsorted(keys >> shift, np.arange(ranges + 1, dtype=np.uint64))
    out = np.zeros(len(keys), np.int64)
    for part in parts:
        a, b = edges[part["range"]], edges[part["range"] + 1]
        out[a:b] = np.frombuffer(pa.decompress(part["totals"], 8 * (b - a), "zstd", asbytes=True), np.int64)
    return out
