"""Substring dedup by level-wise doubling.

A window is a run of ``min_words`` words of one text. Runs of about a quarter of that length are looked at first: each
window is represented by the run inside it with the least hash, so equal windows are represented by equal runs, and
only about one run in ten has to be counted. Windows whose run occurs once in the whole corpus are dropped. The others
go on with runs of twice the length, and so on until the runs are the windows themselves or no candidate survives.
Windows that are left are then counted once more by hashes independent of the first, so that text goes only where 128
bits agree.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relocate.llm import exchange, words
from relocate.llm.blocks import saved_blocks, unpacked
from relocate.llm.memory import lean
from relocate.session import saved

SHORTEST = 10
BROADCAST_BYTES = 32 << 20


def levels(min_words: int) -> list[tuple[int, bool]]:
    """Run lengths, each at most twice the one before up to ``min_words``, and whether second hashes are used: at last."""
    found = [min_words]
    while found[0] > SHORTEST:
        found.insert(0, (found[0] + 1) // 2)
    return [(length, False) for length in found] + [(min_words, True)]


class _Level:
    """Windows of one block, seen through their runs of ``length`` words."""

    def __init__(self, runs: np.ndarray, length: int, min_words: int):
        self.runs, self.length, self.min_words = runs, length, min_words
        self.width = min_words - length + 1
        self.keys = words.windowed(runs, self.width, np.minimum)

    def occurrences(self, alive: np.ndarray) -> np.ndarray:
        """Hashes of the runs that represent a live window, once for each place in the block."""
        if not len(self.keys):
            return self.keys
        edge = np.zeros(self.width - 1, np.uint64)
        highest = words.windowed(np.concatenate([edge, np.where(alive, self.keys, 0), edge]), self.width, np.maximum)
        return self.runs[highest == self.runs]

    def surviving(self, alive: np.ndarray, ranges: int, parts: list[dict]) -> np.ndarray:
        distinct = np.unique(self.occurrences(alive))
        if not len(distinct):
            return alive & False
        again = exchange.flags_of(distinct, ranges, parts)
        where = np.minimum(np.searchsorted(distinct, self.keys), len(distinct) - 1)
        return alive & again[where]


def _level(found: words.Words, level: tuple[int, bool], min_words: int) -> _Level:
    length, second = level
    return _Level(words.runs_of(found.hashes(second=second), length), length, min_words)


def _bits(alive: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(alive).tobytes(), 1) if alive.any() else b""


def _alive(bits: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8), count=count).astype(bool)


def _words_of(payload: bytes, text_col: str) -> tuple[pa.RecordBatch, words.Words]:
    batch = unpacked(payload)
    return batch, words.split_words(*words.layout(batch.column(batch.schema.get_field_index(text_col))))


_STATE = "block_id long, alive binary, keys binary, counts binary"


def _state(block: int, level: _Level | None = None, alive: np.ndarray | None = None) -> pa.RecordBatch:
    """A block's live windows and the runs to count for them; without a level, none are left."""
    bits = b"" if level is None else _bits(alive)
    keys, counts = exchange.packed(level.occurrences(alive), most=2) if bits else (b"", b"")
    return pa.RecordBatch.from_pydict(
        {"block_id": pa.array([block], pa.int64())}
        | {k: pa.array([v], pa.binary()) for k, v in (("alive", bits), ("keys", keys), ("counts", counts))}
    )


def without_repeats(
    docs: DataFrame, min_words: int = 35, text_col: str = "text", counts: tuple[str, str] | None = None
) -> DataFrame:
    """``docs`` without the words that lie in a window whose words also start anywhere else, in the same text or another.

    All rows and columns stay, repeated rows too; only ``text_col`` changes. Windows are judged on the input. Words are
    compared as they stand. Where words are removed, the blanks after them go as well; a text that loses none is
    unchanged. A null text stays null; a text of fewer than ``min_words`` words stays as it is. Every copy of a repeated
    passage goes, the first included. ``counts`` names two columns to add: the text's words, and those removed; they
    replace columns of the same name. An empty table gives an empty table. Memory of a task: some dozen bytes per byte
    of the longest text.
    """
    lengths = levels(min_words)
    blocks = saved_blocks(docs, "substring-blocks")

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch["block_id"].to_pylist(), batch["payload"]):
                found = _words_of(payload.as_py(), text_col)[1]
                alive = words.starts_inside(found.bounds, min_words, len(found.starts))
                yield _state(block, _level(found, lengths[0], min_words), alive)

    state = saved(blocks.mapInArrow(lean(begin), _STATE), "substring-state")
    joined = ranges = None
    for k in range(len(lengths)):
        size = state.agg(
            F.coalesce(F.sum(F.octet_length("keys")), F.lit(0)).alias("keys"),
            F.coalesce(F.sum(F.octet_length("alive")), F.lit(0)).alias("alive"),
        ).first()
        ranges = exchange.ranges_for(size["keys"] // 8)
        flags = exchange.gathered(exchange.repeated(state, ranges), "flags")
        marks = saved(state.select("block_id", "alive").join(flags, "block_id", "left"), "substring-flags")
        # bits of the windows, and a bit and a number of bytes for each key
        small = size["alive"] + size["keys"] // 8 <= BROADCAST_BYTES
        joined = blocks.join(F.broadcast(marks) if small else marks, "block_id")
        if k + 1 < len(lengths):
            state = saved(joined.mapInArrow(_step(text_col, min_words, lengths, k, ranges), _STATE), "substring-state")

    names = docs.columns if counts is None else [c for c in docs.columns if c not in counts]
    schema = docs.select(*[docs[c] for c in names]).schema
    if counts is not None:
        schema = schema.add(counts[0], "long").add(counts[1], "long")
    finish = _finish(text_col, min_words, lengths[-1], ranges, names, counts)
    return joined.mapInArrow(finish, schema)


def _step(text_col: str, min_words: int, lengths: list[tuple[int, bool]], k: int, ranges: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, bits, parts = (batch[c][row].as_py() for c in ("block_id", "alive", "parts"))
                if not bits:
                    yield _state(block)
                    continue
                found = _words_of(batch["payload"][row].as_py(), text_col)[1]
                level = _level(found, lengths[k], min_words)
                alive = level.surviving(_alive(bits, len(level.keys)), ranges, parts or [])
                yield _state(block, _level(found, lengths[k + 1], min_words), alive) if alive.any() else _state(block)

    return lean(step)


def _finish(
    text_col: str, min_words: int, last: tuple[int, bool], ranges: int, names: list[str], counts: tuple[str, str] | None
):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in range(rows.num_rows):
                payload, bits, parts = (rows[c][row].as_py() for c in ("payload", "alive", "parts"))
                batch, found = _words_of(payload, text_col)
                texts, removed = batch[text_col], np.zeros(batch.num_rows, np.int64)
                if bits:
                    level = _level(found, last, min_words)
                    alive = level.surviving(_alive(bits, len(level.keys)), ranges, parts or [])
                    texts, removed = _kept(texts, found, alive, min_words)
                columns = {c: texts if c == text_col else batch[c] for c in names}
                if counts is not None:
                    columns |= {counts[0]: pa.array(np.diff(found.bounds)), counts[1]: pa.array(removed)}
                yield pa.RecordBatch.from_pydict(columns)

    return lean(finish)


def _kept(texts: pa.Array, found: words.Words, alive: np.ndarray, min_words: int) -> tuple[pa.Array, np.ndarray]:
    """Texts without the words that live windows cover, and how many each lost."""
    total = len(found.starts)
    change = np.zeros(total + 1, np.int64)
    at = np.flatnonzero(alive)
    np.add.at(change, at, 1)
    np.add.at(change, at + min_words, -1)
    covered = np.cumsum(change[:-1]) > 0
    removed = np.add.reduceat(np.append(covered, False).astype(np.int64), found.bounds[:-1]) if len(texts) else np.zeros(0, np.int64)
    removed[np.diff(found.bounds) == 0] = 0
    if not removed.any():
        return texts, removed
    values = texts.to_pylist()
    ends = np.append(found.starts, len(found.data))
    for i in np.flatnonzero(removed):
        first, last = found.bounds[i], found.bounds[i + 1]
        own = covered[first:last]
        # kept runs: from their first word up to the word after them
        edge = np.diff(np.concatenate([[False], ~own, [False]]).astype(np.int8))
        pieces = []
        for a, b in zip(np.flatnonzero(edge == 1) + first, np.flatnonzero(edge == -1) + first):
            pieces.append(found.data[found.starts[a] : found.ends[b - 1] if b == last else ends[b]].tobytes())
        values[i] = b"".join(pieces).decode().rstrip(" \t\n\x0b\x0c\r")
    return pa.array(values, texts.type), removed
