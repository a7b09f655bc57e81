"""Order-preserving packing of tokenized documents into sequences of a fixed length, by dynamic programming.

The documents of a task, each followed by an end token, are one stream. It may be cut after documents, after sentences
and, where those lie too far apart, between words. Cuts are chosen to minimise padding plus a penalty for every cut
inside a document. The best cut before each place is the least of a sliding window, which a monotone queue gives in
constant time.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from relocate.llm import bpe, shipped
from relocate.llm.memory import lean

#: Tokens of padding that a cut after a sentence, or inside one, is worth.
SENTENCE, INSIDE = 32, 128
#: Where no document or sentence ends within so many tokens, cuts between words are allowed.
FAR = 256
RUN_TOKENS = 1 << 20
_STOPS, _CLOSERS = frozenset(".!?…。！？"), "\"'”’»)]"


def cuts(places: list[int], penalties: list[int], length: int) -> list[int]:
    """Indexes of the places to cut at, the last one included.

    ``places`` rise, start above 0 and lie at most ``length`` apart. The cost of a sequence is what is missing to
    ``length`` plus the penalty of the place where it ends.
    """
    queue: deque[tuple[int, int, int]] = deque([(0, 0, -1)])  # cost up to a place plus the place, the place, its index
    before = []
    for j, (place, penalty) in enumerate(zip(places, penalties)):
        floor = place - length
        while queue[0][1] < floor:
            queue.popleft()
        value, _, i = queue[0]
        before.append(i)
        value += length + penalty  # cost up to this place, plus the place
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, place, j))
    chosen, at = [], len(places) - 1
    while at >= 0:
        chosen.append(at)
        at = before[at]
    return chosen[::-1]


@dataclass
class _Stream:
    """Tokens of some documents in a row: the first may have begun before."""

    ids: np.ndarray
    starts: np.ndarray  # in the stream, of each document
    done: np.ndarray  # tokens of each document that came before the stream
    sizes: np.ndarray  # of each whole document
    rows: list  # its id
    places: np.ndarray  # where it may be cut
    penalties: np.ndarray

    def after(self, other: _Stream | None) -> _Stream:
        if other is None:
            return self
        shift = len(other.ids)
        return _Stream(
            np.concatenate([other.ids, self.ids]),
            np.concatenate([other.starts, self.starts + shift]),
            *(np.concatenate([getattr(other, n), getattr(self, n)]) for n in ("done", "sizes")),
            other.rows + self.rows,
            np.concatenate([other.places, self.places + shift]),
            np.concatenate([other.penalties, self.penalties]),
        )

    def rest(self, at: int) -> _Stream:
        first = int(np.searchsorted(self.starts, at, "right")) - 1
        later = self.places > at
        starts = self.starts[first:] - at
        done = self.done[first:].copy()
        done[0] -= starts[0]
        starts[0] = 0
        return _Stream(
            self.ids[at:], starts, done, self.sizes[first:], self.rows[first:], self.places[later] - at, self.penalties[later]
        )


def _placed(coder: bpe.Encoder, ids_of_rows: pa.Array, texts: pa.Array, end: int) -> _Stream:
    ids, borders, ends, different, order, words = coder.encode_many(texts)
    count = len(texts)
    sizes = np.diff(borders) + 1
    starts = np.cumsum(sizes) - sizes
    stream = np.full(len(ids) + count, end, np.uint32)
    owner = np.repeat(np.arange(count), sizes - 1)
    stream[np.arange(len(ids)) + owner] = ids
    # places after sentences, documents, and words far from both
    closing = np.array([w.rstrip(_CLOSERS)[-1:] in _STOPS for w in different], bool)
    filled = np.diff(ends, prepend=0) > 0
    word_ends = ends + np.repeat(np.arange(count), words)
    penalty = np.full(len(stream) + 1, -1, np.int64)
    penalty[word_ends[filled & closing[order]]] = SENTENCE
    penalty[starts + sizes] = 0
    known = np.flatnonzero(penalty >= 0)
    gaps = np.diff(known, prepend=0)
    wide = np.flatnonzero(gaps > FAR)
    if len(wide):
        plain = np.zeros(len(stream) + 1, bool)
        plain[word_ends[filled]] = True
        for w in wide:
            low, high = known[w] - gaps[w], known[w]
            some = low + 1 + np.flatnonzero(plain[low + 1 : high])
            grid = np.arange(low + FAR, high, FAR)  # also inside words of very many tokens
            penalty[some[penalty[some] < 0]] = INSIDE
            penalty[grid[penalty[grid] < 0]] = 2 * INSIDE
        known = np.flatnonzero(penalty >= 0)
    known = known[known > 0]
    return _Stream(stream, starts, np.zeros(count, np.int64), sizes, ids_of_rows.to_pylist(), known, penalty[known])


def packed(
    docs: DataFrame, path: str, length: int = 4096, end: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of documents and their places in sequences of at most ``length`` tokens.

    Returns ``id_col, start, length, ids, doc_tokens, sequence_id, offset``: the piece's tokens as little-endian
    unsigned 32-bit numbers, how many tokens of its document come before, how many it has in all with the end token,
    the sequence and the place in it. ``path`` is the tokenizer's file. Documents keep the order in which a task reads
    them, and each token lies in exactly one piece. Null and empty texts are an end token alone. Repeated rows and null
    ids are documents of their own. An empty table gives no rows. A task holds about a million tokens and one document
    at a time; only its last sequence is left short, so padding does not grow with the data.
    """
    shipped(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.encoder(path)
        sequence = TaskContext.get().partitionId() << 33
        waiting: _Stream | None = None
        type_of_id = None

        def drained(stream: _Stream, last: bool) -> tuple[pa.RecordBatch | None, _Stream | None, int]:
            chosen = stream.places[cuts(stream.places.tolist(), stream.penalties.tolist(), length)]
            full = chosen if last else chosen[:-1]
            rest = None if last else stream.rest(int(full[-1])) if len(full) else stream
            return (_pieces(stream, full, sequence, type_of_id) if len(full) else None), rest, len(full)

        for batch in batches:
            type_of_id = batch.schema.field(0).type
            for at, to in bpe.runs_of_texts(batch.column(1)):
                some = _placed(coder, batch.column(0).slice(at, to - at), batch.column(1).slice(at, to - at), end)
                waiting = some.after(waiting)
                if len(waiting.ids) >= RUN_TOKENS:
                    out, waiting, used = drained(waiting, last=False)
                    sequence += used
                    if out is not None:
                        yield out
        if waiting is not None:
            yield drained(waiting, last=True)[0]

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(lean(pack), schema).withColumnRenamed("id", id_col)


def _pieces(stream: _Stream, chosen: np.ndarray, sequence: int, type_of_id: pa.DataType) -> pa.RecordBatch:
    stop = int(chosen[-1])
    begins = np.concatenate([[0], chosen[:-1]])
    starts = np.union1d(stream.starts[stream.starts < stop], begins)
    ends = np.append(starts[1:], stop)
    doc = np.searchsorted(stream.starts, starts, "right") - 1
    window = np.searchsorted(begins, starts, "right") - 1
    rows = pa.array(stream.rows, type_of_id).take(pa.array(doc))
    blobs = [stream.ids[a:b].tobytes() for a, b in zip(starts, ends)]
    return pa.RecordBatch.from_arrays(
        [
            rows,
            pa.array(starts - stream.starts[doc] + stream.done[doc]),
            pa.array(ends - starts),
            pa.array(blobs, pa.binary()),
            pa.array(stream.sizes[doc]),
            pa.array(sequence + window),
            pa.array(starts - begins[window]),
        ],
        ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
    )
