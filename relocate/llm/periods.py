"""Periodic runs: stretches of words that go round and round, found by seeds on diagonals and extended to their ends.

A run of period ``q`` repeats its words at lag ``q`` over a guaranteed number of places. Lags are taken in classes, each
with grams just short enough for that guarantee, so each run has equal grams one lag apart, and no equal gram between
them. Grams are named exactly, by doubling; neighbouring occurrences of a gram in a text are seeds. A seed is extended
both ways, word by word, and a table says for each lag how far it is covered, so no stretch is extended twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from relocate.llm import shipped, words
from relocate.llm.bpe import runs_of_texts

_SCHEMA = "n_words long, runs array<struct<start:long,length:long,period:long>>, best struct<start:long,length:long,period:long>"


def overlap(min_length: int, min_times: int) -> int:
    """Words that each run repeats at its own lag at least, whatever its period."""
    return min(max(min_length - q, (min_times - 1) * q) for q in range(1, min_length + 1))


def _named(pairs_of: np.ndarray, shift: int) -> np.ndarray:
    """Names of grams from those of their first and last parts: equal grams, and they alone, have equal names."""
    first, last = pairs_of[:-shift], pairs_of[shift:]
    return np.unique(first * (int(pairs_of.max()) + 1) + last, return_inverse=True)[1].astype(np.int64)


def _grams(codes: np.ndarray, length: int) -> np.ndarray:
    if length == 1:
        return np.unique(codes, return_inverse=True)[1].astype(np.int64)
    half = (length + 1) // 2
    return _named(_grams(codes, half), length - half)


def _agree(codes: np.ndarray, at: int, lag: int) -> int:
    """How many words from ``at`` on equal those a lag later."""
    done, step = 0, 64
    while (left := len(codes) - lag - at - done) > 0:
        some = min(step, left)
        here = at + done
        same = codes[here : here + some] == codes[here + lag : here + lag + some]
        if not same.all():
            return done + int(np.argmin(same))
        done, step = done + some, step * 2
    return done


def _agree_before(codes: np.ndarray, at: int, lag: int) -> int:
    """How many words before ``at`` equal those a lag later."""
    done, step = 0, 64
    while (left := at - done) > 0:
        some = min(step, left)
        here = at - done
        same = (codes[here - some : here] == codes[here - some + lag : here + lag])[::-1]
        if not same.all():
            return done + int(np.argmin(same))
        done, step = done + some, step * 2
    return done


def runs(codes: np.ndarray, min_length: int = 24, min_times: int = 3) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of one text, by start, then period; words are given as numbers.

    A run is a stretch of smallest period ``q``, at least ``max(min_length, min_times * q)`` words long, that no
    neighbouring word extends; ``min_times`` is 3 or more.
    """
    size, found = overlap(min_length, min_times), []
    low, total = 0, len(codes)
    if total < min_length:
        return found
    names = _grams(codes, size)
    while len(names) > 1:
        order = np.argsort(names, kind="stable")
        lags = np.diff(order)
        again = names[order[1:]] == names[order[:-1]]
        if not again.any():
            break
        # an equal gram at a lag of at most its size is the gram's own smallest period
        near = again & (lags > low) & (lags <= size)
        lag_at = np.zeros(len(names) + 1, np.int64)
        lag_at[order[:-1][near] + 1] = lags[near]
        # seeds right behind one of the same lag lie in its stretch
        seeds = np.flatnonzero((lag_at[1:] > 0) & (lag_at[1:] != lag_at[:-1]))
        covered: dict[int, int] = {}
        for at, lag in zip(seeds.tolist(), lag_at[1:][seeds].tolist()):
            if at < covered.get(lag, 0):
                continue
            end = at + size + _agree(codes, at + size, lag)
            start = at - _agree_before(codes, at, lag)
            covered[lag] = end
            if end + lag - start >= max(min_length, min_times * lag):
                found.append((start, end + lag - start, lag))
        low = size
        if min_times * (low + 1) > total:
            break
        names = _named(names, size)
        size *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period; of equal ones that of the least start, then period."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _suspects(codes: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Texts that may hold some gram of ``size`` words twice: all that do, and hardly any other."""
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    grams = words.runs_of(words.mixed(codes.astype(np.uint64) + (owner << np.uint64(32))), size)
    inside = words.starts_inside(bounds, size, len(codes))
    grams, owner = grams[inside], owner[: len(inside)][inside]
    ordered = np.sort(grams)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    return np.unique(owner[np.isin(grams, twice)]).astype(np.int64) if len(twice) else np.zeros(0, np.int64)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of the texts, numbers that tell different ones apart, and borders by text."""
    split = pc.ascii_split_whitespace(texts.fill_null(""))
    flat = split.flatten()
    full = pc.not_equal(flat, "")
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    bounds = before[split.offsets.to_numpy() - split.offsets[0].as_py()]
    flat = flat.filter(full)
    return flat, flat.dictionary_encode().indices.to_numpy(), bounds


def _structs(rows: list, type_of: pa.DataType) -> pa.Array:
    return pa.array([None if r is None else dict(zip(("start", "length", "period"), r)) for r in rows], type_of)


def collapsed(
    docs: DataFrame, min_length: int = 24, min_times: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id_col, text_col, n_words, runs, best)``: each text's periodic runs, and the text with each run cut to one period.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, numbered from 0 and compared as they stand. ``runs`` holds
    start, length and period of every run (see :func:`runs`) by start, then period; ``best`` the one of most periods,
    null without runs. The text returned is that of the kept words, joined by one space: all but those that some run
    holds after its first period. A null text stays null, empty and blank ones become empty; none of them has runs. A
    row for each row, null ids and repeated rows too; an empty table gives none; other columns are ignored. Runs are
    exact. Time and memory of a text grow with its words times the logarithm of their number, also where it repeats
    one word throughout; a text lies in one task. ``min_times`` below 3 raises.
    """
    if min_times < 3:
        raise ValueError("a run has at least three periods")
    shipped(docs.sparkSession)
    size = overlap(min_length, min_times)
    kind = docs.schema[id_col].dataType.simpleString()
    run_type = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in runs_of_texts(batch.column(1)):
                texts = batch.column(1).slice(at, to - at)
                flat, codes, bounds = _words(texts)
                found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
                change = np.zeros(len(codes) + 1, np.int64)
                for t in _suspects(codes, bounds, size).tolist():
                    found[t] = runs(codes[bounds[t] : bounds[t + 1]], min_length, min_times)
                    for start, length, period in found[t]:
                        change[bounds[t] + start + period] += 1
                        change[bounds[t] + start + length] -= 1
                keep = np.cumsum(change[:-1]) == 0
                borders = np.concatenate([[0], np.cumsum(keep)])[bounds].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(borders), flat.filter(pa.array(keep)))
                joined = pc.if_else(texts.is_null(), pa.scalar(None, pa.string()), pc.binary_join(lists, " "))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, to - at),
                        joined,
                        pa.array(np.diff(bounds)),
                        pa.array([_structs(f, run_type).to_pylist() for f in found], pa.list_(run_type)),
                        _structs([strongest(f) for f in found], run_type),
                    ],
                    ["id", "text", "n_words", "runs", "best"],
                )

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    out = rows.mapInArrow(collapse, f"id {kind}, text string, {_SCHEMA}")
    return out.withColumnsRenamed({"id": id_col, "text": text_col})
