"""Memory that tasks take, and what they leave with the worker."""

import tracemalloc

import numpy as np
import pyarrow as pa

from relocate.llm import memory, minhash


def short_texts(rows, words):
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{n}" for n in line) for line in rng.integers(0, 10**6, (rows, words)).tolist()]
    return pa.RecordBatch.from_pydict({"id": pa.array(range(rows), pa.int64()), "text": pa.array(texts)})


def test_signing_many_short_texts_takes_little_memory():
    batch = short_texts(12_000, 40)
    tracemalloc.start()
    signed = list(minhash._signed(5, minhash.BANDS, minhash.ROWS)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(b.num_rows for b in signed) == batch.num_rows
    assert peak < 100 << 20  # it was 325 MB when 4 MB of text were signed at once


def test_signatures_do_not_depend_on_what_is_signed_at_once(monkeypatch):
    batch = short_texts(300, 30)
    whole = pa.Table.from_batches(minhash._signed(5, 30, 5)(iter([batch])))
    monkeypatch.setattr(minhash, "SIGNED_BYTES", 1000)
    parts = pa.Table.from_batches(minhash._signed(5, 30, 5)(iter([batch])))
    assert parts.column(0).num_chunks > whole.column(0).num_chunks
    assert parts.to_pydict() == whole.to_pydict()


def test_a_lean_step_gives_its_memory_back_at_the_end(monkeypatch):
    seen = []
    monkeypatch.setattr(memory, "give_back", lambda: seen.append("back"))
    batches = [short_texts(2, 3), short_texts(5, 3)]
    rows = [seen.append(b.num_rows) or b for b in memory.lean(lambda some: some)(iter(batches))]
    assert rows == batches and seen == [2, 5, "back"]
    monkeypatch.undo()
    memory.give_back()
