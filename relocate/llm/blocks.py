"""Documents bundled into blocks: rows that hold some megabytes of whole documents, saved in the shared folder.

Operators that go over the corpus several times work on blocks: a block keeps its number and its documents in every
pass, also when tasks are run again, so results of one pass find their documents by the block's number.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from relocate.llm import shipped
from relocate.llm.memory import lean
from relocate.session import saved

BLOCK_BYTES = 4 << 20
BLOCK_ROWS = 20_000


def packed(table: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(table)
    return sink.getvalue().to_pybytes()


def unpacked(payload: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(payload) as stream:
        return stream.read_next_batch()


def bundled(docs: DataFrame) -> DataFrame:
    """``(block_id, payload)``: all columns of ``docs`` in blocks of about ``BLOCK_BYTES``, at least one row each."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            step = max(1, min(BLOCK_ROWS, batch.num_rows, int(batch.num_rows * BLOCK_BYTES / max(1, batch.nbytes))))
            for at in range(0, batch.num_rows, step):
                block = batch.slice(at, step)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([packed(block)], pa.binary())], ["block_id", "payload"]
                )
                number += 1

    return docs.mapInArrow(lean(bundle), "block_id long, payload binary")


def saved_blocks(docs: DataFrame, label: str) -> DataFrame:
    shipped(docs.sparkSession)
    return saved(bundled(docs), label)
