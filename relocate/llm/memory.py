"""Memory of Python workers between tasks.

Spark keeps a worker for a minute after its task, several for each core where a task runs more than one function. What
the allocators hold back there counts against the executor while others work.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa

Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Return freed memory to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)


def lean(step: Step) -> Step:
    """``step`` of a task, for ``mapInArrow``, that leaves no freed memory with the worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        give_back()

    return run
