"""Python tasks that hand their memory back, so that a reused worker does not keep it."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa


def release() -> None:
    """Give free memory of Arrow's pool and of the C allocator back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):     # other C libraries have no such call
        pass


def lean(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A ``mapInArrow`` function that releases its free memory when its task ends."""

    @functools.wraps(fn)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            release()

    return run
