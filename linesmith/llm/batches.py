"""Arrow batches in bounded slices.

Spark's batches are counted in rows, and rows of text have any length. A task
that turns a batch into Python objects, and its result into a batch, does so for
some megabytes of text at a time.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .shipping import ship

ship(__name__)

AT_ONCE = 1 << 22  # bytes of text


def cuts(texts: pa.Array, at_once: int = AT_ONCE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about so many bytes; a longer text is a range of its own or ends one."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // at_once, prepend=-1)).tolist()
    return zip(starts, [*starts[1:], len(texts)][:len(starts)], strict=True)


def give_back() -> None:
    """Return freed memory to the system: a worker stays beside later tasks of its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


Rows = Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]


def sliced(column: str, start: Callable[[], Rows]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` from one for slices; ``start`` makes it, once per task."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_slice = start()
        for batch in batches:
            for a, b in cuts(batch.column(column)):
                yield from of_slice(batch.slice(a, b - a))
            del batch
        del of_slice
        give_back()
    return rows
