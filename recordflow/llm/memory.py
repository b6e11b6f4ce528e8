"""What a Python worker gives back when it is done with a partition."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import pyarrow as pa


def giving_back(items: Iterable) -> Iterator:
    """The items; afterwards the memory that the worker, which Spark keeps, no longer needs goes back to the system."""
    try:
        yield from items
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass
