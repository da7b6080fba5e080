"""Memory of Python workers, which outlive their tasks."""

import ctypes

import pyarrow as pa


def release():
    """Give memory that a task has freed back to the system: its worker lives on beside others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
