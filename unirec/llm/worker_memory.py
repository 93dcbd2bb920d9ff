"""What Python workers remember between tasks.

Spark uses a worker again for the tasks of later stages.  An operator that remembers words there says how to forget them;
when a task of another operator starts, that memory is given back, so a worker holds one operator's at a time.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_remembered: dict[str, Callable[[], None]] = {}


def remember(owner: str, forget: Callable[[], None]) -> None:
    """Called by ``owner`` when it begins to fill a memory."""
    _remembered[owner] = forget


def claim(owner: str) -> None:
    """Called at the start of a task of ``owner``: the others forget."""
    others = [name for name in _remembered if name != owner]
    for name in others:
        _remembered.pop(name)()
    if others:
        give_back()


def give_back() -> None:
    """What is free in this process goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
