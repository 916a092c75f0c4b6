"""What a Python worker keeps between tasks: workers are used again by later stages, beside the JVM's own memory."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable

import pyarrow as pa

_held: dict[Hashable, object] = {}


def held(name: Hashable, make: Callable[[], object]):
    """The worker's one large object, made when another was held before."""
    if name not in _held:
        free()
        _held[name] = make()
    return _held[name]


def free() -> None:
    """Let go of what earlier tasks left; for the start of a task that needs memory of its own, or the end of one that had much.

    Idle workers are used in turn, more of them than tasks run at a time, so what each keeps counts as often.
    """
    _held.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        # Small blocks that are free between used ones go back to the system too.
        trim(0)
