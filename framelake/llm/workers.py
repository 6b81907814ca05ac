"""What Python workers keep from one batch to the next.

Spark hands one worker to the stages of a whole session in turn, so what an operator keeps for its
next batch (tokenizers, models, words already encoded) would stay while others run. An
operator that begins a batch here lets go of what the others kept.
"""

from __future__ import annotations

import ctypes
import functools
import gc

import pyarrow as pa

_kept: dict[str, list] = {}
_owner: list[str] = []


def kept_for(owner: str, maxsize: int):
    """``functools.lru_cache`` for values that belong to one operator."""
    def wrap(fn):
        cached = functools.lru_cache(maxsize=maxsize)(fn)
        _kept.setdefault(owner, []).append(cached)
        return cached

    return wrap


def begin(owner: str) -> None:
    """The operator ``owner`` takes in a batch: drop what others kept, and give memory back."""
    if _owner == [owner]:
        return
    _owner[:] = [owner]
    for name, caches in _kept.items():
        if name != owner:
            for cached in caches:
                cached.cache_clear()
    release()


def release() -> None:
    """Return memory that is free in this process to the system, where that is possible."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        # Not this C library: its allocator returns memory by itself.
        pass
