"""What a Python worker keeps between tasks: one operator's state at a time.

Workers are reused by the stages of a job, and operators keep tokenizers and
caches in them. When another operator starts in a worker, the state of the one
before is dropped, so a worker's memory is that of its largest operator and
not of their sum. Caches are bounded by bytes.
"""

from __future__ import annotations

import gc
from collections.abc import Callable
from typing import Any

_held: tuple[Any, Any] = (None, None)

#: Bytes a cache holds, and what an entry takes beside its key and value.
CACHE_BYTES, ENTRY_BYTES = 32 << 20, 160
#: Longest key that is kept.
KEY_BYTES = 48


def hold(key: Any, make: Callable[[], Any] = dict) -> Any:
    """The state kept under ``key``, made if another one was kept."""
    global _held
    if _held[0] != key:
        release()
        _held = (key, make())
    return _held[1]


def release() -> None:
    """Drop what is kept and give freed memory back to the system."""
    global _held
    _held = (None, None)
    gc.collect()
    give_back()


def give_back() -> None:
    """Return the free memory of Arrow's pool and of the C heap to the system."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


class BoundedCache(dict):
    """A dict that is emptied when its entries take over ``limit`` bytes."""

    def __init__(self, limit: int = CACHE_BYTES):
        super().__init__()
        self.limit, self.taken = limit, 0

    def keep(self, key: bytes, value: Any, value_bytes: int = 0) -> None:
        """Remember ``value`` unless the key is long."""
        if len(key) > KEY_BYTES:
            return
        self.taken += len(key) + value_bytes + ENTRY_BYTES
        if self.taken > self.limit:
            self.clear()
            self.taken = len(key) + value_bytes + ENTRY_BYTES
        self[key] = value

    def values_of(self, keys: list[bytes], make: Callable[[list[bytes]], list[bytes]]) -> list[bytes]:
        """The values of distinct keys; those that are not kept are made
        together. If they don't fit, only the entries in use stay."""
        found = list(map(self.get, keys))
        new = [k for k, v in zip(keys, found) if v is None]
        if not new:
            return found
        made = make(new)
        rest = iter(made)
        found = [next(rest) if v is None else v for v in found]
        taken = _entry_bytes(new, made)
        if self.taken + taken > self.limit:
            self.clear()
            new, made = keys, found
            self.taken, taken = 0, _entry_bytes(new, made)
        if taken > self.limit:
            return found
        self.update((k, v) for k, v in zip(new, made) if len(k) <= KEY_BYTES)
        self.taken += taken
        return found


def _entry_bytes(keys: list[bytes], values: list[bytes]) -> int:
    return sum(map(len, keys)) + sum(map(len, values)) + ENTRY_BYTES * len(keys)
