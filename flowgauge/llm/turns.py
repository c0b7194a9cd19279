"""What a Python worker remembers for one operator goes when it starts on another, and what it has freed goes back."""

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

_forget: dict[str, Callable[[], None]] = {}


@functools.cache
def _trim() -> Callable[[int], int] | None:
    """The C library's way to give freed memory back, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give freed memory back to the machine: allocators keep it for the next task, which may be another operator's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; when they are through, its memory is given back."""
    yield from batches
    release()


def take_turn(name: str, forget: Callable[[], None]) -> None:
    """Say that operator ``name`` works now, and how to drop what it remembers; others' memories are dropped."""
    others = [n for n in _forget if n != name]
    for other in others:
        _forget.pop(other)()
    _forget[name] = forget
    if others:
        release()
