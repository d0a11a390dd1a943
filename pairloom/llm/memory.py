"""Workers live on between tasks; what a task no longer needs goes back to the system when it ends."""

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa


def free() -> None:
    """Hands back what Arrow's pool and the C library keep for later."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The task function ``run``, with its memory handed back at the end."""

    def until_done(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            free()

    return until_done
