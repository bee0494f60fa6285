"""Cutting Arrow columns of texts into slices of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def segments(texts: pa.Array, most_bytes: int) -> Iterator[tuple[int, list[str]]]:
    """Place of the first text, and neighbouring texts of up to ``most_bytes`` together.

    A longer text stands alone; NULL becomes the empty text. Only the texts of one slice
    are Python objects at a time.
    """
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first, done = 0, 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, done + most_bytes, side="right")))
        yield first, [t or "" for t in texts.slice(first, last - first).to_pylist()]
        first, done = last, int(ends[last - 1])
    release_memory()


def release_memory() -> None:
    """Give freed memory back to the system: Python workers live on between tasks, and
    beside an executor's heap what they hold on to is not available to others."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass


def packed_texts(texts: pa.Array) -> pa.Array:
    """Texts for a shuffle, each compressed on its own after its length in bytes."""

    def packed(text: str | None) -> bytes | None:
        if text is None:
            return None
        data = text.encode()
        return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)

    return pa.array((packed(t.as_py()) for t in texts), pa.binary())


def unpacked_texts(column: pa.Array) -> pa.Array:
    """The texts of :func:`packed_texts`; a column of texts is given back as it is."""
    if not pa.types.is_binary(column.type):
        return column

    def text(data: bytes | None) -> str | None:
        if data is None:
            return None
        size = int.from_bytes(data[:8], "little")
        return pa.decompress(data[8:], size, codec="zstd", asbytes=True).decode() if size else ""

    return pa.array((text(d.as_py()) for d in column), pa.string())
