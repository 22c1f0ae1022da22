"""Words of a whole batch of texts at once, in tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


def split(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Word numbers of all texts, the distinct words, and where each text begins.

    Words are runs of characters other than ASCII white space, A-Z in lower case.
    """
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = words.flatten().dictionary_encode()
    number = coded.indices.to_numpy()
    distinct = coded.dictionary.cast(pa.binary()).to_pylist()
    bounds = words.offsets.to_numpy()
    # White space at the ends gives empty words.
    empty = distinct.index(b"") if b"" in distinct else -1
    real = number != empty
    bounds = np.concatenate([[0], np.cumsum(real)])[bounds]
    return number[real], distinct, bounds


def hashes_of(words: list[bytes]) -> np.ndarray:
    """64-bit hashes; two of a million million words share one with a chance of 3 in 100."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


def slices(batch: pa.RecordBatch, column: str, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """A batch in parts whose texts are about so many bytes; a longer text is alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(first, last - first)
        first = last


def gathered(
    batches: Iterator[pa.RecordBatch], column: str, most: int
) -> Iterator[pa.RecordBatch]:
    """All rows, in batches whose texts are about so many bytes; a longer text is alone."""
    held, size = [], 0
    for batch in batches:
        for some in slices(batch, column, most):
            more = pc.sum(pc.binary_length(some.column(column))).as_py() or 0
            if held and size + more > most:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(some)
            size += more
    if held:
        yield pa.concat_batches(held)


def _release() -> None:
    """Give what is freed back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task gives, without memory that others freed before it or that it freed itself.

    Python workers wait for other stages when a task ends, and several are there for one core.
    """
    _release()
    yield from batches
    _release()
