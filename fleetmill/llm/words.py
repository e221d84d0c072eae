"""Texts to arrays of word hashes, a bounded piece of text at a time."""

from __future__ import annotations

from collections.abc import Iterator

from .common import HASHES, sliced

#: Bytes of text that become Python words at once.
CHUNK = 1 << 20


def chunks(text: bytes, size: int = CHUNK) -> Iterator[list[bytes]]:
    """The words of a text between ASCII white space, some at a time."""
    low, n = 0, len(text)
    while low < n:
        high = low + size
        if high >= n:
            yield text[low:].split()
            return
        while high < n and text[high] not in b" \t\n\r\x0b\x0c":
            high += 1
        yield text[low:high].split()
        low = high


def hashes(words: list[bytes]):
    import numpy as np

    return np.fromiter(map(HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def by_bytes(batches: Iterator, column: str, limit: int = 4 << 20, rows: int = 500) -> Iterator:
    """Arrow batches whose texts have ``limit`` bytes at most, or that are one row."""
    import pyarrow.compute as pc

    for batch in sliced(batches, rows):
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        low = total = 0
        for i, n in enumerate(sizes):
            if i > low and total + n > limit:
                yield batch.slice(low, i - low)
                low, total = i, 0
            total += n
        if batch.num_rows > low:
            yield batch.slice(low)


def counted(keys):
    """(distinct keys, ascending, and their counts)."""
    import numpy as np

    return np.unique(keys, return_counts=True)
