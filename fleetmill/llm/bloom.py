"""Bloom filters in segments: tasks fill them, and no more than a slice is broadcast at once.

A key is a well-mixed 64-bit hash and belongs to one segment of 1 MiB. Each of
its levels 1, 2, ... is an element of its own, which sets four bits of one
64-bit word, so a probe reads one word. A filter of level 1 alone is a set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits in a segment, and bits an element.
SEGMENT = 1 << 17
BITS = 12


def mixed(x):
    """A finaliser of 64-bit hashes (array of uint64)."""
    import numpy as np

    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def segments_for(elements: int) -> int:
    return max(1, -(-elements * BITS // (64 * SEGMENT)))


def segment(h: Column, segments: int) -> Column:
    """The segment of a key: its upper half, scaled."""
    return F.shiftrightunsigned(F.shiftrightunsigned(h, 32) * F.lit(segments).cast("bigint"), 32).cast("int")


def segment_of(h, segments: int):
    """The same for an array of uint64."""
    import numpy as np

    return ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)


def _spot(h, level):
    """(word in the segment, mask) of an element."""
    import numpy as np

    x = mixed(h + np.uint64(0x9E3779B97F4A7C15) * np.asarray(level, dtype=np.uint64))
    mask, one = np.zeros(len(x), dtype=np.uint64), np.uint64(1)
    for k in range(4):
        mask |= one << ((x >> np.uint64(6 * k)) & np.uint64(63))
    return x >> np.uint64(47), mask


def filled(keys: DataFrame, segments: int) -> DataFrame:
    """(segment, words) of the keys (h bigint, levels int): a row a segment that has keys.

    Tasks fill what they have of a segment, and those parts are shuffled and
    merged, not the keys. Keys in ranges of h make few parts.
    """

    def rows(batches, add):
        import numpy as np
        import pyarrow as pa

        at, words = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([words.tobytes()], pa.binary())], ["segment", "words"])

        for batch in batches:
            of = batch.column("segment").to_numpy()
            for s in np.unique(of):
                if s != at:
                    if at is not None:
                        yield row()
                    at, words = int(s), np.zeros(SEGMENT, dtype=np.uint64)
                add(words, batch, np.flatnonzero(of == s))
        if at is not None:
            yield row()

    def fill(words, batch, own):
        import numpy as np

        h, levels = batch.column("h").to_numpy().view(np.uint64)[own], batch.column("levels").to_numpy()[own]
        for level in range(1, int(levels.max()) + 1):
            word, mask = _spot(h[levels >= level], level)
            np.bitwise_or.at(words, word, mask)

    def merge(words, batch, own):
        import numpy as np

        for k in own:
            words |= np.frombuffer(batch.column("words")[int(k)].as_buffer(), dtype=np.uint64)

    dealt = keys.select(segment(F.col("h"), segments).alias("segment"), "h", "levels").sortWithinPartitions("segment")
    parts = dealt.mapInArrow(lambda batches: rows(batches, fill), "segment int, words binary")
    return parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(lambda batches: rows(batches, merge), "segment int, words binary")


class Slice:
    """The segments [low, high) of a filter of ``segments`` segments, for probing in tasks."""

    def __init__(self, rows, low: int, high: int, segments: int):
        import numpy as np

        self.words = np.zeros((high - low) * SEGMENT, dtype=np.uint64)
        self.low, self.high, self.segments = low, high, segments
        for r in rows:
            start = (r["segment"] - low) * SEGMENT
            self.words[start : start + SEGMENT] = np.frombuffer(r["words"], dtype=np.uint64)

    def levels(self, h, where=None):
        """The highest level of each key such that it and all before are in the filter; 0 for keys of other slices, and where ``where`` is false."""
        import numpy as np

        of = segment_of(h, self.segments)
        here = (of >= self.low) & (of < self.high)
        left = np.flatnonzero(here if where is None else here & where)
        out, level = np.zeros(len(h), dtype=np.uint8), 1
        base = (of - np.uint64(self.low)) * np.uint64(SEGMENT) if self.low else of * np.uint64(SEGMENT)
        while len(left) and level < 64:
            word, mask = _spot(h[left], level)
            left = left[(self.words[base[left] + word] & mask) == mask]
            out[left] = level
            level += 1
        return out


def read_slice(filter_rows: DataFrame, low: int, high: int, segments: int) -> Slice:
    """A slice, read by the driver; its size is (high - low) MiB."""
    rows = filter_rows.where((F.col("segment") >= low) & (F.col("segment") < high)).collect()
    return Slice(rows, low, high, segments)
