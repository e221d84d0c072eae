"""Counts of 64-bit keys, shuffled as packed ranges.

A task sends the keys that it counted as one row for each range of hashes:
ascending keys as differences, in planes of bytes, which compress to about six
bytes a key. There are as many ranges as the data need for a range to be summed
up in memory; they are dealt in runs of neighbours, so sums come in order.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from .bloom import segment_of


def _packed(h, n) -> bytes:
    """Ascending hashes and their counts, as the planes of bytes of the hashes' differences and of the counts: small ones compress well."""
    import numpy as np

    steps = np.diff(h, prepend=np.uint64(0))
    return np.concatenate([steps.view(np.uint8).reshape(-1, 8).T.ravel(), n.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.ravel()]).tobytes()


def _unpacked(blob: bytes):
    import numpy as np

    planes = np.frombuffer(blob, dtype=np.uint8).reshape(12, -1)
    h = np.ascontiguousarray(planes[:8].T).view(np.uint64).ravel()
    return np.cumsum(h, dtype=np.uint64), np.ascontiguousarray(planes[8:].T).view(np.uint32).ravel()


class Ranges:
    """So many ranges of hashes, in runs that the session's shuffle partitions deal."""

    KIND = "run bigint, bucket bigint, k tinyint, keys binary"

    def __init__(self, spark: SparkSession, ranges: int):
        self.ranges = max(1, ranges)
        self.runs = min(self.ranges, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))

    def rows(self, h, n, k: int) -> Iterator:
        """Arrow batches of KIND for ascending keys of a kind k and their counts (below 2 ^ 32)."""
        import numpy as np
        import pyarrow as pa

        of = segment_of(h, self.ranges).astype(np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]]))
        for low in range(0, len(cuts) - 1, 1000):
            part = list(zip(cuts[low : low + 1000].tolist(), cuts[low + 1 : low + 1001].tolist(), strict=False))
            own = of[[a for a, _ in part]]
            yield pa.RecordBatch.from_arrays([pa.array(own * self.runs // self.ranges), pa.array(own), pa.array(np.full(len(own), k, dtype=np.int8)), pa.array([_packed(h[a:b], n[a:b]) for a, b in part], pa.binary())], ["run", "bucket", "k", "keys"])

    def summed(self, sent: DataFrame, least: dict[int, int]) -> DataFrame:
        """(k, h, n): the sums of rows(), ascending by h within a run, of each kind from its least on."""

        def add(batches):
            import numpy as np
            import pyarrow as pa

            at, own = None, {}

            def sums():
                found = []
                for k, blobs in own.items():
                    h, n = (np.concatenate(x) for x in zip(*map(_unpacked, blobs), strict=True))
                    place = np.argsort(h)
                    h, n = h[place], n[place].astype(np.int64)
                    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                    h, n = h[first], np.add.reduceat(n, first)
                    keep = n >= least.get(k, 1)
                    found.append((h[keep], n[keep], np.full(int(keep.sum()), k, dtype=np.int8)))
                h, n, k = (np.concatenate(x) for x in zip(*found, strict=True))
                place = np.argsort(h)
                return pa.RecordBatch.from_arrays([pa.array(k[place]), pa.array(h[place].view(np.int64)), pa.array(n[place])], ["k", "h", "n"])

            for batch in batches:
                for bucket, k, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "k", "keys")), strict=True):
                    if bucket != at:
                        if own:
                            yield sums()
                        at, own = bucket, {}
                    own.setdefault(k, []).append(blob)
            if own:
                yield sums()

        return sent.repartition("run").sortWithinPartitions("run", "bucket").mapInArrow(add, "k tinyint, h bigint, n bigint")
