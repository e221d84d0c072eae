"""Content ids of any number of rows."""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hashes that one row of a level holds, about.
FOLD = 4096
#: Signs by which hashes are joined, up to which one row holds what they give: 16 ^ 4 hashes.
WIDEST = 4


def row_hash(columns: list[str]) -> Column:
    """SHA-256 of a row's canonical JSON; nulls are written."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def folded(hashes: DataFrame, name: str = "digest", fold: int = FOLD) -> DataFrame:
    """(digest, rows) of hex hashes in a column h, whatever their order and partitions.

    Equal hashes are counted first. Then hashes are joined by their first signs
    and hashed, so many signs that a row holds about ``fold`` of them. What that
    gives, a hash for each ``fold`` rows, is hashed in order: by one row while
    there are few, and else by one task that streams them, as SHA-256 is
    sequential, and holds none.
    """
    each = hashes.groupBy("h").agg(F.count("*").alias("n"))
    each = each.select(F.when(F.col("n") == 1, F.col("h")).otherwise(F.concat_ws("*", "h", "n")).alias("h"), "n")
    width = max(0, ceil(log(max(1, hashes.count()) / fold, 16)))
    joined = lambda c: F.sha2(F.concat_ws("", F.array_sort(F.collect_list(c))), 256)
    part = each.groupBy(F.substring("h", 1, width).alias("b")).agg(joined("h").alias("h"), F.sum("n").alias("n"))
    part = part.select(F.concat_ws(":", "b", "h").alias("t"), "n")
    if width > WIDEST:
        return _streamed(part, name)
    return part.agg(joined("t").alias(name), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


def _streamed(parts: DataFrame, name: str) -> DataFrame:
    """(digest, rows) of texts t, in their order, and numbers n."""

    def run(batches):
        from hashlib import sha256

        import pyarrow as pa

        found, rows = sha256(), 0
        for batch in batches:
            found.update("".join(batch.column("t").to_pylist()).encode())
            rows += sum(batch.column("n").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([found.hexdigest()]), pa.array([rows], pa.int64())], [name, "rows"])

    return parts.repartition(1).sortWithinPartitions("t").mapInArrow(run, f"`{name}` string, rows bigint")
