"""Comparing the members of groups with each other in bounded blocks.

A group of any size is dealt into blocks; each pair of blocks is one unit of
work that holds two blocks in memory, and pairs of members never become rows.
Before that, the members of a large group are compared with a few centres of
it. What links with a centre, directly or through other centres, is the group's
core: it is one class already, so no two of its members need comparing, and
only blocks of the rest are paired with all blocks. A dense group costs about
as many comparisons as it has members, and a hot one is split over tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, forest, groups_of

BLOCK = 1024
#: Centres of a large group.
CENTRES = 6


def whole(rows: DataFrame) -> DataFrame:
    """Groups that are one unit each, in the columns that dealt() needs."""
    return rows.withColumns({"core": F.lit(False), "core_blocks": F.lit(0), "rest_blocks": F.lit(1)})


def centred(rows: DataFrame, group: list[str], near: Callable, scratch: Scratch, block: int = BLOCK, centres: int = CENTRES) -> tuple[DataFrame, DataFrame]:
    """(edges, rows): edges (a, b) of the links with centres, and the rows still to compare, in the columns that dealt() needs.

    ``rows`` has the group's columns, id (unique within a group), members (the
    group's number of rows) and what ``near`` looks at: near(unit, a, b) is the
    boolean matrix of links between the rows a and b of an Arrow table.
    """
    rows = scratch.write(rows.withColumn("__h", F.xxhash64("id")), "large")
    # A centre is the row with the least hash in its share of the group.
    picked = rows.groupBy(*group, F.pmod("__h", F.lit(centres)).alias("__k")).agg(F.min("__h").alias("__h")).drop("__k")
    salts = F.ceil(F.col("members") / block).cast("int")
    centre = rows.join(picked, [*group, "__h"], "left_semi").withColumn("mine", F.lit(0)).withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    member = rows.withColumn("mine", F.lit(1)).withColumn("__salt", F.pmod(F.xxhash64("id", F.lit(1)), salts).cast("int"))
    unit = [*group, "__salt"]
    units = member.unionByName(centre).drop("__h").repartition(*unit).sortWithinPartitions(*unit, "mine", "id")

    def mark(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for table in groups_of(batches, unit):
            mine, ids = table.column("mine").to_numpy(), table.column("id").to_numpy()
            a, b = np.flatnonzero(mine == 1), np.flatnonzero(mine == 0)  # centres are in the order of their ids
            linked = near(table, a, b) | (ids[a][:, None] == ids[b][None, :])
            masks = linked @ (1 << np.arange(len(b), dtype=np.int64))
            found = [ids[b[row]].tolist() for row in linked]
            at = pa.array(a, pa.int64())
            yield pa.RecordBatch.from_arrays([*(table.column(g).take(at).combine_chunks() for g in group), pa.array(ids[a], pa.int64()), pa.array(masks, pa.int64()), pa.array(found, pa.list_(pa.int64()))], [*group, "id", "mask", "centres"])

    kinds = ", ".join(f"{g} {rows.schema[g].dataType.simpleString()}" for g in group)
    marks = scratch.write(units.mapInArrow(mark, f"{kinds}, id bigint, mask bigint, centres array<bigint>"), "marks")
    edges = marks.select(F.col("id").alias("a"), F.explode("centres").alias("b")).where("a <> b")
    # From the centre with the most links, on to all centres that members share: 2 ^ centres masks at most.
    links = [F.count_if(F.getbit("mask", F.lit(k)) == 1).alias(f"c{k}") for k in range(centres)]
    most = F.greatest(*(f"c{k}" for k in range(centres)))
    start = F.coalesce(*(F.when(F.col(f"c{k}") == most, F.lit(1 << k)) for k in range(centres))).cast("bigint")
    grown = lambda reach, mask: F.when(reach.bitwiseAND(mask) != 0, reach.bitwiseOR(mask)).otherwise(reach)
    reach = marks.groupBy(*group).agg(F.collect_set("mask").alias("masks"), *links)
    reach = reach.select(*group, F.aggregate(F.flatten(F.array_repeat("masks", centres)), start, grown).alias("reach"))
    marked = marks.join(reach, group).select(*group, "id", (F.col("mask").bitwiseAND(F.col("reach")) != 0).alias("core"))
    sizes = marked.groupBy(*group).agg(F.count_if("core").alias("nc"), F.count_if(~F.col("core")).alias("nr")).where("nr > 0")
    blocks = sizes.select(*group, F.ceil(F.col("nc") / block).cast("int").alias("core_blocks"), F.ceil(F.col("nr") / block).cast("int").alias("rest_blocks"))
    left = rows.drop("__h").join(marked.join(blocks, group), [*group, "id"])
    return edges, left


def dealt(rows: DataFrame, group: list[str], block: int = BLOCK) -> DataFrame:
    """rows, copied for each block pair of their group, with i <= j and ``mine`` (the row's block), sorted by unit within partitions."""
    h = F.xxhash64("id")
    mine = F.when(F.col("core"), F.pmod(h, "core_blocks")).otherwise(F.col("core_blocks") + F.pmod(h, F.greatest(F.lit(1), "rest_blocks")))
    first = F.when(F.col("core"), F.col("core_blocks")).otherwise(0)
    rows = rows.withColumn("mine", mine.cast("int")).withColumn("__other", F.explode(F.sequence(first, F.col("core_blocks") + F.col("rest_blocks") - 1)))
    rows = rows.withColumns({"i": F.least("mine", "__other"), "j": F.greatest("mine", "__other")}).drop("members", "core", "core_blocks", "rest_blocks", "__other")
    unit = [*group, "i", "j"]
    return rows.repartition(*unit).sortWithinPartitions(*unit)


def sides(unit) -> tuple:
    """(a, b): the rows of a unit of dealt() to compare with each other; both are all rows where the blocks are one."""
    import numpy as np

    i, j = unit.column("i")[0].as_py(), unit.column("j")[0].as_py()
    mine = unit.column("mine").to_numpy()
    if i == j:
        a = b = np.arange(len(mine))
    else:
        a, b = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
    return a, b


def square(linked, a, b, n: int):
    """The links between rows a and b as a symmetric matrix over n rows, without its diagonal."""
    import numpy as np

    out = np.zeros((n, n), dtype=bool)
    out[np.ix_(a, b)] = linked
    out |= out.T
    np.fill_diagonal(out, False)
    return out


def forests(units: DataFrame, group: list[str], near: Callable) -> DataFrame:
    """Edges (a, b): a spanning forest of the links of each unit of dealt()."""

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for unit in groups_of(batches, [*group, "i", "j"]):
            a, b = sides(unit)
            pairs = forest(square(near(unit, a, b), a, b, unit.num_rows))
            if pairs:
                ids = unit.column("id").to_numpy()
                x, y = zip(*pairs, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids[list(x)], pa.int64()), pa.array(ids[list(y)], pa.int64())], ["a", "b"])

    return units.mapInArrow(compare, "a bigint, b bigint")


def linked(rows: DataFrame, group: list[str], near: Callable, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that join what links within each group, whatever its size; rows as for centred()."""
    large = rows.where(F.col("members") > block)
    found = forests(dealt(whole(rows.where(F.col("members") <= block)), group, block), group, near)
    if not large.isEmpty():
        edges, rest = centred(large, group, near, scratch, block)
        found = found.unionByName(edges).unionByName(forests(dealt(rest, group, block), group, near))
    return found
