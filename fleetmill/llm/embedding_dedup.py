"""Embedding near-duplicates: spherical k-means cells, blocked cosine products within them.

Vectors are compared where labels and lengths are equal. Equal vectors are one.
A cell with many vectors is split by spherical k-means, fitted to a bounded
sample of it, and its cells again, until they are small: there's no bound on
their number, and no table of all centroids. A link joins unit vectors at most
r = sqrt(2 - 2 t) apart, so if two linked vectors of a cell go to different
parts of it, one of them is within r / 2 of the plane between the two. A vector
is therefore also shown to every part whose plane is that near, and each link
is met in a part of one of its ends: recall is 1, whatever the samples. A cell
whose parts would hold most of its vectors each isn't split, but compared as it
is. Cells are compared in blocks; links are counted as sums and joined as
spanning forests, never listed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import dealt, sides, square, whole
from .common import Scratch, components, forest, groups_of, small, table, written

COSINE = 0.98
#: Vectors to fit a cell's parts to; a cell of more than twice CELL_ROWS is split, into PARTS at most, down to so many levels.
SAMPLE_ROWS = 20_000
CELL_ROWS = 1_000
PARTS, LEVELS = 32, 9
ROUNDS = 8
#: A cell is split if comparing within its parts costs less than this share of comparing within itself.
WORTH = 0.7
#: Vectors of a cell that are dealt to its parts in one task, and compared as one block.
TASK_ROWS, BLOCK = 50_000, 2_048


def k_means(vectors, cells: int, rounds: int = ROUNDS):
    """Unit centroids of unit vectors by spherical k-means; the start is every so-manyth vector."""
    import numpy as np

    centre = vectors[np.linspace(0, len(vectors) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        near = np.argmax(vectors @ centre.T, axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, near, vectors)
        norm = np.linalg.norm(total, axis=1)
        full = norm > 1e-9
        centre[full] = total[full] / norm[full, None]
    return centre


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, sample_rows: int = SAMPLE_ROWS, cell_rows: int = CELL_ROWS, parts: int = PARTS, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row a vector.

    n_links counts the other rows linked directly; component_id is the smallest
    id of the group. Null, empty, zero and non-finite vectors, and null labels,
    link with nothing. Rows that repeat an id are vectors of their own with that
    id, and a tie at the threshold is a link. Vectors may be of any length. An
    empty table gives no rows; other columns aren't read and may have any name.
    """
    rows = rows.select(F.col(key).alias("vec_id"), F.col(vector).alias("__v"), F.col(label).alias("label"))
    usable = rows.where(_usable()).withColumn("__x", F.transform("__v", lambda v: v.cast("double")))
    same = usable.groupBy("label", "__x").agg(F.min("vec_id").alias("least"), F.count("*").alias("times"))
    with Scratch(rows.sparkSession) as scratch:
        nodes = scratch.write(same.withColumn("id", F.monotonically_increasing_id()).withColumn("size", F.size("__x")), "vectors")
        found = scratch.write(_compared(_cells(nodes, cosine, sample_rows, cell_rows, parts, scratch), cosine, block), "links")
        joined = components(found.select("a", "b"), scratch)
        counted = found.groupBy("a").agg(F.sum("links").alias("links"))
        node = nodes.select("id", "label", "__x", "least", "times").join(joined, "id", "left").withColumn("class", F.coalesce("component", "id"))
        smallest = node.groupBy("class").agg(F.min("least").alias("component_id"))
        node = node.join(smallest, "class").join(counted, F.col("id") == F.col("a"), "left")
        node = node.select("label", "__x", "component_id", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"))
        good = usable.select("vec_id", "label", "__x").join(node, ["label", "__x"]).select("vec_id", "n_links", "component_id")
        bad = rows.where(~_usable()).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
        return written(good.unionByName(bad).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))), "near-duplicates")


def _cells(nodes: DataFrame, cosine: float, sample_rows: int, cell_rows: int, parts: int, scratch: Scratch) -> DataFrame:
    """(label, size, cell, id, times, unit, met): the vectors, scaled to length 1 (as bytes), in each cell that they are shown in.

    ``met`` has the cells, on all levels, that a row's vector is shown in beside the row's own way down.
    """

    def scaled(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            unit = []
            for v in batch.column("__x").to_pylist():
                x = np.array(v)
                x /= np.abs(x).max()
                unit.append((x / np.linalg.norm(x)).tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("label", "size", "id", "times")), pa.array(unit, pa.binary())], ["label", "size", "id", "times", "unit"])

    kind = nodes.schema["label"].dataType.simpleString()
    start = nodes.select("label", "size", "id", "times", "__x").mapInArrow(scaled, f"label {kind}, size int, id bigint, times bigint, unit binary")
    state = scratch.write(start.withColumns({"cell": F.lit(0).cast("bigint"), "met": F.array().cast("array<bigint>")}), "cells")
    cell = ["label", "size", "cell"]
    half, leaves = float((2 - 2 * cosine) ** 0.5 / 2) + 1e-9, None
    for _ in range(LEVELS):
        counts = state.groupBy(*cell).agg(F.count("*").alias("n"))
        large = scratch.write(counts.where(F.col("n") > 2 * cell_rows), "large")
        fitted = scratch.write(_fit(state, large, cell, half, sample_rows, cell_rows, parts), "centres")
        done = state.join(small(fitted.select(*cell)), cell, "left_anti")
        leaves = done if leaves is None else leaves.unionByName(done)
        if fitted.isEmpty():
            return leaves
        state = scratch.write(_descended(state, fitted, cell, half), "cells")
    return leaves.unionByName(state)


def _unit_rows(column):
    import numpy as np

    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(len(column), -1)


def _shown(x, centre, half: float):
    """For unit vectors x: the parts (a boolean matrix) that each is shown to: the nearest one, and those whose plane to it is within ``half``."""
    import numpy as np

    near = x @ centre.T
    home = np.argmax(near, axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * centre @ centre.T, 0))[home]
    shown = near[np.arange(len(x)), home][:, None] - near <= half * apart
    shown[np.arange(len(x)), home] = True
    return shown


def _fit(state: DataFrame, large: DataFrame, cell: list[str], half: float, sample_rows: int, cell_rows: int, parts: int) -> DataFrame:
    """(label, size, cell, n, centres): of each large cell that is worth splitting, the parts' centroids as bytes, fitted to a bounded sample of it in a task of its own."""

    def fit(key, rows):
        import pyarrow as pa

        x = _unit_rows(rows.column("unit"))
        n = rows.column("n")[0].as_py()
        centre = k_means(x, max(2, min(parts, n // cell_rows, len(x) // 4)))
        good = int(len(x) >= 8 and (_shown(x, centre, half).mean(axis=0) ** 2).sum() <= WORTH)
        return pa.table({**{c: pa.array([k.as_py()] * good, rows.column(c).type) for c, k in zip(cell, key, strict=True)}, "n": pa.array([n] * good, pa.int64()), "centres": pa.array([centre.tobytes()] * good, pa.binary())})

    kinds = ", ".join(f"{c} {state.schema[c].dataType.simpleString()}" for c in cell)
    share = F.pmod(F.xxhash64("unit"), F.lit(1_000_000)) * F.col("n") < F.lit(sample_rows * 1_000_000)
    picked = state.join(small(large), cell).where(share).select(*cell, "n", "unit")
    return picked.groupBy(*cell).applyInArrow(fit, f"{kinds}, n bigint, centres binary")


def _descended(state: DataFrame, fitted: DataFrame, cell: list[str], half: float) -> DataFrame:
    """The rows of cells that are split, in the parts that they are shown in. A cell's rows are dealt to tasks of TASK_ROWS, each with the cell's centroids."""
    tasks = F.ceil(F.col("n") / TASK_ROWS).cast("int")
    rows = state.join(small(fitted.select(*cell, "n")), cell).withColumn("salt", F.pmod(F.xxhash64("id"), tasks).cast("int")).drop("n")
    centres = fitted.select(*cell, F.explode(F.sequence(F.lit(0), tasks - 1)).alias("salt"), "centres")

    def down(left, right):
        import numpy as np
        import pyarrow as pa

        if not left.num_rows or not right.num_rows:
            return left.slice(0, 0)
        x = _unit_rows(left.column("unit"))
        centre = np.frombuffer(right.column("centres")[0].as_py(), dtype=np.float64).reshape(-1, x.shape[1])
        row, part = np.nonzero(_shown(x, centre, half))
        above = left.column("cell")[0].as_py()
        child = above * (PARTS * 2) + 1 + part
        beside = [(child[a:b]).tolist() for a, b in zip(*(np.searchsorted(row, np.arange(len(x)) + k) for k in (0, 1)), strict=True)]
        met = left.column("met").to_pylist()
        out = left.take(pa.array(row, pa.int64()))
        out = out.set_column(out.column_names.index("cell"), "cell", pa.array(child, pa.int64()))
        return out.set_column(out.column_names.index("met"), "met", pa.array([met[r] + [c for c in beside[r] if c != own] for r, own in zip(row.tolist(), child.tolist(), strict=True)], pa.list_(pa.int64()))).select(names)

    names = state.columns
    unit = [*cell, "salt"]
    return rows.select(*names, "salt").groupBy(*unit).cogroup(centres.groupBy(*unit)).applyInArrow(_without_salt(down, names), state.schema)


def _without_salt(down: Callable, names: list[str]) -> Callable:
    return lambda left, right: down(left.select(names), right)


def _way(cell: int) -> list[int]:
    """A cell and the cells around it."""
    out = []
    while cell > 0:
        out.append(cell)
        cell = (cell - 1) // (PARTS * 2)
    return out


def _compared(cells: DataFrame, cosine: float, block: int) -> DataFrame:
    """(a, b, links): a vector, one that it is joined with, and its number of links found in a unit, counting each pair of vectors once."""
    cell = ["label", "size", "cell"]
    sizes = cells.groupBy(*cell).agg(F.count("*").alias("members"))
    blocks = whole(cells.join(small(sizes), cell)).withColumn("rest_blocks", F.ceil(F.col("members") / block).cast("int"))

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        for unit in groups_of(batches, [*cell, "i", "j"]):
            a, b = sides(unit)
            x = _unit_rows(unit.column("unit"))
            linked = square(x[a] @ x[b].T >= cosine, a, b, len(x))
            if not linked.any():
                continue
            ids, times = unit.column("id").to_numpy(), unit.column("times").to_numpy()
            # Two vectors that both are shown in a smaller cell beside the way down are counted there.
            way = _way(unit.column("cell")[0].as_py())
            smaller = {c for c in (c for m in unit.column("met").to_pylist() for c in m) if any((c - 1) // (PARTS * 2) == (w - 1) // (PARTS * 2) and c < w for w in way)}
            counted = linked
            if smaller:
                at = {c: k for k, c in enumerate(smaller)}
                there = np.zeros((len(x), len(at)), dtype=np.float32)
                for r, m in enumerate(unit.column("met").to_pylist()):
                    there[r, [at[c] for c in m if c in at]] = 1
                counted = linked & ~((there @ there.T) > 0)
            n = counted @ times
            root = np.arange(len(ids))
            for p, q in forest(linked):
                root[p] = q
            hit = linked.any(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(ids[root[hit]]), pa.array(n[hit].astype(np.int64))], ["a", "b", "links"])

    return dealt(blocks, cell, block).select(*cell, "i", "j", "mine", "id", "times", "unit", "met").mapInArrow(compare, "a bigint, b bigint, links bigint")


def _usable() -> Column:
    """Whether a row's vector is finite, not zero and not null, and its label isn't null."""
    good = F.forall("__v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf"))) & F.exists("__v", lambda v: v != 0)
    return F.coalesce(F.col("label").isNotNull() & F.col("__v").isNotNull() & good, F.lit(False))


def op10_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
