"""What the operators of this subpackage share: the shared folder, link groups, row identity."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Sides of joins are broadcast up to so many rows of ids and hashes (about 50 MB).
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. A session on one machine gets one of its own where it's unset."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: it names the folder that driver and executors share")
        import tempfile

        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-"))
        folder = sc.getCheckpointDir()
    return folder


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """So many rows at most go to a Python worker at once, for jobs that run within; Spark's own bound in bytes holds anyway."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


class WordHash(dict):
    """Words' 64-bit hashes, kept for short words; it starts anew when it's full."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 300_000:
            self.clear()
        x = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = x
        return x


#: This worker's, for all operators.
HASHES = WordHash()


def sliced(batches: Iterator, rows: int = 500) -> Iterator:
    """Arrow batches of so many rows at most: texts become Python objects a few at a time."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage is cut there, and lost executors cost nothing."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class Scratch:
    """Tables in the shared folder that go when the block of ``with`` ends; what is needed later is written() elsewhere."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.paths = spark, f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}", []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{len(self.paths)}-{name}"
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def remove(self, path: str) -> None:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        self.remove(self.folder)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a side for broadcast if it has at most ``rows`` rows; larger ones are shuffled."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_bytes(text: Column) -> Column:
    """A text's UTF-8 bytes; a null text counts as empty."""
    return F.encode(F.coalesce(text, F.lit("")), "utf-8")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) for every id in the edges (a, b): component is the smallest id reachable.

    Alternating large-star and small-star rounds; each round is written to
    ``scratch``, and the round before is removed. Ids may be of any type with an order. Edges with a null end
    are no edges. Nothing is gathered: hubs are handled by grouped minima and
    joins whose skewed side Spark splits.
    """
    e = edges.where("a is not null and b is not null and a <> b")
    e = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = scratch.write(e, "edges")
    path, before = scratch.paths[-1], None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(least, "u")
        e = linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        e = scratch.write(e, "edges")
        scratch.remove(path)
        path = scratch.paths[-1]
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.max(F.col("u"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
    roots = e.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


class Sets:
    """Disjoint sets of the numbers below ``n``, each named by its smallest member."""

    def __init__(self, n: int):
        self.above = list(range(n))

    def root(self, x: int) -> int:
        above = self.above
        while above[x] != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.above[max(x, y)] = min(x, y)
        return True


def forest(linked) -> list[tuple[int, int]]:
    """Edges (member, smallest member) that join what a boolean matrix links."""
    import numpy as np

    n, seen, out = len(linked), np.zeros(len(linked), dtype=bool), []
    for start in range(n):
        if seen[start]:
            continue
        group = front = np.zeros(n, dtype=bool)
        group[start] = True
        front = group.copy()
        while front.any():
            found = linked[front].any(axis=0) & ~group
            group |= found
            front = found
        seen |= group
        out += [(int(x), start) for x in np.flatnonzero(group) if x != start]
    return out


def groups_of(batches: Iterator, keys: list[str]) -> Iterator:
    """Arrow tables, one for each run of equal keys in sorted rows, across batches."""
    import numpy as np
    import pyarrow as pa

    rest = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        now = now if rest is None else pa.concat_tables([rest, now])
        if not now.num_rows:
            continue
        change = np.zeros(now.num_rows, dtype=bool)
        for k in keys:
            x = now.column(k).to_numpy()
            change[1:] |= x[1:] != x[:-1]
        starts = [0, *np.flatnonzero(change).tolist()]
        for a, b in zip(starts, starts[1:], strict=False):
            yield now.slice(a, b - a)
        rest = now.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest
