"""The append-only feature outlet: write-once rows by generation, with a ledger of segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmill.sources.store import exists

from .merge import append_once, digest
from .quality import duplicates

KEYS = ["asset_id", "cycle_index"]


def key_ranges(rows: DataFrame) -> DataFrame:
    """(asset_id, min_cycle, max_cycle, cycles) of a segment, for its ledger entry."""
    return rows.groupBy("asset_id").agg(F.min("cycle_index").alias("min_cycle"), F.max("cycle_index").alias("max_cycle"), F.count("*").alias("cycles"))


def key_maxima(ledger: DataFrame) -> DataFrame:
    """The largest cycle of each asset over all segments, from the ledger alone."""
    return ledger.groupBy("asset_id").agg(F.max("max_cycle").alias("max_cycle"))


def beyond(rows: DataFrame, maxima: DataFrame) -> DataFrame:
    """Rows whose cycle is above the outlet's largest of its asset: new for sure, without reading the outlet."""
    return rows.join(maxima, "asset_id", "left").where("max_cycle is null or cycle_index > max_cycle").drop("max_cycle")


def cumulative(outlet: DataFrame, generation: int, cycles: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Rows of generations up to one (pruned by partition), within the boundary, with their cycles' facts."""
    rows = outlet.where(F.col("generation_id") <= generation)
    if bounds is not None:
        rows = rows.join(bounds.select("asset_id", "max_cycle"), "asset_id").where("cycle_index <= max_cycle").drop("max_cycle")
    facts = [c for c in cycles.columns if c not in rows.columns or c in KEYS]
    return rows.join(cycles.select(*facts), KEYS)


def without_facts(outlet: DataFrame, cycles: DataFrame) -> DataFrame:
    """Rows that no canonical cycle stands for; there should be none."""
    return outlet.select(*KEYS).join(cycles.select(*KEYS), KEYS, "left_anti")


def not_kept(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Keys of a cumulative snapshot that a later one lacks or has with other values; there should be none."""
    rest = [c for c in previous.columns if c not in KEYS]
    b = current.select(*KEYS, F.struct(*rest).alias("b"))
    both = previous.select(*KEYS, F.struct(*rest).alias("a")).join(b, KEYS, "left")
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select(*KEYS)


def first_generation(snapshots: DataFrame) -> DataFrame:
    """Each key of cumulative snapshots (generation_id, keys) with the first generation that has it."""
    return snapshots.groupBy(*KEYS).agg(F.min("generation_id").alias("generation_id"))


def seeded(snapshots: DataFrame) -> DataFrame:
    """The outlet's rows out of cumulative snapshots (generation_id, keys, values): each key in its first generation.

    A later snapshot that lacks a key of an earlier one, or has it with other
    values, is an error.
    """
    rest = [c for c in snapshots.columns if c not in (*KEYS, "generation_id")]
    own = snapshots.groupBy(*KEYS).agg(F.min("generation_id").alias("generation_id"), F.count("*").alias("_n"), F.min(F.struct(*rest)).alias("_a"), F.max(F.struct(*rest)).alias("_b"))
    last = snapshots.select("generation_id").distinct()
    want = own.join(F.broadcast(last.select(F.col("generation_id").alias("_g"))), F.col("_g") >= F.col("generation_id")).groupBy(*KEYS).agg(F.count("*").alias("_want"))  # a row a generation is broadcast
    bad = own.join(want, KEYS).where(~F.col("_a").eqNullSafe(F.col("_b")) | (F.col("_n") != F.col("_want"))).select(*KEYS).limit(1).collect()
    if bad:
        raise ValueError(f"a later snapshot lost or changed {bad[0].asDict()}")
    return own.select(*KEYS, "generation_id", "_a.*")


class Outlet:
    """The outlet's folder: ``rows/generation_id=g/segment=<digest>`` and ``ledger/segment=<digest>``.

    A segment's name is its content: the same append again writes nothing new,
    and a segment whose ledger entry is missing is taken up by the next append.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def rows(self) -> DataFrame | None:
        path = f"{self.folder}/rows"
        return self.spark.read.option("basePath", path).parquet(f"{path}/generation_id=*/segment=*") if exists(self.spark, path) else None

    def ledger(self) -> DataFrame | None:
        path = f"{self.folder}/ledger"
        return self.spark.read.parquet(path) if exists(self.spark, path) else None

    def append(self, rows: DataFrame, generation: int) -> int:
        """Appends rows that are new, and gives their number; a known key with other values is an error."""
        old = self.rows()
        if old is not None:
            if set(rows.columns) != set(old.columns) - {"generation_id", "segment"}:
                raise ValueError("the outlet's columns are fixed at its first append")
            rows = append_once(old.select(*rows.columns), rows, KEYS)
        rows = rows.persist()
        twice = duplicates(rows, KEYS).limit(1).collect()
        if twice:
            raise ValueError(f"a key is null or repeated in one append: {twice[0].asDict()}")
        name = digest(rows, KEYS).first()
        if name["rows"]:
            rows.write.mode("overwrite").parquet(f"{self.folder}/rows/generation_id={generation}/segment={name['digest']}")
            key_ranges(rows).withColumn("generation_id", F.lit(generation)).write.mode("overwrite").parquet(f"{self.folder}/ledger/segment={name['digest']}")
        rows.unpersist()
        return name["rows"]

    def faults(self) -> DataFrame:
        """(fault, rows): duplicate keys, generations below 1, ranges that the ledger has otherwise."""
        rows, ledger = self.rows(), self.ledger()
        twice = rows.groupBy(*KEYS).count().where("count > 1").agg(F.count("*").alias("rows")).withColumn("fault", F.lit("duplicate keys"))
        low = rows.where("generation_id < 1").agg(F.count("*").alias("rows")).withColumn("fault", F.lit("generation below 1"))
        own = rows.groupBy("segment", "asset_id").agg(F.count("*").alias("n"), F.max("cycle_index").alias("m"))
        off = own.join(ledger.select("segment", "asset_id", "cycles", "max_cycle"), ["segment", "asset_id"], "full").where("not (n <=> cycles and m <=> max_cycle)")
        return twice.unionByName(low).unionByName(off.agg(F.count("*").alias("rows")).withColumn("fault", F.lit("ledger differs"))).where("rows > 0").select("fault", "rows")
