"""The test tables as a fleet: customer = asset, order = cycle, line item = sample, nation = lineage group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The last day of each generation but the newest.
CUTOFFS = ("1996-12-31", "1998-12-31", "2000-06-30")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("asset_id"), F.row_number().over(w).cast("bigint").alias("cycle_index"), "o_orderkey", F.col("o_orderdate").alias("cycle_time"), "o_orderstatus", "o_totalprice"
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
    line = table(spark, sf_dir, "lineitem").withColumn("sample_index", F.row_number().over(w).cast("bigint"))
    return line.join(cycles(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "asset_id", "cycle_index", "sample_index", F.concat_ws(":", "asset_id", "cycle_index", "sample_index").alias("event_id"), F.col("l_shipdate").alias("event_time"), F.col("l_quantity").alias("voltage"),
        (F.col("l_discount") - 0.05).alias("current"), (F.col("l_tax") * 100).alias("temperature"), F.col("l_extendedprice").alias("capacity"), (F.col("l_quantity") * 60).alias("source_time"), (F.col("l_discount") * 10).alias("resistance"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("charge_capacity"),
    )


def lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completion events with the expected number of samples (one too many for some cycles), and the ends of assets."""
    done = samples(spark, sf_dir).groupBy("asset_id", "cycle_index").agg(F.max("event_time").alias("event_time"), F.count("*").alias("n"))
    late = (F.col("asset_id") % 5 == 0) & (F.col("cycle_index") == 4)
    done = done.select("asset_id", "cycle_index", F.lit("cycle_complete").alias("event_type"), "event_time", (F.col("n") + F.when(late, 1).otherwise(0)).alias("expected_telemetry_rows"))
    last = cycles(spark, sf_dir).groupBy("asset_id").agg(F.max("cycle_index").alias("cycle_index"), F.max("cycle_time").alias("event_time"))
    kinds = F.array(F.lit("replay_complete"), *([F.lit("eol_observed")]))
    ends = last.withColumn("event_type", F.explode(kinds)).where("event_type = 'replay_complete' or asset_id % 3 <> 0")
    return done.unionByName(ends.select("asset_id", "cycle_index", "event_type", "event_time", F.lit(None).cast("bigint").alias("expected_telemetry_rows")))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = cycles(spark, sf_dir).groupBy("asset_id").agg(F.max("cycle_index").alias("last_source_cycle"), F.min("cycle_time").alias("start_time"))
    m = F.col("c_nationkey") % 5
    split = F.when(m < 3, "train").when(m == 3, "validation").otherwise("test")
    odd = F.col("c_custkey") % 11 == 0
    early = F.col("c_custkey") % 13 == 5
    eol = F.when(F.col("c_custkey") % 7 != 0, F.col("last_source_cycle") + F.when(odd, 2).when(early, -2).otherwise(0))
    joined = table(spark, sf_dir, "customer").join(last, F.col("asset_id") == F.col("c_custkey"))
    return joined.select("asset_id", F.col("c_nationkey").alias("lineage_group_id"), split.alias("split"), "last_source_cycle", "start_time", eol.alias("eol_cycle"), ((F.col("c_custkey") % 7 != 0) & ~odd).alias("valid_eol_label"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arithmetic stand-ins for a model's raw remaining-life predictions."""
    raw = F.lit(12) - F.col("cycle_index") + F.col("asset_id") % 3 - 1 + F.when(F.col("cycle_index") % 4 == 0, 3).otherwise(0)
    return cycles(spark, sf_dir).select("asset_id", "cycle_index", "cycle_time", raw.cast("double").alias("raw_rul"))


def curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arithmetic stand-ins for survival curves at horizons 0, 50, 100, 150, 200 of each asset's newest cycle."""
    last = cycles(spark, sf_dir).groupBy("asset_id").agg(F.max("cycle_index").alias("cycle_index"))
    h = F.explode(F.array(*[F.lit(x) for x in (0, 50, 100, 150, 200)])).alias("horizon")
    p = F.lit(1.0) - F.col("horizon") / 250.0 + F.when((F.col("asset_id") % 4 == 0) & (F.col("horizon") == 100), 0.5).otherwise(0.0)
    return last.select("asset_id", "cycle_index", h).withColumn("probability", p)
