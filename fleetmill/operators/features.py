"""Causal features of a cycle from the cycles before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmill.functions.scalars import ratio

#: Rows before the current one that windows look at.
HISTORY = 9


def causal(cycle_state: DataFrame) -> DataFrame:
    """Lags, rolling mean and slope over the prior HISTORY rows, change since the first cycle.

    The current row is in none of the windows. The slope is null with fewer
    than two points or equal cycles. Efficiency is discharged over charged
    capacity, null where nothing was charged.
    """
    order = Window.partitionBy("asset_id").orderBy("cycle_index")
    prior = order.rowsBetween(-HISTORY, -1)
    first = order.rowsBetween(Window.unboundedPreceding, 0)
    before = F.lag("cycle_index").over(order)
    return cycle_state.select(
        "*",
        F.lag("max_capacity").over(order).alias("prev_capacity"),
        (F.col("charge_time") - F.lag("charge_time").over(order)).alias("charge_time_delta") if "charge_time" in cycle_state.columns else F.lit(None).cast("double").alias("charge_time_delta"),
        (F.col("max_capacity") - F.lag("max_capacity").over(order)).alias("capacity_delta"),
        (F.col("cycle_index") - before).alias("cycle_gap"),
        F.avg("max_capacity").over(prior).alias("rolling_capacity_mean"),
        F.regr_slope("max_capacity", F.col("cycle_index").cast("double")).over(prior).alias("capacity_slope"),
        F.when(before.isNotNull(), F.col("max_capacity") - F.first("max_capacity").over(first)).alias("capacity_since_first"),
        (F.col("max_temperature") - F.col("min_temperature")).alias("temperature_span"),
        ratio(F.col("max_capacity"), F.col("max_charge_capacity")).alias("efficiency"),
    )


def incremental(cycle_state: DataFrame, new_keys: DataFrame) -> DataFrame:
    """causal() for new keys only: each asset is read from its first cycle and the HISTORY before its first new one."""
    order = Window.partitionBy("asset_id").orderBy("cycle_index")
    marked = cycle_state.join(new_keys.select("asset_id", "cycle_index").distinct().withColumn("is_new", F.lit(True)), ["asset_id", "cycle_index"], "left").withColumn("pos", F.row_number().over(order))
    first_new = F.min(F.when(F.col("is_new"), F.col("pos"))).over(Window.partitionBy("asset_id"))
    context = marked.withColumn("first_new", first_new).where("first_new is not null and (pos = 1 or pos >= first_new - %d)" % HISTORY)
    return causal(context).where("is_new").drop("is_new", "pos", "first_new")


def latest(rows: DataFrame, key: str = "asset_id", *order: str) -> DataFrame:
    """The last row of each key, by the order's columns and then by all others, so that ties are settled the same way each time."""
    first = list(order or ("cycle_index",))
    rest = [c for c in rows.columns if c not in first and c != key]
    w = Window.partitionBy(key).orderBy(*(F.desc(c) for c in first), *(F.desc(c) for c in rest))
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def all_finite(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows whose columns are all finite numbers."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    return rows.where(keep)
