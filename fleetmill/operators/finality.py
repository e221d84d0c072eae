"""Which cycles are final: by completeness of the cycle and of all before it, not by lateness."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmill.functions.digests import folded


def ready(state: DataFrame, completions: DataFrame) -> DataFrame:
    """Completion events with event_count and ``ready``: as many samples as expected. Without samples the count is 0."""
    counted = completions.join(state.select("asset_id", "cycle_index", "event_count"), ["asset_id", "cycle_index"], "left")
    n = F.coalesce("event_count", F.lit(0))
    return counted.withColumns({"event_count": n, "ready": F.coalesce(n == F.col("expected_telemetry_rows"), F.lit(False)), "overflow": F.coalesce(n > F.col("expected_telemetry_rows"), F.lit(False))})


def prefix_complete(canonical: DataFrame, ready_keys: DataFrame) -> DataFrame:
    """The canonical cycles (asset_id, cycle_index) up to which, without a gap, all cycles are ready."""
    done = ready_keys.select("asset_id", "cycle_index", F.lit(True).alias("ready")).distinct()
    w = Window.partitionBy("asset_id").orderBy("cycle_index").rowsBetween(Window.unboundedPreceding, 0)
    marked = canonical.select("asset_id", "cycle_index").distinct().join(done, ["asset_id", "cycle_index"], "left").withColumn("final", F.bool_and(F.coalesce("ready", F.lit(False))).over(w))
    return marked.where("final").select("asset_id", "cycle_index")


def boundary(final_keys: DataFrame) -> DataFrame:
    """(asset_id, max_cycle, cycles[, replay_sequence]): the range of final cycles of each asset, and the sequence at its end where keys have one."""
    at = [F.max_by("replay_sequence", "cycle_index").alias("replay_sequence")] if "replay_sequence" in final_keys.columns else []
    return final_keys.groupBy("asset_id").agg(F.max("cycle_index").alias("max_cycle"), F.count("*").alias("cycles"), *at)


def within_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose cycle is among the keys: the form of a boundary that lists all cycles."""
    return rows.join(keys.select("asset_id", "cycle_index"), ["asset_id", "cycle_index"], "left_semi")


def within(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows inside the boundary."""
    return rows.join(bounds.select("asset_id", "max_cycle"), "asset_id").where("cycle_index <= max_cycle").drop("max_cycle")


def state_id(bounds: DataFrame) -> DataFrame:
    """One row with a content id of a boundary, whatever the rows' order, and its number of assets."""
    row = F.sha2(F.concat_ws(":", "asset_id", "max_cycle", "cycles"), 256)
    return folded(bounds.select(row.alias("h")), "state_id").withColumnRenamed("rows", "assets")
