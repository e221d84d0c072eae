"""Per-cycle aggregates as mergeable partial states; one definition for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmill.functions.scalars import finite, pick, ratio

KEYS = ["asset_id", "cycle_index"]
#: How each column of the partial state merges.
SUMS = ("event_count", "voltage_sum", "voltage_count", "current_sum", "current_count")
MAXES = ("max_capacity", "max_charge_capacity", "max_temperature", "max_voltage", "max_abs_current", "charge_time", "resistance", "last_event_time", "last_sequence")
MINS = ("min_temperature", "min_voltage")


def partials(samples: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Sums, counts and extremes of each cycle; absent columns give nulls, non-finite values count as null."""
    keys = keys or KEYS
    value = {c: finite(pick(samples, c, "double")) for c in ("voltage", "current", "temperature", "capacity", "charge_capacity", "source_time", "resistance")}
    return samples.groupBy(*keys).agg(
        F.count("*").alias("event_count"), F.sum(value["voltage"]).alias("voltage_sum"), F.count(value["voltage"]).alias("voltage_count"), F.sum(value["current"]).alias("current_sum"), F.count(value["current"]).alias("current_count"),
        F.max(value["capacity"]).alias("max_capacity"), F.max(value["charge_capacity"]).alias("max_charge_capacity"), F.max(value["temperature"]).alias("max_temperature"), F.min(value["temperature"]).alias("min_temperature"),
        F.max(value["voltage"]).alias("max_voltage"), F.min(value["voltage"]).alias("min_voltage"), F.max(F.abs(value["current"])).alias("max_abs_current"), F.max(pick(samples, "event_time", "timestamp_ntz")).alias("last_event_time"),
        F.max(value["source_time"]).alias("charge_time"), F.max(value["resistance"]).alias("resistance"), F.max(pick(samples, "replay_sequence", "bigint")).alias("last_sequence"),
    )


def merge(*states: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One state of several: sums add up, extremes stay extremes."""
    keys = keys or KEYS
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s, allowMissingColumns=True)
    how = [(F.sum, SUMS), (F.max, MAXES), (F.min, MINS)]
    return both.groupBy(*keys).agg(*(f(c).alias(c) for f, names in how for c in names if c in both.columns))


def rendered(state: DataFrame) -> DataFrame:
    """The state with means, which are null without values."""
    return state.withColumns({"average_voltage": ratio(F.col("voltage_sum"), F.col("voltage_count")), "average_current": ratio(F.col("current_sum"), F.col("current_count"))})


def lifecycle_flags(events: DataFrame) -> DataFrame:
    """Per asset: whether and when its end of life was observed and its replay completed. Events count once, however often they come."""
    def flag(kind):
        return F.coalesce(F.bool_or(F.col("event_type") == kind), F.lit(False))

    def when(kind):
        return F.max(F.when(F.col("event_type") == kind, F.col("event_time")))

    return events.groupBy("asset_id").agg(flag("eol_observed").alias("eol_observed"), flag("replay_complete").alias("replay_complete"), when("eol_observed").alias("eol_time"), when("replay_complete").alias("replay_time"))


def merged_flags(*states: DataFrame) -> DataFrame:
    """Flags of several batches as one: what was seen stays seen, times are the latest."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s, allowMissingColumns=True)
    seen = [F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in ("eol_observed", "replay_complete")]
    return both.groupBy("asset_id").agg(*seen, F.max("eol_time").alias("eol_time"), F.max("replay_time").alias("replay_time"))


def folded_lifecycle(rows: DataFrame) -> DataFrame:
    """Flags of rows that are events (event_type) or states (event_type null, flags set), in any mixture."""
    def flag(kind, column):
        return F.coalesce(F.bool_or(F.when(F.col("event_type").isNull(), F.col(column)).otherwise(F.col("event_type") == kind)), F.lit(False)).alias(column)

    return rows.groupBy("asset_id").agg(flag("eol_observed", "eol_observed"), flag("replay_complete", "replay_complete"))


def cutoff_text(rows: DataFrame, time: str = "event_time") -> DataFrame:
    """One row: the latest time, in ISO form with its zone, which is UTC."""
    return rows.agg(F.date_format(F.max(F.col(time).cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("replay_cutoff"))


def offset_map(watermarks: DataFrame) -> DataFrame:
    """(topic, offsets): a map from partition to offset for each topic; a topic has few partitions."""
    return watermarks.groupBy("topic").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("partition").cast("string"), "offset")))).alias("offsets"))


def beyond_watermarks(completions: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Completions whose source offset is above the watermark of their topic and partition; without a watermark all are."""
    w = watermarks.select("topic", "partition", F.col("offset").alias("_w"))
    return completions.join(w, ["topic", "partition"], "left").where(F.coalesce("_w", F.lit(-1)) < F.col("offset")).drop("_w")


def offset_watermarks(envelopes: DataFrame) -> DataFrame:
    """The highest offset of each (topic, partition)."""
    return envelopes.groupBy("topic", "partition").agg(F.max("offset").alias("offset"))
