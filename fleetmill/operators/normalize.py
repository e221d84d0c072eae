"""Nested asset records to flat tables, and telemetry events to and from JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmill.functions.scalars import pick

EVENT = "event_id string, asset_id bigint, cycle_index bigint, sample_index bigint, event_time string, voltage double, schema_version string"
LIFECYCLE = "event_id string, event_type string, asset_id bigint, cycle_index bigint, event_time string, expected_telemetry_rows bigint, schema_version string"
LIFECYCLE_TYPES = ("cycle_complete", "eol_observed", "replay_complete")
VERSION = "1.0"


def ragged_zip(cells: DataFrame, channels: list[str]) -> DataFrame:
    """A row for each sample of each cycle, up to the longest channel; shorter ones are null beyond their end.

    cells has asset_id and cycle_data: array<struct<cycle_number, channels...>>;
    a missing or zero cycle number is the position.
    """
    c = cells.select("asset_id", F.posexplode("cycle_data").alias("_p", "_c"))
    number = F.coalesce(F.nullif(F.col("_c.cycle_number"), F.lit(0)), F.col("_p") + 1)
    empty = F.array().cast("array<double>")
    zipped = F.arrays_zip(*(F.coalesce(F.col(f"_c.{x}"), empty).alias(x) for x in channels))
    flat = c.select("asset_id", number.cast("bigint").alias("cycle_index"), F.posexplode(zipped).alias("_s", "_v"))
    return flat.select("asset_id", "cycle_index", (F.col("_s") + 1).cast("bigint").alias("sample_index"), *(F.col("_v")[x].alias(x) for x in channels))


def nested(samples: DataFrame, channels: list[str]) -> DataFrame:
    """The inverse: one record an asset, for tests and exports."""
    ordered = F.array_sort(F.collect_list(F.struct("sample_index", *channels)))
    c = samples.groupBy("asset_id", "cycle_index").agg(ordered.alias("s"))
    cycle = F.struct(F.col("cycle_index").alias("cycle_number"), *(F.col("s")[n].alias(n) for n in channels))
    return c.groupBy("asset_id").agg(F.array_sort(F.collect_list(cycle)).alias("cycle_data"))


def provenance(cells: DataFrame, continuations: DataFrame) -> DataFrame:
    """cells (source_file, fingerprint) with lineage_group_id: a continuation's root (of several, the least), else the first file of the same content; and the batch that the file's name tells."""
    continuations = continuations.groupBy("source_file").agg(F.min("root").alias("root"))
    w = Window.partitionBy("fingerprint").orderBy("source_file")
    first = F.first("source_file").over(w)
    return cells.withColumn("_first", first).join(continuations.select("source_file", "root"), "source_file", "left").withColumn("lineage_group_id", F.coalesce("root", "_first")).withColumn("batch_id", F.nullif(F.regexp_replace(F.regexp_extract("source_file", r"(?:^|_)b(\d)[^_]*c", 1), "^(.+)$", "batch_$1"), F.lit(""))).drop("_first", "root")


def encode_events(samples: DataFrame) -> DataFrame:
    """(topic, key, value): telemetry as JSON; rows with an event_type go to the lifecycle topic."""
    topic = F.when(F.col("event_type").isNotNull(), "lifecycle").otherwise("telemetry") if "event_type" in samples.columns else F.lit("telemetry")
    return samples.withColumn("schema_version", F.lit(VERSION)).select(topic.alias("topic"), F.col("asset_id").cast("string").alias("key"), F.to_json(F.struct(*[c for c in samples.columns], "schema_version")).alias("value"))


def _payload(envelopes: DataFrame, schema: str) -> DataFrame:
    """The decoded payload with topic, partition and offset, which are null where the source has none; times that aren't are null."""
    source = [pick(envelopes, c, k).alias(c) for c, k in (("topic", "string"), ("partition", "int"), ("offset", "bigint"))]
    # A generator: what is asked of the fields can't be pushed below it, where each field would parse the payload again.
    x = envelopes.select(F.inline(F.array(F.from_json(F.col("value").cast("string"), schema))), *source)
    return x.withColumn("event_time", F.try_to_timestamp("event_time"))


def event_kinds(envelopes: DataFrame) -> DataFrame:
    """(topic, kind) of each valid event: telemetry, or the type of a lifecycle event. The payload is parsed once for both.

    A payload may be valid as both, and then is both.
    """
    fields = dict.fromkeys(f for schema in (EVENT, LIFECYCLE) for f in schema.split(", "))
    x = _payload(envelopes, ", ".join(fields))
    kinds = F.array(F.when(_is_telemetry(), "telemetry"), F.when(_is_lifecycle(), F.col("event_type")))
    return x.select("topic", F.explode(kinds).alias("kind")).where("kind is not null")


def _is_lifecycle() -> Column:
    return F.col("event_type").isin(*LIFECYCLE_TYPES) & (F.col("schema_version") == VERSION) & F.col("event_id").isNotNull() & F.col("asset_id").isNotNull() & F.col("event_time").isNotNull()


def _is_telemetry() -> Column:
    keep = F.col("schema_version") == VERSION
    for c in ("event_id", "asset_id", "cycle_index", "sample_index", "event_time"):
        keep = keep & F.col(c).isNotNull()
    return keep


def decode_lifecycle(envelopes: DataFrame) -> DataFrame:
    """Valid lifecycle events: known types of the right version with id, asset and time."""
    return _payload(envelopes, LIFECYCLE).where(_is_lifecycle())


def completions(lifecycle: DataFrame) -> DataFrame:
    """The facts of completed cycles, one a cycle: of several, the least offset."""
    facts = lifecycle.where("event_type = 'cycle_complete'").select("asset_id", "cycle_index", "offset", "topic", "partition", "expected_telemetry_rows", "event_time")
    return facts.groupBy("asset_id", "cycle_index").agg(F.min(F.struct("offset", "topic", "partition", "expected_telemetry_rows", "event_time")).alias("f")).select("asset_id", "cycle_index", "f.*")


def decode_events(envelopes: DataFrame, schema: str = EVENT) -> DataFrame:
    """Valid telemetry events; malformed payloads, missing fields, other versions and bad times are left out."""
    return _payload(envelopes, schema).where(_is_telemetry())


def cycle_reductions(cells: DataFrame, channels: list[str]) -> DataFrame:
    """(asset_id, cycle_index, samples, max_<channel>, min_<channel>) straight from the nested arrays, nulls left out."""
    c = cells.select("asset_id", F.posexplode("cycle_data").alias("_p", "_c"))
    number = F.coalesce(F.nullif(F.col("_c.cycle_number"), F.lit(0)), F.col("_p") + 1).cast("bigint")
    size = F.greatest(*(F.coalesce(F.size(F.col(f"_c.{x}")), F.lit(0)) for x in channels), F.lit(0))
    ends = [f(F.col(f"_c.{x}")).alias(f"{n}_{x}") for x in channels for n, f in (("max", F.array_max), ("min", F.array_min))]
    return c.select("asset_id", number.alias("cycle_index"), size.alias("samples"), *ends)


def replay_time(epoch: str, cycle, seconds):
    """The time at which a sample is replayed: a day a cycle from an epoch on, and the sample's own seconds."""
    return F.lit(epoch).cast("timestamp_ntz") + F.make_dt_interval(days=(cycle - 1).cast("int"), secs=seconds)
