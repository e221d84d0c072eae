"""Keyed merges: old and new rows of a key, chosen by a rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmill.functions.digests import folded, row_hash


def merge_keyed(old: DataFrame, new: DataFrame, keys: list[str], take_new: Column) -> DataFrame:
    """old with rows of new: new keys are added, known ones replaced where ``take_new`` holds.

    The rule names the sides ``old`` and ``new`` (structs of the other columns).
    Keys are unique on either side. Both sides have the same columns.
    """
    rest = [c for c in old.columns if c not in keys]
    left = old.select(*keys, F.struct(*rest).alias("old"), F.lit(True).alias("_o"))
    right = new.select(*keys, F.struct(*(F.col(c).cast(old.schema[c].dataType).alias(c) for c in rest)).alias("new"), F.lit(True).alias("_n"))
    both = left.join(right, keys, "full")
    fresh = F.col("_o").isNull() | (F.col("_n").isNotNull() & F.coalesce(take_new, F.lit(False)))
    return both.select(*keys, F.when(fresh, F.col("new")).otherwise(F.col("old")).alias("row")).select(*keys, "row.*").select(*old.columns)


def newer_sequence() -> Column:
    """Serving rule: a later sequence wins; at the same sequence and state, a later selection."""
    o, n = F.col("old"), F.col("new")
    return (n["sequence"] > o["sequence"]) | ((n["sequence"] == o["sequence"]) & n["state_id"].eqNullSafe(o["state_id"]) & (n["revision"] > o["revision"]))


def newer_curve() -> Column:
    """(cycle, sequence) later, or equal with a later revision or another state."""
    o, n = F.col("old"), F.col("new")
    a, b = F.struct(n["cycle_index"], n["sequence"]), F.struct(o["cycle_index"], o["sequence"])
    return (a > b) | ((a == b) & ((n["revision"] > o["revision"]) | ~n["state_id"].eqNullSafe(o["state_id"])))


def bumped_selection(current: DataFrame, wanted: DataFrame) -> DataFrame:
    """A selection (model_version, fingerprint) by key with its revision one higher where either differs (null equals null); new keys get revision 1, and keys without a wish stay."""
    choice = ["model_version", "fingerprint"]
    both = current.select("dataset", F.struct(*choice).alias("was"), "revision").join(wanted.select("dataset", F.struct(*choice).alias("new")), "dataset", "full")
    changed = F.col("new").isNotNull() & ~F.col("new").eqNullSafe(F.col("was"))
    return both.select("dataset", F.coalesce("new", "was").alias("s"), (F.coalesce("revision", F.lit(0)) + F.when(changed, 1).otherwise(0)).alias("revision")).select("dataset", "s.*", "revision")


def unique_facts(old: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    """Facts of both, one a key: a stored one stays, and of several new ones the least by all columns."""
    first = new.groupBy(*keys).agg(F.min(F.struct(*[c for c in new.columns if c not in keys])).alias("r")).select(*keys, "r.*").select(*new.columns)
    return first if old is None else old.unionByName(first.join(old.select(*keys), keys, "left_anti"))


def without_stale(rows: DataFrame, newest: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is among the newest."""
    return rows.join(newest.select(*keys).distinct(), keys, "left_semi")


def conflicts(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that both sides have with different values (null equals null)."""
    rest = [c for c in old.columns if c not in keys]
    both = old.select(*keys, F.struct(*rest).alias("a")).join(new.select(*keys, F.struct(*rest).alias("b")), keys)
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select(*keys)


def append_once(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of new whose key is new; an error if a known key has other values."""
    clash = conflicts(old, new, keys).limit(1).collect()
    if clash:
        raise ValueError(f"a stored row would change: {clash[0].asDict()}")
    return new.join(old.select(*keys), keys, "left_anti").select(*old.columns)


def digest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(digest, rows): a content hash that depends neither on the rows' order nor on the partitions."""
    names = [*keys, *sorted(c for c in rows.columns if c not in keys)]
    return folded(rows.select(row_hash(names).alias("h")))
