"""Landmark rows, the censoring distribution and weighted survival metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def landmark_rows(cycles: DataFrame, assets: DataFrame, flags: DataFrame, cutoff: Column) -> DataFrame:
    """(asset_id, cycle_index, split, duration, event): what was known of the rest of life at each cycle.

    An asset's cycles come a day apart from its start, so a cutoff shows those
    up to its first cycle plus the whole days since, and none before the start;
    held-out splits have their full follow-up. The event is an observed, valid
    end at or before the last cycle shown; the duration is up to it, and up to
    the last cycle shown otherwise. Only positive durations stay.
    """
    dim = assets.select("asset_id", "split", "valid_eol_label", "eol_cycle", "last_source_cycle", "start_time", F.coalesce("first_source_cycle", F.lit(1)).alias("first_source_cycle") if "first_source_cycle" in assets.columns else F.lit(1).alias("first_source_cycle"))
    joined = cycles.select("asset_id", "cycle_index").join(dim, "asset_id").join(flags.select("asset_id", "eol_observed"), "asset_id", "left")
    shown = F.when(F.col("split") != "train", F.col("last_source_cycle")).otherwise(shown_cycle(cutoff))
    joined = joined.withColumn("_shown", shown).where(F.col("cycle_index") <= F.col("_shown"))
    event = F.coalesce(F.col("valid_eol_label") & F.col("eol_observed") & (F.col("eol_cycle") <= F.col("_shown")), F.lit(False))
    end = F.when(F.col("event"), F.col("eol_cycle")).otherwise(F.col("_shown"))
    out = joined.withColumn("event", event).withColumn("duration", (end - F.col("cycle_index")).cast("double"))
    return out.where("duration > 0").select("asset_id", "cycle_index", "split", "duration", "event")


def with_state_rows(features: DataFrame, state: DataFrame, assets: DataFrame, arrived: DataFrame) -> DataFrame:
    """Held-out assets' features, and the published state's for the train assets that have arrived, in place of train rows of their own.

    ``assets`` has asset_id and split, ``arrived`` the arrived train asset_ids.
    An asset without a split isn't train. Columns are those of ``features``.
    """
    train = assets.where("split = 'train'").select("asset_id").distinct()
    rows = state.join(arrived.select("asset_id").distinct(), "asset_id", "left_semi").select(*features.columns)
    return features.join(train, "asset_id", "left_anti").select(*features.columns).unionByName(rows)


def shown_cycle(cutoff: Column) -> Column:
    """The last cycle of an asset (first_source_cycle, last_source_cycle, start_time) that is there at a cutoff; null before its start."""
    days = F.floor((F.unix_micros(cutoff.cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))) / 86_400_000_000)
    return F.when(F.col("start_time") <= cutoff, F.least(F.col("last_source_cycle"), F.col("first_source_cycle") + days))


def latest_landmarks(rows: DataFrame) -> DataFrame:
    """The newest landmark of each asset."""
    w = Window.partitionBy("asset_id").orderBy(F.desc("cycle_index"), F.desc("duration"))
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def landmark_counts(rows: DataFrame) -> DataFrame:
    """(split, rows, events, censored)."""
    return rows.groupBy("split").agg(F.count("*").alias("rows"), F.count_if("event").alias("events"), F.count_if(~F.col("event")).alias("censored"))


def checked_features(columns: list[str]) -> list[str]:
    """The columns, if none of them knows the future; an error otherwise."""
    forbidden = sorted({"eol_cycle", "rul_cycles", "duration", "duration_cycles", "event", "event_observed", "terminal_cycle", "lifecycle_state"} & set(columns))
    if forbidden:
        raise ValueError("features that know the future: " + ", ".join(forbidden))
    return columns


def landmark_sample(rows: DataFrame, every: int = 10) -> DataFrame:
    """Of train rows the first of each asset, every so-manyth, and the last; others all."""
    first = F.min("cycle_index").over(Window.partitionBy("asset_id"))
    return rows.withColumn("_f", first).where((F.col("split") != "train") | (F.col("cycle_index") == F.col("_f")) | (F.col("cycle_index") % every == 0) | (F.col("duration") == 1)).drop("_f")


def censoring(rows: DataFrame) -> DataFrame:
    """(duration, at_risk, censored, survival): the Kaplan-Meier estimate of not being censored.

    Events of a duration come before its censored rows, so they aren't at risk
    of being censored then. Counts are grouped by duration first; only that
    small table is ordered.
    """
    by = rows.groupBy("duration").agg(F.count("*").alias("n"), F.count_if(~F.col("event")).alias("censored"))
    # Those at risk are the censored rows of this duration and all of longer ones.
    longer = F.sum("n").over(Window.orderBy(F.desc("duration")).rowsBetween(Window.unboundedPreceding, -1))
    upto = Window.orderBy("duration").rowsBetween(Window.unboundedPreceding, 0)
    stay = F.when(F.col("censored") > 0, 1 - F.col("censored") / F.col("at_risk")).otherwise(1.0)
    return by.withColumn("at_risk", F.coalesce(longer, F.lit(0)) + F.col("censored")).withColumn("survival", F.product(stay).over(upto)).select("duration", "at_risk", "censored", "survival")


def supported(train: DataFrame, rows: DataFrame) -> DataFrame:
    """rows with g, the censoring estimate of the train rows at their duration; those beyond the train rows' durations, or where g is 0, go."""
    limit = train.agg(F.max("duration").alias("_limit"))
    own = rows.join(F.broadcast(limit), F.lit(True)).where(F.col("duration") <= F.col("_limit")).drop("_limit")
    return _step(own, censoring(train), "duration", "g").where("g > 0")


def _step(rows: DataFrame, km: DataFrame, at: str, name: str) -> DataFrame:
    """rows with the value of the step function (duration, survival) at a column: 1 before the first step.

    Distinct values and steps are merged in one order, a row a distinct value,
    and the rows are joined to that.
    """
    values = rows.select(F.col(at).cast("double").alias("v")).distinct()
    both = values.withColumn("s", F.lit(None).cast("double")).withColumn("k", F.lit(1)).unionByName(km.select(F.col("duration").cast("double").alias("v"), F.col("survival").alias("s"), F.lit(0).alias("k")))
    upto = Window.orderBy("v", "k").rowsBetween(Window.unboundedPreceding, 0)
    steps = both.withColumn(name, F.coalesce(F.last("s", ignorenulls=True).over(upto), F.lit(1.0))).where("k = 1").select("v", name)
    return rows.join(steps, F.col(at).cast("double") == F.col("v")).drop("v")


def brier(train: DataFrame, rows: DataFrame, horizons: tuple[int, ...]) -> DataFrame:
    """(horizon, rows, brier): inverse-censoring-weighted Brier scores of ``probability`` (of surviving the horizon).

    rows has duration, event, horizon and probability. Rows without support in
    the train rows don't count.
    """
    own = supported(train, rows.where(F.col("horizon").isin(*horizons)))
    own = _step(own, censoring(train), "horizon", "gh")
    dead = (F.col("duration") <= F.col("horizon")) & F.col("event")
    alive = F.col("duration") > F.col("horizon")
    p = F.col("probability")
    term = F.when(dead, p * p / F.col("g")).when(alive, F.try_divide((1 - p) * (1 - p), F.col("gh"))).otherwise(0.0)
    return own.groupBy("horizon").agg(F.count("*").alias("rows"), F.avg(term).alias("brier"))


def integrated_brier(train: DataFrame, rows: DataFrame, horizons: tuple[int, ...]) -> DataFrame:
    """One row: the mean Brier score over the horizons between 0 and the longest supported duration (null for fewer than two), and the counts of rows with and without support.

    rows has id columns, duration, event, horizon and probability, each row once a horizon.
    """
    one = rows.where(F.col("horizon") == horizons[0])
    good = supported(train, one)
    counts = good.agg(F.count("*").alias("supported_rows"), F.max("duration").alias("longest")).join(F.broadcast(one.agg(F.count("*").alias("_all"))), F.lit(True))
    scores = brier(train, rows, horizons).join(F.broadcast(counts), F.lit(True)).where((F.col("horizon") > 0) & (F.col("horizon") < F.col("longest")))
    w = Window.orderBy("horizon")
    steps = scores.withColumns({"_dx": F.col("horizon") - F.lag("horizon").over(w), "_y": (F.col("brier") + F.lag("brier").over(w)) / 2})  # a row a horizon
    area = steps.agg(F.try_divide(F.sum(F.col("_dx") * F.col("_y")), F.sum("_dx")).alias("integrated_brier"))
    return counts.join(F.broadcast(area), F.lit(True)).select("integrated_brier", "supported_rows", (F.col("_all") - F.col("supported_rows")).alias("excluded_rows"))


def concordance(train: DataFrame, rows: DataFrame) -> DataFrame:
    """One row: the censoring-weighted concordance of ``risk`` with duration and event, and the weight of its pairs.

    A pair is an event and a row that lasts longer, or is censored at the event's
    duration; its weight is that of the estimate there. It's concordant if the event
    has the higher risk, and half so at equal risk. Only rows with support in
    the train rows count. Pairs are never formed: rows are counted by duration
    and rank of risk, and pairs are sums over a binary tree of ranks: on each
    level, an event counts the later rows in the half below its own.
    """
    own = supported(train, rows)
    cells = own.groupBy("duration", "risk").agg(F.count("*").alias("n"), F.count_if("event").alias("e"))
    ranks = cells.select("risk").distinct()
    ranks = ranks.withColumn("_x", F.row_number().over(Window.orderBy("risk")) - 1)  # a row a distinct risk
    cells = cells.join(ranks, "risk")
    levels = max(1, (int(ranks.agg(F.max("_x")).first()[0] or 0)).bit_length())
    # Rows of each cell, on each level: where the cell is the upper child of its node, the later rows of the lower child count as below.
    each = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("_level"))
    each = each.withColumns({"_node": F.floor(F.col("_x") / F.pow(F.lit(2.0), F.col("_level") + 1)).cast("bigint"), "_upper": F.floor(F.col("_x") / F.pow(F.lit(2.0), F.col("_level"))).cast("bigint") % 2})
    node = Window.partitionBy("_level", "_node").orderBy(F.desc("duration"))
    low = lambda c: F.when(F.col("_upper") == 0, F.col(c)).otherwise(0)
    # As long or longer, without the events of the same duration.
    lower = F.sum(low("n")).over(node.rangeBetween(Window.unboundedPreceding, 0)) - F.sum(low("e")).over(node.rangeBetween(0, 0))
    below = each.withColumn("_b", F.coalesce(lower, F.lit(0))).where("_upper = 1 and e > 0").groupBy("duration", "risk").agg(F.sum("_b").alias("below"))
    same = Window.partitionBy("risk").orderBy(F.desc("duration")).rowsBetween(Window.unboundedPreceding, -1)
    by_duration = cells.groupBy("duration").agg(F.sum("n").alias("_n"), F.sum("e").alias("_e"))
    after = Window.orderBy(F.desc("duration")).rowsBetween(Window.unboundedPreceding, 0)
    longer = by_duration.select("duration", (F.sum("_n").over(after) - F.col("_e")).alias("all"))  # a row a distinct duration
    events = cells.withColumn("equal", F.coalesce(F.sum("n").over(same), F.lit(0)) + F.col("n") - F.col("e")).where("e > 0").join(longer, "duration").join(below, ["duration", "risk"], "left")
    at = _step(events, censoring(train), "duration", "g").withColumn("w", F.try_divide(F.col("e"), F.col("g") * F.col("g")))
    good = F.sum(F.col("w") * (F.coalesce("below", F.lit(0)) + 0.5 * F.col("equal")))
    return at.agg(F.try_divide(good, F.sum(F.col("w") * F.col("all"))).alias("c_index"), F.coalesce(F.sum(F.col("w") * F.col("all")), F.lit(0.0)).alias("weight"))
