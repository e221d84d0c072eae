"""Cohorts, splits, generations and schedules of assets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _arrived(assets: DataFrame, cutoff: Column) -> tuple[Column, Column]:
    """(arrived, observed) of train assets at a cutoff.

    An asset's end comes (eol_cycle - first_source_cycle) days after its start,
    at its start without an end; it is observed if the label is valid, the
    event was seen and it comes by the cutoff.
    """
    first = F.coalesce(F.col("first_source_cycle"), F.lit(1)) if "first_source_cycle" in assets.columns else F.lit(1)
    end = F.col("start_time") + F.make_dt_interval(days=F.coalesce(F.col("eol_cycle") - first, F.lit(0)).cast("int"))
    here = F.coalesce((F.col("split") == "train") & (F.col("start_time") <= cutoff), F.lit(False))
    return here, here & F.coalesce(F.col("valid_eol_label") & F.col("eol_observed") & (end <= cutoff), F.lit(False))


def at_cutoff(assets: DataFrame, cutoff: Column) -> DataFrame:
    """The training cohort at a cutoff: train assets that have arrived, with ``observed``; the others are censored. Their order is that of arrival_rank."""
    here, seen = _arrived(assets, cutoff)
    return assets.withColumn("observed", seen).where(here)


def counts_at(assets: DataFrame, cutoffs: list[str]) -> DataFrame:
    """(cutoff, arrived, observed, censored) of the training cohort at each of a few cutoffs, in one pass over the assets."""
    each = F.explode(F.array(*[F.lit(c).cast("timestamp_ntz") for c in cutoffs])).alias("cutoff")
    here, seen = _arrived(assets, F.col("cutoff"))
    return assets.select("*", each).groupBy("cutoff").agg(F.count_if(here).alias("arrived"), F.count_if(seen).alias("observed"), F.count_if(here & ~seen).alias("censored"))


def generation(time: Column, cutoffs: tuple[str, ...]) -> Column:
    """The first generation (from 1) whose cutoff isn't before the time, or the one behind the last cutoff: a forward as-of."""
    out = F.lit(len(cutoffs) + 1)
    for k, c in reversed(list(enumerate(cutoffs, 1))):
        out = F.when(time <= F.lit(c).cast("timestamp_ntz"), k).otherwise(out)
    return out.cast("int")


def generation_asof(rows: DataFrame, generations: DataFrame, time: str) -> DataFrame:
    """The same against a small table (generation, cutoff), gathered into one row: the first cutoff that isn't before the time, else the last."""
    dim = generations.agg(F.array_sort(F.collect_list(F.struct("cutoff", "generation"))).alias("dim"))
    hit = F.filter("dim", lambda g: g["cutoff"] >= F.col(time))
    return rows.join(F.broadcast(dim), F.lit(True)).withColumn("generation", F.when(F.size(hit) > 0, hit[0]["generation"]).otherwise(F.element_at("dim", -1)["generation"])).drop("dim")


def ranked(rows: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """rows with their rank from 0, in the order of some columns: ranks within ranges of it, plus the rows of the ranges before.

    No task orders all rows, whatever the columns hold; nulls come first. The
    order should be total: rows that are alike in it may swap places.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    own = rows.withColumns({f"_o{k}": c for k, c in enumerate(keys)})
    names = [f"_o{k}" for k in range(len(keys))]
    # The ranges' bounds are cuts of a sample of 20,000 rows; any bounds give the same ranks.
    cuts = own.select(F.struct(*names).alias("o")).sample(fraction=1.0 if parts < 2 else min(1.0, 20_000 / max(1, own.count())), seed=3)
    cut = cuts.withColumn("_n", F.ntile(parts).over(Window.orderBy("o"))).groupBy("_n").agg(F.max("o").alias("o")).agg(F.array_sort(F.collect_list("o")).alias("_cuts"))
    # The number of bounds below a row, by a binary search: steps fall from the largest power of 2, and there's none beyond the last bound.
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(max(1, parts).bit_length()))))
    below = F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get("_cuts", n + step - 1) < F.struct(*names), n + step).otherwise(n))
    own = own.join(F.broadcast(cut), F.lit(True)).withColumn("_b", below).drop("_cuts")
    sizes = own.groupBy("_b").agg(F.count("*").alias("_n"))  # a row a range
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_b", "_before")
    w = Window.partitionBy("_b").orderBy(*names)
    return own.join(F.broadcast(before), "_b").withColumn(name, F.col("_before") + F.row_number().over(w) - 1).drop("_b", "_before", *names)


def arrival_rank(assets: DataFrame, version: str = "v1") -> DataFrame:
    """assets with arrival_rank, from 0, in the order of a hash of their lineage group; those without a group come first."""
    h = F.sha2(F.concat(F.lit(version + ":"), F.col("lineage_group_id").cast("string")), 256)
    return ranked(assets, "arrival_rank", h, "asset_id")


def scheduled(ranked: DataFrame, epoch: str, days: int) -> DataFrame:
    """Ranked assets with arrival_time: ``days`` apart from an epoch on."""
    after = F.make_dt_interval(days=(F.col("arrival_rank") * days).cast("int"))
    return ranked.withColumn("arrival_time", F.lit(epoch).cast("timestamp_ntz") + after)


def arrival_text(epoch: str, days: int) -> Column:
    """The arrival_time of ranked assets as text, for epochs from the year 1000 on. Timestamps end in the year 294247, days go on to 5,881,580, so that late arrivals have their text."""
    day = F.date_add(F.lit(epoch).cast("date"), (F.col("arrival_rank") * days).cast("int"))
    month, of_month = (F.lpad(f(day).cast("string"), 2, "0") for f in (F.month, F.dayofmonth))
    return F.concat(F.concat_ws("-", F.year(day), month, of_month), F.lit(" 00:00:00"))


def lineage_split(assets: DataFrame, seed: int = 42, chunk: int = 2_000) -> DataFrame:
    """(lineage_group_id, split): whole groups in hash order to train, validation or test, whichever is least full for its target.

    Targets are 60 and 20 % of the groups, rounded half to even, and the rest;
    fullness counts assets. A split that has its target takes no more; if all
    have, train takes the rest (stated here, as the rule has no answer then).
    The fold is sequential by its nature: one task streams the groups in hash
    order, ``chunk`` at a time, and carries three totals. Its sort spills.
    """
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("lineage_group_id").cast("string")), 256)
    groups = assets.where("lineage_group_id is not null").groupBy("lineage_group_id").agg(F.count("*").alias("n"))
    count = groups.count()
    names = ["train", "validation", "test"]
    targets = [round(count * 0.6), round(count * 0.2)]
    targets.append(count - sum(targets))
    kind = groups.select("lineage_group_id", F.lit("").alias("split")).schema

    def fold(batches):
        import pyarrow as pa

        used = [0, 0, 0]
        a, b, c = (t or 1 for t in targets)
        for batch in batches:
            for low in range(0, batch.num_rows, chunk):
                part, out = batch.slice(low, chunk), []
                for n in part.column("n").to_pylist():
                    best, k = 1.0, 0
                    for i, full in enumerate((used[0] / a, used[1] / b, used[2] / c)):
                        if full < best and targets[i]:
                            best, k = full, i
                    used[k] += n
                    out.append(names[k])
                yield pa.RecordBatch.from_arrays([part.column("lineage_group_id"), pa.array(out, pa.string())], ["lineage_group_id", "split"])

    return groups.withColumn("_h", h).repartition(1).sortWithinPartitions("_h").select("lineage_group_id", "n").mapInArrow(fold, kind)


def split_counts(assets: DataFrame, *by: str) -> DataFrame:
    """(split, attribute, value, assets): how many assets of each split have each value, for several attributes in one pass."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value")) for c in by))).alias("p")
    return assets.select("split", pairs).groupBy("split", "p.attribute", "p.value").agg(F.count("*").alias("assets"))


def split_audit(assets: DataFrame) -> DataFrame:
    """(split, assets, groups, overlapping): overlapping groups are in another split too."""
    spread = assets.groupBy("lineage_group_id").agg(F.count_distinct("split").alias("splits"))
    return assets.join(spread, "lineage_group_id").groupBy("split").agg(F.count("*").alias("assets"), F.count_distinct("lineage_group_id").alias("groups"), F.count_if(F.col("splits") > 1).alias("overlapping"))


def eligible(assets: DataFrame, flags: DataFrame) -> DataFrame:
    """Training assets with a valid label whose replay is complete and whose end of life was seen."""
    return assets.where("split = 'train' and valid_eol_label").join(flags.where("eol_observed and replay_complete").select("asset_id"), "asset_id", "left_semi")


def replay_sequence(events: DataFrame, *order: str) -> DataFrame:
    """events with replay_sequence, from 0, in global order."""
    return ranked(events, "replay_sequence", *order)


def limited(samples: DataFrame, per_asset: int, ids: list[int] | None = None, without: list[int] | None = None, total: int | None = None) -> DataFrame:
    """The first samples of each asset, of some assets or all but some, and of these the first ``total``."""
    if without is not None:
        samples = samples.where(~F.col("asset_id").isin(without))
    if ids is not None:
        samples = samples.where(F.col("asset_id").isin(ids))
    w = Window.partitionBy("asset_id").orderBy("cycle_index", "sample_index")
    first = samples.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= per_asset).drop("_r")
    return first if total is None else first.orderBy("asset_id", "cycle_index", "sample_index").limit(total)


def completion_events(samples: DataFrame) -> DataFrame:
    """One event a cycle: its sample count, and its latest sample."""
    last = F.max_by(F.struct("sample_index", "event_time"), F.struct("event_time", "sample_index"))
    return samples.groupBy("asset_id", "cycle_index").agg(F.count("*").alias("expected"), last.alias("last")).select("asset_id", "cycle_index", "expected", F.col("last.sample_index").alias("last_sample"), F.col("last.event_time").alias("event_time"))


def arrival_manifest(assets: DataFrame, cycles: DataFrame, epoch: str, version: str = "v1") -> DataFrame:
    """The manifest: a row an asset with its rank, start, first and last cycle, end-of-life label and whether that is within what the source shows.

    ``assets`` has asset_id, lineage_group_id and split; ``cycles`` has asset_id,
    cycle_index and eol_cycle. An asset with several labels is an error.
    """
    own = cycles.groupBy("asset_id").agg(F.max("cycle_index").alias("last_source_cycle"), F.min(F.struct("eol_cycle")).alias("_a"), F.max(F.struct("eol_cycle")).alias("_b"))
    clash = own.where(~F.col("_a").eqNullSafe(F.col("_b"))).select("asset_id").limit(1).collect()
    if clash:
        raise ValueError(f"asset {clash[0][0]} has several end-of-life labels")
    out = arrival_rank(assets, version).join(own.select("asset_id", "last_source_cycle", F.col("_a.eol_cycle").alias("eol_cycle")), "asset_id")
    delta = F.col("eol_cycle") - F.col("last_source_cycle")
    valid = F.coalesce(delta <= 0, F.lit(False))
    start = F.lit(epoch).cast("timestamp_ntz") + F.make_dt_interval(days=F.col("arrival_rank").cast("int"))
    status = F.when(valid, "valid_observed_endpoint").otherwise("unverified_endpoint_after_source_end")
    return out.select("asset_id", "lineage_group_id", "split", "arrival_rank", start.alias("start_time"), F.lit(1).alias("first_source_cycle"), "last_source_cycle", "eol_cycle", delta.alias("eol_cycle_delta"), status.alias("label_status"), valid.alias("valid_eol_label"))


def lifecycle_events(manifest: DataFrame) -> DataFrame:
    """The events that a manifest's replay gives: replay_complete of each asset, and eol_observed of those with a valid label."""
    def event(kind: str, cycle: str) -> Column:
        at = F.col("start_time") + F.make_dt_interval(days=(F.col(cycle) - F.col("first_source_cycle")).cast("int"))
        return F.struct(F.concat_ws(":", F.lit("lifecycle"), "asset_id", F.lit(kind)).alias("event_id"), F.lit(kind).alias("event_type"), F.col(cycle).cast("bigint").alias("cycle_index"), at.alias("event_time"))

    both = F.array(event("replay_complete", "last_source_cycle"), event("eol_observed", "eol_cycle"))
    return manifest.select("asset_id", "valid_eol_label", F.explode(both).alias("e")).where("e.event_type = 'replay_complete' or valid_eol_label").select("asset_id", "e.*")


def asof_keys(cycles: DataFrame, manifest: DataFrame, cutoff: Column) -> DataFrame:
    """The cycles (asset_id, cycle_index) that the schedule alone shows at a cutoff."""
    from .survival import shown_cycle

    dim = manifest.select("asset_id", "start_time", "first_source_cycle", "last_source_cycle").withColumn("_shown", shown_cycle(cutoff))
    return cycles.join(dim.select("asset_id", "_shown"), "asset_id").where(F.col("cycle_index") <= F.col("_shown")).select("asset_id", "cycle_index")


def with_cohort(events: DataFrame, arrived: DataFrame, observed: DataFrame) -> DataFrame:
    """(asset_id, eol_observed): lifecycle facts whose training cohort is replaced: arrived assets count as observed only if ``observed`` has them."""
    rest = events.select("asset_id", "eol_observed").join(arrived.select("asset_id"), "asset_id", "left_anti")
    return rest.unionByName(observed.select("asset_id", F.lit(True).alias("eol_observed")))


def next_snapshot(eligible_ranked: DataFrame, thresholds: tuple[int, ...], published: list[int]) -> DataFrame:
    """The members, by rank, of the first threshold that is reached and unpublished; none if there's no such one."""
    n = eligible_ranked.count()
    size = next((t for t in thresholds if t not in published and t <= n), 0)
    w = Window.orderBy("arrival_rank")
    first = eligible_ranked.orderBy("arrival_rank").limit(size)  # bounded by the threshold
    return first.withColumn("position", F.row_number().over(w))


def nth_arrival(ranked: DataFrame, n: int) -> DataFrame:
    """The n-th arrival (from 1) and its time."""
    return ranked.where(F.col("arrival_rank") == n - 1).select("asset_id", "arrival_time")
