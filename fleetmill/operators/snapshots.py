"""Training generations: as-of snapshots, plans, receipts and the fixed benchmark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmill.functions.digests import folded, row_hash

from .contracts import matching

KEYS = ["asset_id", "cycle_index"]


def asset_checksum(assets: DataFrame, name: str) -> DataFrame:
    """One row: (name, its assets): a content id of a cohort's assets."""
    ids = assets.select(F.sha2(F.col("asset_id").cast("string"), 256).alias("h"))
    return folded(ids, "checksum").select(F.lit(name).alias("cohort"), "checksum", F.col("rows").alias("assets"))


def cohort_checksums(cohort: DataFrame) -> DataFrame:
    """(cohort, checksum, assets) for arrived, observed and censored assets; cohort has asset_id and observed."""
    parts = [asset_checksum(cohort, "arrived"), asset_checksum(cohort.where("observed"), "observed"), asset_checksum(cohort.where("not observed"), "censored")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def plan(generation: str, cohort: DataFrame, state: DataFrame, contract: str, settings: str) -> DataFrame:
    """One row, the plan of a generation: its inputs' ids, the cohort's size, and a fingerprint of all.

    ``state`` is one row with state_id; ``settings`` are the models' settings as
    canonical text. The same inputs give the same fingerprint.
    """
    sums = cohort_checksums(cohort).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("cohort", "checksum")))).alias("checksums"), F.max(F.when(F.col("cohort") == "arrived", F.col("assets"))).alias("arrived"))
    out = state.select("state_id").join(F.broadcast(sums), F.lit(True))
    text = F.concat_ws("|", F.lit(generation), "state_id", F.lit(contract), F.lit(settings), *(F.col("checksums")[c] for c in ("arrived", "censored", "observed")))
    return out.select(F.lit(generation).alias("generation"), "state_id", F.col("arrived").alias("training_assets"), "checksums", F.sha2(text, 256).alias("fingerprint"))


def selected(outlet: DataFrame, generation: int, bounds: DataFrame) -> DataFrame:
    """The outlet's rows of generations up to one, within a boundary."""
    rows = outlet.where(F.col("generation_id") <= generation)
    return rows.join(bounds.select("asset_id", "max_cycle"), "asset_id").where("cycle_index <= max_cycle").drop("max_cycle")


def receipt(rows: DataFrame, generation: int, state_id: str, contract: str) -> DataFrame:
    """One row for the selected rows of a generation: what they were selected by, their number and digest."""
    names = [*KEYS, *sorted(c for c in rows.columns if c not in KEYS)]
    own = folded(rows.select(row_hash(names).alias("h")))
    return own.select(F.lit(generation).alias("generation_id"), F.lit(state_id).alias("state_id"), F.lit(contract).alias("feature_contract"), F.col("rows").alias("selected_rows"), F.col("digest").alias("selected_digest"))


def verified(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows, if they are those that a receipt was given for; an error otherwise."""
    was = found.first()
    now = receipt(rows, was.generation_id, was.state_id, was.feature_contract).first()
    matching(was.asDict(), now.asDict(), "receipt")
    return rows


def benchmark_members(manifest: DataFrame) -> DataFrame:
    """The assets of validation and test with a valid label."""
    return manifest.where(F.col("split").isin("validation", "test") & F.col("valid_eol_label"))


def benchmark_rows(rows: DataFrame, members: DataFrame) -> DataFrame:
    """All rows of the benchmark's assets, with their split, whatever any cutoff."""
    return rows.join(members.select("asset_id", "split"), "asset_id")


def benchmark_record(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """(split, assets, lineage_groups, rows, digest) of the fixed benchmark."""
    members = benchmark_members(manifest)
    own = benchmark_rows(rows, members)
    size = members.groupBy("split").agg(F.count_distinct("asset_id").alias("assets"), F.count_distinct("lineage_group_id").alias("lineage_groups"))
    out = None
    for split in ("validation", "test"):
        part = own.where(F.col("split") == split).drop("split")
        names = [*KEYS, *sorted(c for c in part.columns if c not in KEYS)]
        one = folded(part.select(row_hash(names).alias("h"))).withColumn("split", F.lit(split))
        out = one if out is None else out.unionByName(one)
    return size.join(out, "split").select("split", "assets", "lineage_groups", "rows", "digest")


def published_counts(evaluations: DataFrame) -> DataFrame:
    """(training_assets): the numbers of training assets of the generations published so far, from their metadata."""
    n = F.get_json_object("training_metadata_json", "$.training_battery_count").try_cast("bigint")
    return evaluations.select(n.alias("training_assets")).where("training_assets is not null").distinct()


def one_value(rows: DataFrame, column: str) -> Column:
    """A column's only value, as a literal; an error if it has none or several."""
    found = rows.select(column).distinct().limit(2).collect()
    if len(found) != 1 or found[0][0] is None:
        raise ValueError(f"{column} must have exactly one value")
    return F.lit(found[0][0])
