"""Serving of what is current: selections, scores with a frozen end of life, coverage, statuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contracts import ContractError

ACTIVE = ("candidate", "champion")


def initialised(current: DataFrame, evaluations: DataFrame, others: DataFrame) -> DataFrame:
    """The current selections (dataset, model_version, fingerprint, revision) and, for a dataset without one, the newest active model at revision 1.

    Both model families (evaluations and others) must have an active model.
    """
    active = lambda df: df.where(F.col("status").isin(*ACTIVE) & F.col("fingerprint").isNotNull())
    if active(evaluations).isEmpty() or active(others).isEmpty():
        raise ContractError("both model families need an active model first")
    newest = active(evaluations).groupBy("dataset").agg(F.max_by(F.struct("model_version", "fingerprint"), F.struct("evaluated_at", "model_version")).alias("m"))
    fresh = newest.join(current, "dataset", "left_anti").select("dataset", "m.model_version", "m.fingerprint", F.lit(1).cast("bigint").alias("revision"))
    return current.select("dataset", "model_version", "fingerprint", F.col("revision").cast("bigint").alias("revision")).unionByName(fresh)


def selection(current: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Selections with their model's metadata and whether fingerprint and feature contract fit; those of unknown models go."""
    own = evaluations.select("model_version", F.col("fingerprint").alias("_f"), "feature_contract")
    return current.join(own, "model_version").withColumn("usable", F.col("fingerprint").eqNullSafe(F.col("_f"))).drop("_f")


def frozen_scores(rows: DataFrame, prior: DataFrame) -> DataFrame:
    """rows (asset_id, cycle_index, raw_rul) with rul and eol_cycle; an asset whose prior remaining life is 0 keeps 0 and its end.

    prior has asset_id, rul and eol_cycle: what is served so far.
    """
    before = prior.select("asset_id", F.col("rul").alias("_rul"), F.col("eol_cycle").alias("_eol"))
    joined = rows.join(before, "asset_id", "left")
    ended = F.coalesce(F.col("_rul") == 0, F.lit(False))
    served = F.when(ended, 0.0).otherwise(F.greatest("raw_rul", F.lit(0.0)))
    return joined.withColumn("rul", served).withColumn("eol_cycle", F.when(ended, F.col("_eol")).otherwise(F.col("cycle_index") + F.col("rul"))).drop("_rul", "_eol")


def guarded(new: DataFrame, states: DataFrame, selections: DataFrame) -> DataFrame:
    """New rows whose state is the dataset's current one and whose model, fingerprint and revision are selected."""
    return new.join(states.select("dataset", "state_id"), ["dataset", "state_id"], "left_semi").join(selections.select("dataset", "model_version", "fingerprint", "revision"), ["dataset", "model_version", "fingerprint", "revision"], "left_semi")


def replaced(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old, with every row of new in place of the row of its key."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new.select(*old.columns))


def replaced_version(old: DataFrame, new: DataFrame, column: str = "model_version") -> DataFrame:
    """old without the rows of new's versions, and new: a version is loaded whole."""
    found = new.select(column).distinct().limit(2).collect()
    if len(found) != 1:
        raise ContractError(f"exactly one {column} can be loaded at a time")
    # The version is a constant: a join by it would put all rows of a version into one task, against all of new's.
    return old.where(F.coalesce(F.col(column) != F.lit(found[0][0]), F.lit(True))).unionByName(new.select(*old.columns))


def status_rows(results: DataFrame) -> DataFrame:
    """(dataset, state_id, consumer, revision, status, rows_written, error): failed with an error, served with rows, else pending."""
    status = F.when(F.col("error").isNotNull(), "failed").when(F.col("rows_written").isNotNull(), "served").otherwise("pending")
    return results.select("dataset", "state_id", "consumer", F.coalesce("revision", F.lit(0)).alias("revision"), status.alias("status"), F.coalesce("rows_written", F.lit(0)).alias("rows_written"), F.substring("error", 1, 500).alias("error"))


def must_serve(status: Column, rows_written: Column, expected: Column, complete: Column) -> Column:
    """Whether a state is to be served (again): unless it's complete, and recorded as served with all its rows."""
    return ~F.coalesce(complete & (status == "served") & (rows_written == expected), F.lit(False))


def model_view(view: DataFrame, current: DataFrame, predictions: DataFrame, horizon: int = 100) -> DataFrame:
    """The latest view with the selected survival model's probability at a horizon, where it is of the same dataset, asset, cycle and model."""
    at = predictions.where(F.col("horizon") == horizon).join(current.select("dataset", "model_version", "fingerprint", "revision"), ["dataset", "model_version", "fingerprint", "revision"], "left_semi")
    return view.join(at.select("dataset", "asset_id", "cycle_index", F.col("probability").alias("survival")), ["dataset", "asset_id", "cycle_index"])


def current_curve(predictions: DataFrame, newest: DataFrame) -> DataFrame:
    """The curves of each asset's newest cycle only."""
    return predictions.join(newest.select("asset_id", "cycle_index"), ["asset_id", "cycle_index"], "left_semi")


def newest_final(features: DataFrame, final: DataFrame, without: DataFrame | None = None) -> DataFrame:
    """The newest final feature row of each asset, by cycle and sequence, but of some assets none."""
    from .features import latest

    rows = features.join(final.select("asset_id", "cycle_index"), ["asset_id", "cycle_index"], "left_semi")
    if without is not None:
        rows = rows.join(without.select("asset_id"), "asset_id", "left_anti")
    return latest(rows, "asset_id", "cycle_index", "sequence")
