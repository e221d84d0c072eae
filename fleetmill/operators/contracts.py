"""What tables must hold before they are used; a broken rule is an error, its rows can be looked at first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A table breaks a rule that its readers rely on."""


def split_required(rows: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(complete rows, rows with a null in a required field and the list of those fields)."""
    missing = F.filter(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in fields)), lambda x: x.isNotNull())
    marked = rows.withColumn("missing", missing)
    return marked.where(F.size("missing") == 0).drop("missing"), marked.where(F.size("missing") > 0)


def bad_keys(rows: DataFrame, texts: list[str], cycle: str = "cycle_index") -> DataFrame:
    """Rows whose key isn't one: a text that is null or empty, a cycle that is null, no whole number or below 1."""
    bad = F.coalesce(F.col(cycle) < 1, F.lit(True)) | (F.col(cycle) != F.floor(cycle))
    for c in texts:
        bad = bad | F.coalesce(F.length(F.col(c).cast("string")) == 0, F.lit(True))
    return rows.where(bad)


def not_prefix(final: DataFrame, canonical: DataFrame) -> DataFrame:
    """(asset_id, final, canonical): assets whose final cycles aren't all canonical ones up to their last, each once."""
    own = final.groupBy("asset_id").agg(F.max("cycle_index").alias("_max"), F.count("*").alias("final"), F.count_distinct("cycle_index").alias("_once"))
    known = canonical.select("asset_id", "cycle_index").distinct()
    there = known.join(own.select("asset_id", "_max"), "asset_id").where("cycle_index <= _max").groupBy("asset_id").agg(F.count("*").alias("canonical"))
    hit = final.select("asset_id", "cycle_index").distinct().join(known, ["asset_id", "cycle_index"], "left_semi").groupBy("asset_id").agg(F.count("*").alias("_hit"))
    both = own.join(there, "asset_id", "left").join(hit, "asset_id", "left").na.fill(0, ["canonical", "_hit"])
    return both.where("final <> canonical or final <> _hit or final <> _once").select("asset_id", "final", "canonical")


def boundary_faults(bounds: DataFrame) -> DataFrame:
    """(fault, rows) of a boundary (asset_id, max_cycle, cycles, replay_sequence)."""
    rules = {
        "asset missing": F.col("asset_id").isNull(), "cycle below 1": F.coalesce(F.col("max_cycle") < 1, F.lit(True)), "count below 1": F.coalesce(F.col("cycles") < 1, F.lit(True)),
        "more cycles than the last": F.col("cycles") > F.col("max_cycle"), "sequence below 0": F.coalesce(F.col("replay_sequence") < 0, F.lit(True)),
    }
    counts = bounds.agg(*(F.count_if(r).alias(n) for n, r in rules.items()))
    twice = bounds.groupBy("asset_id").count().where("count > 1").agg(F.count("*").alias("rows")).select(F.lit("asset twice").alias("fault"), "rows")
    return counts.unpivot([], list(rules), "fault", "rows").unionByName(twice).where("rows > 0")


def cohort_faults(arrived: DataFrame, observed: DataFrame, censored: DataFrame) -> DataFrame:
    """(asset_id, fault): observed and censored assets must be the arrived ones, each once and in one of the two."""
    own = [("arrived", arrived), ("observed", observed), ("censored", censored)]
    each = [df.groupBy("asset_id").agg(F.count("*").alias(n)) for n, df in own]
    both = each[0].join(each[1], "asset_id", "full").join(each[2], "asset_id", "full").na.fill(0)
    fault = F.when(F.greatest("arrived", "observed", "censored") > 1, "repeated").when((F.col("observed") > 0) & (F.col("censored") > 0), "observed and censored").when((F.col("arrived") > 0) & (F.col("observed") + F.col("censored") == 0), "neither").when(F.col("arrived") == 0, "not arrived")
    return both.withColumn("fault", fault).where("fault is not null").select("asset_id", "fault")


def required_empty(faults: DataFrame, what: str) -> None:
    """An error that shows the first fault, if there's any."""
    first = faults.limit(1).collect()
    if first:
        raise ContractError(f"{what}: {first[0].asDict()}")


def matching(expected: dict, found: dict, what: str) -> None:
    """An error where a field of ``found`` isn't as expected; an expected None asks for nothing."""
    for field, value in expected.items():
        if value is not None and found.get(field) != value:
            raise ContractError(f"{what}: {field.replace('_', ' ')} mismatch")


def publish_predictions(predictions: DataFrame, evaluations: DataFrame) -> DataFrame:
    """The constrained trajectories of one model's predictions, if there are some and exactly one evaluation."""
    from .predict import irreversible

    required_one(evaluations, "evaluation")
    if predictions.isEmpty():
        raise ContractError("no predictions to publish")
    return irreversible(predictions)


def publish_curves(curves: DataFrame, evaluations: DataFrame) -> DataFrame:
    """The survival curves, if each is whole and falling from 1, with exactly one evaluation."""
    from .predict import curve_violations

    required_one(evaluations, "evaluation")
    if curves.isEmpty():
        raise ContractError("no curves to publish")
    required_empty(curve_violations(curves), "survival curve")
    return curves


def required_one(rows: DataFrame, what: str) -> None:
    if rows.limit(2).count() != 1:
        raise ContractError(f"exactly one {what} is needed")


def load_faults(rows: DataFrame, keys: list[str], target: DataFrame) -> DataFrame:
    """(fault, rows) of a load: null or repeated keys of the rows, and keys that only one side has."""
    from .quality import duplicates

    a, b = rows.select(*keys), target.select(*keys)
    parts = {"null or repeated key": duplicates(rows, keys), "missing in target": a.exceptAll(b), "extra in target": b.exceptAll(a)}
    out = None
    for name, df in parts.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("fault"), "rows")
        out = one if out is None else out.unionByName(one)
    return out.where("rows > 0")
