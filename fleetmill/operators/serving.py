"""Fleet views: latest state, KPIs, histograms, rankings, metrics from documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmill.functions.scalars import pick


def latest_view(health: DataFrame, current: DataFrame, predictions: DataFrame) -> DataFrame:
    """Each asset's newest cycle, the model selected for its dataset, and that model's prediction for the cycle, if any."""
    w = Window.partitionBy("dataset", "asset_id").orderBy(F.desc("cycle_index"))
    newest = health.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    return newest.join(current.select("dataset", "model_version"), "dataset", "left").join(predictions, ["dataset", "asset_id", "cycle_index", "model_version"], "left")


def serving_predictions(rows: DataFrame) -> DataFrame:
    """Predictions as they are served; without raw values the served ones, without an end the cycle plus the remaining life."""
    has = rows.columns
    raw = F.col("raw_rul") if "raw_rul" in has else F.col("rul")
    end = F.col("eol_cycle") if "eol_cycle" in has else F.col("cycle_index") + F.col("rul")
    return rows.select("model_version", "asset_id", "cycle_index", raw.alias("raw_rul"), "rul", end.cast("double").alias("eol_cycle"))


def serving_evaluations(rows: DataFrame) -> DataFrame:
    """Evaluations as they are served; absent metadata is an empty document, absent fingerprint and generation are null."""
    has = rows.columns
    text = lambda c: F.col(c).cast("string") if c in has else F.lit(None).cast("string")
    metadata = F.col("training_metadata_json") if "training_metadata_json" in has else F.lit("{}")
    return rows.select("model_version", "status", F.try_to_timestamp("evaluated_at").alias("evaluated_at"), F.col("metrics_json").alias("metrics"), metadata.alias("training_metadata"), text("fingerprint").alias("fingerprint"), text("generation").alias("generation"))


def serving_cycles(rows: DataFrame) -> DataFrame:
    """Cycle health as it is served; columns that a table lacks are null."""
    return rows.select("asset_id", "cycle_index", *(pick(rows, c, "double").alias(c) for c in ("soh", "rul_cycles", "max_capacity", "resistance", "max_temperature", "charge_time", "capacity_slope", "efficiency")))


def soh_percent(soh):
    """The health in percent, two digits."""
    return F.round(soh * 100, 2)


#: The names of known families.
FAMILIES = {"cox": "Cox", "random_survival_forest": "Random Survival Forest", "ridge": "Ridge", "random_forest": "Random Forest", "xgboost": "XGBoost", "mlp": "MLP"}


def family_label(family: Column) -> Column:
    """A family's name to show: that of a known family, else its own with spaces for _ and a capital at the start of each run of letters. Null stays."""
    known = F.create_map(*(F.lit(x) for pair in FAMILIES.items() for x in pair))
    runs = F.regexp_extract_all(F.lower(F.replace(family, F.lit("_"), F.lit(" "))), F.lit(r"(\p{L}+|[^\p{L}]+)"))
    return F.coalesce(F.try_element_at(known, family), F.array_join(F.transform(runs, F.initcap), ""))


def survival_metrics(models: DataFrame) -> DataFrame:
    """(model_version, ibs, c_index, brier_100) of the test part of survival models' metric documents."""
    kind = "test struct<integrated_brier_score double, ipcw_c_index double, horizon_brier map<string, double>>"
    m = F.from_json("metrics_json", kind)["test"]
    return models.select("model_version", m["integrated_brier_score"].alias("ibs"), m["ipcw_c_index"].alias("c_index"), m["horizon_brier"]["100"].alias("brier_100"))


def survival_winner(metrics: DataFrame) -> DataFrame:
    """The model with the least integrated Brier score (null last), then the highest C-index, then the first by rank."""
    return metrics.orderBy(F.asc_nulls_last("ibs"), F.desc_nulls_last("c_index"), "rank", "model_version").limit(1)


def null_safe_status(states: DataFrame, statuses: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """States with the status of the same asset and revision; null revisions are equal, and both missing is pending.

    With ``current`` (asset_id, revision), the revision is the one selected now, or 0 without any.
    """
    if current is not None:
        states = states.join(current.select("asset_id", "revision"), "asset_id", "left").withColumn("revision", F.coalesce("revision", F.lit(0)))
    s = statuses.select(F.col("asset_id").alias("_a"), F.col("revision").alias("_r"), "status")
    return states.join(s, states["asset_id"].eqNullSafe(F.col("_a")) & states["revision"].eqNullSafe(F.col("_r")), "left").select(*states.columns, F.coalesce("status", F.lit("pending")).alias("status"))


def fleet_kpis(fleet: DataFrame) -> DataFrame:
    """One row: assets, mean and median health, median and lower quartile of the remaining life."""
    return fleet.agg(F.count("*").alias("assets"), F.avg("health").alias("mean_health"), F.median("health").alias("median_health"), F.median("rul").alias("median_rul"), F.percentile("rul", F.lit(0.25)).alias("p25_rul"), F.count("rul").alias("with_rul"), *([F.median("survival").alias("median_survival"), F.percentile("survival", F.lit(0.25)).alias("p25_survival")] if "survival" in fleet.columns else []))


def histogram(fleet: DataFrame, column: str, width: int) -> DataFrame:
    """(low, label, assets): left-closed bins of a width; empty ones are left out."""
    low = (F.floor(F.col(column) / width) * width).cast("bigint")
    return fleet.where(F.col(column).isNotNull()).groupBy(low.alias("low")).agg(F.count("*").alias("assets")).select("low", F.format_string("%d–%d%%", F.col("low"), F.col("low") + width).alias("label"), "assets")


def risk_filter(fleet: DataFrame, text: str | None = None, **most: float) -> DataFrame:
    """Rows whose id holds a text, whatever its case, and whose columns are at most so much.

    A threshold counts only if it is below the column's largest value among the
    rows left so far; then rows without a value go.
    """
    if text:
        fleet = fleet.where(F.lower("name").contains(text.lower()))
    for column, limit in most.items():
        top = fleet.agg(F.max(column).alias("_top"))
        fleet = fleet.join(F.broadcast(top), F.lit(True)).where((F.coalesce(F.col("_top"), F.lit(limit)) <= limit) | (F.col(column) <= limit)).drop("_top")
    return fleet


def lowest(rows: DataFrame, column: str, tie: str, k: int = 5) -> DataFrame:
    """The k rows with the smallest values that aren't null."""
    return rows.where(F.col(column).isNotNull()).orderBy(column, tie).limit(k)


def flat_metrics(models: DataFrame) -> DataFrame:
    """Metrics out of their JSON documents; what a document lacks is null."""
    kind = "mae double, rmse double, families map<string, struct<mae double, rmse double>>"
    m = F.from_json("metrics_json", kind)
    return models.select("model_version", m["mae"].alias("mae"), m["rmse"].alias("rmse"), m["families"].alias("families"))


def family_rows(flat: DataFrame) -> DataFrame:
    """(model_version, family, family_mae, family_rmse): a row for each family of a model."""
    return flat.select("model_version", F.explode("families").alias("family", "v")).select("model_version", "family", F.col("v.mae").alias("family_mae"), F.col("v.rmse").alias("family_rmse"))


def long_metrics(flat: DataFrame, columns: list[str]) -> DataFrame:
    """(model_version, metric, value)."""
    return flat.unpivot(["model_version"], columns, "metric", "value")


def colour_scores(rows: DataFrame, column: str, lower_is_better: bool = True) -> DataFrame:
    """rows with a score from 0 to 1 within the column's range; a constant column scores 1."""
    ends = rows.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    share = F.coalesce(F.try_divide(F.col(column) - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0 if lower_is_better else 1.0))
    score = 1 - share if lower_is_better else share
    return rows.join(F.broadcast(ends), F.lit(True)).withColumn("score", F.when(F.col(column).isNotNull(), score)).drop("_lo", "_hi")


def distinct_labels(models: DataFrame) -> DataFrame:
    """Labels that several models share get the start of their fingerprint."""
    n = F.count("*").over(Window.partitionBy("label"))
    return models.withColumn("display", F.when(n > 1, F.concat("label", F.lit(" · "), F.substring("fingerprint", 1, 8))).otherwise(F.col("label")))


def selectable_models(models: DataFrame, current: str | None = None) -> DataFrame:
    """One model a generation that isn't retired: the current one if it's there, else the best record class, then a neutral family, champions, the newest.

    models has model_version, generation, record_class, family, status,
    evaluated_at; those without a generation are left out.
    """
    models = models.where(~F.col("status").eqNullSafe(F.lit("retired")) & F.col("generation").isNotNull())
    mine = F.coalesce(F.col("model_version") == F.lit(current).cast("string"), F.lit(False))
    w = Window.partitionBy("generation").orderBy(F.desc(mine), F.desc("record_class"), F.desc(F.col("family") == "neutral"), F.desc(F.col("status") == "champion"), F.desc("evaluated_at"), F.desc("model_version"))
    return models.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def best_model(models: DataFrame) -> DataFrame:
    """The model with the least test error; one without an error comes last."""
    return models.orderBy(F.asc_nulls_last("mae"), "model_version").limit(1)


def newest_evaluation(models: DataFrame) -> DataFrame:
    """The newest candidate or champion with a fingerprint."""
    return models.where(F.col("status").isin("candidate", "champion") & F.col("fingerprint").isNotNull()).orderBy(F.desc("evaluated_at"), F.desc("model_version")).limit(1)
