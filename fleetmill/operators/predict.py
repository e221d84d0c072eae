"""Constraints on served predictions, and how predictions are judged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmill.functions.scalars import ratio


def irreversible(rows: DataFrame, raw: str = "raw_rul") -> DataFrame:
    """rows with rul and eol_cycle: once the remaining life is 0 it stays 0, and the end stays where it was."""
    so_far = Window.partitionBy("asset_id").orderBy("cycle_index").rowsBetween(Window.unboundedPreceding, 0)
    served = F.greatest(F.col(raw), F.lit(0.0))
    first = F.min(F.when(served == 0, F.col("cycle_index"))).over(so_far)
    return rows.withColumn("_first", first).withColumns({"rul": F.when(F.col("_first").isNotNull(), 0.0).otherwise(served), "eol_cycle": F.when(F.col("_first").isNotNull(), F.col("_first").cast("double")).otherwise(F.col("cycle_index") + served)}).drop("_first")


def eol_violations(rows: DataFrame) -> DataFrame:
    """Served rows that contradict an earlier end of life, or have a negative remaining life."""
    before = Window.partitionBy("asset_id").orderBy("cycle_index").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.min(F.when(F.col("rul") == 0, F.col("cycle_index"))).over(before)
    return rows.withColumn("_e", ended).where("rul < 0 or (_e is not null and rul <> 0)").drop("_e")


def monotone(curves: DataFrame) -> DataFrame:
    """Curves with ``served``: clamped to 0..1, never rising; from a non-finite value on 0."""
    w = Window.partitionBy("asset_id", "cycle_index").orderBy("horizon").rowsBetween(Window.unboundedPreceding, 0)
    p = F.col("probability")
    clamped = F.when(p.isNull() | F.isnan(p) | (F.abs(p) == float("inf")), 0.0).otherwise(F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))
    return curves.withColumn("served", F.min(clamped).over(w))


#: The longest horizon of a served curve.
LONGEST = 200


def curve_violations(curves: DataFrame, required: tuple[int, ...] = (50, 100, 200)) -> DataFrame:
    """(model_version, asset_id, cycle_index, rising, out_of_range, bad_start, missing) of curves with any fault; without a model_version where curves have none.

    Probabilities are from 0 to 1 and horizons from 0 to LONGEST.
    """
    keys = [c for c in ("model_version", "asset_id", "cycle_index") if c in curves.columns]
    w = Window.partitionBy(*keys).orderBy("horizon")
    p, h = F.col("probability"), F.col("horizon")
    marked = curves.withColumn("up", F.coalesce(p > F.lag("probability").over(w), F.lit(False)))
    out = marked.groupBy(*keys).agg(
        F.count_if("up").alias("rising"), F.count_if(p.isNull() | F.isnan(p) | (p < 0) | (p > 1) | (h < 0) | (h > LONGEST)).alias("out_of_range"), F.count_if((F.col("horizon") == 0) & (p != 1)).alias("bad_start"),
        (F.lit(len(required)) - F.count_if(F.col("horizon").isin(*required))).alias("missing"),
    )
    return out.where("rising > 0 or out_of_range > 0 or bad_start > 0 or missing <> 0")


def life_stage(cycle: Column, end: Column) -> Column:
    """early, mid or late in a true life: before 0.33 and 0.67 of it; unknown without an end, early at an end of 0."""
    share = F.coalesce(ratio(cycle.cast("double"), end), F.lit(0.0))
    return F.when(end.isNull(), "unknown").when(share < 0.33, "early").when(share < 0.67, "mid").otherwise("late")


def predicted_stage(cycle: Column, rul: Column) -> Column:
    """Early, Mid or Late: thirds of the life that the model predicts; Unavailable without a prediction, Early at an end of 0."""
    share = F.coalesce(ratio(cycle.cast("double"), cycle + rul), F.lit(0.0))
    return F.when(rul.isNull(), "Unavailable").when(share < F.lit(1 / 3), "Early").when(share < F.lit(2 / 3), "Mid").otherwise("Late")


def labels(cycles: DataFrame) -> DataFrame:
    """cycles with rul_cycles (down to 0, null without an end) and soh: capacity over nominal capacity and the width of the charge window, 1 where that is 0."""
    width = F.coalesce(F.nullif(F.col("soc_end") - F.col("soc_start"), F.lit(0.0)), F.lit(1.0))
    return cycles.withColumns({"rul_cycles": F.when(F.col("eol_cycle").isNotNull(), F.greatest(F.col("eol_cycle") - F.col("cycle_index"), F.lit(0))), "soh": ratio(ratio(F.col("capacity"), F.col("nominal_capacity")), width)})


def generalisation_gap(metrics: DataFrame) -> DataFrame:
    """One row: how much larger the error of test than that of validation and of train is."""
    of = lambda s: F.max(F.when(F.col("split") == s, F.col("mae")))
    return metrics.agg((of("test") - of("validation")).alias("test_validation"), (of("test") - of("train")).alias("test_train"))


def regression_metrics(rows: DataFrame, by: list[str], truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """rows, mae, rmse, r2 of each group; predictions below 0 count as 0. R2 is null without spread."""
    e = F.greatest(F.col(predicted), F.lit(0.0)) - F.col(truth)
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), (1 - F.try_divide(F.sum(e * e), F.var_pop(truth) * F.count("*"))).alias("r2"))


def winner(metrics: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group; an order with the row's id is total."""
    return metrics.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_r = 1").drop("_r")
