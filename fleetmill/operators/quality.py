"""Quality reports and checks; violations are rows, not exceptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def report(samples: DataFrame, cycles: DataFrame) -> DataFrame:
    """(metric, value): counts, ranges, missing and invalid values, in one pass for each table."""
    s = samples.agg(
        F.count("*").cast("double").alias("sample_rows"), F.count_distinct("asset_id").cast("double").alias("sampled_assets"), F.min("voltage").alias("min_voltage"), F.max("voltage").alias("max_voltage"),
        F.count_if(F.col("capacity").isNull()).cast("double").alias("missing_capacity"), F.count_if(F.col("current") < 0).cast("double").alias("negative_current"),
        F.min("current").alias("min_current"), F.max("current").alias("max_current"), F.min("temperature").alias("min_temperature"), F.max("temperature").alias("max_temperature"),
        F.count_if(F.col("temperature").isNull()).cast("double").alias("missing_temperature"), F.count_if(F.col("resistance").isNull()).cast("double").alias("missing_resistance"),
    )
    c = cycles.agg(F.count("*").cast("double").alias("cycle_rows"), F.count_distinct("asset_id").cast("double").alias("assets"), F.max("cycle_index").cast("double").alias("max_cycle"))
    k = cycles.groupBy("asset_id", "cycle_index").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("double").alias("repeated_cycles"))
    s, c = s.join(F.broadcast(k), F.lit(True)), c
    return s.unpivot([], s.columns, "metric", "value").unionByName(c.unpivot([], c.columns, "metric", "value"))


def histogram_of_counts(rows: DataFrame, key: str, name: str = "cycles") -> DataFrame:
    """(cycles, assets): how many keys have so many rows."""
    return rows.groupBy(key).agg(F.count("*").alias(name)).groupBy(name).agg(F.count("*").alias("assets"))


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with several rows, or with a null, and their number of rows."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return rows.groupBy(*keys).agg(F.count("*").alias("rows")).where((F.col("rows") > 1) | missing)


def order_violations(rows: DataFrame, group: str, position: str, key: list[str]) -> DataFrame:
    """Rows whose key isn't above that of the row before them in ingestion order."""
    w = Window.partitionBy(group).orderBy(position)
    return rows.withColumn("_k", F.struct(*key)).withColumn("_b", F.lag("_k").over(w)).where("_b is not null and _k <= _b").drop("_k", "_b")


def file_neighbours(rows: DataFrame, key: list[str], within: list[str], block: int = 65_536) -> DataFrame:
    """rows with ``before``: the key (a struct) of the row before, in the order of file and place there, among rows that are equal in ``within``.

    ``rows`` has _file and _row, as in_file() gives them. Rows are compared in
    blocks of places; only the last key of each block goes on to the next, so
    no task orders a whole file or group. The first row's ``before`` is null.
    """
    rows = rows.withColumns({"_k": F.struct(*key), "_b": F.floor(F.col("_row") / block)})
    part = list(dict.fromkeys([*within, "_file", "_b"]))
    same = [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in part]
    rows = rows.withColumn("before", F.lag("_k").over(Window.partitionBy(*part).orderBy("_row")))
    ends = rows.groupBy(*part).agg(F.max_by("_k", "_row").alias("_last"), F.min("_row").alias("_first"))
    ends = ends.withColumn("_last", F.lag("_last").over(Window.partitionBy(*within).orderBy("_file", "_b")))
    ends = ends.select(*(F.col(c).alias(f"_o_{c}") for c in part), "_last", "_first")
    on = same[0]
    for c in same[1:]:
        on = on & c
    joined = rows.join(ends, on)
    before = F.when(F.col("_row") == F.col("_first"), F.col("_last")).otherwise(F.col("before"))
    return joined.withColumn("before", before).drop("_b", "_last", "_first", *(f"_o_{c}" for c in part))


def in_file(rows: DataFrame) -> DataFrame:
    """Rows of a Parquet table, as read, with _file and _row: their file and their place in it."""
    return rows.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})


def file_order_violations(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows of a Parquet table whose key isn't above that of the row before them in their file, with _file and _row."""
    return file_neighbours(in_file(rows), key, ["_file"]).where("_k <= before").drop("_k", "before")


def unsorted_groups(rows: DataFrame, group: str, value: str) -> DataFrame:
    """(group, errors): the groups whose values fall somewhere in the order of files and places, and how often; equal neighbours are in order."""
    return file_neighbours(in_file(rows), [value], [group]).where("_k < before").groupBy(group).agg(F.count("*").alias("errors"))


def total_differences(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """(key, source_rows, target_rows) where the two differ."""
    a = source.groupBy(key).agg(F.count("*").alias("source_rows"))
    b = target.groupBy(key).agg(F.count("*").alias("target_rows"))
    both = a.join(b, key, "full").select(key, F.coalesce("source_rows", F.lit(0)).alias("source_rows"), F.coalesce("target_rows", F.lit(0)).alias("target_rows"))
    return both.where("source_rows <> target_rows")


def coverage(expected: DataFrame, served: DataFrame, horizons: tuple[int, ...]) -> DataFrame:
    """Assets whose served cycle or horizons aren't the expected: (asset_id, expected_cycle, served_cycle, horizons)."""
    got = served.groupBy("asset_id").agg(F.max("cycle_index").alias("served_cycle"), F.array_sort(F.collect_set("horizon")).alias("h"))
    both = expected.select("asset_id", F.col("cycle_index").alias("expected_cycle")).join(got, "asset_id", "full")
    whole = F.col("h").eqNullSafe(F.array(*map(F.lit, sorted(horizons))))
    return both.where(~(F.col("expected_cycle").eqNullSafe(F.col("served_cycle")) & whole)).select("asset_id", "expected_cycle", "served_cycle", F.coalesce(F.array_join("h", ","), F.lit("")).alias("horizons"))


def violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, rows): how many rows break each rule; a null outcome breaks none, as in a table constraint."""
    out = rows.agg(*(F.count_if(~r).alias(n) for n, r in rules.items()))
    return out.unpivot([], list(rules), "rule", "rows")


def missing_references(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-null key has no parent."""
    return rows.where(F.col(key).isNotNull()).join(parents.select(F.col(parent_key).alias(key)), key, "left_anti")


def gate(found: DataFrame, expected: dict[str, float]) -> DataFrame:
    """(metric, value, expected) of a report's metrics that aren't as expected; an absent one has a null value."""
    pairs = [F.struct(F.lit(k).alias("metric"), F.lit(float(v)).alias("expected")) for k, v in sorted(expected.items())]
    wanted = found.sparkSession.range(1).select(F.inline(F.array(*pairs)))
    return wanted.join(found.select("metric", "value"), "metric", "left").where(~F.col("value").eqNullSafe(F.col("expected"))).select("metric", "value", "expected")


def single_value(rows: DataFrame, column: str) -> DataFrame:
    """One row: a column's only value, or null and ``distinct`` other than 1."""
    return rows.agg(F.min(column).alias("least"), F.count_distinct(column).alias("distinct")).select(F.when(F.col("distinct") == 1, F.col("least")).alias("value"), "distinct")
