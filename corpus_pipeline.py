"""A corpus pipeline over ``documents``: reject toxic texts, join near copies, decontaminate, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written and read again as the next one's docs; run() does so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmill.llm import decontamination, jaccard_join, packing, toxicity
from fleetmill.llm.common import small, table, written

#: Documents of at least this score are rejected.
TOXIC = 0.3


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score is below TOXIC, repeated ones alike, with all their columns. A null or empty text is kept if the leak is below. The model is learned from the labelled rows of the whole table."""
    scored = toxicity.scored(spark, docs, sf_dir, names=("__score", "__offending"))
    return scored.where(F.col("__score") < TOXIC).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the row with the smallest doc_id, null being the largest; of equal ids, any one row.

    Rows are told apart by a number of their own, so ids may be null or repeated.
    Null, empty and wordless texts are near copies of nothing and stay.
    """
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__row")
    found = written(jaccard_join.jaccard_components(rows.select(key.alias("doc_id"), "text")), "groups")
    dropped = found.select(F.col("doc_id.__row").alias("__row"), F.col("component_id.__row").alias("kept")).where("__row <> kept").select("__row")
    return rows.join(small(dropped), "__row", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any benchmark window, with all their columns; a row with one is removed, repeated ones alike. Null and empty texts stay."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), names=("__words", "__spans", "__items", "__hit"))
    return found.where("__hit = 0").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document left, as pieces in sequences; null and empty texts are an end id. No rows give no pieces."""
    return packing.packed(docs.select("doc_id", "text"))


STAGES = [("toxicity", reject_toxic), ("jaccard join", one_of_each_group), ("decontamination", decontaminate), ("packing", pack)]

#: A model and tokenizer ids aren't SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return written(STAGES[-1][1](spark, docs, sf_dir), "stage-packing")
