"""Ingestion of nested asset records: flat tables, provenance and schedule, and a manifest that is written last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmill.functions.digests import folded, row_hash
from fleetmill.operators import cohort, normalize
from fleetmill.sources.store import exists

CHANNELS = ("source_time", "voltage", "current", "temperature", "charge_capacity", "capacity", "resistance")
TABLES = ("assets", "cycles", "samples", "provenance", "schedule")


def nested_records(spark: SparkSession, path: str, kind: str = "parquet", **options: str) -> DataFrame:
    """The records of a folder with source_file, the name of the file that each is in."""
    return spark.read.format(kind).options(**options).load(path).withColumn("source_file", F.col("_metadata.file_name"))


def file_labels(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, eol_cycle) of a JSON object of lives by file; a life that is no whole number is null."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("source_file", "life")).select("source_file", F.expr("try_cast(life AS BIGINT)").alias("eol_cycle"))


def labelled(records: DataFrame, labels: DataFrame) -> DataFrame:
    """records with the eol_cycle of their file, null without one; a file with several lives is an error."""
    clash = labels.groupBy("source_file").agg(F.count_distinct("eol_cycle").alias("n")).where("n > 1").limit(1).collect()
    if clash:
        raise ValueError(f"file {clash[0].source_file} has several labels")
    return records.join(labels.groupBy("source_file").agg(F.max("eol_cycle").alias("eol_cycle")), "source_file", "left")


def samples(records: DataFrame, dataset: str, epoch: str, channels: tuple[str, ...] = CHANNELS) -> DataFrame:
    """A row a sample: event_id (dataset:asset:cycle:sample, samples from 0), its channels, and the time at which it is replayed."""
    flat = normalize.ragged_zip(records, list(channels)).withColumn("sample_index", F.col("sample_index") - 1)
    event = F.concat_ws(":", F.lit(dataset), "asset_id", "cycle_index", "sample_index")
    replayed = normalize.replay_time(epoch, F.col("cycle_index"), F.coalesce("source_time", F.lit(0.0)))
    return flat.select(event.alias("event_id"), F.lit(dataset).alias("dataset"), "*", replayed.alias("replay_time"))


def cycles(records: DataFrame, dataset: str) -> DataFrame:
    """A row a cycle, straight from the nested arrays: extremes, health (capacity by nominal capacity and charge range, null if either is zero) and remaining life (0 at least, null without a label)."""
    own = records.select("asset_id", "eol_cycle", (F.col("nominal_capacity") * F.coalesce("charge_range", F.lit(1.0))).alias("_full")).dropDuplicates(["asset_id"])
    most = normalize.cycle_reductions(records, ["capacity", "charge_capacity", "resistance", "temperature", "source_time"])
    health = F.col("max_capacity") / F.nullif(F.col("_full"), F.lit(0.0))
    left = F.when(F.col("eol_cycle").isNotNull(), F.greatest(F.col("eol_cycle") - F.col("cycle_index"), F.lit(0)))
    return most.join(own, "asset_id").select(
        F.lit(dataset).alias("dataset"), "asset_id", "cycle_index", "eol_cycle", left.alias("rul"), "max_charge_capacity", "max_capacity", health.alias("health"),
        F.col("max_resistance").alias("resistance"), "min_temperature", "max_temperature", F.col("max_source_time").alias("charge_time"),
    )


def lineage(records: DataFrame, continuations: DataFrame, dataset: str) -> DataFrame:
    """Where each record comes from: (source_file, asset_id, fingerprint, batch_id, original_asset_id, lineage_group_id, lineage_reason, provenance_status).

    A known continuation belongs to its root (of several, the least). Else a
    record with the content of an earlier file (all but its names and label)
    belongs where that one does; any other is alone, as is one without cycles.
    ``continuations`` has asset_id and root. Files of one content are reduced to
    the first before they're joined, so none are gathered.
    """
    content = row_hash([c for c in records.columns if c not in ("source_file", "asset_id", "eol_cycle")])
    print_ = records.select("source_file", "asset_id", F.substring(content, 1, 16).alias("fingerprint"), F.coalesce(F.size("cycle_data") > 0, F.lit(False)).alias("held"))
    roots = continuations.groupBy("asset_id").agg(F.min("root").alias("root"))
    rows = print_.join(roots, "asset_id", "left").withColumn("original_asset_id", F.coalesce(F.col("root").cast("string"), F.col("asset_id").cast("string")))
    first = rows.groupBy("fingerprint").agg(F.min(F.struct("source_file", "asset_id", "original_asset_id")).alias("first"))
    known, later = F.col("root").isNotNull(), F.col("held") & ((F.col("source_file") != F.col("first.source_file")) | (F.col("asset_id") != F.col("first.asset_id")))
    reason = F.when(known, "official_continuation").when(later, "exact_source_duplicate").otherwise("documented_singleton")
    group = F.when(later & ~known, F.col("first.original_asset_id")).otherwise(F.col("original_asset_id"))
    batch = F.nullif(F.regexp_extract("source_file", r"(?:^|_)b(\d)[^_]*c", 1), F.lit(""))
    return rows.join(first, "fingerprint").select(
        "source_file", "asset_id", "fingerprint", F.concat(F.lit("batch_"), batch).alias("batch_id"), "original_asset_id", F.concat_ws(":", F.lit(dataset), group).alias("lineage_group_id"),
        reason.alias("lineage_reason"), F.when(reason == "documented_singleton", reason).otherwise("verified").alias("provenance_status"),
    )


def content(rows: DataFrame) -> tuple[str, int]:
    """A table's content id, whatever its order, and its number of rows."""
    found = folded(rows.select(row_hash(sorted(rows.columns)).alias("h"))).first()
    return found.digest, found.rows


def ingest(records: DataFrame, labels: DataFrame, continuations: DataFrame, folder: str, dataset: str, epoch: str) -> DataFrame:
    """Writes the tables of a batch of records and returns its manifest: (batch, table, path, rows, content).

    ``records`` has source_file, asset_id, nominal_capacity, charge_range and
    cycle_data (array of structs of cycle_number and the CHANNELS). The batch is
    named by the content of records, labels and continuations. Its tables are
    written first and its manifest last, so a batch without a manifest is none
    and is written again; one with a manifest is returned as it is. No records,
    or two files for an asset, are errors. Repeated samples of a cycle stay.
    """
    spark = records.sparkSession
    rows = labelled(records, labels)
    named = rows.select("source_file", "asset_id", "eol_cycle", row_hash(sorted(records.columns)).alias("content"))
    batch, count = content(named.join(continuations.groupBy("asset_id").agg(F.min("root").alias("root")), "asset_id", "left"))
    if not count:
        raise ValueError("no records to ingest")
    twice = rows.groupBy("asset_id").count().where("count > 1 or asset_id is null").limit(1).collect()
    if twice:
        raise ValueError(f"asset {twice[0].asset_id} has {twice[0]['count']} records, or none has an id")
    home = f"{folder}/batch={batch[:16]}"
    if not exists(spark, f"{home}/manifest/_SUCCESS"):
        _tables(rows, continuations, home, dataset, epoch)
        found = [(name, *content(spark.read.parquet(f"{home}/{name}"))) for name in TABLES]
        listed = F.inline(F.array(*(F.struct(F.lit(batch[:16]).alias("batch"), F.lit(n).alias("table"), F.lit(f"{home}/{n}").alias("path"), F.lit(r).cast("bigint").alias("rows"), F.lit(c).alias("content")) for n, c, r in found)))
        spark.range(1).select(listed).coalesce(1).write.mode("overwrite").parquet(f"{home}/manifest")
    return spark.read.parquet(f"{home}/manifest")


def _tables(rows: DataFrame, continuations: DataFrame, home: str, dataset: str, epoch: str) -> None:
    def write(name: str, table: DataFrame) -> DataFrame:
        table.write.mode("overwrite").parquet(f"{home}/{name}")
        return table.sparkSession.read.parquet(f"{home}/{name}")

    from_ = write("provenance", lineage(rows, continuations, dataset))
    write("assets", rows.drop("cycle_data").withColumn("dataset", F.lit(dataset)))
    done = write("cycles", cycles(rows, dataset))
    write("samples", samples(rows, dataset, epoch))
    split = cohort.lineage_split(from_)
    write("schedule", cohort.arrival_manifest(from_.select("asset_id", "lineage_group_id").join(split, "lineage_group_id"), done.select("asset_id", "cycle_index", "eol_cycle"), epoch))


def faults(manifest: DataFrame) -> DataFrame:
    """(table, fault) of a manifest's tables that aren't what it says: missing, other content, or other rows. One row a table is read at the driver: TABLES."""
    spark, out = manifest.sparkSession, []
    for r in manifest.collect():
        if not exists(spark, r.path):
            out.append((r.table, "missing"))
        elif (found := content(spark.read.parquet(r.path))) != (r.content, r.rows):
            out.append((r.table, "content" if found[1] == r.rows else "rows"))
    return spark.createDataFrame(out, "table string, fault string")
