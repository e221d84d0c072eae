"""Published tables and JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. A session on one machine gets one of its own where it's unset."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: it names the folder that driver and executors share")
        import tempfile

        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-"))
        folder = sc.getCheckpointDir()
    return folder


class Published:
    """A table with versions: ``v=<name>`` folders that never change, and pointer rows to the newest."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def publish(self, rows: DataFrame, version: str, content: str) -> bool:
        """Writes a version and points to it. The same content again is a no-op (False); another one is an error."""
        seen = self.pointers()
        if seen is not None and (was := seen.where(F.col("version") == version).first()):
            if was.content != content:
                raise ValueError(f"version {version} is published with other content")
            return False
        rows.write.mode("overwrite").parquet(f"{self.folder}/v={version}")  # without a pointer, what a crash left is no version
        number = 0 if seen is None else seen.count()
        self.spark.range(1).select(F.lit(number).alias("number"), F.lit(version).alias("version"), F.lit(content).alias("content")).write.mode("append").parquet(f"{self.folder}/pointers")
        return True

    def pointers(self) -> DataFrame | None:
        path = f"{self.folder}/pointers"
        return self.spark.read.parquet(path) if exists(self.spark, path) else None

    def latest(self) -> DataFrame | None:
        seen = self.pointers()
        return None if seen is None else self.spark.read.parquet(f"{self.folder}/v={seen.agg(F.max_by('version', 'number')).first()[0]}")


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A table or a pushed-down sub-query; give partitionColumn, lowerBound, upperBound and numPartitions for large ones."""
    return spark.read.format("jdbc").options(url=url, dbtable=query if " " not in query else f"({query}) q", **options).load()


def load_jdbc(rows: DataFrame, url: str, name: str, keys: list[str], mode: str = "append", **options: str) -> DataFrame:
    """Writes rows to a JDBC table and returns the keys that then are on one side only, with ``side``.

    In mode overwrite there should be none. In mode append, "extra" keys are
    those that the table had before.
    """
    rows.write.format("jdbc").options(url=url, dbtable=name, **options).mode(mode).save()
    there = read_jdbc(rows.sparkSession, url, name, **options)
    ours = rows.select(*keys)
    theirs = there.select(*(F.col(c).cast(rows.schema[c].dataType).alias(c) for c in keys))
    return ours.exceptAll(theirs).withColumn("side", F.lit("missing")).unionByName(theirs.exceptAll(ours).withColumn("side", F.lit("extra")))


def merge_jdbc(rows: DataFrame, url: str, name: str, keys: list[str], merge, **options: str) -> DataFrame:
    """Replaces a JDBC table by merge(its rows, rows), through a staging table next to it, so a failed write leaves the table as it was."""
    old = read_jdbc(rows.sparkSession, url, name, **options)
    stage = f"{name}_stage"
    merge(old, rows).write.format("jdbc").options(url=url, dbtable=stage, **options).mode("overwrite").save()
    return load_jdbc(read_jdbc(rows.sparkSession, url, stage, **options), url, name, keys, "overwrite", **options)


def read_json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines with a declared schema, for features of older states."""
    return spark.read.schema(schema).json(path)
