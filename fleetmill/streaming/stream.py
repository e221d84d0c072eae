"""Structured Streaming of telemetry: exact deduplication, idempotent batches, finality, quarantine.

State is a set of Parquet tables, a directory a batch: a batch that runs again
writes its own directories again, so replays change nothing. Samples of cycles
that aren't final stay in an open-cycle buffer, deduplicated by event_id across
batches; a cycle's aggregates are made from it, and its rows leave it once the
cycle is final or overfull, for good. Later samples of it go to quarantine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetmill.operators.aggregate import partials, rendered
from fleetmill.operators.normalize import decode_events
from fleetmill.sources.store import exists


KEYS = ["asset_id", "cycle_index"]


class CycleStore:
    """The stream's tables under one folder. ``version`` directories are never changed by another batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str, batch: int) -> str:
        return f"{self.folder}/{name}/v={batch}"

    def before(self, name: str, batch: int) -> DataFrame | None:
        """The table as the batch before left it."""
        path = self.path(name, batch - 1)
        return self.spark.read.parquet(path) if batch > 0 and exists(self.spark, f"{path}/_SUCCESS") else None

    def upto(self, name: str, batch: int, keep_version: bool = False) -> DataFrame | None:
        """What all batches up to one have added to a table; with the batch of each row as ``v`` if asked for."""
        path = f"{self.folder}/{name}"
        if not exists(self.spark, path):
            return None
        rows = self.spark.read.parquet(path).where(F.col("v") <= batch)
        return rows if keep_version else rows.drop("v")

    def write(self, name: str, batch: int, rows: DataFrame) -> DataFrame:
        rows.write.mode("overwrite").parquet(self.path(name, batch))
        return self.spark.read.parquet(self.path(name, batch))

    def finals(self) -> DataFrame:
        """The aggregates of all final cycles."""
        return self.upto("final", 1 << 40)

    def closed(self, batch: int) -> DataFrame | None:
        """(asset_id, cycle_index, v): the cycles that batches up to one have made final, or found overfull, and when."""
        each = [t.select(*KEYS, "v") for t in (self.upto(name, batch, True) for name in ("final", "overfull")) if t is not None]
        return each[0].unionByName(each[1]) if len(each) == 2 else each[0] if each else None

    def process(self, events: DataFrame, batch: int, expected: DataFrame, strict: bool = False) -> None:
        """One micro-batch: events are valid telemetry, expected has the sample count of completed cycles.

        A batch writes its own samples and closed cycles only. Of what is stored
        it reads open samples, the keys of closed cycles, and the event ids of
        those closed cycles that samples still come for. A cycle closes once: as
        final with as many samples as expected, or as overfull with more, and
        then it never becomes final and all its samples are in quarantine (the
        table ``late``). So are new samples of a closed cycle; samples that it
        had already are dropped, however often they come again. If ``strict``,
        an overfull cycle or a new sample of a closed one is an error.
        """
        closed, seen = self.closed(batch - 1), self.before("open", batch)
        fresh, late = events.dropDuplicates(["event_id"]), None
        if closed is not None:
            behind = self.write("behind", batch, fresh.join(closed, KEYS))
            when = [r["v"] for r in behind.select("v").distinct().collect()]  # batches
            known = self.upto("counted", batch - 1, True).where(F.col("v").isin(when)).select("event_id")
            late, told = behind.drop("v").join(known, "event_id", "left_anti"), self.upto("late", batch - 1)
            if told is not None:
                late = late.join(told.select("event_id"), "event_id", "left_anti")
            fresh = fresh.join(closed.select(*KEYS), KEYS, "left_anti")
        if seen is not None:
            fresh = seen.unionByName(fresh.join(seen.select("event_id"), "event_id", "left_anti"))
        held = self.write("held", batch, fresh)
        counted = self.write("complete", batch, rendered(partials(held)).join(expected.select(*KEYS, "expected_telemetry_rows"), KEYS))
        over = self.write("overfull", batch, counted.where("event_count > expected_telemetry_rows").select(*KEYS))
        spilt = held.join(over, KEYS, "left_semi")
        late = self.write("late", batch, spilt if late is None else spilt.unionByName(late.select(*spilt.columns)))
        if strict and not late.isEmpty():
            raise RuntimeError("a cycle has more samples than its completion says")
        done = self.write("final", batch, counted.where("event_count = expected_telemetry_rows").drop("expected_telemetry_rows"))
        now = done.select(*KEYS).unionByName(over)
        self.write("counted", batch, held.join(now, KEYS, "left_semi").select(*KEYS, "event_id"))
        self.write("open", batch, held.join(now, KEYS, "left_anti"))


def run(source: DataFrame, store: CycleStore, expected: Callable[[], DataFrame], checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    """Starts the stream: over what is available, or every so many seconds."""
    return started(source, lambda rows, batch: store.process(decode_events(rows), batch, expected()), checkpoint, seconds)


def started(source: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    writer = source.writeStream.foreachBatch(process).outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")).start()


def deduplicated(events: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Duplicates by event_id within a watermark for streams, all duplicates for batches."""
    if not events.isStreaming:
        return events.dropDuplicates(["event_id"])
    return events.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["event_id"])


def kafka_source(spark: SparkSession, servers: str, topics: str, most: int = 5_000_000) -> DataFrame:
    """Envelopes (value, topic, partition, offset) of topics from their beginning, so many a batch at most; the connector must be on the class path."""
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topics).option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", most).load()


def window_metrics(telemetry: DataFrame) -> DataFrame:
    """The aggregates of a batch or a stream of valid telemetry, without its duplicates."""
    return rendered(partials(deduplicated(telemetry)))
