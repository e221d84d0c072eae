"""Publication of finalized state from a stream of telemetry and lifecycle events.

A batch adds its offsets, samples, lifecycle flags and completion facts to the
store. Then the cycles up to which, without a gap, all canonical ones are final
make the boundary; its content is the state's id. A state that is in the ledger
is published already. Otherwise its completions must be covered by the source
offsets read so far, the features of its new cycles go to the outlet by
generation, and the ledger's row, written last, makes it the latest. Serving
comes after that and can't take a state back: its outcome is a status row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmill.operators import aggregate, features, finality, normalize
from fleetmill.operators.merge import unique_facts
from fleetmill.operators.outlet import Outlet, beyond, key_maxima
from fleetmill.sources.store import exists

from .stream import CycleStore

KEYS = ["asset_id", "cycle_index"]
FEATURES = ["capacity_delta", "rolling_capacity_mean", "capacity_slope", "capacity_since_first", "temperature_span", "charge_time_delta", "efficiency"]


class Publication:
    """The published states under a folder, from a store of cycles and the canonical cycles that count.

    ``generation`` is a column of the completion's event_time; ``serve`` gets a
    state's id and boundary, and gives the number of rows it wrote.
    """

    def __init__(self, spark: SparkSession, folder: str, canonical: DataFrame, generation: Callable | None = None, serve: Callable[[str, DataFrame], int] | None = None):
        self.spark, self.folder, self.canonical, self.serve = spark, folder, canonical, serve
        self.store, self.outlet = CycleStore(spark, f"{folder}/cycles"), Outlet(spark, f"{folder}/outlet")
        self.generation = generation or (lambda time: F.lit(1))

    def process(self, envelopes: DataFrame, batch: int) -> str | None:
        """One micro-batch of envelopes; the id of the state that it published, if any. A batch that runs again changes nothing."""
        store = self.store
        marks = store.write("offsets", batch, aggregate.offset_watermarks(envelopes.where("topic is not null and partition is not null and offset is not null")))
        lifecycle = store.write("lifecycle", batch, normalize.decode_lifecycle(envelopes).dropDuplicates(["event_id"]))
        store.write("flags", batch, aggregate.lifecycle_flags(lifecycle.where("event_type <> 'cycle_complete'")))
        facts = store.upto("completions", batch - 1)
        fresh = unique_facts(None, normalize.completions(lifecycle), KEYS)
        store.write("completions", batch, fresh if facts is None else fresh.join(facts.select(*KEYS), KEYS, "left_anti"))
        store.process(normalize.decode_events(envelopes), batch, store.upto("completions", batch))
        del marks
        return self.publish(batch)

    def flags(self, batch: int) -> DataFrame:
        return aggregate.merged_flags(self.store.upto("flags", batch))

    def watermarks(self, batch: int) -> DataFrame:
        return aggregate.offset_watermarks(self.store.upto("offsets", batch))

    def final_keys(self, batch: int) -> DataFrame:
        """The canonical cycles up to which all are final."""
        done = self.store.upto("final", batch).select(*KEYS).join(self.store.upto("completions", batch).select(*KEYS), KEYS, "left_semi")
        return finality.prefix_complete(self.canonical, done)

    def publish(self, batch: int) -> str | None:
        keys = self.store.write("prefix", batch, self.final_keys(batch))
        if keys.isEmpty():
            return None
        facts = self.store.upto("completions", batch).join(keys, KEYS)
        bounds = finality.boundary(keys)
        state = finality.state_id(bounds).first()["state_id"]
        seen = self.states()
        if seen is not None and not seen.where(F.col("state_id") == state).isEmpty():
            return None
        ahead = aggregate.beyond_watermarks(facts, self.watermarks(batch)).limit(1).collect()
        if ahead:
            raise RuntimeError(f"a completion is ahead of its source offset: {ahead[0].asDict()}")
        self._append(keys, facts, batch)
        path = f"{self.folder}/boundaries/{state}"
        bounds.write.mode("overwrite").parquet(path)
        cutoff = aggregate.cutoff_text(facts).select("replay_cutoff", F.lit(state).alias("state_id"), F.lit(batch).cast("bigint").alias("batch"))
        cutoff.write.mode("append").parquet(f"{self.folder}/states")
        self._served(state, self.spark.read.parquet(path))
        return state

    def _append(self, keys: DataFrame, facts: DataFrame, batch: int) -> None:
        """Features of the cycles beyond the outlet's, from the cycles before them, by generation."""
        ledger = self.outlet.ledger()
        new = keys if ledger is None else beyond(keys, key_maxima(ledger))
        rows = features.incremental(self.store.upto("final", batch).join(keys, KEYS, "left_semi"), new)
        rows = rows.join(facts.select(*KEYS, self.generation(F.col("event_time")).alias("_g")), KEYS)
        rows = self.store.write("features", batch, rows.select(*KEYS, *FEATURES, "_g"))
        for r in rows.select("_g").distinct().orderBy("_g").collect():  # a few generations
            self.outlet.append(rows.where(F.col("_g") == r["_g"]).drop("_g"), r["_g"])

    def _served(self, state: str, bounds: DataFrame) -> None:
        if self.serve is None:
            return
        try:
            rows, error = self.serve(state, bounds), None
        except Exception as failure:  # a serving failure never retracts a published state
            rows, error = None, str(failure)[:500]
        status = "failed" if error is not None else "served"
        self.spark.range(1).select(F.lit(state).alias("state_id"), F.lit(status).alias("status"), F.lit(rows).cast("bigint").alias("rows_written"), F.lit(error).cast("string").alias("error")).write.mode("append").parquet(f"{self.folder}/statuses")

    def refresh(self) -> None:
        """Serves the latest state again, without reading the source."""
        state = self.latest()
        if state is not None:
            self._served(state, self.spark.read.parquet(f"{self.folder}/boundaries/{state}"))

    def states(self) -> DataFrame | None:
        path = f"{self.folder}/states"
        return self.spark.read.parquet(path) if exists(self.spark, path) else None

    def latest(self) -> str | None:
        seen = self.states()
        return None if seen is None else seen.agg(F.max_by("state_id", "batch")).first()[0]
