"""Ingestion of nested records, and the order of rows in files."""

import json

import pytest
from pyspark.sql import functions as F

from fleetmill.operators import quality, survival
from fleetmill.sources import ingest

CYCLE = "struct<cycle_number: bigint, " + ", ".join(f"{c}: array<double>" for c in ingest.CHANNELS) + ">"
RECORD = f"source_file string, asset_id string, nominal_capacity double, charge_range double, cycle_data array<{CYCLE}>"


def cycle(number, times=(0.0, 1.5), capacity=(1.0, 0.5), temperature=(20.0,)):
    own = {"source_time": times, "capacity": capacity, "temperature": temperature}
    return (number, *(None if own.get(c) is None else list(own.get(c)) for c in ingest.CHANNELS))


ROWS = [
    ("x_b2c1.json", "a", 2.0, 0.5, [cycle(1), cycle(None), cycle(0, (), (), ())]),
    ("x_b2c2.json", "b", 0.0, None, [cycle(4, capacity=None)]),
    ("y.json", "c", 2.0, None, None),
    ("z.json", "d", 2.0, None, []),
]


def records(spark, rows=ROWS):
    return spark.createDataFrame(rows, RECORD)


@pytest.fixture
def labels(spark, tmp_path):
    (tmp_path / "labels.json").write_text(json.dumps({"x_b2c1.json": 2, "x_b2c2.json": "long", "none.json": 7}))
    return ingest.file_labels(spark, str(tmp_path / "labels.json"))


@pytest.fixture
def roots(spark):
    return spark.createDataFrame([("b", "a"), ("b", "c")], "asset_id string, root string")


def tables(spark, manifest):
    return {r.table: spark.read.parquet(r.path) for r in manifest.collect()}


def test_labels_by_file(spark, labels):
    assert {(r.source_file, r.eol_cycle) for r in labels.collect()} == {("x_b2c1.json", 2), ("x_b2c2.json", None), ("none.json", 7)}
    assert {(r.asset_id, r.eol_cycle) for r in ingest.labelled(records(spark), labels).collect()} == {("a", 2), ("b", None), ("c", None), ("d", None)}
    with pytest.raises(ValueError, match="several labels"):
        ingest.labelled(records(spark), labels.unionByName(labels.withColumn("eol_cycle", F.lit(3))))


def test_flat_tables(spark, tmp_path, labels, roots):
    made = tables(spark, ingest.ingest(records(spark), labels, roots, f"{tmp_path}/out", "fleet", "2020-01-01"))
    rows = {r.event_id: r for r in made["samples"].collect()}
    assert set(rows) == {f"fleet:{k}:{s}" for k in ("a:1", "a:2", "b:4") for s in (0, 1)}
    last = rows["fleet:a:2:1"]
    assert (last.capacity, last.temperature, last.voltage, str(last.replay_time)) == (0.5, None, None, "2020-01-02 00:00:01.500000")
    got = {(r.asset_id, r.cycle_index): (r.rul, r.max_capacity, r.health, r.charge_time) for r in made["cycles"].collect()}
    assert got == {("a", 1): (1, 1.0, 1.0, 1.5), ("a", 2): (0, 1.0, 1.0, 1.5), ("a", 3): (0, None, None, None), ("b", 4): (None, None, None, 1.5)}
    assert made["assets"].count() == 4 and made["schedule"].count() == 2  # assets without cycles aren't scheduled


def test_lineage(spark, labels, roots):
    rows = [*ROWS, ("zz.json", "d2", *ROWS[0][2:]), ("zz2.json", "e", *ROWS[3][2:])]
    own = ingest.lineage(records(spark, rows), roots, "f")
    got = {r.asset_id: (r.batch_id, r.original_asset_id, r.lineage_group_id, r.lineage_reason, r.provenance_status) for r in own.collect()}
    assert got["b"] == ("batch_2", "a", "f:a", "official_continuation", "verified")
    assert got["a"] == ("batch_2", "a", "f:a", "documented_singleton", "documented_singleton")
    assert got["d2"] == (None, "d2", "f:a", "exact_source_duplicate", "verified")
    assert got["c"][2] == "f:c" and got["d"][2] == "f:d" and got["e"][2] == "f:e"


def test_batches_are_written_once(spark, tmp_path, labels, roots):
    def run(rows=ROWS):
        return ingest.ingest(records(spark, rows).repartition(3), labels, roots, f"{tmp_path}/out", "fleet", "2020-01-01")

    first = run()
    kept = sorted(str(p) for p in (tmp_path / "out").rglob("*.parquet"))
    assert run().collect() == first.collect() and sorted(str(p) for p in (tmp_path / "out").rglob("*.parquet")) == kept
    other = run([*ROWS[:-1], ("z.json", "d", 3.0, None, [])])
    assert other.first().batch != first.first().batch
    assert ingest.faults(first).count() == 0
    home = {r.table: r.path for r in first.collect()}
    for p in (tmp_path / "out" / f"batch={first.first().batch}" / "manifest").iterdir():  # as if the job had ended before its last step
        p.unlink()
    before = {r["table"]: r["content"] for r in other.collect()}
    again = run()
    assert {r["table"] for r in again.collect()} == set(before)
    changed = spark.read.parquet(home["samples"]).withColumn("capacity", F.when(F.col("event_id") == "fleet:b:4:0", 9.0).otherwise(F.col("capacity"))).collect()
    spark.createDataFrame(changed, spark.read.parquet(home["samples"]).schema).write.mode("overwrite").parquet(home["samples"])
    spark.createDataFrame([("a",)], "asset_id string").write.mode("overwrite").parquet(home["cycles"])
    assert {(r.table, r.fault) for r in ingest.faults(again).collect()} == {("samples", "content"), ("cycles", "rows")}


def test_bad_records(spark, tmp_path, labels, roots):
    for rows, what in (([], "no records"), ([ROWS[0], ("w.json", *ROWS[0][1:])], "has 2 records"), ([("w.json", None, 1.0, None, None)], "none has an id")):
        with pytest.raises(ValueError, match=what):
            ingest.ingest(records(spark, rows), labels, roots, f"{tmp_path}/out", "fleet", "2020-01-01")


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_order_in_files(spark, tmp_path, block):
    files = [[(1, 1), (1, 2), (1, 2), (2, 1), (1, 9), (None, 1), (3, 1)], [(1, 1), (2, 2)], [(2, 1)]]
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, "g bigint, v bigint").coalesce(1).write.parquet(f"{tmp_path}/t/k={k}")
    rows = quality.in_file(spark.read.parquet(f"{tmp_path}/t").select("g", "v", "k", "_metadata"))
    found = quality.file_neighbours(rows, ["g", "v"], ["_file"], block).where("_k <= before")
    low = lambda r: tuple((x is not None, x or 0) for x in r)  # noqa: E731, nulls come first
    want = {(k, i) for k, f in enumerate(files) for i in range(1, len(f)) if low(f[i]) <= low(f[i - 1])}
    assert {(r.k, r._row) for r in found.collect()} == want
    falls = quality.file_neighbours(rows, ["v"], ["g"], block).where("_k < before").groupBy("g").count()
    order = {}
    for g, v in (r for f in files for r in f):
        order.setdefault(g, []).append(v)
    want = {g: n for g, v in order.items() if (n := sum(y < x for x, y in zip(v, v[1:], strict=False)))}
    assert {r.g: r["count"] for r in falls.collect()} == want


def test_rows_of_the_state(spark):
    kind = "asset_id bigint, x double"
    own, state = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0), (None, 5.0)], kind), spark.createDataFrame([(1, -1.0), (2, -2.0), (3, -3.0)], kind)
    assets = spark.createDataFrame([(1, "train"), (2, "train"), (3, "test"), (1, "train")], "asset_id bigint, split string")
    arrived = spark.createDataFrame([(1,), (1,), (9,)], "asset_id bigint")
    got = survival.with_state_rows(own, state, assets, arrived)
    assert sorted((r.asset_id or 0, r.x) for r in got.collect()) == [(0, 5.0), (1, -1.0), (3, 3.0), (4, 4.0)]
