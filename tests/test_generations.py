"""Generations, contracts, serving and publication, on frames written by hand."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fleetmill.functions import digests
from fleetmill.operators import cohort, contracts, current, features, normalize, outlet, predict, quality, snapshots, survival
from fleetmill.plans import queries
from fleetmill.streaming.publish import Publication

CYCLE = "asset_id bigint, cycle_index bigint, max_capacity double, max_charge_capacity double, max_temperature double, min_temperature double, charge_time double"


def plain_features(rows):
    """The windows row by row: a second, independent statement of them."""
    out, by = {}, {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        history = by.setdefault(r[0], [])
        window = history[-9:]
        known = [h for h in window if h[2] is not None]
        slope = None
        if len(known) >= 2:
            mx, my = (sum(h[k] for h in known) / len(known) for k in (1, 2))
            spread = sum((h[1] - mx) ** 2 for h in known)
            slope = sum((h[1] - mx) * (h[2] - my) for h in known) / spread if spread else None
        less = lambda a, b: None if a is None or b is None else a - b
        out[r[0], r[1]] = (
            less(r[2], history[-1][2]) if history else None, sum(h[2] for h in known) / len(known) if known else None, slope, less(r[2], history[0][2]) if history else None,
            less(r[4], r[5]), None if r[2] is None or not r[3] else r[2] / r[3], less(r[6], history[-1][6]) if history else None,
        )
        history.append(r)
    return out


def test_windows_equal_a_plain_walk(spark):
    r = random.Random(3)
    value = lambda: None if r.random() < 0.15 else round(r.uniform(0, 5), 2)
    rows = [(a, c, value(), r.choice([0.0, 2.0, None]), value(), value(), value()) for a in range(4) for c in range(1, 26) if r.random() < 0.9]
    names = ["capacity_delta", "rolling_capacity_mean", "capacity_slope", "capacity_since_first", "temperature_span", "efficiency", "charge_time_delta"]
    got = {(x.asset_id, x.cycle_index): tuple(x[n] for n in names) for x in features.causal(spark.createDataFrame(rows, CYCLE)).collect()}
    for key, want in plain_features(rows).items():
        assert all((a is None and b is None) or math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got[key], want, strict=True)), (key, got[key], want)


def test_stages_are_thirds_of_the_prediction(spark):
    rows = spark.createDataFrame([(1, 2.0), (2, 4.0), (1, 0.5), (1, None), (0, 0.0), (66, 34.0), (67, 33.0)], "c bigint, r double")
    assert [x.s for x in rows.select(predict.predicted_stage(F.col("c"), F.col("r")).alias("s")).collect()] == ["Mid", "Mid", "Late", "Unavailable", "Early", "Mid", "Late"]


def test_landmarks_see_days_since_the_start(spark):
    """The end is eol_cycle where it was seen by then, else the last cycle shown."""
    cycles = spark.createDataFrame([(a, c) for a in (1, 2, 3, 4) for c in range(1, 9)], "asset_id bigint, cycle_index bigint")
    kind = "asset_id bigint, split string, valid_eol_label boolean, eol_cycle bigint, last_source_cycle bigint, start_time string"
    rows = [(1, "train", True, 5, 8, "2024-01-01"), (2, "train", True, 7, 8, "2024-01-03"), (3, "test", True, 6, 8, "2024-01-09"), (4, "train", True, 2, 8, "2024-01-09")]
    assets = spark.createDataFrame(rows, kind).withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))
    flags = spark.createDataFrame([(a, True) for a in (1, 2, 3, 4)], "asset_id bigint, eol_observed boolean")
    out = survival.landmark_rows(cycles, assets, flags, F.lit("2024-01-06 12:00:00").cast("timestamp_ntz"))
    got = {}
    for r in out.collect():
        got.setdefault(r.asset_id, []).append((r.cycle_index, r.duration, r.event))
    # Asset 1 shows 6 cycles and ended at 5; asset 2 shows 4; asset 3 is held out and shows all; asset 4 hasn't come.
    assert sorted(got[1]) == [(c, 5.0 - c, True) for c in range(1, 5)] and sorted(got[2]) == [(c, 4.0 - c, False) for c in range(1, 4)]
    assert sorted(got[3]) == [(c, 6.0 - c, True) for c in range(1, 6)] and 4 not in got
    with pytest.raises(ValueError):
        survival.checked_features(["x", "eol_cycle"])


def test_ranks_have_no_gaps_with_nulls_and_ties(spark):
    rows = [(k, None if k % 4 == 0 else f"2024-01-{1 + k % 3:02d}") for k in range(200)]
    frame = spark.createDataFrame(rows, "k bigint, t string").repartition(5)
    got = {r.k: r.replay_sequence for r in cohort.replay_sequence(frame, "t", "k").collect()}
    want = [k for k, t in sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[0]))]
    assert [got[k] for k in want] == list(range(200))
    assets = spark.createDataFrame([(1, None), (2, 5), (3, 5), (4, 9)], "asset_id bigint, lineage_group_id bigint")
    assert sorted(r.arrival_rank for r in cohort.arrival_rank(assets).collect()) == [0, 1, 2, 3]


def plain_split(sizes, seed=42):
    from hashlib import sha256

    names, used, out = ["train", "validation", "test"], {"train": 0, "validation": 0, "test": 0}, {}
    target = {"train": round(len(sizes) * 0.6), "validation": round(len(sizes) * 0.2)}
    target["test"] = len(sizes) - sum(target.values())
    for g in sorted(sizes, key=lambda g: sha256(f"{seed}:{g}".encode()).hexdigest()):
        open_ = [n for n in names if used[n] < target[n]]
        out[g] = min(open_, key=lambda n: used[n] / target[n]) if open_ else "train"
        used[out[g]] += sizes[g]
    return out


@pytest.mark.parametrize("groups", [1, 3, 7, 12])
def test_lineage_split_equals_a_plain_fold(spark, groups):
    sizes = {g: 1 + g % 3 for g in range(groups)}
    assets = spark.createDataFrame([(g * 10 + k, g) for g, n in sizes.items() for k in range(n)], "asset_id bigint, lineage_group_id bigint")
    for chunk in (2_000, 2):
        assert {r.lineage_group_id: r.split for r in cohort.lineage_split(assets, chunk=chunk).collect()} == plain_split(sizes)


def test_arrivals_beyond_the_year_9999(spark):
    """54,000 train assets are those of 6 times sf0.1; 3,240,000 those of 360 times, beyond the last timestamp (2273-02-14 and 1,330 times 400 years)."""
    ranked = spark.createDataFrame([(0,), (1,), (54_000,), (540_000,), (3_240_000,)], "arrival_rank bigint")
    got = {r.arrival_rank: r.t for r in ranked.select("*", cohort.arrival_text("2024-01-01", 60).alias("t")).collect()}
    assert got == {0: "2024-01-01 00:00:00", 1: "2024-03-01 00:00:00", 54_000: "10894-10-26 00:00:00", 540_000: "90732-03-10 00:00:00", 3_240_000: "534273-02-14 00:00:00"}
    times = cohort.scheduled(ranked.where("arrival_rank < 1000000"), "2024-01-01", 60)
    assert all(r.arrival_time == got[r.arrival_rank] for r in queries._text_times(times, "arrival_time").collect())


def test_lineage_split_is_one_stream_whatever_the_groups(spark):
    """30,000 groups of 1 to 3 assets; a plan or a job for each chunk of them grew the driver."""
    sizes = {g: 1 + g % 3 for g in range(30_000)}
    assets = spark.range(90_000).selectExpr("id as asset_id", "id div 3 as lineage_group_id").where("asset_id % 3 <= lineage_group_id % 3")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    found = cohort.lineage_split(assets, chunk=100)
    assert {r.lineage_group_id: r.split for r in found.collect()} == plain_split(sizes)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before < 20


def test_a_version_is_replaced_without_a_join_by_it(spark):
    kind = "model_version string, asset_id bigint, x double"
    old = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0), ("b", 2, 3.0), (None, 3, 4.0)], kind)
    out = current.replaced_version(old, spark.createDataFrame([("b", 9, 9.0), ("b", 8, 8.0)], kind))
    assert {tuple(r) for r in out.collect()} == {("a", 1, 1.0), (None, 3, 4.0), ("b", 9, 9.0), ("b", 8, 8.0)}
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    for versions in ([], ["a", "b"]):
        with pytest.raises(contracts.ContractError):
            current.replaced_version(old, spark.createDataFrame([(v, 1, 1.0) for v in versions], kind))


@pytest.mark.parametrize("parts", ["1", "2", "7", "8", "33"])
def test_ranks_by_any_number_of_ranges(spark, parts):
    """Ranges are found by a binary search: no row is compared with every bound."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = [(k, None if k % 5 == 0 else k % 13) for k in range(150)]
        out = cohort.replay_sequence(spark.createDataFrame(rows, "k bigint, t bigint"), "t", "k")
        assert "filter(_cuts" not in out._jdf.queryExecution().optimizedPlan().toString()
        got = {r.k: r.replay_sequence for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = [k for k, t in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))]
    assert [got[k] for k in want] == list(range(150))


def test_digests_fold_in_levels(spark):
    rows = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    a, b = (digests.folded(r, fold=4).first() for r in (rows, rows.repartition(7)))
    assert a == b and a["rows"] == 3000
    twice = digests.folded(rows.unionByName(rows.limit(1)), fold=4).first()
    assert twice.digest != a.digest and twice["rows"] == 3001


def plain_digest(hashes, fold):
    """The catalogue's SQL in Python: one level of hashes by their first signs, then one hash of all."""
    from collections import Counter
    from hashlib import sha256

    sha = lambda x: sha256("".join(sorted(x)).encode()).hexdigest()
    width = max(0, math.ceil(math.log(max(1, len(hashes)) / fold) / math.log(16)))
    parts = {}
    for h, n in Counter(hashes).items():
        parts.setdefault(h[:width], []).append(h if n == 1 else f"{h}*{n}")
    return sha(f"{b}:{sha(own)}" for b, own in parts.items())


@pytest.mark.parametrize("fold", [1, 4, 4096])
@pytest.mark.parametrize("widest", [1, 4])
def test_digests_of_many_rows_are_those_of_the_sql(spark, monkeypatch, fold, widest):
    """3,000 rows by 4 have three signs, as 16 million rows have by 4096."""
    monkeypatch.setattr(digests, "WIDEST", widest)
    rows = spark.range(3000).select(F.sha2((F.col("id") % 2990).cast("string"), 256).alias("h"))
    got = digests.folded(rows.repartition(3), fold=fold).first()
    assert (got.digest, got.rows) == (plain_digest([r.h for r in rows.collect()], fold), 3000)
    none = digests.folded(rows.where("false"), fold=fold).first()
    assert (none.digest, none.rows) == (plain_digest([], fold), 0)


def test_receipts_notice_changes(spark):
    rows = spark.createDataFrame([(1, 1, 2.0), (1, 2, None)], "asset_id bigint, cycle_index bigint, x double")
    found = snapshots.receipt(rows, 1, "s", "v1")
    assert snapshots.verified(rows.repartition(3), found).count() == 2
    with pytest.raises(contracts.ContractError):
        snapshots.verified(rows.fillna(0.0), found)
    with pytest.raises(ValueError):
        snapshots.one_value(rows, "cycle_index")


def test_publish_gates(spark):
    predictions = spark.createDataFrame([(1, 1, 5.0), (1, 2, 0.0), (1, 3, 3.0)], "asset_id bigint, cycle_index bigint, raw_rul double")
    one = spark.range(1)
    assert [r.rul for r in contracts.publish_predictions(predictions, one).orderBy("cycle_index").collect()] == [5.0, 0.0, 0.0]
    curves = spark.createDataFrame([(1, 1, h, p) for h, p in ((0, 1.0), (50, 0.9), (100, 0.8), (200, 0.1))], "asset_id bigint, cycle_index bigint, horizon int, probability double")
    assert contracts.publish_curves(curves, one).count() == 4
    for bad in (lambda: contracts.publish_predictions(predictions.where("false"), one), lambda: contracts.publish_predictions(predictions, spark.range(2)), lambda: contracts.publish_curves(curves.where("horizon <> 50"), one)):
        with pytest.raises(contracts.ContractError):
            bad()


def test_a_model_must_be_there_for_both_families(spark):
    kind = "model_version string, dataset string, status string, fingerprint string, evaluated_at bigint"
    models = spark.createDataFrame([("m1", "a", "candidate", "f", 1), ("m2", "a", "champion", "f2", 2), ("m3", "a", "retired", "f3", 9)], kind)
    none = spark.createDataFrame([], "dataset string, model_version string, fingerprint string, revision bigint")
    assert [tuple(r) for r in current.initialised(none, models, models).collect()] == [("a", "m2", "f2", 1)]
    with pytest.raises(contracts.ContractError):
        current.initialised(none, models, models.where("status = 'retired'"))
    with pytest.raises(contracts.ContractError):
        current.replaced_version(models, models)


def test_seeding_refuses_lost_and_changed_rows(spark):
    kind = "asset_id bigint, cycle_index bigint, generation_id int, x double"
    rows = [(1, 1, 1, 1.0), (1, 1, 2, 1.0), (1, 2, 2, None)]
    assert sorted((r.cycle_index, r.generation_id) for r in outlet.seeded(spark.createDataFrame(rows, kind)).collect()) == [(1, 1), (2, 2)]
    for bad in ([*rows[:1], (1, 1, 2, 9.0)], [rows[0], rows[2]]):
        with pytest.raises(ValueError):
            outlet.seeded(spark.createDataFrame(bad, kind))


def test_concordance_of_close_risks(spark):
    """Against all pairs; risks differ in the sixth digit."""
    r = random.Random(1)
    rows = [(float(r.randrange(1, 30)), r.random() < 0.6, round(r.random() / 1e5, 8)) for _ in range(120)]
    frame = spark.createDataFrame(rows, "duration double, event boolean, risk double")
    steps, g = [], 1.0
    for t in sorted({d for d, _, _ in rows}):  # events of a time leave before those censored then
        gone = sum(d == t and not e for d, e, _ in rows)
        g *= 1 - gone / (sum(d > t for d, _, _ in rows) + gone) if gone else 1
        steps.append((t, g))
    got = {x.duration: x.survival for x in survival.censoring(frame).collect()}
    assert got == pytest.approx(dict(steps))
    at = lambda t, strict: next((s for d, s in reversed(steps) if d < t or (d == t and not strict)), 1.0)
    good = [x for x in rows if at(x[0], False) > 0]
    num = den = 0.0
    for d, e, k in good:
        for d2, e2, k2 in good:
            if e and (d2 > d or (d2 == d and not e2)):
                w = 1 / at(d, False) ** 2
                den += w
                num += w * (1.0 if k > k2 else 0.5 if k == k2 else 0.0)
    got = survival.concordance(frame, frame).first()
    assert got.c_index == pytest.approx(num / den) and got.weight == pytest.approx(den)


def envelopes(spark, rows):
    """(topic, partition, offset, json) as envelopes."""
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string").withColumn("value", F.col("value").cast("binary"))


def sample(a, c, s, offset):
    return ("telemetry", 0, offset, f'{{"event_id":"{a}:{c}:{s}","asset_id":{a},"cycle_index":{c},"sample_index":{s},"event_time":"2024-01-0{c}","voltage":1.0,"schema_version":"1.0"}}')


def done(a, c, n, offset):
    return ("lifecycle", 0, offset, f'{{"event_id":"d:{a}:{c}","event_type":"cycle_complete","asset_id":{a},"cycle_index":{c},"event_time":"2024-01-0{c}","expected_telemetry_rows":{n},"schema_version":"1.0"}}')


def test_kinds_of_events_are_those_of_both_decoders(spark):
    """One parse gives what the two decoders give, also for payloads that are broken, of both kinds, or bad in the other's fields."""
    rows = [sample(1, 1, 1, 1), done(1, 1, 1, 1), ("lifecycle", 0, 9, "no json"), ("telemetry", 0, 9, None), ("telemetry", 0, 9, sample(1, 1, 2, 1)[3][:60])]
    change = lambda row, old, new: (*row[:3], row[3].replace(old, new))
    rows += [change(done(1, 2, 1, 1), "cycle_complete", kind) for kind in ("replay_complete", "unknown")]
    rows += [change(sample(1, 1, 3, 1), '"voltage"', '"event_type":"eol_observed","voltage"'), change(sample(1, 1, 4, 1), '"voltage"', '"expected_telemetry_rows":"many","voltage"'), change(done(1, 3, 1, 1), '"schema', '"voltage":"x","sample_index":[],"schema')]
    rows += [change(x, old, new) for x in (sample(1, 1, 5, 1), done(1, 4, 1, 1)) for old, new in (('"1.0"}', '"2.0"}'), ("2024-01-01", "soon"), ('"asset_id":1', '"asset_id":null'))]
    sent = envelopes(spark, rows)
    want = [(r.topic, "telemetry") for r in normalize.decode_events(sent).collect()] + [(r.topic, r.event_type) for r in normalize.decode_lifecycle(sent).collect()]
    assert sorted(tuple(r) for r in normalize.event_kinds(sent).collect()) == sorted(want) and len(want) >= 7
    for decoded in (normalize.event_kinds(sent), normalize.decode_events(sent), normalize.decode_lifecycle(sent)):  # a payload is parsed once, not once a field
        assert decoded._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_publication_is_by_prefix_idempotent_and_survives_serving(spark, tmp_path):
    canonical = spark.createDataFrame([(1, c) for c in (1, 2, 3)], "asset_id bigint, cycle_index bigint")
    served = []

    def serve(state, bounds):
        served.append(state)
        if len(served) == 1:
            raise RuntimeError("the database is away")
        return bounds.count()

    out = Publication(spark, str(tmp_path), canonical, serve=serve)
    assert out.process(envelopes(spark, [sample(1, 2, 1, 1), done(1, 2, 1, 1)]), 0) is None  # cycle 1 is missing
    first = out.process(envelopes(spark, [sample(1, 1, 1, 2), sample(1, 1, 1, 3), done(1, 1, 1, 2), ("lifecycle", 0, 9, "no json")]), 1)
    assert first and out.latest() == first and [tuple(r) for r in spark.read.parquet(f"{tmp_path}/boundaries/{first}").collect()] == [(1, 2, 2)]
    assert out.process(envelopes(spark, [sample(1, 1, 1, 2), sample(1, 1, 1, 3), done(1, 1, 1, 2)]), 1) is None  # the same batch again
    assert out.outlet.rows().count() == 2 and out.states().count() == 1
    second = out.process(envelopes(spark, [sample(1, 3, 1, 4), done(1, 3, 1, 4)]), 2)
    assert second != first and out.latest() == second and out.outlet.rows().count() == 3
    out.refresh()
    statuses = [(r.status, r.rows_written) for r in spark.read.parquet(f"{tmp_path}/statuses").orderBy("rows_written").collect()]
    assert statuses == [("failed", None), ("served", 1), ("served", 1)] and len(served) == 3


def test_single_values(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b")], "k bigint, s string")
    assert tuple(quality.single_value(rows, "k").first()) == (1, 1) and quality.single_value(rows, "s").first().value is None
