"""Edge cases on frames written by hand."""

import pytest
from pyspark.sql import functions as F

from fleetmill.operators import aggregate, cohort, features, finality, merge, normalize, predict, quality, serving, survival


def cells(spark, rows):
    return spark.createDataFrame(rows, "asset_id bigint, cycle_index bigint, max_capacity double, max_charge_capacity double, max_temperature double, min_temperature double")


def test_aggregates_ignore_what_is_not_finite(spark):
    rows = [(1, 1, float("nan"), 2.0), (1, 1, float("inf"), None), (1, 1, 3.0, None), (2, 1, None, None)]
    out = {r.asset_id: r for r in aggregate.rendered(aggregate.partials(spark.createDataFrame(rows, "asset_id bigint, cycle_index bigint, voltage double, temperature double"))).collect()}
    assert out[1].event_count == 3 and out[1].average_voltage == 3.0 and out[1].max_voltage == 3.0
    assert out[2].average_voltage is None and out[2].max_voltage is None and out[1].max_capacity is None


def test_merge_of_parts_is_the_whole(spark):
    rows = spark.createDataFrame([(1, c, float(v)) for c in (1, 2) for v in range(5)], "asset_id bigint, cycle_index bigint, voltage double")
    whole = aggregate.partials(rows)
    parts = aggregate.merge(aggregate.partials(rows.where("voltage < 2")), aggregate.partials(rows.where("voltage >= 2")))
    assert sorted(whole.select(parts.columns).collect()) == sorted(parts.collect())


def test_windows_leave_out_the_current_row(spark):
    out = features.causal(cells(spark, [(1, c, float(100 - c), 0.0, 1.0, 1.0) for c in range(1, 13)])).orderBy("cycle_index").collect()
    assert out[0].rolling_capacity_mean is None and out[0].capacity_slope is None and out[0].capacity_since_first is None
    assert out[1].rolling_capacity_mean == 99.0 and out[1].capacity_slope is None
    assert out[2].capacity_slope == pytest.approx(-1.0)
    assert out[11].rolling_capacity_mean == pytest.approx(sum(100 - c for c in range(3, 12)) / 9)


def test_ratio_by_zero_is_null(spark):
    assert features.causal(cells(spark, [(1, 1, 5.0, 0.0, 1.0, 1.0)])).first().efficiency is None
    assert features.causal(cells(spark, [(1, 1, 4.0, 5.0, 1.0, 1.0)])).first().efficiency == 0.8


def test_a_gap_blocks_what_follows(spark):
    canonical = spark.createDataFrame([(1, c) for c in range(1, 6)] + [(2, 1)], "asset_id bigint, cycle_index bigint")
    ready = spark.createDataFrame([(1, 1), (1, 2), (1, 4), (1, 9), (2, 7)], "asset_id bigint, cycle_index bigint")
    assert sorted(map(tuple, finality.prefix_complete(canonical, ready).collect())) == [(1, 1), (1, 2)]


def test_too_few_and_too_many_samples_are_not_ready(spark):
    state = spark.createDataFrame([(1, 1, 3), (1, 2, 2), (1, 3, 5)], "asset_id bigint, cycle_index bigint, event_count bigint")
    done = spark.createDataFrame([(1, 1, 3), (1, 2, 3), (1, 3, 3), (1, 4, 1)], "asset_id bigint, cycle_index bigint, expected_telemetry_rows bigint")
    out = {r.cycle_index: (r.ready, r.overflow) for r in finality.ready(state, done).collect()}
    assert out == {1: (True, False), 2: (False, False), 3: (False, True), 4: (False, False)}


def test_an_end_of_life_is_irreversible(spark):
    rows = spark.createDataFrame([(1, 1, 5.0), (1, 2, -1.0), (1, 3, 3.0)], "asset_id bigint, cycle_index bigint, raw_rul double")
    assert [(r.rul, r.eol_cycle) for r in predict.irreversible(rows).orderBy("cycle_index").collect()] == [(5.0, 6.0), (0.0, 2.0), (0.0, 2.0)]


def test_a_curve_never_rises_and_ends_at_what_is_not_finite(spark):
    rows = spark.createDataFrame([(1, 1, h, p) for h, p in ((0, 1.2), (10, 0.8), (20, 0.9), (30, float("nan")), (40, 0.5))], "asset_id bigint, cycle_index bigint, horizon int, probability double")
    assert [r.served for r in predict.monotone(rows).orderBy("horizon").collect()] == [1.0, 0.8, 0.8, 0.0, 0.0]


def test_old_rows_never_replace_newer_ones(spark):
    kind = "asset_id bigint, sequence bigint, state_id string, revision int, v string"
    old = spark.createDataFrame([(1, 5, "s", 1, "old"), (2, 5, "s", 1, "old"), (3, 5, "s", 1, "old"), (4, 5, None, 1, "old")], kind)
    new = spark.createDataFrame([(1, 4, "s", 9, "new"), (2, 6, "s", 1, "new"), (3, 5, "s", 2, "new"), (4, 5, None, 2, "new"), (5, 1, "s", 1, "new")], kind)
    out = {r.asset_id: r.v for r in merge.merge_keyed(old, new, ["asset_id"], merge.newer_sequence()).collect()}
    assert out == {1: "old", 2: "new", 3: "new", 4: "new", 5: "new"}


def test_append_once(spark):
    old = spark.createDataFrame([(1, 1.0), (2, None)], "k bigint, v double")
    assert merge.append_once(old, old, ["k"]).count() == 0
    assert merge.append_once(old, spark.createDataFrame([(3, 1.0)], "k bigint, v double"), ["k"]).count() == 1
    with pytest.raises(ValueError):
        merge.append_once(old, spark.createDataFrame([(2, 9.0)], "k bigint, v double"), ["k"])


def test_a_selection_keeps_its_revision_unless_it_changes(spark):
    kind = "dataset string, model_version string, fingerprint string"
    current = spark.createDataFrame([("a", "m1", "f", 3), ("b", "m2", "f", 7), ("d", "m4", "f", 1), ("e", "m5", None, 2), ("g", "m6", None, 5)], kind + ", revision bigint")
    wanted = spark.createDataFrame([("a", "m1", "f"), ("b", "m9", "f"), ("c", "m3", "f"), ("d", "m4", "other"), ("e", "m5", None)], kind)
    got = sorted(map(tuple, merge.bumped_selection(current, wanted).collect()))
    assert got == [("a", "m1", "f", 3), ("b", "m9", "f", 8), ("c", "m3", "f", 1), ("d", "m4", "other", 2), ("e", "m5", None, 2), ("g", "m6", None, 5)]


def test_the_current_model_takes_its_generations_place(spark):
    rows = [("m1", 1, 3, "tree", "candidate", 1), ("m2", 1, 2, "neutral", "champion", 2), ("m3", 1, 3, "neutral", "retired", 3), ("m4", 2, 1, "tree", "candidate", 1), ("m5", 2, 1, "tree", "champion", 0), ("m6", None, 3, "tree", "champion", 9)]
    models = spark.createDataFrame(rows, "model_version string, generation int, record_class int, family string, status string, evaluated_at int")
    chosen = lambda current: sorted(r.model_version for r in serving.selectable_models(models, current).collect())
    assert chosen(None) == ["m1", "m5"] and chosen("m2") == ["m2", "m5"] and chosen("m3") == ["m1", "m5"] and chosen("m6") == ["m1", "m5"]


def test_cohorts_are_of_train_assets_with_ends_by_days(spark):
    rows = [(1, "train", "2024-01-01", 1, 5, True, True), (2, "train", "2024-01-01", 1, 6, True, True), (3, "test", "2024-01-01", 1, 2, True, True), (4, "train", "2024-01-06", 1, 1, True, True),
            (5, "train", "2024-01-01", 3, 7, True, True), (6, "train", "2024-01-01", 1, 2, False, True), (7, "train", "2024-01-01", 1, 2, True, False), (8, "train", "2024-01-01", 1, None, True, True)]
    assets = spark.createDataFrame(rows, "asset_id int, split string, start_time string, first_source_cycle int, eol_cycle int, valid_eol_label boolean, eol_observed boolean").withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))
    got = cohort.at_cutoff(assets, F.lit("2024-01-05").cast("timestamp_ntz")).collect()
    assert sorted((r.asset_id, r.observed) for r in got) == [(1, True), (2, False), (5, True), (6, False), (7, False), (8, True)]
    assert [tuple(r)[1:] for r in cohort.counts_at(assets, ["2024-01-05", "2024-01-06", "2023-01-01"]).orderBy("cutoff").collect()] == [(0, 0, 0), (6, 3, 3), (7, 5, 2)]


def test_malformed_events_are_left_out(spark):
    good = '{"event_id":"e","asset_id":1,"cycle_index":1,"sample_index":1,"event_time":"2024-01-01T00:00:00","voltage":1.0,"schema_version":"1.0"}'
    rows = [(x.encode(),) for x in (good, "{", good.replace("1.0\"}", "2.0\"}"), good.replace("2024-01-01T00:00:00", "soon"), good.replace('"event_id":"e",', ""))]
    assert normalize.decode_events(spark.createDataFrame(rows, "value binary")).count() == 1


def test_ragged_channels_are_padded(spark):
    kind = "asset_id bigint, cycle_data array<struct<cycle_number int, a array<double>, b array<double>>>"
    rows = [(1, [(0, [1.0, 2.0, 3.0], [9.0]), (7, None, [4.0]), (None, [], [])])]
    out = sorted(map(tuple, normalize.ragged_zip(spark.createDataFrame(rows, kind), ["a", "b"]).collect()), key=lambda r: r[:3])
    assert out == [(1, 1, 1, 1.0, 9.0), (1, 1, 2, 2.0, None), (1, 1, 3, 3.0, None), (1, 7, 1, None, 4.0)]


def test_generation_boundaries(spark):
    rows = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("2030-01-01",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert [r.g for r in rows.select(cohort.generation(F.col("t"), ("2024-01-01", "2025-01-01")).alias("g")).collect()] == [1, 2, 3]


def test_more_assets_than_the_targets_go_to_the_first_split(spark):
    assets = spark.createDataFrame([(i, i % 2) for i in range(40)], "asset_id bigint, lineage_group_id bigint")
    rows = cohort.lineage_split(assets).collect()
    assert len(rows) == 2 and {r.split for r in rows} <= {"train", "validation", "test"}


def test_kaplan_meier_of_censoring(spark):
    rows = spark.createDataFrame([(1.0, True), (2.0, False), (3.0, True), (3.0, False)], "duration double, event boolean")
    out = [(r.at_risk, r.censored, round(r.survival, 6)) for r in survival.censoring(rows).orderBy("duration").collect()]
    assert out == [(3, 0, 1.0), (3, 1, round(2 / 3, 6)), (1, 1, 0.0)]


def test_duplicates_and_rules(spark):
    rows = spark.createDataFrame([(1, 1), (1, 1), (None, 2), (3, -1)], "k bigint, v int")
    assert sorted((str(r.k), r.rows) for r in quality.duplicates(rows, ["k"]).collect()) == [("1", 2), ("None", 1)]
    assert {r.rule: r.rows for r in quality.violations(rows, {"positive": F.col("v") > 0, "keyed": F.col("k") > 0}).collect()} == {"positive": 1, "keyed": 0}


def test_a_threshold_above_the_largest_value_filters_nothing(spark):
    rows = spark.createDataFrame([("A1", 5.0), ("a2", None), ("b", 1.0)], "name string, rul double")
    assert serving.risk_filter(rows, "A", rul=9.0).count() == 2
    assert [r.name for r in serving.risk_filter(rows, None, rul=2.0).collect()] == ["b"]


def test_constant_colours_score_one(spark):
    rows = spark.createDataFrame([(1.0,), (1.0,), (None,)], "x double")
    assert sorted([r.score for r in serving.colour_scores(rows, "x").collect()], key=str) == [1.0, 1.0, None]


def test_replayed_batch_changes_nothing_and_late_rows_wait(spark, tmp_path):
    from fleetmill.streaming.stream import CycleStore

    kind = "event_id string, asset_id bigint, cycle_index bigint, sample_index bigint, event_time string, voltage double"
    def batch(*rows):
        return spark.createDataFrame([(f"{a}:{c}:{s}", a, c, s, "2024-01-01", 1.0) for a, c, s in rows], kind).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))

    expected = spark.createDataFrame([(1, 1, 2), (1, 2, 1)], "asset_id bigint, cycle_index bigint, expected_telemetry_rows bigint")
    store = CycleStore(spark, str(tmp_path))
    store.process(batch((1, 1, 1), (1, 1, 1)), 0, expected)
    for _ in range(2):
        store.process(batch((1, 1, 1), (1, 1, 2)), 1, expected)
    store.process(batch((1, 1, 3), (1, 2, 1)), 2, expected)
    final = {(r.asset_id, r.cycle_index): r.event_count for r in store.finals().collect()}
    assert final == {(1, 1): 2, (1, 2): 1}
    assert store.upto("late", 2).count() == 1 and store.before("open", 3).count() == 0
    with pytest.raises(RuntimeError):
        store.process(batch((1, 2, 9)), 3, expected, strict=True)


def samples_of(spark, *rows):
    kind = "event_id string, asset_id bigint, cycle_index bigint, sample_index bigint, event_time string, voltage double"
    return spark.createDataFrame([(f"{a}:{c}:{s}", a, c, s, "2024-01-01", 1.0) for a, c, s in rows], kind).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def test_an_overfull_cycle_never_becomes_final(spark, tmp_path):
    from fleetmill.streaming.stream import CycleStore

    expected = spark.createDataFrame([(1, 1, 5)], "asset_id bigint, cycle_index bigint, expected_telemetry_rows bigint")
    store = CycleStore(spark, str(tmp_path / "a"))
    six = [(1, 1, s) for s in range(6)]
    store.process(samples_of(spark, *six), 0, expected)
    for _ in range(2):  # a batch that runs again changes nothing
        store.process(samples_of(spark, *six[:5]), 1, expected)
    store.process(samples_of(spark, (1, 1, 7), (1, 1, 0)), 2, expected)
    store.process(samples_of(spark, (1, 1, 7)), 3, expected)
    assert store.finals().count() == 0 and store.before("open", 4).count() == 0
    assert sorted(r.event_id for r in store.upto("late", 3).collect()) == [f"1:1:{s}" for s in (0, 1, 2, 3, 4, 5, 7)]
    with pytest.raises(RuntimeError):
        CycleStore(spark, str(tmp_path / "b")).process(samples_of(spark, *six), 0, expected, strict=True)


def test_strict_streams_take_repeats_of_counted_samples(spark, tmp_path):
    from fleetmill.streaming.stream import CycleStore

    expected = spark.createDataFrame([(1, 1, 2), (1, 2, 1)], "asset_id bigint, cycle_index bigint, expected_telemetry_rows bigint")
    store = CycleStore(spark, str(tmp_path))
    store.process(samples_of(spark, (1, 1, 1), (1, 1, 2)), 0, expected, strict=True)
    store.process(samples_of(spark, (1, 1, 2), (1, 2, 1)), 1, expected, strict=True)
    store.process(samples_of(spark, (1, 1, 1), (1, 2, 1)), 2, expected, strict=True)
    assert store.finals().count() == 2 and store.upto("late", 2).count() == 0
    with pytest.raises(RuntimeError):
        store.process(samples_of(spark, (1, 1, 3)), 3, expected, strict=True)


def test_filters_reach_the_scan(spark, sf):
    import os

    from fleetmill.sources import domain

    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    plan = domain.table(spark, sf, "lineitem").where("l_quantity > 40").select("l_orderkey")._jdf.queryExecution().toString()
    assert "GreaterThan(l_quantity,40" in plan and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
