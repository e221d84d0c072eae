"""The catalogue: each query applies an operator to the test tables as a fleet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmill.operators import aggregate, cohort, contracts, current, features, finality, merge, normalize, outlet, predict, quality, serving, snapshots, survival
from fleetmill.sources import domain, ingest

QUERIES: dict = {}
CUTOFF = "1999-12-31"
#: Arrivals are a day apart from here on, and landmarks are seen from there.
EPOCH, SEEN = "2024-01-01", "2024-03-31 12:00:00"


def query(f):
    QUERIES[f.__name__] = f
    return f


def _round(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _text_times(df: DataFrame, *columns: str) -> DataFrame:
    """Times as text, which is the same in every engine; years beyond 9999 have no sign."""
    return df.withColumns({c: F.ltrim(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("+")) for c in columns})


def _cutoff():
    return F.lit(CUTOFF).cast("timestamp_ntz")


def _state(spark, sf) -> DataFrame:
    return aggregate.rendered(aggregate.partials(domain.samples(spark, sf)))


def _features(spark, sf) -> DataFrame:
    return features.causal(_state(spark, sf))


def _complete(spark, sf) -> DataFrame:
    return domain.lifecycle(spark, sf).where("event_type = 'cycle_complete'").select("asset_id", "cycle_index", "expected_telemetry_rows")


def _ready(spark, sf) -> DataFrame:
    return finality.ready(_state(spark, sf), _complete(spark, sf))


def _final(spark, sf) -> DataFrame:
    return finality.prefix_complete(domain.cycles(spark, sf), _ready(spark, sf).where("ready"))


def _flags(spark, sf) -> DataFrame:
    ends = domain.cycles(spark, sf).groupBy("asset_id").agg(F.max("cycle_time").alias("event_time"))
    events = ends.withColumn("event_type", F.explode(F.array(F.lit("replay_complete"), F.lit("eol_observed")))).where("event_type = 'replay_complete' or asset_id % 3 <> 0")
    return aggregate.lifecycle_flags(events)


def _cohort(spark, sf) -> DataFrame:
    return cohort.arrival_rank(domain.manifest(spark, sf)).join(_flags(spark, sf), "asset_id")


def _generations(spark, sf) -> DataFrame:
    return domain.cycles(spark, sf).withColumn("generation", cohort.generation(F.col("cycle_time"), domain.CUTOFFS))


def _served(spark, sf) -> DataFrame:
    return predict.irreversible(domain.predictions(spark, sf))


def _metrics(spark, sf) -> DataFrame:
    rows = domain.predictions(spark, sf).join(domain.manifest(spark, sf), "asset_id")
    rows = rows.withColumns({"truth": (F.col("last_source_cycle") - F.col("cycle_index")).cast("double"), "stage": predict.life_stage(F.col("cycle_index"), F.col("last_source_cycle").cast("double"))})
    return predict.regression_metrics(rows, ["split", "stage"], predicted="raw_rul")


def _arrivals(spark, sf) -> DataFrame:
    assets = domain.manifest(spark, sf).select("asset_id", "lineage_group_id", "split", "eol_cycle")
    cycles = domain.cycles(spark, sf).join(assets.select("asset_id", "eol_cycle"), "asset_id")
    return cohort.arrival_manifest(assets.drop("eol_cycle"), cycles, EPOCH)


def _stored(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: what is made of them reads it, and doesn't make them again."""
    path = f"{_scratch(df.sparkSession)}/stored"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _seen():
    return F.lit(SEEN).cast("timestamp_ntz")


def _land(spark, sf) -> DataFrame:
    return _stored(survival.landmark_rows(domain.cycles(spark, sf), _arrivals(spark, sf), _flags(spark, sf), _seen()))


def _fleet(spark, sf) -> DataFrame:
    newest = features.latest(_served(spark, sf).join(domain.cycles(spark, sf).select("asset_id", "cycle_index", "o_totalprice"), ["asset_id", "cycle_index"]))
    names = domain.table(spark, sf, "customer").select(F.col("c_custkey").alias("asset_id"), F.col("c_name").alias("name"))
    return newest.join(names, "asset_id").select("asset_id", "name", "rul", (F.col("o_totalprice") / 5000).alias("health"))


def _models(spark, sf) -> DataFrame:
    ids = domain.cycles(spark, sf).select("asset_id").distinct()
    families = F.create_map(F.lit("tree"), F.struct((F.col("asset_id") % 3).cast("double").alias("mae"), F.lit(3.0).alias("rmse")), F.lit("linear"), F.struct(F.lit(2.0).alias("mae"), F.lit(None).cast("double").alias("rmse")))
    doc = F.to_json(F.struct((F.col("asset_id") % 7 / 2.0).alias("mae"), F.when(F.col("asset_id") % 2 == 0, F.col("asset_id") % 5 / 4.0).alias("rmse"), families.alias("families")))
    return ids.select(F.concat(F.lit("m"), "asset_id").alias("model_version"), doc.alias("metrics_json"))


@query
def cycle_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    return _round(_state(spark, sf), 6, "average_voltage", "average_current", "max_abs_current").select("asset_id", "cycle_index", "event_count", "average_voltage", "average_current", "max_capacity", "max_temperature", "min_temperature", "max_voltage", "min_voltage", "max_abs_current")


@query
def merge_partials(spark, sf):
    s = domain.samples(spark, sf)
    merged = aggregate.merge(aggregate.partials(s.where("sample_index % 2 = 0")), aggregate.partials(s.where("sample_index % 2 = 1")))
    return _round(merged, 6, "voltage_sum").select("asset_id", "cycle_index", "event_count", "voltage_sum", "max_capacity", "min_voltage")


_FEATURES = ["capacity_delta", "rolling_capacity_mean", "capacity_slope", "capacity_since_first"]


@query
def causal_features(spark, sf):
    extra = [*_FEATURES, "temperature_span", "efficiency", "charge_time_delta"]
    return _round(_features(spark, sf), 6, *extra).select("asset_id", "cycle_index", F.col("cycle_gap").cast("double").alias("cycle_gap"), *extra)


@query
def incremental_features(spark, sf):
    new = _generations(spark, sf).where("generation = 4")
    return _round(features.incremental(_state(spark, sf), new), 6, *_FEATURES).select("asset_id", "cycle_index", F.col("cycle_gap").cast("double").alias("cycle_gap"), *_FEATURES)


@query
def latest_per_asset(spark, sf):
    return _round(features.latest(_features(spark, sf)), 6, "rolling_capacity_mean", "capacity_slope").select("asset_id", "cycle_index", "rolling_capacity_mean", "capacity_slope")


@query
def latest_finite_row(spark, sf):
    return _round(features.latest(features.all_finite(_features(spark, sf), "capacity_slope", "capacity_delta")), 6, "capacity_slope").select("asset_id", "cycle_index", "capacity_slope")


@query
def lifecycle_flags(spark, sf):
    return _text_times(_flags(spark, sf), "eol_time", "replay_time")


@query
def offset_watermarks(spark, sf):
    s = domain.samples(spark, sf)
    return aggregate.offset_watermarks(s.select(F.lit("telemetry").alias("topic"), (F.col("asset_id") % 3).cast("int").alias("partition"), (F.col("asset_id") * 1000 + F.col("cycle_index") * 10 + F.col("sample_index")).alias("offset")))


@query
def ready_cycles(spark, sf):
    return _ready(spark, sf).select("asset_id", "cycle_index", "event_count", "ready")


@query
def prefix_complete(spark, sf):
    return _final(spark, sf)


@query
def boundary_ranges(spark, sf):
    return finality.boundary(_final(spark, sf))


@query
def boundary_select(spark, sf):
    return finality.within(_state(spark, sf), finality.boundary(_final(spark, sf))).select("asset_id", "cycle_index", "event_count")


@query
def generation_asof(spark, sf):
    dim = spark.createDataFrame([(k, c) for k, c in enumerate([*domain.CUTOFFS, "2100-01-01"], 1)], "generation int, c string").select("generation", F.col("c").cast("timestamp_ntz").alias("cutoff"))
    return cohort.generation_asof(domain.cycles(spark, sf), dim, "cycle_time").select("asset_id", "cycle_index", "generation")


@query
def cumulative_generation(spark, sf):
    own = _generations(spark, sf).join(_state(spark, sf).select("asset_id", "cycle_index"), ["asset_id", "cycle_index"]).groupBy("generation").agg(F.count("*").alias("n"))
    each = own.select("n", F.explode(F.sequence(F.col("generation"), F.lit(4))).alias("generation"))
    return each.groupBy("generation").agg(F.sum("n").alias("features"))


@query
def new_keys(spark, sf):
    all_rows = _generations(spark, sf).join(_state(spark, sf).select("asset_id", "cycle_index"), ["asset_id", "cycle_index"])
    return all_rows.select("asset_id", "cycle_index").join(all_rows.where("generation <= 2").select("asset_id", "cycle_index"), ["asset_id", "cycle_index"], "left_anti")


@query
def conflict_rows(spark, sf):
    old = _state(spark, sf).select("asset_id", "cycle_index", "max_voltage", "max_capacity")
    new = old.withColumn("max_voltage", F.when(F.col("asset_id") % 10 == 3, F.least("max_voltage", F.lit(40.0))).otherwise(F.col("max_voltage")))
    return merge.conflicts(old, new, ["asset_id", "cycle_index"])


@query
def arrival_rank(spark, sf):
    return cohort.arrival_rank(domain.manifest(spark, sf)).select("asset_id", "arrival_rank")


@query
def train_schedule(spark, sf):
    rows = cohort.arrival_rank(domain.manifest(spark, sf).where("split = 'train'"))
    return rows.select("asset_id", "arrival_rank", cohort.arrival_text("2024-01-01", 60).alias("arrival_time"))


@query
def replay_sequence(spark, sf):
    return cohort.replay_sequence(domain.samples(spark, sf), "event_time", "asset_id", "cycle_index", "sample_index").select("asset_id", "cycle_index", "sample_index", "replay_sequence")


@query
def completion_events(spark, sf):
    return _text_times(cohort.completion_events(domain.samples(spark, sf)), "event_time")


@query
def cohort_at_cutoff(spark, sf):
    return cohort.at_cutoff(_cohort(spark, sf), _cutoff()).select("asset_id", "arrival_rank", "observed")


@query
def cohort_counts(spark, sf):
    return _text_times(cohort.counts_at(_cohort(spark, sf), list(domain.CUTOFFS)), "cutoff")


@query
def eligible_assets(spark, sf):
    return cohort.eligible(domain.manifest(spark, sf), _flags(spark, sf)).select("asset_id")


@query
def split_audit(spark, sf):
    return cohort.split_audit(domain.manifest(spark, sf))


@query
def lineage_split(spark, sf):
    return cohort.lineage_split(domain.manifest(spark, sf))


@query
def irreversible_eol(spark, sf):
    return _served(spark, sf).select("asset_id", "cycle_index", "raw_rul", "rul", "eol_cycle")


@query
def eol_violations(spark, sf):
    return predict.eol_violations(domain.predictions(spark, sf).select("asset_id", "cycle_index", F.greatest("raw_rul", F.lit(0.0)).alias("rul")))


@query
def monotone_curve(spark, sf):
    return _round(predict.monotone(domain.curves(spark, sf)), 6, "served").select("asset_id", "cycle_index", "horizon", "served")


@query
def curve_violations(spark, sf):
    """Curves of two model versions, of which one has horizons beyond the longest."""
    c = domain.curves(spark, sf).withColumn("model_version", F.lit("m1"))
    beyond = F.col("horizon") + F.when(F.col("asset_id") % 5 == 0, 50).otherwise(0)
    return predict.curve_violations(c.unionByName(c.withColumns({"model_version": F.lit("m2"), "horizon": beyond})))


@query
def qc_report(spark, sf):
    return quality.report(domain.samples(spark, sf), domain.cycles(spark, sf))


@query
def cycles_histogram(spark, sf):
    return quality.histogram_of_counts(domain.cycles(spark, sf), "asset_id")


@query
def duplicate_keys(spark, sf):
    return quality.duplicates(domain.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def order_violations(spark, sf):
    return quality.order_violations(domain.table(spark, sf, "orders"), "o_custkey", "o_orderkey", ["o_orderdate"]).select("o_orderkey", "o_custkey")


@query
def group_total_diff(spark, sf):
    c = domain.cycles(spark, sf)
    return quality.total_differences(c, c.where("asset_id % 17 <> 0"), "asset_id")


@query
def coverage_check(spark, sf):
    curves = domain.curves(spark, sf)
    served = curves.where("asset_id % 9 <> 0 and (asset_id % 9 <> 1 or horizon < 200)")
    found = quality.coverage(curves.select("asset_id", "cycle_index").distinct(), served, (0, 50, 100, 150, 200))
    return found.withColumn("served_cycle", F.col("served_cycle").cast("double"))


@query
def table_violations(spark, sf):
    return quality.violations(domain.table(spark, sf, "orders"), {"price_positive": F.col("o_totalprice") > 0, "status_known": F.col("o_orderstatus").isin("O", "F"), "customer_present": F.col("o_custkey").isNotNull()})


def _current(spark, sf, new: bool) -> DataFrame:
    newest = domain.cycles(spark, sf).groupBy("asset_id").agg(F.max("cycle_index").alias("cycle_index"))
    even, third = F.col("asset_id") % 2 == 0, F.col("asset_id") % 3 == 0
    if not new:
        return newest.select("asset_id", "cycle_index", F.lit(100).cast("bigint").alias("sequence"), F.lit("s").alias("state_id"), F.lit(1).alias("revision"), F.lit("old").alias("source"))
    return newest.select("asset_id", (F.col("cycle_index") + F.when(even, 1).otherwise(0)).alias("cycle_index"), F.when(even, 200).when(third, 100).otherwise(50).cast("bigint").alias("sequence"), F.lit("s").alias("state_id"), F.lit(2).alias("revision"), F.lit("new").alias("source"))


@query
def current_upsert(spark, sf):
    return merge.merge_keyed(_current(spark, sf, False), _current(spark, sf, True), ["asset_id"], merge.newer_sequence()).select("asset_id", "sequence", "source")


@query
def survival_upsert(spark, sf):
    """Only rows of the current state and selection are merged."""
    dataset = F.when(F.col("asset_id") % 5 == 0, "other").otherwise("fleet")
    tagged = [_current(spark, sf, new).withColumns({"dataset": dataset, "model_version": F.lit("s1"), "fingerprint": F.lit("f1")}) for new in (False, True)]
    one = domain.table(spark, sf, "region").where("r_regionkey = 0")
    states = one.select(F.lit("fleet").alias("dataset"), F.lit("s").alias("state_id"))
    selections = one.select(F.lit("fleet").alias("dataset"), F.lit("s1").alias("model_version"), F.lit("f1").alias("fingerprint"), F.lit(2).alias("revision"))
    new = current.guarded(tagged[1], states, selections)
    return merge.merge_keyed(tagged[0], new, ["asset_id"], merge.newer_curve()).select("asset_id", "cycle_index", "source")


@query
def selection_revision(spark, sf):
    c = domain.table(spark, sf, "customer")
    was = c.where("c_custkey % 4 <> 0").select(F.col("c_custkey").cast("string").alias("dataset"), F.lit("m1").alias("model_version"), F.when(F.col("c_custkey") % 5 != 0, "f1").alias("fingerprint"), (F.col("c_custkey") % 7).alias("revision"))
    fingerprint = F.when(F.col("c_custkey") % 10 != 0, F.concat(F.lit("f"), F.col("c_custkey") % 2 + F.col("c_custkey") % 11 % 2 + 1))
    wanted = c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").cast("string").alias("dataset"), F.when(F.col("c_custkey") % 2 == 0, "m1").otherwise("m2").alias("model_version"), fingerprint.alias("fingerprint"))
    return merge.bumped_selection(was, wanted)


def _evaluations(spark, sf) -> DataFrame:
    c = domain.table(spark, sf, "customer")
    status = F.element_at(F.array(*map(F.lit, ("candidate", "champion", "retired"))), (F.col("c_custkey") % 3 + 1).cast("int"))
    return c.select(F.concat(F.lit("m"), "c_custkey").alias("model_version"), F.col("c_nationkey").cast("string").alias("dataset"), status.alias("status"), F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("f"), "c_custkey")).alias("fingerprint"), (F.col("c_custkey") % 11).alias("evaluated_at"), F.lit("v1").alias("feature_contract"), (F.col("c_acctbal")).alias("mae"))


@query
def initialised_selection(spark, sf):
    own = domain.table(spark, sf, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").cast("string").alias("dataset"), F.lit("kept").alias("model_version"), F.lit("f").alias("fingerprint"), F.lit(4).alias("revision"))
    models = _evaluations(spark, sf)
    return current.initialised(own, models, models)


@query
def model_selection(spark, sf):
    models = _evaluations(spark, sf)
    chosen = models.where("status = 'champion'").select("dataset", "model_version", F.when(F.col("evaluated_at") % 2 == 0, F.col("fingerprint")).otherwise("other").alias("fingerprint"))
    return current.selection(chosen, models).select("model_version", "usable")


@query
def best_model(spark, sf):
    return serving.best_model(serving.selectable_models(_generation_models(spark, sf))).select("model_version")


@query
def newest_evaluation(spark, sf):
    return serving.newest_evaluation(_evaluations(spark, sf)).select("model_version")


@query
def frozen_scores(spark, sf):
    """Newest scores on top of those served up to generation 3."""
    prior = features.latest(_served(spark, sf).join(_generations(spark, sf).where("generation <= 3").select("asset_id", "cycle_index"), ["asset_id", "cycle_index"])).select("asset_id", "rul", "eol_cycle")
    newest = features.latest(domain.predictions(spark, sf))
    return current.frozen_scores(newest.select("asset_id", "cycle_index", (F.col("raw_rul") + 6).alias("raw_rul")), prior).select("asset_id", "cycle_index", "rul", "eol_cycle")


@query
def replaced_version(spark, sf):
    old = domain.predictions(spark, sf).select(F.when(F.col("asset_id") % 2 == 0, "m0").otherwise("m1").alias("model_version"), "asset_id", "cycle_index", "raw_rul")
    new = domain.predictions(spark, sf).where("asset_id % 4 = 1").select(F.lit("m1").alias("model_version"), "asset_id", "cycle_index", (F.col("raw_rul") + 1).alias("raw_rul"))
    return current.replaced_version(old, new)


@query
def serving_statuses(spark, sf):
    ids = domain.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("state_id"), (F.col("c_custkey") % 4).alias("k"))
    results = ids.select(F.lit("fleet").alias("dataset"), "state_id", F.lit("rul").alias("consumer"), F.when(F.col("k") > 0, F.col("k")).alias("revision"), F.when(F.col("k") == 1, F.col("k") * 10).alias("rows_written"), F.when(F.col("k") == 2, "lost").alias("error"))
    out = current.status_rows(results)
    return out.withColumn("serve", current.must_serve(F.col("status"), F.col("rows_written"), F.lit(10), F.col("state_id") != "5")).select("state_id", "revision", "status", "rows_written", "error", "serve")


@query
def newest_final(spark, sf):
    rows = _state(spark, sf).select("asset_id", "cycle_index", "event_count", (F.col("cycle_index") % 3).alias("sequence"))
    return current.newest_final(rows, _final(spark, sf), domain.manifest(spark, sf).where("split = 'test'")).select("asset_id", "cycle_index", "event_count")


@query
def serving_predictions(spark, sf):
    return serving.serving_predictions(_served(spark, sf).select(F.lit("m").alias("model_version"), "asset_id", "cycle_index", "rul"))


@query
def serving_cycles(spark, sf):
    return _round(serving.serving_cycles(_features(spark, sf)), 6, "capacity_slope", "efficiency", "resistance")


@query
def serving_evaluations(spark, sf):
    models = _evaluations(spark, sf).select("model_version", "status", F.concat(F.lit("2024-01-"), F.lpad((F.col("evaluated_at") + 1).cast("string"), 2, "0")).alias("evaluated_at"), F.lit("{}").alias("metrics_json"), "fingerprint")
    return _text_times(serving.serving_evaluations(models), "evaluated_at").select("model_version", "status", "evaluated_at", "training_metadata", "fingerprint", "generation")


@query
def cycle_labels(spark, sf):
    c = domain.cycles(spark, sf).join(domain.manifest(spark, sf).select("asset_id", "eol_cycle"), "asset_id")
    width = F.when(F.col("asset_id") % 2 == 0, 0.8).otherwise(0.0)
    rows = c.withColumns({"capacity": F.col("o_totalprice"), "nominal_capacity": F.lit(250000.0), "soc_start": F.lit(0.0), "soc_end": width})
    out = predict.labels(rows).withColumn("percent", serving.soh_percent(F.col("soh")))
    return out.select("asset_id", "cycle_index", F.col("rul_cycles").cast("double").alias("rul_cycles"), "percent")


@query
def family_labels(spark, sf):
    name = F.when(F.col("p_partkey") % 7 == 0, "xgboost").when(F.col("p_partkey") % 7 == 1, "random_survival_forest").otherwise(F.concat(F.col("p_type"), F.lit("_by-spark 2x")))
    return domain.table(spark, sf, "part").select("p_partkey", serving.family_label(name).alias("label"))


@query
def survival_metrics(spark, sf):
    ids = domain.cycles(spark, sf).select("asset_id").distinct()
    brier = F.create_map(F.lit("50"), F.lit(0.1), F.lit("100"), (F.col("asset_id") % 9 / 8.0))
    doc = F.to_json(F.struct(F.struct(F.when(F.col("asset_id") % 3 != 0, F.col("asset_id") % 5 / 4.0).alias("integrated_brier_score"), (F.col("asset_id") % 2 / 2.0).alias("ipcw_c_index"), brier.alias("horizon_brier")).alias("test")))
    return serving.survival_metrics(ids.select(F.concat(F.lit("m"), "asset_id").alias("model_version"), doc.alias("metrics_json")))


@query
def survival_winner(spark, sf):
    return serving.survival_winner(survival_metrics(spark, sf).withColumn("rank", F.lit(0))).select("model_version", "ibs", "c_index")


@query
def generalisation_gap(spark, sf):
    rows = domain.predictions(spark, sf).join(domain.manifest(spark, sf), "asset_id").withColumn("truth", (F.col("last_source_cycle") - F.col("cycle_index")).cast("double"))
    return _round(predict.generalisation_gap(predict.regression_metrics(rows, ["split"], predicted="raw_rul")), 6, "test_validation", "test_train")


@query
def arrival_manifest(spark, sf):
    return _text_times(_arrivals(spark, sf), "start_time").select("asset_id", "arrival_rank", "start_time", "last_source_cycle", F.col("eol_cycle").cast("double").alias("eol_cycle"), F.col("eol_cycle_delta").cast("double").alias("eol_cycle_delta"), "label_status", "valid_eol_label")


@query
def scheduled_lifecycle(spark, sf):
    return _text_times(cohort.lifecycle_events(_arrivals(spark, sf)), "event_time").select("asset_id", "event_type", "cycle_index", "event_time")


@query
def nth_arrival(spark, sf):
    ranked = cohort.scheduled(cohort.arrival_rank(domain.manifest(spark, sf).where("split = 'train'")), EPOCH, 60)
    return _text_times(cohort.nth_arrival(ranked, 26), "arrival_time")


@query
def asof_keys(spark, sf):
    return cohort.asof_keys(domain.cycles(spark, sf), _arrivals(spark, sf), _seen())


@query
def bound_lifecycle(spark, sf):
    m = domain.manifest(spark, sf)
    return cohort.with_cohort(_flags(spark, sf), m.where("split = 'train'"), m.where("split = 'train' and asset_id % 4 = 1"))


@query
def split_counts(spark, sf):
    c = domain.table(spark, sf, "customer").select(F.col("c_custkey").alias("asset_id"), "c_mktsegment")
    return cohort.split_counts(domain.manifest(spark, sf).join(c, "asset_id"), "c_mktsegment", "valid_eol_label")


@query
def merged_flags(spark, sf):
    """Two batches of lifecycle flags as one."""
    ends = domain.lifecycle(spark, sf).where("event_type <> 'cycle_complete'")
    return _text_times(aggregate.merged_flags(aggregate.lifecycle_flags(ends.where("event_type = 'eol_observed'")), aggregate.lifecycle_flags(ends.where("event_type = 'replay_complete'"))), "eol_time", "replay_time")


@query
def folded_lifecycle(spark, sf):
    """Events of some assets, stored states of the others."""
    events = domain.lifecycle(spark, sf).where("event_type <> 'cycle_complete' and asset_id % 2 = 0").select("asset_id", "event_type")
    states = _flags(spark, sf).where("asset_id % 2 = 1").select("asset_id", "eol_observed", "replay_complete")
    return aggregate.folded_lifecycle(events.unionByName(states, allowMissingColumns=True))


@query
def replay_cutoff(spark, sf):
    return aggregate.cutoff_text(domain.samples(spark, sf))


def _sources(spark, sf) -> DataFrame:
    """Completions with the place in the source that line items of their cycle have."""
    line = domain.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.lit("lifecycle").alias("topic"), (F.col("l_suppkey") % 3).cast("int").alias("partition"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("offset"))
    return domain.cycles(spark, sf).select("asset_id", "cycle_index", "o_orderkey").join(line, "o_orderkey").drop("o_orderkey")


@query
def offset_map(spark, sf):
    out = aggregate.offset_map(aggregate.offset_watermarks(_sources(spark, sf)))
    return out.select("topic", F.array_join(F.transform(F.map_entries("offsets"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("offsets"))


@query
def beyond_watermarks(spark, sf):
    """Completions ahead of the offsets of the partitions that were read in part."""
    own = _sources(spark, sf)
    return aggregate.beyond_watermarks(own, aggregate.offset_watermarks(own.where("partition < 2 and cycle_index <= 8"))).select("asset_id", "cycle_index", "partition", "offset")


def _envelopes(spark, sf) -> DataFrame:
    """Telemetry and lifecycle events of the fleet as they are sent; every key's offsets are its own."""
    stamp = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("event_time")
    telemetry = domain.samples(spark, sf).select("event_id", "asset_id", "cycle_index", "sample_index", stamp, "voltage", "capacity", "charge_capacity", "temperature", "source_time")
    life = domain.lifecycle(spark, sf).select(F.concat_ws(":", "event_type", "asset_id", "cycle_index").alias("event_id"), "event_type", "asset_id", "cycle_index", stamp, "expected_telemetry_rows")
    both = telemetry.unionByName(life, allowMissingColumns=True)
    place = {"partition": F.pmod("asset_id", F.lit(3)).cast("int"), "offset": F.col("asset_id") * 10_000 + F.col("cycle_index") * 100 + F.coalesce("sample_index", F.lit(99))}
    sent = normalize.encode_events(both.withColumns(place))
    at = F.inline(F.array(F.from_json("value", "partition int, offset bigint")))
    return sent.select("topic", "key", F.col("value").cast("binary").alias("value"), at)


@query
def event_routing(spark, sf):
    """What arrives of each kind, by topic."""
    return normalize.event_kinds(_envelopes(spark, sf)).groupBy("topic", "kind").agg(F.count("*").alias("events"))


@query
def required_split(spark, sf):
    rows = _fleet(spark, sf).select("asset_id", F.when(F.col("asset_id") % 3 != 0, F.col("name")).alias("name"), F.when(F.col("asset_id") % 5 != 0, F.col("rul")).alias("rul"))
    return contracts.split_required(rows, ["asset_id", "name", "rul"])[1].select("asset_id", F.array_join("missing", ",").alias("missing"))


@query
def bad_keys(spark, sf):
    rows = _fleet(spark, sf).select("asset_id", F.when(F.col("asset_id") % 4 != 0, "fleet").otherwise(F.when(F.col("asset_id") % 8 == 0, "")).alias("dataset"), (F.col("asset_id") % 3).alias("cycle_index"))
    return contracts.bad_keys(rows, ["dataset"]).select("asset_id")


@query
def not_prefix(spark, sf):
    return contracts.not_prefix(_ready(spark, sf).where("ready"), domain.cycles(spark, sf))


@query
def boundary_faults(spark, sf):
    bounds = finality.boundary(_final(spark, sf).withColumn("replay_sequence", F.col("cycle_index") - F.col("asset_id") % 5))
    return contracts.boundary_faults(bounds.withColumn("cycles", F.col("cycles") + F.when(F.col("asset_id") % 10 == 7, 1).otherwise(0)))


@query
def cohort_faults(spark, sf):
    rows = cohort.at_cutoff(_cohort(spark, sf), _cutoff())
    return contracts.cohort_faults(rows.where("asset_id % 11 <> 0"), rows.where("observed or asset_id % 6 = 0"), rows.where("not observed and asset_id % 8 <> 0"))


@query
def load_faults(spark, sf):
    c = domain.cycles(spark, sf).select("asset_id", "cycle_index")
    return contracts.load_faults(c.where("asset_id % 19 <> 0"), ["asset_id", "cycle_index"], c.where("asset_id % 17 <> 0"))


@query
def published_predictions(spark, sf):
    one = domain.table(spark, sf, "region").where("r_regionkey = 0")
    return contracts.publish_predictions(domain.predictions(spark, sf), one).select("asset_id", "cycle_index", "rul", "eol_cycle")


@query
def cohort_checksums(spark, sf):
    return snapshots.cohort_checksums(cohort.at_cutoff(_cohort(spark, sf), _cutoff()))


@query
def generation_plan(spark, sf):
    state = finality.state_id(finality.boundary(_final(spark, sf)))
    out = snapshots.plan("1.2", cohort.at_cutoff(_cohort(spark, sf), _cutoff()), state, "features-v1", "ridge|forest")
    return out.select("generation", "state_id", "training_assets", "fingerprint")


@query
def generation_receipt(spark, sf):
    rows = _state(spark, sf).select("asset_id", "cycle_index", "event_count").join(_generations(spark, sf).select("asset_id", "cycle_index", F.col("generation").alias("generation_id")), ["asset_id", "cycle_index"])
    chosen = snapshots.selected(rows, 3, finality.boundary(_final(spark, sf))).drop("generation_id")
    found = snapshots.receipt(chosen, 3, "state", "features-v1")
    snapshots.verified(chosen, found)
    return found.select("generation_id", "selected_rows", "selected_digest")


@query
def benchmark_record(spark, sf):
    return snapshots.benchmark_record(_state(spark, sf).select("asset_id", "cycle_index", "event_count"), domain.manifest(spark, sf))


@query
def published_counts(spark, sf):
    docs = domain.table(spark, sf, "customer").select(F.when(F.col("c_custkey") % 3 != 0, F.to_json(F.struct((F.col("c_custkey") % 50).alias("training_battery_count")))).otherwise("{}").alias("training_metadata_json"))
    return snapshots.published_counts(docs)


@query
def single_values(spark, sf):
    o = domain.table(spark, sf, "orders").withColumn("always", F.col("o_orderkey") * 0 + 7)
    return quality.single_value(o, "always").unionByName(quality.single_value(o, "o_custkey")).withColumn("value", F.col("value").cast("double"))


@query
def curve_count(spark, sf):
    return domain.curves(spark, sf).select("asset_id", "cycle_index").distinct().agg(F.count("*").alias("curves"))


@query
def seeded_outlet(spark, sf):
    own = _state(spark, sf).select("asset_id", "cycle_index", "max_capacity").join(_generations(spark, sf).select("asset_id", "cycle_index", "generation"), ["asset_id", "cycle_index"])
    snapshots_of = own.withColumn("generation_id", F.explode(F.sequence("generation", F.lit(4)))).drop("generation")
    return outlet.seeded(snapshots_of)




@query
def prune_stale(spark, sf):
    newest = finality.boundary(_final(spark, sf)).select("asset_id", F.col("max_cycle").alias("cycle_index"))
    return merge.without_stale(domain.curves(spark, sf), newest, ["asset_id", "cycle_index"]).select("asset_id", "horizon")


@query
def regression_metrics(spark, sf):
    return _round(_metrics(spark, sf), 6, "mae", "rmse", "r2")


@query
def model_winner(spark, sf):
    best = predict.winner(_metrics(spark, sf), ["split"], [F.col("mae"), F.col("rmse"), F.col("stage")])
    return _round(best, 6, "mae").select("split", "stage", "mae")


@query
def landmark_rows(spark, sf):
    return _land(spark, sf)


@query
def landmark_sample(spark, sf):
    return survival.landmark_sample(_land(spark, sf)).select("asset_id", "cycle_index", "split")


@query
def censoring_km(spark, sf):
    return _round(survival.censoring(_land(spark, sf).where("split = 'train'")), 6, "survival")


def _scored(rows: DataFrame) -> DataFrame:
    return rows.where("split = 'test'").withColumn("horizon", F.explode(F.array(*map(F.lit, (2, 5, 8))))).withColumn("probability", F.exp(-F.col("horizon") / 10.0))


@query
def ipcw_brier(spark, sf):
    rows = _land(spark, sf)
    return _round(survival.brier(rows.where("split = 'train'"), _scored(rows), (2, 5, 8)), 6, "brier")


@query
def integrated_brier(spark, sf):
    rows = _land(spark, sf)
    return _round(survival.integrated_brier(rows.where("split = 'train'"), _scored(rows), (2, 5, 8)), 6, "integrated_brier").select("integrated_brier", "supported_rows", "excluded_rows")


@query
def landmark_counts(spark, sf):
    return survival.landmark_counts(_land(spark, sf))


@query
def latest_landmarks(spark, sf):
    return survival.latest_landmarks(_land(spark, sf)).select("asset_id", "cycle_index", "duration")


def _view(spark, sf) -> DataFrame:
    """Two datasets, by asset, of which one has a selected model."""
    dataset = F.when(F.col("asset_id") % 3 == 0, "a").otherwise("b").alias("dataset")
    predictions = _served(spark, sf).select(dataset, "asset_id", "cycle_index", F.concat(F.lit("m"), F.col("asset_id") % 2).alias("model_version"), "rul")
    selection = domain.table(spark, sf, "region").where("r_regionkey = 0").select(F.lit("a").alias("dataset"), F.lit("m1").alias("model_version"))
    return serving.latest_view(domain.cycles(spark, sf).select(dataset, "asset_id", "cycle_index"), selection, predictions)


@query
def latest_dashboard(spark, sf):
    return _view(spark, sf)


def _survival(spark, sf) -> DataFrame:
    own = domain.curves(spark, sf).withColumns({"dataset": F.when(F.col("asset_id") % 3 == 0, "a").otherwise("b"), "model_version": F.lit("s1"), "fingerprint": F.when(F.col("asset_id") % 5 == 0, "old").otherwise("f1"), "revision": F.lit(1)})
    return own.withColumn("cycle_index", F.col("cycle_index") - F.when(F.col("asset_id") % 7 == 0, 1).otherwise(0))


@query
def survival_view(spark, sf):
    chosen = domain.table(spark, sf, "region").where("r_regionkey < 2").select(F.element_at(F.array(F.lit("a"), F.lit("b")), F.col("r_regionkey") + 1).alias("dataset"), F.lit("s1").alias("model_version"), F.lit("f1").alias("fingerprint"), F.lit(1).alias("revision"))
    return _round(current.model_view(_view(spark, sf), chosen, _survival(spark, sf)), 6, "survival").select("asset_id", "cycle_index", "rul", "survival")


@query
def current_curve(spark, sf):
    newest = domain.cycles(spark, sf).groupBy("asset_id").agg(F.max("cycle_index").alias("cycle_index"))
    return current.current_curve(_survival(spark, sf), newest).select("asset_id", "horizon")


@query
def fleet_survival(spark, sf):
    """The fleet with its survival at 100 where there is one, and its figures."""
    at = _survival(spark, sf).where("horizon = 100 and asset_id % 5 <> 0").select("asset_id", F.col("probability").alias("survival"))
    figures = serving.fleet_kpis(_fleet(spark, sf).join(at, "asset_id", "left"))
    return _round(figures, 6, "median_survival", "p25_survival").select("assets", "median_survival", "p25_survival")


@query
def null_safe_status(spark, sf):
    ids = domain.cycles(spark, sf).select("asset_id").distinct()
    selected = ids.where("asset_id % 4 <> 1").select("asset_id", (F.col("asset_id") % 4).alias("revision"))
    statuses = ids.where("asset_id % 4 < 2").select("asset_id", F.when(F.col("asset_id") % 8 != 1, F.lit(0)).cast("bigint").alias("revision"), F.when(F.col("asset_id") % 4 == 0, "ok").otherwise("none").alias("status"))
    return serving.null_safe_status(ids, statuses, selected).select("asset_id", "status")


@query
def fleet_kpis(spark, sf):
    return _round(serving.fleet_kpis(_fleet(spark, sf)), 6, "mean_health", "median_health", "median_rul", "p25_rul")


@query
def soh_histogram(spark, sf):
    return serving.histogram(_fleet(spark, sf), "health", 5)


@query
def risk_filter(spark, sf):
    return serving.risk_filter(_fleet(spark, sf), "1", health=60.0, rul=3.0).select("asset_id")


@query
def bottom_k(spark, sf):
    return _round(serving.lowest(_fleet(spark, sf), "health", "asset_id", 25).select("asset_id", "health"), 6, "health")


@query
def metric_json_flatten(spark, sf):
    return serving.flat_metrics(_models(spark, sf)).select("model_version", "mae", "rmse")


@query
def family_metrics(spark, sf):
    return serving.family_rows(serving.flat_metrics(_models(spark, sf)))


@query
def metric_unpivot(spark, sf):
    return serving.long_metrics(serving.flat_metrics(_models(spark, sf)), ["mae", "rmse"])


@query
def colour_scores(spark, sf):
    return _round(serving.colour_scores(_fleet(spark, sf), "health"), 6, "score").select("asset_id", "score")


@query
def lifecycle_stage(spark, sf):
    return _served(spark, sf).select("asset_id", "cycle_index", predict.predicted_stage(F.col("cycle_index"), F.when(F.col("asset_id") % 5 != 1, F.col("rul"))).alias("stage"))


@query
def ragged_zip(spark, sf):
    records = normalize.nested(domain.samples(spark, sf), ["voltage", "temperature"])
    short = F.transform("cycle_data", lambda c: F.struct(c["cycle_number"].alias("cycle_number"), c["voltage"].alias("voltage"), F.slice(c["temperature"], 1, 3).alias("temperature")))
    return normalize.ragged_zip(records.withColumn("cycle_data", short), ["voltage", "temperature"])


@query
def limit_per_asset(spark, sf):
    return cohort.limited(domain.samples(spark, sf), 5, without=[7, 11], total=400).select("asset_id", "cycle_index", "sample_index")


@query
def event_json_roundtrip(spark, sf):
    sent = normalize.encode_events(domain.samples(spark, sf).withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss")))
    broken = F.when(F.col("key").cast("bigint") % 6 == 5, F.substring("value", 1, 20)).otherwise(F.col("value"))
    return normalize.decode_events(sent.withColumn("value", broken.cast("binary"))).select("asset_id", "cycle_index", "sample_index", "voltage")


@query
def provenance(spark, sf):
    o = domain.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("source_file"), "o_orderkey", F.sha2(F.concat_ws(":", "o_custkey", "o_orderdate"), 256).alias("fingerprint"))
    roots = o.where("o_orderkey % 10 = 0").select("source_file", F.lit("root").alias("root"))
    return normalize.provenance(o.drop("o_orderkey"), roots).select("source_file", "lineage_group_id")


@query
def duplicate_labels(spark, sf):
    c = domain.table(spark, sf, "customer")
    models = c.select(F.col("c_custkey").alias("asset_id"), F.col("c_mktsegment").alias("label"), F.sha2(F.col("c_custkey").cast("string"), 256).alias("fingerprint"))
    return serving.distinct_labels(models).select("asset_id", "display")


@query
def row_digest(spark, sf):
    return merge.digest(_state(spark, sf).select("asset_id", "cycle_index", "event_count"), ["asset_id", "cycle_index"])


@query
def boundary_state_id(spark, sf):
    return finality.state_id(finality.boundary(_final(spark, sf)))


@query
def outlet_key_ranges(spark, sf):
    return outlet.key_ranges(_state(spark, sf))


@query
def outlet_beyond(spark, sf):
    """What is new after generation 2, by the ledger's maxima alone."""
    own = _generations(spark, sf).join(_state(spark, sf).select("asset_id", "cycle_index"), ["asset_id", "cycle_index"])
    ledger = outlet.key_ranges(own.where("generation <= 2"))
    return outlet.beyond(own.select("asset_id", "cycle_index"), outlet.key_maxima(ledger))


@query
def outlet_cumulative(spark, sf):
    rows = _state(spark, sf).select("asset_id", "cycle_index", "max_capacity").join(_generations(spark, sf).select("asset_id", "cycle_index", F.col("generation").alias("generation_id")), ["asset_id", "cycle_index"])
    out = outlet.cumulative(rows, 3, domain.cycles(spark, sf), finality.boundary(_final(spark, sf)))
    return out.select("asset_id", "cycle_index", "generation_id", "max_capacity", "o_orderkey")


@query
def superset_violations(spark, sf):
    """A later snapshot that lost a tenth of an earlier one's keys and changed another tenth."""
    old = _state(spark, sf).select("asset_id", "cycle_index", "max_capacity")
    new = old.where("asset_id % 10 <> 1").withColumn("max_capacity", F.when(F.col("asset_id") % 10 == 2, F.col("max_capacity") + 1).otherwise(F.col("max_capacity")))
    return outlet.not_kept(old, new)


@query
def qc_gate(spark, sf):
    found = quality.report(domain.samples(spark, sf), domain.cycles(spark, sf))
    return quality.gate(found, {"missing_capacity": 0, "negative_current": -1, "max_cycle": 3, "unknown": 1}).select("metric", "expected", F.coalesce("value", F.lit(-9.0)).alias("value"))


@query
def concordance_index(spark, sf):
    rows = _land(spark, sf).withColumn("risk", (F.col("asset_id") * 7919 + F.col("cycle_index") * 104729) % 1009 / 1e6)
    return _round(survival.concordance(rows.where("split = 'train'"), rows.where("split = 'test'")), 6, "c_index").select("c_index")


@query
def nested_reductions(spark, sf):
    records = normalize.nested(domain.samples(spark, sf), ["voltage", "capacity"])
    return normalize.cycle_reductions(records, ["voltage", "capacity"]).select("asset_id", "cycle_index", F.col("samples").cast("bigint").alias("samples"), "max_voltage", "min_voltage", "max_capacity")


@query
def replay_times(spark, sf):
    rows = domain.samples(spark, sf).withColumn("t", normalize.replay_time("2024-01-01", F.col("cycle_index"), F.col("sample_index").cast("double")))
    return _text_times(rows.select("asset_id", "cycle_index", "sample_index", "t"), "t")


@query
def next_training_snapshot(spark, sf):
    ranked = cohort.arrival_rank(cohort.eligible(domain.manifest(spark, sf), _flags(spark, sf)))
    return cohort.next_snapshot(ranked, (10, 26, 51), [10]).select("asset_id", F.col("position").cast("bigint").alias("position"))


def _generation_models(spark, sf) -> DataFrame:
    c = domain.table(spark, sf, "customer")
    status = F.when(F.col("c_custkey") % 6 == 5, "retired").when(F.col("c_custkey") % 7 == 0, "champion").otherwise("candidate")
    return c.select(F.concat(F.lit("m"), "c_custkey").alias("model_version"), (F.col("c_custkey") % 8).alias("generation"), (F.col("c_custkey") % 3).alias("record_class"), F.when(F.col("c_custkey") % 5 == 0, "neutral").otherwise("tree").alias("family"), status.alias("status"), F.col("c_custkey").alias("evaluated_at"), F.col("c_acctbal").alias("mae"))


@query
def selectable_models(spark, sf):
    """With a current model that isn't its generation's best; a current one that is retired changes nothing."""
    models = _generation_models(spark, sf)
    first, second = (serving.selectable_models(models, name).select("generation", "model_version", F.lit(name).alias("chosen")) for name in ("m9", "m11"))
    return first.unionByName(second)


def _scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share."""
    import uuid

    from fleetmill.sources.store import shared_folder

    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def _sent_twice(sent: DataFrame, folder: str) -> DataFrame:
    """The envelopes as a stream of a few batches, every one of them in two of four files."""
    part = F.explode(F.array(F.pmod(F.xxhash64("value"), F.lit(4)), F.pmod(F.xxhash64("value") + 1, F.lit(4)))).alias("file")
    sent.select("*", part).repartition(4, "file").drop("file").write.parquet(f"{folder}/in")
    return sent.sparkSession.readStream.schema(sent.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")


@query
def stream_cycle_aggregates(spark, sf):
    """The stream's final cycles, of telemetry that arrives in several batches with repeats."""
    from fleetmill.streaming import stream

    folder = _scratch(spark)
    s = domain.samples(spark, sf).withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss"))
    source = _sent_twice(normalize.encode_events(s.select("event_id", "asset_id", "cycle_index", "sample_index", "event_time", "voltage")), folder)
    store, expected = stream.CycleStore(spark, f"{folder}/state"), f"{folder}/expected"
    _complete(spark, sf).write.parquet(expected)
    stream.run(source, store, lambda: spark.read.parquet(expected), f"{folder}/checkpoint").awaitTermination()
    return _round(store.finals(), 6, "average_voltage").select("asset_id", "cycle_index", "event_count", "average_voltage")


@query
def stream_finalized(spark, sf):
    """The boundary of the latest state that a stream of telemetry and lifecycle events publishes."""
    from fleetmill.streaming import publish, stream

    folder = _scratch(spark)
    source = _sent_twice(_envelopes(spark, sf), folder)
    domain.cycles(spark, sf).select("asset_id", "cycle_index").write.parquet(f"{folder}/canonical")
    out = publish.Publication(spark, f"{folder}/published", spark.read.parquet(f"{folder}/canonical"), lambda time: cohort.generation(time.cast("timestamp_ntz"), domain.CUTOFFS))
    stream.started(source, out.process, f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/published/boundaries/{out.latest()}")


@query
def rul_fit_score(spark, sf):
    """The winner of the grid without its unbounded forest, which takes minutes."""
    from fleetmill.operators import models

    rows = _features(spark, sf).join(domain.manifest(spark, sf), "asset_id").withColumn("label", F.when(F.col("valid_eol_label"), F.greatest(F.col("eol_cycle") - F.col("cycle_index"), F.lit(0)).cast("double")))
    return models.select(rows, [name for name in models.candidates(1) if name != "forest_unbounded"])[2]


@query
def aft_curves(spark, sf):
    from fleetmill.operators import models

    land = _land(spark, sf).withColumn("x", F.col("cycle_index").cast("double"))
    newest = features.latest(domain.cycles(spark, sf)).select("asset_id", F.col("cycle_index").cast("double").alias("x"))
    return models.survival_curves(land.where("split = 'train'"), newest, ["x"], list(range(0, 201, 10))).select("asset_id", "horizon", "probability")


@query
def survival_selection(spark, sf):
    """Survival fits by two sets of features, judged on validation rows; the winner first."""
    from fleetmill.operators import models

    land = _land(spark, sf).withColumns({"x": F.col("cycle_index").cast("double"), "y": (F.col("asset_id") % 7).cast("double")})
    return models.survival_select(land, {"cycle": ["x"], "cycle_and_asset": ["x", "y"]}, (2, 5, 8))


def _records(spark, sf) -> DataFrame:
    """A record an asset, in a file of its own; temperatures end after three samples."""
    cells = normalize.nested(domain.samples(spark, sf), list(ingest.CHANNELS))
    short = F.transform("cycle_data", lambda c: F.struct(c["cycle_number"].alias("cycle_number"), *((F.slice(c[x], 1, 3) if x == "temperature" else c[x]).alias(x) for x in ingest.CHANNELS)))
    name = F.concat(F.lit("cell_b"), F.col("asset_id") % 3 + 1, F.lit("c"), "asset_id", F.lit(".json"))
    return cells.select(name.alias("source_file"), "asset_id", F.lit(50000.0).alias("nominal_capacity"), F.when(F.col("asset_id") % 2 == 0, 2.0).alias("charge_range"), short.alias("cycle_data"))


def _ingested(spark, sf) -> DataFrame:
    """The manifest of the test assets as records: those whose id divides by 4 have no label, those by 5 continue the asset before them."""
    records = _stored(_records(spark, sf))
    labels = domain.manifest(spark, sf).where("asset_id % 4 <> 0").select(F.concat(F.lit("cell_b"), F.col("asset_id") % 3 + 1, F.lit("c"), "asset_id", F.lit(".json")).alias("source_file"), "eol_cycle")
    continued = domain.manifest(spark, sf).where("asset_id % 5 = 0").select("asset_id", (F.col("asset_id") - 1).alias("root"))
    return ingest.ingest(records, labels, continued, _scratch(spark), "fleet", EPOCH)


def _ingested_table(spark, sf, name: str) -> DataFrame:
    home = _ingested(spark, sf).where(F.col("table") == name).first().path
    return spark.read.parquet(home)


@query
def ingest_manifest(spark, sf):
    return _ingested(spark, sf).select("table", "rows")


@query
def ingested_samples(spark, sf):
    return _text_times(_ingested_table(spark, sf, "samples").select("event_id", "voltage", "temperature", "replay_time"), "replay_time")


@query
def ingested_cycles(spark, sf):
    return _ingested_table(spark, sf, "cycles").select("asset_id", "cycle_index", "eol_cycle", "rul", "max_capacity", "health", "min_temperature")


@query
def ingested_provenance(spark, sf):
    return _ingested_table(spark, sf, "provenance").select("source_file", "asset_id", "batch_id", "original_asset_id", "lineage_group_id", "lineage_reason", "provenance_status")


@query
def file_order(spark, sf):
    return quality.file_order_violations(domain.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "_metadata"), ["l_orderkey", "l_linenumber"]).select(F.col("_row").alias("place"), "l_orderkey", "l_linenumber", "l_partkey")


@query
def unsorted_cycles(spark, sf):
    return quality.unsorted_groups(domain.table(spark, sf, "orders").select("o_custkey", "o_orderdate", "_metadata"), "o_custkey", "o_orderdate")


@query
def state_train_rows(spark, sf):
    assets, own = domain.manifest(spark, sf), _features(spark, sf).select("asset_id", "cycle_index", "max_capacity")
    state = own.where("cycle_index <= 3").withColumn("max_capacity", -F.col("max_capacity"))
    arrived = cohort.at_cutoff(assets.withColumn("eol_observed", F.lit(True)), _cutoff())
    return survival.with_state_rows(own, state, assets, arrived)
