"""The catalogue's queries in SQL, over the test tables."""

from __future__ import annotations

VIEWS = """
WITH v_cycles AS (
 SELECT o_custkey AS asset_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS cycle_index,
        o_orderkey, o_orderdate AS cycle_time, o_orderstatus, o_totalprice FROM orders),
v_samples AS (
 SELECT c.asset_id, c.cycle_index,
        CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_quantity, l.l_extendedprice) AS BIGINT) AS sample_index,
        l.l_shipdate AS event_time, l.l_quantity AS voltage, l.l_discount - 0.05 AS current, l.l_tax * 100 AS temperature, l.l_extendedprice AS capacity,
        l.l_extendedprice * (1 - l.l_discount) AS charge_capacity, l.l_quantity * 60 AS source_time, l.l_discount * 10 AS resistance
 FROM lineitem l JOIN v_cycles c ON c.o_orderkey = l.l_orderkey),
v_complete AS (
 SELECT asset_id, cycle_index, max(event_time) AS event_time, count(*) + CASE WHEN asset_id % 5 = 0 AND cycle_index = 4 THEN 1 ELSE 0 END AS expected, count(*) AS n
 FROM v_samples GROUP BY asset_id, cycle_index),
v_flags AS (
 SELECT asset_id, asset_id % 3 <> 0 AS eol_observed, true AS replay_complete, CASE WHEN asset_id % 3 <> 0 THEN max(cycle_time) END AS eol_time, max(cycle_time) AS replay_time
 FROM v_cycles GROUP BY asset_id),
v_manifest AS (
 SELECT c_custkey AS asset_id, c_nationkey AS lineage_group_id,
        CASE WHEN c_nationkey % 5 < 3 THEN 'train' WHEN c_nationkey % 5 = 3 THEN 'validation' ELSE 'test' END AS split,
        n.last_cycle AS last_source_cycle, n.start_time,
        CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE n.last_cycle + CASE WHEN c_custkey % 11 = 0 THEN 2 WHEN c_custkey % 13 = 5 THEN -2 ELSE 0 END END AS eol_cycle,
        (c_custkey % 7 <> 0 AND c_custkey % 11 <> 0) AS valid_eol_label
 FROM customer JOIN (SELECT asset_id, max(cycle_index) AS last_cycle, min(cycle_time) AS start_time FROM v_cycles GROUP BY asset_id) n ON n.asset_id = c_custkey),
v_state AS (
 SELECT asset_id, cycle_index, count(*) AS event_count, sum(voltage) AS voltage_sum, count(voltage) AS voltage_count, sum(current) AS current_sum, max(capacity) AS max_capacity,
        max(charge_capacity) AS max_charge_capacity, max(temperature) AS max_temperature, min(temperature) AS min_temperature, max(voltage) AS max_voltage, min(voltage) AS min_voltage, max(abs(current)) AS max_abs_current, max(source_time) AS charge_time, max(resistance) AS resistance
 FROM v_samples GROUP BY asset_id, cycle_index),
v_features AS (
 SELECT asset_id, cycle_index, max_capacity - lag(max_capacity) OVER w AS capacity_delta, CAST(cycle_index - lag(cycle_index) OVER w AS DOUBLE) AS cycle_gap,
        avg(max_capacity) OVER p AS rolling_capacity_mean, CASE WHEN count(*) OVER p >= 2 THEN regr_slope(max_capacity, CAST(cycle_index AS DOUBLE)) OVER p END AS capacity_slope,
        CASE WHEN lag(cycle_index) OVER w IS NOT NULL THEN max_capacity - first_value(max_capacity) OVER w END AS capacity_since_first,
        max_temperature - min_temperature AS temperature_span, max_capacity / nullif(max_charge_capacity, 0) AS efficiency, charge_time - lag(charge_time) OVER w AS charge_time_delta,
        max_capacity, resistance, max_temperature, charge_time
 FROM v_state WINDOW w AS (PARTITION BY asset_id ORDER BY cycle_index), p AS (PARTITION BY asset_id ORDER BY cycle_index ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING)),
v_ready AS (SELECT asset_id, cycle_index, expected, n, expected = n AS ready FROM v_complete),
v_final AS (
 SELECT asset_id, cycle_index FROM (
  SELECT c.asset_id, c.cycle_index, bool_and(coalesce(r.ready, false)) OVER (PARTITION BY c.asset_id ORDER BY c.cycle_index ROWS UNBOUNDED PRECEDING) AS final
  FROM v_cycles c LEFT JOIN v_ready r USING (asset_id, cycle_index)) WHERE final),
v_boundary AS (SELECT asset_id, max(cycle_index) AS max_cycle, count(*) AS cycles FROM v_final GROUP BY asset_id),
v_generations AS (
 SELECT c.*, CASE WHEN cycle_time <= TIMESTAMP '1996-12-31' THEN 1 WHEN cycle_time <= TIMESTAMP '1998-12-31' THEN 2 WHEN cycle_time <= TIMESTAMP '2000-06-30' THEN 3 ELSE 4 END AS generation FROM v_cycles c),
v_pred AS (
 SELECT asset_id, cycle_index, cycle_time, CAST(12 - cycle_index + asset_id % 3 - 1 + CASE WHEN cycle_index % 4 = 0 THEN 3 ELSE 0 END AS DOUBLE) AS raw_rul FROM v_cycles),
v_first_zero AS (
 SELECT *, min(CASE WHEN greatest(raw_rul, 0) = 0 THEN cycle_index END) OVER (PARTITION BY asset_id ORDER BY cycle_index ROWS UNBOUNDED PRECEDING) AS fz FROM v_pred),
v_served AS (
 SELECT asset_id, cycle_index, raw_rul, CASE WHEN fz IS NOT NULL THEN 0.0 ELSE greatest(raw_rul, 0) END AS rul, CASE WHEN fz IS NOT NULL THEN CAST(fz AS DOUBLE) ELSE cycle_index + greatest(raw_rul, 0) END AS eol_cycle FROM v_first_zero),
v_curves AS (
 SELECT asset_id, cycle_index, h AS horizon, 1.0::DOUBLE - h / 250.0::DOUBLE + CASE WHEN asset_id % 4 = 0 AND h = 100 THEN 0.5::DOUBLE ELSE 0 END AS probability
 FROM (SELECT asset_id, max(cycle_index) AS cycle_index FROM v_cycles GROUP BY asset_id), (SELECT unnest([0, 50, 100, 150, 200]) AS h)),
v_arrival AS (
 SELECT *, TIMESTAMP '2024-01-01' + to_days(CAST(arrival_rank AS INTEGER)) AS starts, eol_cycle - last_source_cycle AS delta, coalesce(eol_cycle - last_source_cycle <= 0, false) AS valid
 FROM (SELECT *, CAST(row_number() OVER (ORDER BY sha256('v1:' || CAST(lineage_group_id AS VARCHAR)), asset_id) - 1 AS BIGINT) AS arrival_rank FROM v_manifest)),
v_shown AS (
 SELECT *, CASE WHEN split <> 'train' THEN last_source_cycle WHEN starts <= TIMESTAMP '2024-03-31 12:00:00' THEN least(last_source_cycle, 1 + CAST(floor(epoch(TIMESTAMP '2024-03-31 12:00:00' - starts) / 86400) AS BIGINT)) END AS shown FROM v_arrival),
v_land AS (
 SELECT asset_id, cycle_index, split, CAST(CASE WHEN event THEN eol_cycle ELSE shown END - cycle_index AS DOUBLE) AS duration, event
 FROM (SELECT c.asset_id, c.cycle_index, s.split, s.eol_cycle, s.shown, coalesce(s.valid AND f.eol_observed AND s.eol_cycle <= s.shown, false) AS event
       FROM v_cycles c JOIN v_shown s USING (asset_id) LEFT JOIN v_flags f USING (asset_id) WHERE c.cycle_index <= s.shown)
 WHERE CASE WHEN event THEN eol_cycle ELSE shown END - cycle_index > 0),
v_km AS (
 SELECT duration, at_risk, censored, exp(sum(CASE WHEN censored = 0 THEN 0 WHEN censored = at_risk THEN -1e9 ELSE ln(1 - censored / at_risk::DOUBLE) END) OVER (ORDER BY duration)) AS survival
 FROM (SELECT duration, sum(n) OVER (ORDER BY duration DESC) - events AS at_risk, censored FROM (SELECT duration, count(*) AS n, count(*) FILTER (event) AS events, count(*) FILTER (NOT event) AS censored FROM v_land WHERE split = 'train' GROUP BY duration))),
v_metrics AS (
 SELECT split, stage, count(*) AS rows, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, 1 - sum(e * e) / nullif(var_pop(truth) * count(*), 0) AS r2
 FROM (SELECT m.split, s.truth, greatest(s.predicted, 0) - s.truth AS e, s.stage FROM (
   SELECT p.asset_id, CAST(m.last_source_cycle - p.cycle_index AS DOUBLE) AS truth, p.raw_rul AS predicted,
          CASE WHEN p.cycle_index / m.last_source_cycle::DOUBLE < 0.33 THEN 'early' WHEN p.cycle_index / m.last_source_cycle::DOUBLE < 0.67 THEN 'mid' ELSE 'late' END AS stage
   FROM v_pred p JOIN v_manifest m USING (asset_id)) s JOIN v_manifest m USING (asset_id)) GROUP BY split, stage),
v_fleet AS (
 SELECT s.asset_id, c_name AS name, max_by(s.rul, s.cycle_index) AS rul, max_by(CAST(o.o_totalprice AS DOUBLE), s.cycle_index) / 5000 AS health
 FROM v_served s JOIN v_cycles o USING (asset_id, cycle_index) JOIN customer ON c_custkey = s.asset_id GROUP BY s.asset_id, c_name)
"""


def _km_at(x: str, less: str = "<=") -> str:
    """The censoring estimate's step function at x, or just before it."""
    return f"coalesce((SELECT max_by(k.survival, k.duration) FROM v_km k WHERE k.duration {less} {x}), 1.0)"


def _digest(rows: str, name: str = "digest", count: str = "rows") -> str:
    """One row: the content id of hashes h, as the library folds them (levels of up to two signs)."""
    width = f"(SELECT CAST(greatest(0, ceil(ln(greatest(1, count(*)) / 4096.0::DOUBLE) / ln(16))) AS INTEGER) FROM ({rows}))"
    each = f"SELECT CASE WHEN n = 1 THEN h ELSE h || '*' || n END AS t, n FROM (SELECT h, count(*) AS n FROM ({rows}) GROUP BY h)"
    part = f"SELECT left(t, {width}) AS b, sha256(string_agg(t, '' ORDER BY t)) AS h, sum(n) AS n FROM ({each}) GROUP BY 1"
    return f"SELECT sha256(coalesce(string_agg(b || ':' || h, '' ORDER BY b || ':' || h), '')) AS {name}, CAST(coalesce(sum(n), 0) AS BIGINT) AS {count} FROM ({part})"


def _selectable(current: str) -> str:
    """A generation's model: the current one takes the place of the best; retired ones don't count."""
    return f"""SELECT generation, model_version, mae FROM (SELECT *, row_number() OVER (PARTITION BY generation ORDER BY model_version = '{current}' DESC, k % 3 DESC, k % 5 = 0 DESC, k % 7 = 0 DESC, k DESC) AS r
      FROM (SELECT c_custkey AS k, 'm' || c_custkey AS model_version, c_custkey % 8 AS generation, c_acctbal AS mae FROM customer WHERE c_custkey % 6 <> 5)) WHERE r = 1"""


_SUPPORTED = f"(SELECT * FROM (SELECT l.*, {_km_at('l.duration')} AS g FROM v_land l WHERE split = 'test' AND duration <= (SELECT max(duration) FROM v_land WHERE split = 'train')) WHERE g > 1e-12)"
_BRIER = f"SELECT horizon, count(*) AS rows, avg(CASE WHEN duration <= horizon AND event THEN p * p / g WHEN duration > horizon THEN (1 - p) * (1 - p) / nullif(gh, 0) ELSE 0 END) AS brier FROM (SELECT l.*, h.horizon, exp(-h.horizon / 10.0::DOUBLE) AS p, {_km_at('h.horizon')} AS gh FROM {_SUPPORTED} l, (SELECT unnest([2, 5, 8]) AS horizon) h) GROUP BY horizon"
_RISK = "((asset_id * 7919 + cycle_index * 104729) % 1009 / 1e6::DOUBLE)"
_VIEW = "(SELECT c.dataset, c.asset_id, c.cycle_index, CASE WHEN c.dataset = 'a' THEN 'm1' END AS model_version, s.rul FROM (SELECT CASE WHEN asset_id % 3 = 0 THEN 'a' ELSE 'b' END AS dataset, asset_id, max(cycle_index) AS cycle_index FROM v_cycles GROUP BY asset_id) c LEFT JOIN v_served s ON s.asset_id = c.asset_id AND s.cycle_index = c.cycle_index AND c.dataset = 'a' AND c.asset_id % 2 = 1)"
_RECEIPT = _digest("SELECT sha256('{\"asset_id\":' || asset_id || ',\"cycle_index\":' || cycle_index || ',\"event_count\":' || event_count || '}') AS h FROM v_state JOIN v_generations USING (asset_id, cycle_index) JOIN v_boundary b USING (asset_id) WHERE cycle_index <= b.max_cycle AND generation <= 3", "selected_digest", "selected_rows")
_STATE_ROWS = "SELECT sha256('{\"asset_id\":' || asset_id || ',\"cycle_index\":' || cycle_index || ',\"event_count\":' || event_count || '}') AS h FROM v_state"
_COHORT = "(SELECT asset_id, coalesce(valid_eol_label AND eol_observed AND start_time + to_days(CAST(coalesce(eol_cycle, 1) - 1 AS INTEGER)) <= TIMESTAMP '1999-12-31', false) AS observed, arrival_rank FROM v_arrival JOIN v_flags USING (asset_id) WHERE split = 'train' AND start_time <= TIMESTAMP '1999-12-31')"
_CHECKSUMS = " UNION ALL ".join(f"SELECT '{name}' AS cohort, * FROM ({_digest(f'SELECT sha256(CAST(asset_id AS VARCHAR)) AS h FROM {_COHORT} WHERE {rule}', 'checksum', 'assets')})" for name, rule in (("arrived", "true"), ("observed", "observed"), ("censored", "NOT observed")))
_STATE_ID = _digest("SELECT sha256(asset_id || ':' || max_cycle || ':' || cycles) AS h FROM v_boundary", "state_id", "assets")
_MODELS = "(SELECT 'm' || c_custkey AS model_version, CAST(c_nationkey AS VARCHAR) AS dataset, CASE c_custkey % 3 WHEN 0 THEN 'candidate' WHEN 1 THEN 'champion' ELSE 'retired' END AS status, CASE WHEN c_custkey % 5 <> 0 THEN 'f' || c_custkey END AS fingerprint, c_custkey % 11 AS evaluated_at, c_acctbal AS mae FROM customer)"
_EVENTS = "(SELECT asset_id, cycle_index, 'cycle_complete' AS kind FROM v_complete UNION ALL SELECT asset_id, cycle_index, 'replay_complete' FROM (SELECT asset_id, max(cycle_index) AS cycle_index FROM v_cycles GROUP BY asset_id) UNION ALL SELECT asset_id, cycle_index, 'eol_observed' FROM (SELECT asset_id, max(cycle_index) AS cycle_index FROM v_cycles GROUP BY asset_id) WHERE asset_id % 3 <> 0)"
_SOURCES = "(SELECT asset_id, cycle_index, CAST(l_suppkey % 3 AS INTEGER) AS partition, l_orderkey * 10 + l_linenumber AS \"offset\" FROM v_cycles JOIN lineitem ON l_orderkey = o_orderkey)"

_BODIES = {
    "cycle_aggregates": "SELECT asset_id, cycle_index, event_count, round(voltage_sum / voltage_count, 6) AS average_voltage, round(current_sum / event_count, 6) AS average_current, max_capacity, max_temperature, min_temperature, max_voltage, min_voltage, round(max_abs_current, 6) AS max_abs_current FROM v_state",
    "merge_partials": "SELECT asset_id, cycle_index, event_count, round(voltage_sum, 6) AS voltage_sum, max_capacity, min_voltage FROM v_state",
    "causal_features": "SELECT asset_id, cycle_index, round(capacity_delta, 6) AS capacity_delta, cycle_gap, round(rolling_capacity_mean, 6) AS rolling_capacity_mean, round(capacity_slope, 6) AS capacity_slope, round(capacity_since_first, 6) AS capacity_since_first, round(temperature_span, 6) AS temperature_span, round(efficiency, 6) AS efficiency, round(charge_time_delta, 6) AS charge_time_delta FROM v_features",
    "incremental_features": "SELECT f.asset_id, f.cycle_index, round(capacity_delta, 6) AS capacity_delta, cycle_gap, round(rolling_capacity_mean, 6) AS rolling_capacity_mean, round(capacity_slope, 6) AS capacity_slope, round(capacity_since_first, 6) AS capacity_since_first FROM v_features f JOIN v_generations g USING (asset_id, cycle_index) WHERE g.generation = 4",
    "latest_per_asset": "SELECT asset_id, cycle_index, round(rolling_capacity_mean, 6) AS rolling_capacity_mean, round(capacity_slope, 6) AS capacity_slope FROM v_features QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY cycle_index DESC) = 1",
    "latest_finite_row": "SELECT asset_id, cycle_index, round(capacity_slope, 6) AS capacity_slope FROM v_features WHERE capacity_slope IS NOT NULL AND NOT isnan(capacity_slope) AND capacity_delta IS NOT NULL QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY cycle_index DESC) = 1",
    "lifecycle_flags": "SELECT asset_id, eol_observed, replay_complete, strftime(eol_time, '%Y-%m-%d %H:%M:%S') AS eol_time, strftime(replay_time, '%Y-%m-%d %H:%M:%S') AS replay_time FROM v_flags",
    "offset_watermarks": "SELECT 'telemetry' AS topic, CAST(asset_id % 3 AS INTEGER) AS partition, max(asset_id * 1000 + cycle_index * 10 + sample_index) AS \"offset\" FROM v_samples GROUP BY ALL",
    "ready_cycles": "SELECT asset_id, cycle_index, n AS event_count, ready FROM v_ready",
    "prefix_complete": "SELECT asset_id, cycle_index FROM v_final",
    "boundary_ranges": "SELECT asset_id, max_cycle, cycles FROM v_boundary",
    "boundary_select": "SELECT s.asset_id, s.cycle_index, s.event_count FROM v_state s JOIN v_boundary b ON b.asset_id = s.asset_id AND s.cycle_index <= b.max_cycle",
    "generation_asof": "SELECT asset_id, cycle_index, CAST(generation AS INTEGER) AS generation FROM v_generations",
    "cumulative_generation": "SELECT g.generation::INTEGER AS generation, count(*) AS features FROM (SELECT unnest([1, 2, 3, 4]) AS generation) g JOIN v_generations v ON v.generation <= g.generation JOIN v_state s USING (asset_id, cycle_index) GROUP BY g.generation",
    "new_keys": "SELECT asset_id, cycle_index FROM v_generations v JOIN v_state USING (asset_id, cycle_index) WHERE generation > 2",
    "conflict_rows": "SELECT asset_id, cycle_index FROM v_state WHERE asset_id % 10 = 3 AND max_voltage > 40",
    "arrival_rank": "SELECT asset_id, CAST(row_number() OVER (ORDER BY sha256('v1:' || CAST(lineage_group_id AS VARCHAR)), asset_id) - 1 AS BIGINT) AS arrival_rank FROM v_manifest",
    "train_schedule": "SELECT asset_id, arrival_rank, strftime(TIMESTAMP '2024-01-01' + to_days(CAST(60 * arrival_rank AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS arrival_time FROM (SELECT asset_id, CAST(row_number() OVER (ORDER BY sha256('v1:' || CAST(lineage_group_id AS VARCHAR)), asset_id) - 1 AS BIGINT) AS arrival_rank FROM v_manifest WHERE split = 'train')",
    "replay_sequence": "SELECT asset_id, cycle_index, sample_index, CAST(row_number() OVER (ORDER BY event_time, asset_id, cycle_index, sample_index) - 1 AS BIGINT) AS replay_sequence FROM v_samples",
    "completion_events": "SELECT asset_id, cycle_index, count(*) AS expected, CAST(max_by(sample_index, (event_time, sample_index)) AS BIGINT) AS last_sample, strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS event_time FROM v_samples GROUP BY asset_id, cycle_index",
    "cohort_at_cutoff": f"SELECT asset_id, arrival_rank, observed FROM {_COHORT}",
    "cohort_counts": "SELECT strftime(cutoff, '%Y-%m-%d %H:%M:%S') AS cutoff, count(*) FILTER (here) AS arrived, count(*) FILTER (here AND seen) AS observed, count(*) FILTER (here AND NOT seen) AS censored FROM (SELECT t.cutoff, split = 'train' AND start_time <= t.cutoff AS here, coalesce(valid_eol_label AND eol_observed AND start_time + to_days(CAST(coalesce(eol_cycle, 1) - 1 AS INTEGER)) <= t.cutoff, false) AS seen FROM v_manifest JOIN v_flags USING (asset_id), (SELECT unnest([TIMESTAMP '1996-12-31', TIMESTAMP '1998-12-31', TIMESTAMP '2000-06-30']) AS cutoff) t) GROUP BY cutoff",
    "eligible_assets": "SELECT asset_id FROM v_manifest JOIN v_flags USING (asset_id) WHERE split = 'train' AND valid_eol_label AND eol_observed AND replay_complete",
    "split_audit": "SELECT split, count(*) AS assets, count(DISTINCT lineage_group_id) AS groups, CAST(0 AS BIGINT) AS overlapping FROM v_manifest GROUP BY split",
    "irreversible_eol": "SELECT asset_id, cycle_index, raw_rul, rul, eol_cycle FROM v_served",
    "eol_violations": "SELECT asset_id, cycle_index, rul FROM (SELECT asset_id, cycle_index, greatest(raw_rul, 0) AS rul, min(CASE WHEN greatest(raw_rul, 0) = 0 THEN cycle_index END) OVER (PARTITION BY asset_id ORDER BY cycle_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM v_pred) WHERE e IS NOT NULL AND rul <> 0",
    "monotone_curve": "SELECT asset_id, cycle_index, horizon, round(min(least(greatest(probability, 0), 1)) OVER (PARTITION BY asset_id ORDER BY horizon), 6) AS served FROM v_curves",
    "curve_violations": "SELECT * FROM (SELECT model_version, asset_id, cycle_index, count(*) FILTER (up) AS rising, count(*) FILTER (probability < 0 OR probability > 1 OR horizon < 0 OR horizon > 200) AS out_of_range, count(*) FILTER (horizon = 0 AND probability <> 1) AS bad_start, 3 - count(*) FILTER (horizon IN (50, 100, 200)) AS missing FROM (SELECT *, probability > lag(probability) OVER (PARTITION BY model_version, asset_id ORDER BY horizon) AS up FROM (SELECT asset_id, cycle_index, probability, horizon, 'm1' AS model_version FROM v_curves UNION ALL SELECT asset_id, cycle_index, probability, horizon + CASE WHEN asset_id % 5 = 0 THEN 50 ELSE 0 END, 'm2' FROM v_curves)) GROUP BY model_version, asset_id, cycle_index) WHERE rising > 0 OR out_of_range > 0 OR bad_start > 0 OR missing <> 0",
    "qc_report": "SELECT * FROM (SELECT 'sample_rows' AS metric, count(*)::DOUBLE AS value FROM v_samples UNION ALL SELECT 'sampled_assets', count(DISTINCT asset_id) FROM v_samples UNION ALL SELECT 'min_voltage', min(voltage) FROM v_samples UNION ALL SELECT 'max_voltage', max(voltage) FROM v_samples UNION ALL SELECT 'min_current', min(current) FROM v_samples UNION ALL SELECT 'max_current', max(current) FROM v_samples UNION ALL SELECT 'min_temperature', min(temperature) FROM v_samples UNION ALL SELECT 'max_temperature', max(temperature) FROM v_samples UNION ALL SELECT 'missing_temperature', count(*) - count(temperature) FROM v_samples UNION ALL SELECT 'missing_resistance', count(*) - count(resistance) FROM v_samples UNION ALL SELECT 'repeated_cycles', count(*) - count(DISTINCT (asset_id, cycle_index)) FROM v_cycles UNION ALL SELECT 'missing_capacity', count(*) - count(capacity) FROM v_samples UNION ALL SELECT 'negative_current', count(*) FILTER (current < 0) FROM v_samples UNION ALL SELECT 'cycle_rows', count(*) FROM v_cycles UNION ALL SELECT 'assets', count(DISTINCT asset_id) FROM v_cycles UNION ALL SELECT 'max_cycle', max(cycle_index) FROM v_cycles)",
    "cycles_histogram": "SELECT cycles, count(*) AS assets FROM (SELECT asset_id, count(*) AS cycles FROM v_cycles GROUP BY asset_id) GROUP BY cycles",
    "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "order_violations": "SELECT o_orderkey, o_custkey FROM (SELECT *, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS b FROM orders) WHERE o_orderdate <= b",
    "group_total_diff": "SELECT c_custkey AS asset_id, n AS source_rows, CAST(0 AS BIGINT) AS target_rows FROM (SELECT asset_id AS c_custkey, count(*) AS n FROM v_cycles WHERE asset_id % 17 = 0 GROUP BY 1)",
    "coverage_check": "SELECT asset_id, cycle_index AS expected_cycle, CAST(CASE WHEN asset_id % 9 = 0 THEN NULL ELSE cycle_index END AS DOUBLE) AS served_cycle, CASE WHEN asset_id % 9 = 0 THEN '' ELSE '0,50,100,150' END AS horizons FROM (SELECT asset_id, max(cycle_index) AS cycle_index FROM v_cycles GROUP BY asset_id) WHERE asset_id % 9 = 0 OR asset_id % 9 = 1",
    "table_violations": "SELECT * FROM (SELECT 'price_positive' AS rule, count(*) FILTER (NOT o_totalprice > 0) AS rows FROM orders UNION ALL SELECT 'status_known', count(*) FILTER (NOT o_orderstatus IN ('O', 'F')) FROM orders UNION ALL SELECT 'customer_present', count(*) FILTER (o_custkey IS NULL) FROM orders)",
    "current_upsert": "SELECT asset_id, CASE WHEN asset_id % 2 = 0 THEN 200 WHEN asset_id % 3 = 0 THEN 100 ELSE 100 END::BIGINT AS sequence, CASE WHEN asset_id % 2 = 0 OR asset_id % 3 = 0 THEN 'new' ELSE 'old' END AS source FROM (SELECT DISTINCT asset_id FROM v_cycles)",
    "survival_upsert": "SELECT asset_id, CAST(CASE WHEN asset_id % 2 = 0 AND asset_id % 5 <> 0 THEN cycle_index + 1 ELSE cycle_index END AS BIGINT) AS cycle_index, CASE WHEN (asset_id % 2 = 0 OR asset_id % 3 = 0) AND asset_id % 5 <> 0 THEN 'new' ELSE 'old' END AS source FROM (SELECT asset_id, max(cycle_index) AS cycle_index FROM v_cycles GROUP BY asset_id)",
    "selection_revision": "SELECT dataset, CASE WHEN w.dataset IS NULL THEN o.model_version ELSE w.model_version END AS model_version, CASE WHEN w.dataset IS NULL THEN o.fingerprint ELSE w.fingerprint END AS fingerprint, CAST(CASE WHEN o.dataset IS NULL THEN 1 WHEN w.dataset IS NOT NULL AND (w.model_version IS DISTINCT FROM o.model_version OR w.fingerprint IS DISTINCT FROM o.fingerprint) THEN o.revision + 1 ELSE o.revision END AS BIGINT) AS revision FROM (SELECT CAST(c_custkey AS VARCHAR) AS dataset, 'm1' AS model_version, CASE WHEN c_custkey % 5 <> 0 THEN 'f1' END AS fingerprint, c_custkey % 7 AS revision FROM customer WHERE c_custkey % 4 <> 0) o FULL JOIN (SELECT CAST(c_custkey AS VARCHAR) AS dataset, CASE WHEN c_custkey % 2 = 0 THEN 'm1' ELSE 'm2' END AS model_version, CASE WHEN c_custkey % 10 <> 0 THEN 'f' || (c_custkey % 2 + c_custkey % 11 % 2 + 1) END AS fingerprint FROM customer WHERE c_custkey % 3 <> 0) w USING (dataset)",
    "prune_stale": "SELECT c.asset_id, c.horizon FROM v_curves c WHERE EXISTS (SELECT 1 FROM v_boundary b WHERE b.asset_id = c.asset_id AND b.max_cycle = c.cycle_index)",
    "regression_metrics": "SELECT split, stage, rows, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2 FROM v_metrics",
    "model_winner": "SELECT split, stage, round(mae, 6) AS mae FROM v_metrics QUALIFY row_number() OVER (PARTITION BY split ORDER BY mae, rmse, stage) = 1",
    "landmark_rows": "SELECT asset_id, cycle_index, split, duration, event FROM v_land",
    "landmark_sample": "SELECT asset_id, cycle_index, split FROM (SELECT *, min(cycle_index) OVER (PARTITION BY asset_id) AS f FROM v_land) WHERE split <> 'train' OR cycle_index = f OR cycle_index % 10 = 0 OR duration = 1",
    "censoring_km": "SELECT duration, CAST(at_risk AS BIGINT) AS at_risk, censored, round(survival, 6) AS survival FROM v_km",
    "ipcw_brier": f"SELECT horizon, rows, round(brier, 6) AS brier FROM ({_BRIER})",
    "latest_dashboard": f"SELECT * FROM {_VIEW}",
    "null_safe_status": "SELECT asset_id, CASE WHEN asset_id % 4 = 0 THEN 'ok' WHEN asset_id % 8 = 5 THEN 'none' ELSE 'pending' END AS status FROM (SELECT DISTINCT asset_id FROM v_cycles)",
    "fleet_kpis": "SELECT count(*) AS assets, round(avg(health), 6) AS mean_health, round(quantile_cont(health, 0.5), 6) AS median_health, round(quantile_cont(rul, 0.5), 6) AS median_rul, round(quantile_cont(rul, 0.25), 6) AS p25_rul, count(rul) AS with_rul FROM v_fleet",
    "soh_histogram": "SELECT CAST(floor(health / 5) * 5 AS BIGINT) AS low, CAST(floor(health / 5) * 5 AS BIGINT) || '–' || CAST(floor(health / 5) * 5 + 5 AS BIGINT) || '%' AS label, count(*) AS assets FROM v_fleet GROUP BY ALL",
    "risk_filter": "SELECT asset_id FROM v_fleet WHERE lower(name) LIKE '%1%' AND health <= 60 AND rul <= 3",
    "bottom_k": "SELECT asset_id, round(health, 6) AS health FROM v_fleet ORDER BY v_fleet.health, asset_id LIMIT 25",
    "metric_json_flatten": "SELECT 'm' || asset_id AS model_version, asset_id % 7 / 2.0::DOUBLE AS mae, CASE WHEN asset_id % 2 = 0 THEN asset_id % 5 / 4.0::DOUBLE END AS rmse FROM (SELECT DISTINCT asset_id FROM v_cycles)",
    "family_metrics": "SELECT 'm' || asset_id AS model_version, f AS family, CASE WHEN f = 'tree' THEN asset_id % 3 ELSE 2 END::DOUBLE AS family_mae, CASE WHEN f = 'tree' THEN 3.0::DOUBLE END AS family_rmse FROM (SELECT DISTINCT asset_id FROM v_cycles), (SELECT unnest(['tree', 'linear']) AS f)",
    "metric_unpivot": "SELECT model_version, metric, value FROM (SELECT 'm' || asset_id AS model_version, 'mae' AS metric, asset_id % 7 / 2.0::DOUBLE AS value FROM (SELECT DISTINCT asset_id FROM v_cycles) UNION ALL SELECT 'm' || asset_id, 'rmse', CASE WHEN asset_id % 2 = 0 THEN asset_id % 5 / 4.0::DOUBLE END FROM (SELECT DISTINCT asset_id FROM v_cycles))",
    "colour_scores": "SELECT asset_id, round(1 - (health - min(health) OVER ()) / (max(health) OVER () - min(health) OVER ()), 6) AS score FROM v_fleet",
    "lifecycle_stage": "SELECT asset_id, cycle_index, CASE WHEN asset_id % 5 = 1 THEN 'Unavailable' WHEN cycle_index + rul = 0 OR 3 * cycle_index < cycle_index + rul THEN 'Early' WHEN 3 * cycle_index < 2 * (cycle_index + rul) THEN 'Mid' ELSE 'Late' END AS stage FROM v_served",
    "ragged_zip": "SELECT asset_id, cycle_index, sample_index, voltage, CASE WHEN sample_index <= 3 THEN temperature END AS temperature FROM v_samples",
    "limit_per_asset": "SELECT asset_id, cycle_index, sample_index FROM (SELECT * FROM v_samples WHERE asset_id NOT IN (7, 11) QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY cycle_index, sample_index) <= 5) ORDER BY asset_id, cycle_index, sample_index LIMIT 400",
    "event_json_roundtrip": "SELECT asset_id, cycle_index, sample_index, voltage FROM v_samples WHERE asset_id % 6 <> 5",
    "provenance": "SELECT o_orderkey::VARCHAR AS source_file, CASE WHEN o_orderkey % 10 = 0 THEN 'root' ELSE min(o_orderkey::VARCHAR) OVER (PARTITION BY o_custkey, o_orderdate) END AS lineage_group_id FROM orders",
    "duplicate_labels": "SELECT asset_id, CASE WHEN n > 1 THEN label || ' · ' || left(sha256(CAST(asset_id AS VARCHAR)), 8) ELSE label END AS display FROM (SELECT c_custkey AS asset_id, c_mktsegment AS label, count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer)",
    "stream_cycle_aggregates": "SELECT asset_id, cycle_index, event_count, round(voltage_sum / voltage_count, 6) AS average_voltage FROM v_state JOIN v_ready USING (asset_id, cycle_index) WHERE ready",
    "outlet_key_ranges": "SELECT asset_id, min(cycle_index) AS min_cycle, max(cycle_index) AS max_cycle, count(*) AS cycles FROM v_state GROUP BY asset_id",
    "outlet_beyond": "SELECT asset_id, cycle_index FROM v_state s LEFT JOIN (SELECT asset_id, max(cycle_index) AS m FROM v_generations JOIN v_state USING (asset_id, cycle_index) WHERE generation <= 2 GROUP BY asset_id) o USING (asset_id) WHERE m IS NULL OR cycle_index > m",
    "outlet_cumulative": "SELECT g.asset_id, g.cycle_index, CAST(generation AS INTEGER) AS generation_id, max_capacity, o_orderkey FROM v_generations g JOIN v_state USING (asset_id, cycle_index) JOIN v_boundary b ON b.asset_id = g.asset_id AND g.cycle_index <= b.max_cycle WHERE generation <= 3",
    "superset_violations": "SELECT asset_id, cycle_index FROM v_state WHERE asset_id % 10 IN (1, 2)",
    "qc_gate": "SELECT * FROM (SELECT 'negative_current' AS metric, -1.0::DOUBLE AS expected, (SELECT count(*) FILTER (current < 0) FROM v_samples)::DOUBLE AS value UNION ALL SELECT 'max_cycle', 3.0, (SELECT max(cycle_index) FROM v_cycles) UNION ALL SELECT 'unknown', 1.0, -9.0)",
    "concordance_index": f"SELECT round(sum(w * CASE WHEN ri > rj THEN 1.0 WHEN ri = rj THEN 0.5 ELSE 0 END) / sum(w), 6) AS c_index FROM (SELECT i.risk AS ri, j.risk AS rj, 1 / nullif(i.gb * i.gb, 0) AS w FROM (SELECT *, {_RISK} AS risk, {_km_at('s.duration')} AS gb FROM {_SUPPORTED} s WHERE event) i JOIN (SELECT *, {_RISK} AS risk FROM {_SUPPORTED}) j ON j.duration > i.duration OR (j.duration = i.duration AND NOT j.event))",
    "nested_reductions": "SELECT asset_id, cycle_index, count(*) AS samples, max(voltage) AS max_voltage, min(voltage) AS min_voltage, max(capacity) AS max_capacity FROM v_samples GROUP BY ALL",
    "replay_times": "SELECT asset_id, cycle_index, sample_index, strftime(TIMESTAMP '2024-01-01' + to_days(CAST(cycle_index - 1 AS INTEGER)) + to_seconds(sample_index), '%Y-%m-%d %H:%M:%S') AS t FROM v_samples",
    "next_training_snapshot": "SELECT asset_id, CAST(row_number() OVER (ORDER BY sha256('v1:' || CAST(lineage_group_id AS VARCHAR)), asset_id) AS BIGINT) AS position FROM v_manifest JOIN v_flags USING (asset_id) WHERE split = 'train' AND valid_eol_label AND eol_observed QUALIFY row_number() OVER (ORDER BY sha256('v1:' || CAST(lineage_group_id AS VARCHAR)), asset_id) <= 26",
    "selectable_models": " UNION ALL ".join(f"SELECT generation, model_version, '{m}' AS chosen FROM ({_selectable(m)})" for m in ("m9", "m11")),
    "integrated_brier": f"SELECT (SELECT round(sum(dx * y) / sum(dx), 6) FROM (SELECT horizon - lag(horizon) OVER (ORDER BY horizon) AS dx, (brier + lag(brier) OVER (ORDER BY horizon)) / 2 AS y FROM ({_BRIER}) WHERE horizon < (SELECT max(duration) FROM {_SUPPORTED}))) AS integrated_brier, (SELECT count(*) FROM {_SUPPORTED}) AS supported_rows, (SELECT count(*) FROM v_land WHERE split = 'test') - (SELECT count(*) FROM {_SUPPORTED}) AS excluded_rows",
    "landmark_counts": "SELECT split, count(*) AS rows, count(*) FILTER (event) AS events, count(*) FILTER (NOT event) AS censored FROM v_land GROUP BY split",
    "latest_landmarks": "SELECT asset_id, cycle_index, duration FROM v_land QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY cycle_index DESC) = 1",
    "survival_view": f"SELECT v.asset_id, v.cycle_index, v.rul, round(c.probability, 6) AS survival FROM {_VIEW} v JOIN v_curves c ON c.asset_id = v.asset_id AND c.horizon = 100 WHERE v.asset_id % 7 <> 0 AND v.asset_id % 5 <> 0",
    "current_curve": "SELECT asset_id, horizon FROM v_curves WHERE asset_id % 7 <> 0",
    "fleet_survival": "SELECT count(*) AS assets, round(quantile_cont(s, 0.5), 6) AS median_survival, round(quantile_cont(s, 0.25), 6) AS p25_survival FROM (SELECT f.asset_id, c.probability AS s FROM v_fleet f LEFT JOIN v_curves c ON c.asset_id = f.asset_id AND c.horizon = 100 AND c.asset_id % 5 <> 0)",
    "initialised_selection": f"SELECT CAST(n_nationkey AS VARCHAR) AS dataset, 'kept' AS model_version, 'f' AS fingerprint, CAST(4 AS BIGINT) AS revision FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT dataset, model_version, fingerprint, CAST(1 AS BIGINT) FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY evaluated_at DESC, model_version DESC) AS r FROM {_MODELS} WHERE status <> 'retired' AND fingerprint IS NOT NULL AND CAST(dataset AS INTEGER) % 2 = 1) WHERE r = 1",
    "model_selection": f"SELECT model_version, evaluated_at % 2 = 0 AS usable FROM {_MODELS} WHERE status = 'champion'",
    "best_model": f"SELECT model_version FROM ({_selectable('')}) ORDER BY mae ASC NULLS LAST, model_version LIMIT 1",
    "newest_evaluation": f"SELECT model_version FROM {_MODELS} WHERE status <> 'retired' AND fingerprint IS NOT NULL ORDER BY evaluated_at DESC, model_version DESC LIMIT 1",
    "frozen_scores": "SELECT n.asset_id, n.cycle_index, CASE WHEN p.rul = 0 THEN 0.0 ELSE greatest(n.raw_rul + 6, 0) END AS rul, CASE WHEN p.rul = 0 THEN p.eol_cycle ELSE n.cycle_index + greatest(n.raw_rul + 6, 0) END AS eol_cycle FROM (SELECT * FROM v_pred QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY cycle_index DESC) = 1) n LEFT JOIN (SELECT s.asset_id, s.rul, s.eol_cycle FROM v_served s JOIN v_generations g USING (asset_id, cycle_index) WHERE g.generation <= 3 QUALIFY row_number() OVER (PARTITION BY s.asset_id ORDER BY s.cycle_index DESC) = 1) p USING (asset_id)",
    "replaced_version": "SELECT 'm0' AS model_version, asset_id, cycle_index, raw_rul FROM v_pred WHERE asset_id % 2 = 0 UNION ALL SELECT 'm1', asset_id, cycle_index, raw_rul + 1 FROM v_pred WHERE asset_id % 4 = 1",
    "serving_statuses": "SELECT CAST(c_custkey AS VARCHAR) AS state_id, c_custkey % 4 AS revision, CASE c_custkey % 4 WHEN 1 THEN 'served' WHEN 2 THEN 'failed' ELSE 'pending' END AS status, CAST(CASE WHEN c_custkey % 4 = 1 THEN 10 ELSE 0 END AS BIGINT) AS rows_written, CASE WHEN c_custkey % 4 = 2 THEN 'lost' END AS error, NOT (c_custkey % 4 = 1 AND c_custkey <> 5) AS serve FROM customer",
    "newest_final": "SELECT asset_id, cycle_index, event_count FROM v_state JOIN v_final USING (asset_id, cycle_index) JOIN v_manifest m USING (asset_id) WHERE m.split <> 'test' QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY cycle_index DESC) = 1",
    "serving_predictions": "SELECT 'm' AS model_version, asset_id, cycle_index, rul AS raw_rul, rul, cycle_index + rul AS eol_cycle FROM v_served",
    "serving_cycles": "SELECT asset_id, cycle_index, CAST(NULL AS DOUBLE) AS soh, CAST(NULL AS DOUBLE) AS rul_cycles, max_capacity, round(resistance, 6) AS resistance, max_temperature, charge_time, round(capacity_slope, 6) AS capacity_slope, round(efficiency, 6) AS efficiency FROM v_features",
    "serving_evaluations": f"SELECT model_version, status, '2024-01-' || lpad(CAST(evaluated_at + 1 AS VARCHAR), 2, '0') || ' 00:00:00' AS evaluated_at, '{{}}' AS training_metadata, fingerprint, CAST(NULL AS VARCHAR) AS generation FROM {_MODELS}",
    "cycle_labels": "SELECT c.asset_id, c.cycle_index, CASE WHEN m.eol_cycle IS NOT NULL THEN CAST(greatest(m.eol_cycle - c.cycle_index, 0) AS DOUBLE) END AS rul_cycles, round(c.o_totalprice / 250000.0::DOUBLE / CASE WHEN c.asset_id % 2 = 0 THEN 0.8::DOUBLE ELSE 1 END * 100, 2) AS percent FROM v_cycles c JOIN v_manifest m USING (asset_id)",
    "family_labels": "SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'XGBoost' WHEN 1 THEN 'Random Survival Forest' ELSE array_to_string(list_transform(regexp_extract_all(lower(replace(p_type || '_by-spark 2x', '_', ' ')), '[a-z]+|[^a-z]+'), lambda x: upper(left(x, 1)) || substr(x, 2)), '') END AS label FROM part",
    "survival_metrics": "SELECT 'm' || asset_id AS model_version, CASE WHEN asset_id % 3 <> 0 THEN asset_id % 5 / 4.0::DOUBLE END AS ibs, asset_id % 2 / 2.0::DOUBLE AS c_index, asset_id % 9 / 8.0::DOUBLE AS brier_100 FROM (SELECT DISTINCT asset_id FROM v_cycles)",
    "survival_winner": "SELECT * FROM (SELECT 'm' || asset_id AS model_version, CASE WHEN asset_id % 3 <> 0 THEN asset_id % 5 / 4.0::DOUBLE END AS ibs, asset_id % 2 / 2.0::DOUBLE AS c_index FROM (SELECT DISTINCT asset_id FROM v_cycles)) ORDER BY ibs ASC NULLS LAST, c_index DESC NULLS LAST, model_version LIMIT 1",
    "generalisation_gap": "SELECT round(max(mae) FILTER (split = 'test') - max(mae) FILTER (split = 'validation'), 6) AS test_validation, round(max(mae) FILTER (split = 'test') - max(mae) FILTER (split = 'train'), 6) AS test_train FROM (SELECT m.split, avg(abs(greatest(p.raw_rul, 0) - (m.last_source_cycle - p.cycle_index))) AS mae FROM v_pred p JOIN v_manifest m USING (asset_id) GROUP BY m.split)",
    "arrival_manifest": "SELECT asset_id, arrival_rank, strftime(starts, '%Y-%m-%d %H:%M:%S') AS start_time, last_source_cycle, CAST(eol_cycle AS DOUBLE) AS eol_cycle, CAST(delta AS DOUBLE) AS eol_cycle_delta, CASE WHEN valid THEN 'valid_observed_endpoint' ELSE 'unverified_endpoint_after_source_end' END AS label_status, valid AS valid_eol_label FROM v_arrival",
    "scheduled_lifecycle": "SELECT asset_id, 'replay_complete' AS event_type, last_source_cycle AS cycle_index, strftime(starts + to_days(CAST(last_source_cycle - 1 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS event_time FROM v_arrival UNION ALL SELECT asset_id, 'eol_observed', eol_cycle, strftime(starts + to_days(CAST(eol_cycle - 1 AS INTEGER)), '%Y-%m-%d %H:%M:%S') FROM v_arrival WHERE valid",
    "nth_arrival": "SELECT asset_id, strftime(TIMESTAMP '2024-01-01' + to_days(25 * 60), '%Y-%m-%d %H:%M:%S') AS arrival_time FROM v_manifest WHERE split = 'train' QUALIFY row_number() OVER (ORDER BY sha256('v1:' || CAST(lineage_group_id AS VARCHAR)), asset_id) = 26",
    "asof_keys": "SELECT c.asset_id, c.cycle_index FROM v_cycles c JOIN v_arrival a USING (asset_id) WHERE a.starts <= TIMESTAMP '2024-03-31 12:00:00' AND c.cycle_index <= least(a.last_source_cycle, 1 + CAST(floor(epoch(TIMESTAMP '2024-03-31 12:00:00' - a.starts) / 86400) AS BIGINT))",
    "bound_lifecycle": "SELECT asset_id, f.eol_observed FROM v_flags f JOIN v_manifest m USING (asset_id) WHERE m.split <> 'train' UNION ALL SELECT asset_id, true FROM v_manifest WHERE split = 'train' AND asset_id % 4 = 1",
    "split_counts": "SELECT split, 'c_mktsegment' AS attribute, c_mktsegment AS value, count(*) AS assets FROM v_manifest JOIN customer ON c_custkey = asset_id GROUP BY ALL UNION ALL SELECT split, 'valid_eol_label', CAST(valid_eol_label AS VARCHAR), count(*) FROM v_manifest GROUP BY ALL",
    "merged_flags": "SELECT asset_id, eol_observed, replay_complete, strftime(eol_time, '%Y-%m-%d %H:%M:%S') AS eol_time, strftime(replay_time, '%Y-%m-%d %H:%M:%S') AS replay_time FROM v_flags",
    "folded_lifecycle": "SELECT asset_id, eol_observed, replay_complete FROM v_flags",
    "replay_cutoff": "SELECT strftime(max(event_time), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS replay_cutoff FROM v_samples",
    "offset_map": f"SELECT 'lifecycle' AS topic, string_agg(partition || '=' || o, ',' ORDER BY partition) AS offsets FROM (SELECT partition, max(\"offset\") AS o FROM {_SOURCES} GROUP BY partition)",
    "beyond_watermarks": f"SELECT asset_id, cycle_index, partition, \"offset\" FROM {_SOURCES} LEFT JOIN (SELECT partition, max(\"offset\") AS w FROM {_SOURCES} WHERE partition < 2 AND cycle_index <= 8 GROUP BY partition) USING (partition) WHERE coalesce(w, -1) < \"offset\"",
    "event_routing": f"SELECT 'telemetry' AS topic, 'telemetry' AS kind, count(*) AS events FROM v_samples UNION ALL SELECT 'lifecycle', kind, count(*) FROM {_EVENTS} GROUP BY kind",
    "required_split": "SELECT asset_id, CASE WHEN asset_id % 3 = 0 AND asset_id % 5 = 0 THEN 'name,rul' WHEN asset_id % 3 = 0 THEN 'name' ELSE 'rul' END AS missing FROM v_fleet WHERE asset_id % 3 = 0 OR asset_id % 5 = 0",
    "bad_keys": "SELECT asset_id FROM v_fleet WHERE asset_id % 4 = 0 OR asset_id % 3 = 0",
    "not_prefix": "SELECT r.asset_id, r.final, c.canonical FROM (SELECT asset_id, max(cycle_index) AS m, count(*) AS final FROM v_ready WHERE ready GROUP BY asset_id) r JOIN (SELECT v.asset_id, count(*) AS canonical FROM v_cycles v JOIN (SELECT asset_id, max(cycle_index) AS m FROM v_ready WHERE ready GROUP BY asset_id) x ON x.asset_id = v.asset_id AND v.cycle_index <= x.m GROUP BY v.asset_id) c USING (asset_id) WHERE r.final <> c.canonical",
    "boundary_faults": "SELECT * FROM (SELECT 'more cycles than the last' AS fault, count(*) FILTER (asset_id % 10 = 7) AS rows FROM v_boundary UNION ALL SELECT 'sequence below 0', count(*) FILTER (max_cycle - asset_id % 5 < 0) FROM v_boundary) WHERE rows > 0",
    "cohort_faults": f"SELECT asset_id, fault FROM (SELECT asset_id, CASE WHEN o AND c THEN 'observed and censored' WHEN a AND NOT o AND NOT c THEN 'neither' WHEN NOT a AND (o OR c) THEN 'not arrived' END AS fault FROM (SELECT asset_id, asset_id % 11 <> 0 AS a, observed OR asset_id % 6 = 0 AS o, NOT observed AND asset_id % 8 <> 0 AS c FROM {_COHORT})) WHERE fault IS NOT NULL",
    "load_faults": "SELECT * FROM (SELECT 'missing in target' AS fault, count(*) AS rows FROM v_cycles WHERE asset_id % 17 = 0 AND asset_id % 19 <> 0 UNION ALL SELECT 'extra in target', count(*) FROM v_cycles WHERE asset_id % 19 = 0 AND asset_id % 17 <> 0) WHERE rows > 0",
    "published_predictions": "SELECT asset_id, cycle_index, rul, eol_cycle FROM v_served",
    "cohort_checksums": _CHECKSUMS,
    "generation_plan": f"SELECT '1.2' AS generation, s.state_id, (SELECT assets FROM ({_CHECKSUMS}) WHERE cohort = 'arrived') AS training_assets, sha256(concat_ws('|', '1.2', s.state_id, 'features-v1', 'ridge|forest', (SELECT string_agg(checksum, '|' ORDER BY cohort) FROM ({_CHECKSUMS})))) AS fingerprint FROM ({_STATE_ID}) s",
    "generation_receipt": f"SELECT CAST(3 AS INTEGER) AS generation_id, selected_rows, selected_digest FROM ({_RECEIPT})",
    "benchmark_record": " UNION ALL ".join(f"SELECT '{x}' AS split, (SELECT count(DISTINCT asset_id) FROM v_manifest WHERE split = '{x}' AND valid_eol_label) AS assets, (SELECT count(DISTINCT lineage_group_id) FROM v_manifest WHERE split = '{x}' AND valid_eol_label) AS lineage_groups, rows, digest FROM (" + _digest(_STATE_ROWS + f" JOIN v_manifest m USING (asset_id) WHERE m.split = '{x}' AND m.valid_eol_label") + ")" for x in ("validation", "test")),
    "published_counts": "SELECT DISTINCT c_custkey % 50 AS training_assets FROM customer WHERE c_custkey % 3 <> 0",
    "single_values": "SELECT CAST(7 AS DOUBLE) AS value, CAST(1 AS BIGINT) AS \"distinct\" UNION ALL SELECT CASE WHEN count(DISTINCT o_custkey) = 1 THEN min(o_custkey) END, count(DISTINCT o_custkey) FROM orders",
    "curve_count": "SELECT count(*) AS curves FROM (SELECT DISTINCT asset_id, cycle_index FROM v_curves)",
    "seeded_outlet": "SELECT asset_id, cycle_index, CAST(generation AS INTEGER) AS generation_id, max_capacity FROM v_state JOIN v_generations USING (asset_id, cycle_index)",
    "stream_finalized": "SELECT asset_id, max_cycle, cycles FROM v_boundary",
    "ingest_manifest": "SELECT * FROM (SELECT 'samples' AS \"table\", count(*) AS rows FROM v_samples UNION ALL SELECT 'cycles', count(*) FROM (SELECT DISTINCT asset_id, cycle_index FROM v_samples) UNION ALL SELECT unnest(['assets', 'provenance', 'schedule']), count(DISTINCT asset_id) FROM v_samples)",
    "ingested_samples": "SELECT 'fleet:' || asset_id || ':' || cycle_index || ':' || (sample_index - 1) AS event_id, voltage, CASE WHEN sample_index <= 3 THEN temperature END AS temperature, strftime(TIMESTAMP '2024-01-01' + to_days(CAST(cycle_index - 1 AS INTEGER)) + to_microseconds(CAST(source_time * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS replay_time FROM v_samples",
    "ingested_cycles": "SELECT asset_id, cycle_index, eol_cycle, CASE WHEN eol_cycle IS NOT NULL THEN greatest(eol_cycle - cycle_index, 0) END AS rul, max_capacity, max_capacity / (CASE WHEN asset_id % 2 = 0 THEN 100000 ELSE 50000 END) AS health, min_temperature FROM (SELECT asset_id, cycle_index, max(capacity) AS max_capacity, min(temperature) FILTER (sample_index <= 3) AS min_temperature FROM v_samples GROUP BY ALL) LEFT JOIN (SELECT asset_id, eol_cycle FROM v_manifest WHERE asset_id % 4 <> 0) USING (asset_id)",
    "ingested_provenance": "SELECT 'cell_b' || (asset_id % 3 + 1) || 'c' || asset_id || '.json' AS source_file, asset_id, 'batch_' || (asset_id % 3 + 1) AS batch_id, CAST(r AS VARCHAR) AS original_asset_id, 'fleet:' || r AS lineage_group_id, CASE WHEN r <> asset_id THEN 'official_continuation' ELSE 'documented_singleton' END AS lineage_reason, CASE WHEN r <> asset_id THEN 'verified' ELSE 'documented_singleton' END AS provenance_status FROM (SELECT DISTINCT asset_id, CASE WHEN asset_id % 5 = 0 THEN asset_id - 1 ELSE asset_id END AS r FROM v_samples)",
    "file_order": "SELECT place, l_orderkey, l_linenumber, l_partkey FROM (SELECT row_number() OVER () - 1 AS place, l_orderkey, l_linenumber, l_partkey, lag(l_orderkey) OVER () AS a, lag(l_linenumber) OVER () AS b FROM lineitem) WHERE a IS NOT NULL AND (l_orderkey, l_linenumber) <= (a, b)",
    "unsorted_cycles": "SELECT o_custkey, count(*) AS errors FROM (SELECT o_custkey, o_orderdate, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY place) AS b FROM (SELECT row_number() OVER () AS place, o_custkey, o_orderdate FROM orders)) WHERE o_orderdate < b GROUP BY o_custkey",
    "state_train_rows": "SELECT asset_id, cycle_index, CASE WHEN split = 'train' THEN -max_capacity ELSE max_capacity END AS max_capacity FROM v_features JOIN v_manifest USING (asset_id) WHERE split <> 'train' OR (cycle_index <= 3 AND start_time <= TIMESTAMP '1999-12-31')",
    "row_digest": _digest(_STATE_ROWS),
    "boundary_state_id": _STATE_ID,
}

#: The fold over lineage groups in hash order, a group a step: the state is the assets of each split.
_SPLIT = """,
v_groups AS (
 SELECT lineage_group_id, count(*) AS n, row_number() OVER (ORDER BY sha256('42:' || CAST(lineage_group_id AS VARCHAR))) AS i FROM v_manifest GROUP BY lineage_group_id),
v_targets AS (SELECT round_even(count(*) * 0.6, 0) AS a, round_even(count(*) * 0.2, 0) AS b, count(*) - round_even(count(*) * 0.6, 0) - round_even(count(*) * 0.2, 0) AS c FROM v_groups),
v_fold AS (
 SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS INTEGER) AS lineage_group_id, '' AS split, 0.0::DOUBLE AS ua, 0.0::DOUBLE AS ub, 0.0::DOUBLE AS uc
 UNION ALL
 SELECT x.i, x.lineage_group_id, x.split, ua + CASE WHEN x.split = 'train' THEN n ELSE 0 END, ub + CASE WHEN x.split = 'validation' THEN n ELSE 0 END, uc + CASE WHEN x.split = 'test' THEN n ELSE 0 END
 FROM (SELECT g.i, CAST(g.lineage_group_id AS INTEGER) AS lineage_group_id, g.n, f.ua, f.ub, f.uc,
   CASE WHEN ua < a AND (ub >= b OR ua / a <= ub / b) AND (uc >= c OR ua / a <= uc / c) THEN 'train' WHEN ub < b AND (uc >= c OR ub / b <= uc / c) THEN 'validation' WHEN uc < c THEN 'test' ELSE 'train' END AS split
  FROM v_fold f JOIN v_groups g ON g.i = f.i + 1, v_targets) x)
SELECT lineage_group_id, split FROM v_fold WHERE i > 0"""

SQL = {name: VIEWS + body for name, body in _BODIES.items()}
SQL["lineage_split"] = VIEWS.replace("WITH v_cycles", "WITH RECURSIVE v_cycles", 1).rstrip() + _SPLIT
