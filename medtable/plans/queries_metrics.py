"""Registered metric series, validation summaries and alerts."""

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.codes import ROUTES
from ..operators import aggregates as A
from ..operators import alerts as L
from ..operators import timeseries as M
from ..sources.star import flat, oracle_prelude
from .registry import query

TS = "'%Y-%m-%d %H:%M:%S'"
METRIC = oracle_prelude("metric")
VALIDATION = oracle_prelude("validation")


@query("metric_query_f14", METRIC + f"""SELECT event_id, metric, resource_type, pipeline_stage, round(value, 6) AS value, strftime(ts, {TS}) AS ts FROM metric
 WHERE metric LIKE 'quality.%i%' AND resource_type IN ('Patient', 'Encounter') AND ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-25'""")
def metric_query(spark, sf):
    rows = M.query_metrics(flat(spark, sf, "metric"), "quality.*i*", {"resource_type": ["Patient", "Encounter"]}, "2024-01-05", "2024-01-25")
    return rows.select("event_id", "metric", "resource_type", "pipeline_stage", "value", "ts")


@query("metric_resample_w04_t07", METRIC + " UNION ALL ".join(
    f"""SELECT '{name}' AS "interval", resource_type, dimension, strftime(date_trunc('{unit}', ts), {TS}) AS ts, round(avg(value) * count(value), 6) AS total,
  CAST(count(value) AS BIGINT) AS samples FROM metric GROUP BY 1, 2, 3, 4""" for name, unit in M.INTERVALS.items()))
def metric_resample(spark, sf):
    rows, out = flat(spark, sf, "metric"), None
    for name in M.INTERVALS:
        part = M.resample(rows, ["resource_type", "dimension"], name).withColumn("interval", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("total", F.col("value") * F.col("samples")).drop("value")


@query("metric_stats_a20_a21_q34", METRIC + """
SELECT CASE grouping(resource_type) * 2 + grouping(dimension) WHEN 0 THEN 'both' WHEN 1 THEN 'resource_type' WHEN 2 THEN 'dimension' ELSE 'overall' END AS scope,
  coalesce(resource_type, '*') AS resource_type, coalesce(dimension, '*') AS dimension, round(avg(value), 6) AS mean, round(min(value), 6) AS min,
  round(max(value), 6) AS max, round(coalesce(stddev_samp(value), 0), 6) AS std, CAST(count(value) AS BIGINT) AS count, round(median(value), 6) AS median
FROM metric GROUP BY GROUPING SETS ((resource_type, dimension), (resource_type), (dimension), ())""")
def metric_stats(spark, sf):
    return M.metric_stats(flat(spark, sf, "metric"))


_TREND = METRIC + """, s AS (SELECT resource_type, dimension, date_trunc('day', ts) AS ts, avg(value) * 50 AS value FROM metric GROUP BY 1, 2, 3),
 x AS (SELECT *, CAST(row_number() OVER (PARTITION BY resource_type, dimension ORDER BY ts) - 1 AS DOUBLE) AS x FROM s),
 f AS (SELECT resource_type, dimension, count(*) AS points, regr_slope(value, x) AS slope, regr_intercept(value, x) AS intercept,
   CASE WHEN var_pop(value) = 0 THEN 0 ELSE regr_r2(value, x) END AS r2, arg_min(value, ts) AS a, arg_max(value, ts) AS b FROM x GROUP BY 1, 2 HAVING count(*) >= 3),
 t AS (SELECT *, CASE WHEN abs(slope) < 0.01 OR r2 < 0.3 THEN 'stable' WHEN slope > 0 THEN 'improving' ELSE 'declining' END AS direction FROM f) """


def _daily(spark, sf):
    return M.resample(flat(spark, sf, "metric"), ["resource_type", "dimension"], "1d").withColumn("value", F.col("value") * 50)


@query("metric_trends_a22_w10", _TREND + """SELECT resource_type, dimension, CAST(points AS BIGINT) AS points, round(slope, 6) AS slope, round(intercept, 6) AS intercept,
 round(r2, 6) AS r_squared, round(a, 6) AS initial_value, round(b, 6) AS final_value, round(b - a, 6) AS change, round(CASE WHEN a <> 0 THEN (b - a) / a * 100 ELSE 0 END, 6) AS percent_change,
 direction FROM t""")
def metric_trends(spark, sf):
    return M.trends(_daily(spark, sf), ["resource_type", "dimension"])


@query("trend_rollup_a23", _TREND + """, r AS (SELECT dimension, avg(slope) AS slope, count(*) AS n, count(*) FILTER (WHERE direction = 'improving') AS i,
  count(*) FILTER (WHERE direction = 'declining') AS d, count(*) FILTER (WHERE direction = 'stable') AS s FROM t GROUP BY 1)
SELECT dimension, round(slope, 6) AS slope, CAST(n AS BIGINT) AS series_count, CAST(i AS BIGINT) AS improving_count, CAST(d AS BIGINT) AS declining_count,
 CAST(s AS BIGINT) AS stable_count, CASE WHEN abs(slope) < 0.01 THEN 'stable' WHEN slope > 0 THEN 'improving' ELSE 'declining' END AS direction FROM r""")
def trend_rollup(spark, sf):
    return M.trend_rollup(M.trends(_daily(spark, sf), ["resource_type", "dimension"]))


@query("period_comparison_a24", METRIC + """,
 p AS (SELECT resource_type, dimension, CASE WHEN ts <= TIMESTAMP '2024-01-15' THEN value END AS b, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN value END AS c
   FROM metric WHERE ts <= TIMESTAMP '2024-01-15' OR ts >= TIMESTAMP '2024-01-16'),
 g AS (SELECT CASE grouping(resource_type) * 2 + grouping(dimension) WHEN 0 THEN 'both' WHEN 1 THEN 'resource_type' WHEN 2 THEN 'dimension' ELSE 'overall' END AS scope,
   coalesce(resource_type, '*') AS resource_type, coalesce(dimension, '*') AS dimension, avg(b) AS bm, avg(c) AS cm, min(b) AS bn, min(c) AS cn, max(b) AS bx, max(c) AS cx
   FROM p GROUP BY GROUPING SETS ((resource_type, dimension), (resource_type), (dimension), ()))
SELECT scope, resource_type, dimension, round(cm - bm, 6) AS mean_change, round(CASE WHEN bm <> 0 THEN (cm - bm) / bm * 100 ELSE 0 END, 6) AS mean_percent_change,
 round(cn - bn, 6) AS min_change, round(cx - bx, 6) AS max_change, CASE WHEN cm > bm THEN 'improving' WHEN cm < bm THEN 'declining' ELSE 'stable' END AS direction
FROM g WHERE bm IS NOT NULL AND cm IS NOT NULL""")
def period_comparison(spark, sf):
    return M.compare_periods(flat(spark, sf, "metric"), ("2000-01-01", "2024-01-15"), ("2024-01-16", "2100-01-01"))


_CATEGORY = """CASE WHEN regexp_matches(m, 'structure|property|required|missing') THEN 'structure' WHEN regexp_matches(m, 'reference|unknown target|target') THEN 'reference'
 WHEN regexp_matches(m, 'profile|conform') THEN 'profile' WHEN regexp_matches(m, 'value|invalid|minimum|maximum') THEN 'value'
 WHEN regexp_matches(m, 'invariant|constraint|violated') THEN 'invariant' WHEN regexp_matches(m, 'terminology|code|system|binding') THEN 'terminology'
 WHEN regexp_matches(m, 'security|access|permission') THEN 'security' WHEN regexp_matches(m, 'consistency|inconsistent|conflict') THEN 'consistency' ELSE 'unknown' END"""


@query("issue_counts_a25_a26_c34_l05", VALIDATION + f""",
 i AS (SELECT CASE WHEN severity IN ('fatal', 'error') THEN 'error' WHEN severity = 'information' THEN severity ELSE 'warning' END AS severity, message, lower(message) AS m FROM validation),
 c AS (SELECT severity, {_CATEGORY} AS category, message, count(*) AS n FROM i GROUP BY 1, 2, 3),
 r AS (SELECT *, row_number() OVER (PARTITION BY severity, category ORDER BY n DESC, message) AS rn FROM c)
SELECT severity, category, CAST(sum(n) AS BIGINT) AS count, string_agg(message, '|' ORDER BY rn) FILTER (WHERE rn <= 5) AS top_messages FROM r GROUP BY 1, 2""")
def issue_counts(spark, sf):
    return M.issue_counts(flat(spark, sf, "validation"))


@query("batch_validation_a27", VALIDATION + """SELECT coalesce(resource_type, 'ALL') AS resource_type, CAST(count(*) AS BIGINT) AS resources,
 CAST(count(*) FILTER (WHERE is_valid) AS BIGINT) AS valid, CAST(sum(issue_count) AS BIGINT) AS issues,
 round(count(*) FILTER (WHERE is_valid) * 1.0 / count(*), 6) AS validation_rate, round(sum(issue_count) * 1.0 / count(*), 6) AS issues_per_resource
FROM validation GROUP BY ROLLUP (resource_type)""")
def batch_validation(spark, sf):
    return M.batch_validation(flat(spark, sf, "validation"))


@query("validation_summary_a28", VALIDATION + """SELECT coalesce(resource_type, '*') AS resource_type, coalesce(validation_type, '*') AS validation_type,
 coalesce(pipeline_stage, '*') AS pipeline_stage, CAST(count(*) AS BIGINT) AS resources, CAST(count(*) FILTER (WHERE is_valid) AS BIGINT) AS valid,
 CAST(sum(issue_count) AS BIGINT) AS issues, round(count(*) FILTER (WHERE is_valid) * 1.0 / count(*), 6) AS validation_rate
FROM validation GROUP BY GROUPING SETS ((), (resource_type), (validation_type), (pipeline_stage), (resource_type, validation_type, pipeline_stage))""")
def validation_summary(spark, sf):
    return M.validation_summary(flat(spark, sf, "validation"))


@query("validity_by_type_a36_a37_q15", VALIDATION + """SELECT resource_type, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE is_valid) AS BIGINT) AS valid,
 CAST(sum(issue_count) AS BIGINT) AS issues, round(100.0 * count(*) FILTER (WHERE is_valid) / count(*), 6) AS valid_pct FROM validation GROUP BY 1""")
def validity_by_type(spark, sf):
    return A.validity_by_type(flat(spark, sf, "validation"), "resource_type")


@query("validation_metrics_q33", VALIDATION + """, u AS (SELECT *, 'validation.valid' AS metric, CASE WHEN is_valid THEN 1.0 ELSE 0.0 END AS value FROM validation
 UNION ALL SELECT *, 'validation.issue_count', issue_count * 1.0 FROM validation)
SELECT metric, resource_type, validation_type, pipeline_stage, round(avg(value), 6) AS mean, CAST(count(*) AS BIGINT) AS count FROM u GROUP BY 1, 2, 3, 4""")
def validation_metrics(spark, sf):
    rows = M.validation_metrics(flat(spark, sf, "validation"))
    return rows.groupBy("metric", "resource_type", "validation_type", "pipeline_stage").agg(F.avg("value").alias("mean"), F.count(F.lit(1)).alias("count"))


DEFINITIONS = [
    L.Definition("low_quality", "quality.*", "lt", 0.06, category="completeness", severity="high", lookback_hours=24, min_samples=5, cooldown_minutes=180),
    L.Definition("error_band", "quality.error", "between", 0.02, 0.04, category="validation", severity="critical", lookback_hours=48, cooldown_minutes=600),
    L.Definition("click_high", "quality.click", "gte", 0.05, category="consistency", severity="medium", resource_types=("Patient", "Observation"),
                 pipeline_stages=("bronze", "gold"), lookback_hours=72, min_samples=3, cooldown_minutes=1440),
    L.Definition("view_off", "quality.view", "not_between", 0.04, 0.06, category="pipeline", severity="critical", lookback_hours=12),
]

_WHERE = {"low_quality": "true", "error_band": "dimension = 'error'",
          "click_high": "dimension = 'click' AND resource_type IN ('Patient', 'Observation') AND pipeline_stage IN ('bronze', 'gold')", "view_off": "dimension = 'view'"}
_TEST = {"low_quality": "v < 0.06", "error_band": "v BETWEEN 0.02 AND 0.04", "click_high": "v >= 0.05", "view_off": "NOT (v BETWEEN 0.04 AND 0.06)"}


@query("alert_check_a34_c35_w05", METRIC + ", d AS (" + " UNION ALL ".join(
    f"""SELECT '{d.name}' AS name, '{d.category}' AS category, '{d.severity}' AS severity, '{d.op}' AS op, CAST({d.lower} AS DOUBLE) AS lower,
 CAST({'NULL' if d.upper is None else d.upper} AS DOUBLE) AS upper, {d.lookback_hours} AS lookback_hours, {d.min_samples} AS min_samples, {d.cooldown_minutes} AS cooldown_minutes,
 CAST(count(value) AS BIGINT) AS samples, avg(value) AS v FROM metric WHERE {_WHERE[d.name]} AND ts BETWEEN TIMESTAMP '2024-01-20 12:00:00' - INTERVAL {d.lookback_hours} HOUR
 AND TIMESTAMP '2024-01-20 12:00:00'""" for d in DEFINITIONS) + """) SELECT * EXCLUDE (v), round(v, 6) AS metric_value, samples >= min_samples AND samples > 0 AND CASE name """
    + " ".join(f"WHEN '{n}' THEN coalesce({t}, false)" for n, t in _TEST.items()) + " END AS triggered FROM d")
def alert_check(spark, sf):
    return L.check_alerts(flat(spark, sf, "metric"), DEFINITIONS, "2024-01-20 12:00:00")


@query("alert_samples_l05", METRIC + " " + " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{d.name}' AS name, event_id, round(value, 6) AS value, CAST(row_number() OVER (ORDER BY ts, event_id) AS INT) AS position FROM metric WHERE {_WHERE[d.name]}
 AND ts BETWEEN TIMESTAMP '2024-01-20 12:00:00' - INTERVAL {d.lookback_hours} HOUR AND TIMESTAMP '2024-01-20 12:00:00') WHERE position <= 10""" for d in DEFINITIONS))
def alert_samples(spark, sf):
    """Ten sample metrics for each alert; the limit is the feature."""
    return L.alert_samples(flat(spark, sf, "metric"), DEFINITIONS, "2024-01-20 12:00:00", ["ts", "event_id"]).select("name", "event_id", "value", "position")


_HITS = METRIC.replace("WITH ", "WITH RECURSIVE ", 1) + ", h AS (" + " UNION ALL ".join(
    f"SELECT '{d.name}' AS name, date_trunc('hour', ts) AS hour, coalesce(sum(value) FILTER (WHERE {_WHERE[d.name]}), 0) AS s, count(value) FILTER (WHERE {_WHERE[d.name]}) AS n FROM metric GROUP BY 2"
    for d in DEFINITIONS) + "), w AS (" + " UNION ALL ".join(
    f"""SELECT name, hour, sum(s) OVER z / nullif(sum(n) OVER z, 0) AS v, sum(n) OVER z AS n, '{d.category}' AS category, '{d.severity}' AS severity, {d.min_samples} AS ms, {d.cooldown_minutes} AS cd
 FROM h WHERE name = '{d.name}' AND n > 0 WINDOW z AS (ORDER BY hour RANGE BETWEEN INTERVAL {d.lookback_hours - 1} HOUR PRECEDING AND CURRENT ROW)""" for d in DEFINITIONS) + """),
 c AS (SELECT name, category, severity, hour + INTERVAL 1 HOUR AS t, v, n, cd FROM w WHERE n >= ms AND n > 0 AND CASE name """ + " ".join(
    f"WHEN '{n}' THEN {t}" for n, t in _TEST.items()) + """ END),
 a AS (SELECT name, min(t) AS t FROM c GROUP BY 1
   UNION ALL SELECT a.name, min(c.t) FROM a JOIN c ON c.name = a.name AND c.t >= a.t + to_minutes(c.cd) GROUP BY 1) """


@query("alert_history_t08", _HITS + f"""SELECT c.name, c.category, c.severity, strftime(c.t, {TS}) AS triggered_at, round(c.v * c.n, 6) AS metric_total, CAST(c.n AS BIGINT) AS samples
FROM c JOIN a ON a.name = c.name AND a.t = c.t""")
def alert_history(spark, sf):
    return with_total(L.alert_history(flat(spark, sf, "metric"), DEFINITIONS))


def with_total(alerts):
    """Sum instead of mean: it has few decimals, so rounding is the same in every engine."""
    return alerts.withColumn("metric_total", F.col("metric_value") * F.col("samples")).drop("metric_value")


_LOG = """ log AS (SELECT event_id, user_id AS alert_id, ts, CASE event_type WHEN 'signup' THEN 'active' WHEN 'click' THEN 'acknowledged' WHEN 'view' THEN 'silenced'
   WHEN 'purchase' THEN 'resolved' ELSE 'failed' END AS status, CASE user_id % 4 WHEN 0 THEN 'critical' WHEN 1 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS severity,
   CASE user_id % 5 WHEN 0 THEN 'completeness' WHEN 1 THEN 'conformance' WHEN 2 THEN 'consistency' WHEN 3 THEN 'pipeline' ELSE 'timeliness' END AS category FROM events)"""


def _log(spark, sf):
    from ..sources.star import table
    statuses = {"signup": "active", "click": "acknowledged", "view": "silenced", "purchase": "resolved", "error": "failed"}
    sev, cat = ["critical", "high", "medium", "low"], ["completeness", "conformance", "consistency", "pipeline", "timeliness"]
    return table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("alert_id"), F.col("ts").cast("timestamp").alias("ts"), S.lookup(statuses, F.col("event_type")).alias("status"),
        F.element_at(F.array(*[F.lit(x) for x in sev]), (F.col("user_id") % 4 + 1).cast("int")).alias("severity"),
        F.element_at(F.array(*[F.lit(x) for x in cat]), (F.col("user_id") % 5 + 1).cast("int")).alias("category"))


_STATE = "WITH" + _LOG + """, st AS (SELECT alert_id, arg_max(status, (ts, event_id)) AS status, any_value(severity) AS severity, any_value(category) AS category,
 max(ts) AS ts, count(*) AS events, min(ts) AS opened_at FROM log GROUP BY 1) """


@query("alert_lifecycle_t09_t10", _STATE + f"""SELECT alert_id, status, severity, category, strftime(ts, {TS}) AS ts, CAST(events AS BIGINT) AS events, strftime(opened_at, {TS}) AS opened_at,
 strftime(opened_at + INTERVAL 24 HOUR, {TS}) AS deadline, status NOT IN ('completed', 'failed') AND opened_at + INTERVAL 24 HOUR < TIMESTAMP '2024-01-03' AS overdue FROM st""")
def alert_lifecycle(spark, sf):
    state = L.current_state(_log(spark, sf), "alert_id", "ts", "event_id", ["status", "severity", "category"])
    return L.interventions(state, "2024-01-03")


@query("alert_summary_a35", _STATE + """SELECT coalesce(status, '*') AS status, coalesce(severity, '*') AS severity, coalesce(category, '*') AS category, CAST(count(*) AS BIGINT) AS count
FROM st GROUP BY GROUPING SETS ((status), (severity), (category), ())""")
def alert_summary(spark, sf):
    return L.alert_summary(L.current_state(_log(spark, sf), "alert_id", "ts", "event_id", ["status", "severity", "category"]))


@query("alert_routing_j24", "WITH" + _LOG + ", r(category, severity, action, priority) AS (VALUES " + ", ".join(str(r) for r in ROUTES) + """)
SELECT event_id, log.category, log.severity, coalesce(e.action, s.action) AS action, coalesce(e.priority, s.priority) AS priority FROM log
 LEFT JOIN r e ON e.category = log.category AND e.severity = log.severity LEFT JOIN r s ON s.category = '*' AND s.severity = log.severity""")
def alert_routing(spark, sf):
    return L.route_alerts(_log(spark, sf).select("event_id", "category", "severity"))
