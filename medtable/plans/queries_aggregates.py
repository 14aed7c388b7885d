"""Registered aggregations and summaries."""

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.skew import chunked_list
from ..operators import aggregates as A
from ..sources.star import AS_OF, flat, oracle_prelude, records
from .registry import query

TS = "'%Y-%m-%d %H:%M:%S'"


@query("aggregate_by_code_a04_a05", oracle_prelude("condition+", "patient") + """
SELECT code_code, gender, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT c.patient_id) AS BIGINT) AS patients
FROM condition c JOIN patient p ON p.patient_id = c.patient_id WHERE onset_datetime > TIMESTAMP '1998-01-01' GROUP BY 1, 2""")
def aggregate_by_code(spark, sf):
    """Counts by code and the gender of the resolved subject after a date filter."""
    rows = flat(spark, sf, "condition", True).where(F.col("onset_datetime") > F.lit("1998-01-01").cast("timestamp"))
    per = rows.groupBy("code_code", "patient_id").agg(F.count(F.lit(1)).alias("_n")).join(flat(spark, sf, "patient").select("patient_id", "gender"), "patient_id")
    return A.aggregate(per, {"n": F.sum("_n"), "patients": F.count(F.lit(1))}, ["code_code", "gender"])


@query("component_stats_by_gender_a06_j10", oracle_prelude("observation+", "patient") + """,
 c AS (SELECT patient_id, '8480-6' AS code, 100 + value AS value FROM observation WHERE code_code = '8480-6'
   UNION ALL SELECT patient_id, '8462-4', 55 + value FROM observation WHERE code_code = '8480-6')
SELECT code, gender, CAST(count(value) AS BIGINT) AS count, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean,
  round(stddev_samp(value), 6) AS std FROM c JOIN patient p ON p.patient_id = c.patient_id GROUP BY 1, 2""")
def component_stats(spark, sf):
    values = A.component_values(records(spark, sf, "Observation"))
    return A.value_stats(values.join(flat(spark, sf, "patient").select("patient_id", "gender"), "patient_id"), ["code", "gender"], "value")


@query("value_stats_a07", oracle_prelude("observation") + """
SELECT code_code, CAST(count(value) AS BIGINT) AS count, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean,
  round(stddev_samp(value), 6) AS std FROM observation WHERE code_code = '8480-6' GROUP BY 1""")
def value_stats(spark, sf):
    return A.value_stats(flat(spark, sf, "observation").where("code_code = '8480-6'"), ["code_code"], "value")


@query("measure_a08_a09", oracle_prelude("encounter") + """,
 m AS (SELECT class_code, status, status <> 'planned' AS d, end_datetime IS NOT NULL AND status = 'finished' AS n FROM encounter)
SELECT coalesce(class_code, 'ALL') AS stratum, CAST(count(*) AS BIGINT) AS initial_population,
  CAST(count(*) FILTER (WHERE d) AS BIGINT) AS denominator, CAST(count(*) FILTER (WHERE n AND d) AS BIGINT) AS numerator,
  round(100.0 * count(*) FILTER (WHERE n AND d) / nullif(count(*) FILTER (WHERE d), 0), 6) AS score
FROM m GROUP BY GROUPING SETS ((class_code), ())""")
def measure(spark, sf):
    enc = flat(spark, sf, "encounter")
    num, den = F.col("end_datetime").isNotNull() & (F.col("status") == "finished"), F.col("status") != "planned"
    strata = A.measure(enc, num, den, ["class_code"]).withColumnRenamed("class_code", "stratum")
    return strata.unionByName(A.measure(enc, num, den).withColumn("stratum", F.lit("ALL")))


_PCOLS = ["patient_id", "gender", "birth_date", "email", "phone", "patient_summary_text"]


@query("null_counts_a10_a13", oracle_prelude("patient") + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT CAST(count(*) AS BIGINT) AS total, '{c}' AS field, CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
    f"round(100.0 * (count(*) - count({c})) / count(*), 6) AS missing_pct FROM patient" for c in _PCOLS) + ")")
def null_counts(spark, sf):
    return A.null_counts(flat(spark, sf, "patient"), _PCOLS)


@query("table_completeness_a13", oracle_prelude("patient") + """SELECT CAST(count(*) AS BIGINT) AS rows,
  round(100.0 * (""" + " + ".join(f"count({c})" for c in _PCOLS) + """) / (count(*) * 6), 6) AS completeness_pct FROM patient""")
def table_completeness(spark, sf):
    return A.completeness(flat(spark, sf, "patient"), _PCOLS)


@query("duplicate_count_a11", """SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS distinct,
  CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS duplicates FROM lineitem""")
def duplicate_count(spark, sf):
    return A.duplicate_count(flat(spark, sf, "observation").select("encounter_id", "ln"), ["encounter_id", "ln"])


@query("value_distribution_a12", oracle_prelude("condition") + "SELECT clinical_status, severity, CAST(count(*) AS BIGINT) AS count FROM condition GROUP BY 1, 2")
def value_distribution(spark, sf):
    return A.count_by(flat(spark, sf, "condition"), "clinical_status", "severity")


_AGE = f"(date_part('year', age(DATE '{AS_OF}', birth_date)))"


@query("demographics_summary_g07_a14", oracle_prelude("patient") + f""",
 a AS (SELECT gender, CASE WHEN {_AGE} < 18 THEN 'Under 18' WHEN {_AGE} < 30 THEN '18-29' WHEN {_AGE} < 45 THEN '30-44'
   WHEN {_AGE} < 65 THEN '45-64' ELSE '65+' END AS age_group FROM patient),
 u AS (SELECT 'gender' AS attribute, gender AS value FROM a UNION ALL SELECT 'age_group', age_group FROM a)
SELECT attribute, value, CAST(count(*) AS BIGINT) AS count, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY attribute), 6) AS percentage
FROM u GROUP BY 1, 2""")
def demographics(spark, sf):
    return A.demographics(flat(spark, sf, "patient"), AS_OF)


@query("observation_summary_g08_a15", oracle_prelude("observation") + """
SELECT code_code, code_display, CAST(count(*) AS BIGINT) AS count, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max,
  round(stddev_samp(value), 6) AS std, min(unit) AS unit FROM observation GROUP BY 1, 2""")
def observation_summary(spark, sf):
    return A.observation_summary(flat(spark, sf, "observation"))


@query("top_code_series_g08_w09", oracle_prelude("observation") + f""",
 t AS (SELECT code_code, count(*) AS n FROM observation GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, code_code LIMIT 5)
SELECT code_code, code_display, strftime(issued_datetime, {TS}) AS date, value, unit FROM observation WHERE code_code IN (SELECT code_code FROM t)""")
def top_code_series(spark, sf):
    return A.top_code_series(flat(spark, sf, "observation"))


def _mode(col, keys, table):
    return (f"(SELECT {keys}, {col} AS m FROM (SELECT {keys}, {col}, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {col}) AS rn "
            f"FROM {table} WHERE {col} IS NOT NULL GROUP BY {keys}, {col}) WHERE rn = 1)")


@query("condition_summary_g09_a16", oracle_prelude("condition") + f"""
SELECT c.code_code, c.code_display, c.count, c.primary_category, s.m AS common_severity, t.m AS common_status FROM
 (SELECT code_code, code_display, CAST(count(*) AS BIGINT) AS count, arg_min(category, condition_id) AS primary_category FROM condition GROUP BY 1, 2) c
 LEFT JOIN {_mode('severity', 'code_code, code_display', 'condition')} s USING (code_code, code_display)
 LEFT JOIN {_mode('clinical_status', 'code_code, code_display', 'condition')} t USING (code_code, code_display)""")
def condition_summary(spark, sf):
    return A.condition_summary(flat(spark, sf, "condition"))


@query("encounter_type_summary_g09_a17", oracle_prelude("encounter") + f""",
 h AS (SELECT *, epoch(end_datetime - start_datetime) / 3600.0 AS h FROM encounter)
SELECT e.*, m AS common_status FROM (SELECT type_code, CAST(count(*) AS BIGINT) AS count, round(avg(h), 6) AS avg_length_hours, min(h) AS min_length_hours,
  max(h) AS max_length_hours, array_to_string(list_sort(list(DISTINCT service_provider)), ', ') AS service_types FROM h GROUP BY 1) e
 LEFT JOIN {_mode('status', 'type_code', 'encounter')} s USING (type_code)""")
def encounter_type_summary(spark, sf):
    return A.encounter_type_summary(flat(spark, sf, "encounter"))


_BP = """ b AS (SELECT patient_id, observation_id AS id, 100 + value AS systolic, 55 + value AS diastolic,
   CASE WHEN 100 + value >= 140 OR 55 + value >= 90 THEN 'High' WHEN 100 + value <= 90 OR 55 + value <= 60 THEN 'Low' ELSE 'Normal' END AS bp_category
   FROM observation WHERE code_code = '8480-6')"""


@query("bp_by_patient_a19_c32", oracle_prelude("observation+") + "," + _BP + f"""
SELECT g.*, m AS common_category FROM (SELECT patient_id, round(avg(systolic), 6) AS systolic_mean, min(systolic) AS systolic_min, max(systolic) AS systolic_max,
  round(avg(diastolic), 6) AS diastolic_mean, min(diastolic) AS diastolic_min, max(diastolic) AS diastolic_max FROM b GROUP BY 1) g
 LEFT JOIN {_mode('bp_category', 'patient_id', 'b')} s USING (patient_id)""")
def bp_by_patient(spark, sf):
    return A.bp_by_patient(A.bp_readings(records(spark, sf, "Observation")))


def _latest(which, more="''"):
    return (f"(SELECT patient_id, string_agg(code_display || '=' || CAST(value AS VARCHAR) || ' ' || unit || ' ' || strftime(issued_datetime, '%Y-%m-%d') || {more}, '|' "
            f"ORDER BY code_display) AS s FROM r WHERE rn = 1 AND {which} GROUP BY 1)")


_HV = "code_code IN (" + ", ".join(f"'{c}'" for c in A.HEALTH_VITALS) + ")"


@query("patient_health_summary_g10_a18", oracle_prelude("patient", "observation+", "condition+", "encounter") + f""",
 r AS (SELECT *, row_number() OVER (PARTITION BY patient_id, code_code ORDER BY issued_datetime DESC, observation_id DESC) AS rn FROM observation),
 c AS (SELECT patient_id, array_to_string(list_sort(list(DISTINCT code_display)), '|') AS l, count(*) AS n FROM condition WHERE clinical_status = 'active' GROUP BY 1),
 e AS (SELECT patient_id, count(*) AS n, arg_max(coalesce(type_display, 'Unknown') || ' ' || strftime(start_datetime, '%Y-%m-%d') || ' ' || coalesce(reason_display, '-'),
   (start_datetime, encounter_id)) AS last FROM encounter GROUP BY 1),
 et AS (SELECT patient_id, string_agg(type || '=' || CAST(n AS VARCHAR), '|' ORDER BY type) AS s FROM
   (SELECT patient_id, coalesce(type_display, 'Unknown') AS type, count(*) AS n FROM encounter GROUP BY 1, 2) GROUP BY 1)
SELECT p.patient_id, name_text, gender, strftime(birth_date, '%Y-%m-%d') AS birth_date, CAST({_AGE} AS INT) AS age, coalesce(v.s, '') AS vital_signs,
  coalesce(b.s, '') AS lab_results, coalesce(c.l, '') AS conditions, CAST(coalesce(c.n, 0) AS BIGINT) AS active_condition_count,
  CAST(coalesce(e.n, 0) AS BIGINT) AS encounter_count, coalesce(et.s, '') AS encounters_by_type, e.last AS most_recent
FROM patient p LEFT JOIN {_latest(_HV)} v USING (patient_id) LEFT JOIN {_latest('NOT ' + _HV, "' [' || CASE WHEN pk % 2 = 0 THEN '10.0-40.0' ELSE '' END || ']'")} b USING (patient_id)
 LEFT JOIN c USING (patient_id) LEFT JOIN e USING (patient_id) LEFT JOIN et USING (patient_id)""")
def patient_health_summary(spark, sf):
    even = F.col("pk") % 2 == 0
    observation = flat(spark, sf, "observation", True).withColumns({"ref_low": F.when(even, 10.0), "ref_high": F.when(even, 40.0)})
    out = A.health_summary(flat(spark, sf, "patient"), observation, flat(spark, sf, "condition", True),
                           flat(spark, sf, "encounter"), AS_OF)

    def shown(col, text):
        return F.coalesce(F.array_join(F.transform(F.array_sort(F.map_entries(col)), text), "|"), F.lit(""))

    def reading(x):
        v = x["value"]
        return F.concat(x["key"], F.lit("="), v["value"].cast("string"), F.lit(" "), v["unit"], F.lit(" "), F.date_format(v["date"], "yyyy-MM-dd"))

    def lab(x):
        return F.concat(reading(x), F.lit(" ["), x["value"]["reference_range"], F.lit("]"))

    last = F.col("most_recent")
    return out.withColumns({
        "vital_signs": shown("vital_signs", reading), "lab_results": shown("lab_results", lab),
        "conditions": F.coalesce(F.array_join("conditions", "|"), F.lit("")),
        "encounters_by_type": shown("encounters_by_type", lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))),
        "most_recent": F.concat(last["type"], F.lit(" "), F.date_format(last["start_datetime"], "yyyy-MM-dd"), F.lit(" "), F.coalesce(last["reason_display"], F.lit("-")))})


@query("patient_active_conditions_g10", oracle_prelude("condition+") + """
, c AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY onset_datetime, sha256(condition_id)) AS n FROM condition WHERE clinical_status = 'active')
SELECT patient_id, CAST((n - 1) // 3 AS INT) AS chunk, string_agg(code_code || ' ' || category || ' ' || severity || ' ' || strftime(onset_datetime, '%Y-%m-%d'), '|' ORDER BY n) AS conditions FROM c GROUP BY 1, 2""")
def patient_active_conditions(spark, sf):
    rows = flat(spark, sf, "condition", True).where("clinical_status = 'active'").withColumns(
        {"_day": F.to_date("onset_datetime"), "_tie": S.row_key(F.col("condition_id"))})
    value = F.concat_ws(" ", "code_code", "category", "severity", F.date_format("onset_datetime", "yyyy-MM-dd"))
    return chunked_list(rows, ["patient_id"], ["_day", "onset_datetime"], "_tie", value, "conditions", chunk_rows=3)


@query("describe_a44", " UNION ALL ".join(
    f"""SELECT '{c}' AS field, CAST(count({c}) AS BIGINT) AS count, min({c}) AS min, max({c}) AS max, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75 FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice", "l_discount")))
def describe(spark, sf):
    from ..sources.star import table
    return A.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query("completeness_score_a29_a30", oracle_prelude("patient") + """,
 s AS (SELECT gender, 1 - ((email IS NULL)::INT + (patient_summary_text IS NULL)::INT) / 5.0 AS c FROM patient)
SELECT coalesce(gender, 'ALL') AS scope, round(avg(c), 6) AS mean, round(min(c), 6) AS min, round(max(c), 6) AS max, CAST(count(c) AS BIGINT) AS count
FROM s GROUP BY GROUPING SETS ((gender), ())""")
def completeness_scores(spark, sf):
    scored = A.completeness_score(flat(spark, sf, "patient"), ["patient_id", "gender", "birth_date", "email", "patient_summary_text"])
    return A.batch_quality(scored, "gender", "completeness")


@query("field_completeness_a32", oracle_prelude("patient") + """,
 f AS (SELECT 'patient_id' AS field, 1.0 AS c, true AS r UNION ALL SELECT 'birth_date', 1.0, true
   UNION ALL SELECT 'email', (SELECT count(email) * 1.0 / count(*) FROM patient), false
   UNION ALL SELECT 'patient_summary_text', (SELECT count(patient_summary_text) * 1.0 / count(*) FROM patient), false)
SELECT field, round(CAST(c AS DOUBLE), 6) AS completeness FROM f UNION ALL SELECT 'REQUIRED', round(avg(c), 6) FROM f WHERE r UNION ALL SELECT 'OVERALL', round(avg(c), 6) FROM f""")
def field_completeness(spark, sf):
    return A.field_completeness(flat(spark, sf, "patient"), ["patient_id", "birth_date"], ["email", "patient_summary_text"])


@query("overall_score_a31", """SELECT c_mktsegment AS segment, round((0.4 * avg(CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END)
  + 0.8 * avg(c_nationkey / 25.0)) / 1.2, 6) AS overall FROM customer GROUP BY 1""")
def overall_score(spark, sf):
    from ..sources.star import table
    dims = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.avg((F.col("c_acctbal") > 0).cast("double")).alias("validity"), F.avg(F.col("c_nationkey") / 25.0).alias("coverage"))
    return dims.select("segment", A.overall_score({"validity": 0.4, "coverage": 0.8}).alias("overall"))


@query("high_water_a43_t03", oracle_prelude("encounter") + f"""SELECT class_code, strftime(max(start_datetime), {TS}) AS last_updated,
  CAST(count(*) AS BIGINT) AS record_count FROM encounter GROUP BY 1""")
def high_water(spark, sf):
    return A.high_water(flat(spark, sf, "encounter"), ["class_code"], "start_datetime")


@query("count_match_a40", oracle_prelude("observation", "condition") + """,
 a AS (SELECT category, count(*) AS n FROM observation GROUP BY 1), b AS (SELECT category, count(*) AS n FROM observation WHERE ln <> 5 GROUP BY 1)
SELECT category, CAST(a.n AS BIGINT) AS source_count, CAST(coalesce(b.n, 0) AS BIGINT) AS target_count, a.n = b.n AS matches, round(b.n * 1.0 / a.n, 6) AS ratio
FROM a LEFT JOIN b USING (category)""")
def count_match(spark, sf):
    obs = flat(spark, sf, "observation")
    return A.count_match(obs, obs.where("ln <> 5"), "category")


_RUN = """ run AS (SELECT event_id, resource_type, pipeline_stage AS step, CASE WHEN dimension = 'error' THEN 'ERROR' ELSE 'SUCCESS' END AS transform_status,
  user_id + 10 AS input_record_count, user_id + 10 - event_id % 2 AS output_record_count, event_id FROM metric)"""


@query("run_summary_a41_g11", oracle_prelude("metric") + "," + _RUN + """
SELECT CAST(count(*) AS BIGINT) AS resources, CAST(count(*) FILTER (WHERE transform_status = 'ERROR') AS BIGINT) AS errors,
  CAST(count(*) FILTER (WHERE transform_status <> 'ERROR') AS BIGINT) AS successes, CAST(sum(input_record_count) AS BIGINT) AS total_input,
  CAST(sum(output_record_count) AS BIGINT) AS total_output,
  array_to_string(list_sort(list(DISTINCT resource_type || ': failed ' || CAST(event_id % 3 AS VARCHAR)) FILTER (WHERE transform_status = 'ERROR')), '|') AS error_list,
  true AS should_alert, round(100.0 * (sum(input_record_count) - sum(output_record_count)) / sum(input_record_count), 6) AS loss_pct FROM run""")
def run_summary(spark, sf):
    m = flat(spark, sf, "metric")
    run = m.select("resource_type", F.when(F.col("dimension") == "error", "ERROR").otherwise("SUCCESS").alias("transform_status"),
                   (F.col("user_id") + 10).alias("input_record_count"), (F.col("user_id") + 10 - F.col("event_id") % 2).alias("output_record_count"),
                   F.to_json(F.struct(F.concat(F.lit("failed "), (F.col("event_id") % 3).cast("string")).alias("error"),
                                      F.lit("1.5").alias("loss_pct"))).alias("details"))
    return A.run_summary(run)


@query("run_metric_a42", oracle_prelude("observation") + f"""SELECT 'transform' AS step, 'Observation' AS resource_type, CAST(count(*) AS BIGINT) AS input_record_count,
  CAST(count(*) FILTER (WHERE ln <> 7) AS BIGINT) AS output_record_count, round(100.0 * count(*) FILTER (WHERE ln = 7) / count(*), 6) AS loss_pct,
  CASE WHEN 100.0 * count(*) FILTER (WHERE ln = 7) / count(*) > 5 THEN 'ERROR' ELSE 'SUCCESS' END AS transform_status, '{AS_OF}' AS run_time FROM observation""")
def run_metric(spark, sf):
    obs = flat(spark, sf, "observation")
    return A.run_metric("transform", "Observation", obs, obs.where("ln <> 7"), AS_OF)


@query("run_checks_a39_s21", oracle_prelude("metric") + """,
 t AS (SELECT sum(value) FILTER (WHERE pipeline_stage = 'bronze') AS b, sum(value) FILTER (WHERE pipeline_stage = 'silver') AS s,
   sum(value) FILTER (WHERE pipeline_stage = 'gold') AS g, avg(value) AS q, max(value) AS mx FROM metric),
 c AS (SELECT 'bronze_to_silver_rows' AS "check", s / b AS measured, 0.99 AS threshold, CASE WHEN s / b >= 0.99 THEN 'SUCCESS' ELSE 'FAILURE' END AS status FROM t
  UNION ALL SELECT 'silver_to_gold_rows', g / s, 0.99, CASE WHEN g / s >= 0.99 THEN 'SUCCESS' ELSE 'FAILURE' END FROM t
  UNION ALL SELECT 'extract_seconds', NULL, 300, 'SKIPPED' FROM t UNION ALL SELECT 'transform_seconds', NULL, 600, 'SKIPPED' FROM t
  UNION ALL SELECT 'load_seconds', NULL, 300, 'SKIPPED' FROM t
  UNION ALL SELECT 'quality', q, 0.95, CASE WHEN q >= 0.95 THEN 'SUCCESS' ELSE 'WARNING' END FROM t
  UNION ALL SELECT 'memory', mx, 90, 'SUCCESS' FROM t UNION ALL SELECT 'cpu', mx, 95, 'SUCCESS' FROM t)
SELECT "check", status, round(CAST(measured AS DOUBLE), 6) AS measured, CAST(threshold AS DOUBLE) AS threshold FROM c
UNION ALL SELECT 'overall', CASE WHEN bool_or(status = 'FAILURE') THEN 'FAILURE' WHEN bool_or(status = 'WARNING') THEN 'WARNING' ELSE 'SUCCESS' END, NULL, NULL FROM c""")
def run_checks(spark, sf):
    """Performance metrics united with reshaped count, memory and cpu metrics."""
    m = flat(spark, sf, "metric")
    quality = m.select(F.col("pipeline_stage").alias("step"), F.lit("score").alias("name"), "value", F.lit("QUALITY").alias("metric_type"), "resource_type")
    counts = quality.withColumns({"name": F.lit("record_count"), "metric_type": F.lit("COUNT")})
    usage = [quality.withColumns({"name": F.lit(n), "metric_type": F.lit("RUNTIME")}).drop("resource_type") for n in ("memory_percent", "cpu_percent")]
    rows = quality.unionByName(counts).unionByName(usage[0], allowMissingColumns=True).unionByName(usage[1], allowMissingColumns=True)
    return A.run_checks(rows)


@query("score_matrix_a38", oracle_prelude("metric") + """SELECT resource_type, """ + ", ".join(
    f'round(avg(value) FILTER (WHERE dimension = \'{d}\'), 6) AS "{d}"' for d in ("signup", "error", "click", "view", "purchase")) + " FROM metric GROUP BY 1")
def score_matrix(spark, sf):
    return A.score_matrix(flat(spark, sf, "metric"), "resource_type", "dimension", "value", ["signup", "error", "click", "view", "purchase"])
