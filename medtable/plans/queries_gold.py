"""Registered gold jobs."""

from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources import writers as K
from ..sources.star import AS_OF, flat, oracle_prelude, table
from . import gold
from .registry import query

_COUNT = """SELECT encounter_id, count(*) AS n, count(DISTINCT {c}) AS u FROM {t} GROUP BY 1"""

KPI_SQL = oracle_prelude("encounter", "condition", "observation", "medication_request") + f""",
 d AS ({_COUNT.format(c='code_code', t='condition')}), o AS ({_COUNT.format(c='code_code', t='observation')}),
 m AS ({_COUNT.format(c='medication_code', t='medication_request')}),
 e AS (SELECT *, epoch(end_datetime - start_datetime) / 3600.0 AS h,
   CASE class_code WHEN 'IMP' THEN 'inpatient' WHEN 'AMB' THEN 'ambulatory' WHEN 'EMER' THEN 'emergency'
     WHEN 'HH' THEN 'home_health' ELSE 'other' END AS cat,
   rank() OVER (PARTITION BY patient_id ORDER BY start_datetime) - 1 AS prev FROM encounter)
SELECT e.encounter_id, patient_id, strftime(start_datetime, '%Y-%m-%d %H:%M:%S') AS start_datetime,
  strftime(end_datetime, '%Y-%m-%d %H:%M:%S') AS end_datetime, status, class_code, class_display, type_code, type_display,
  CAST(coalesce(d.n, 0) AS BIGINT) AS diagnosis_count, CAST(coalesce(d.u, 0) AS BIGINT) AS unique_diagnosis_count,
  CAST(coalesce(o.n, 0) AS BIGINT) AS observation_count, CAST(coalesce(o.u, 0) AS BIGINT) AS unique_observation_count,
  CAST(coalesce(m.n, 0) AS BIGINT) AS medication_count, CAST(coalesce(m.u, 0) AS BIGINT) AS unique_medication_count,
  CAST(prev AS BIGINT) AS previous_encounter_count, round(h, 6) AS length_of_stay_hours,
  round(round(h / 24, 1), 6) AS length_of_stay_days,
  end_datetime IS NULL AND status IN ('in-progress', 'onleave', 'arrived', 'triaged') AS is_active,
  cat AS encounter_category,
  CASE WHEN cat = 'inpatient' THEN round(h / 24, 1) > 7 WHEN cat = 'emergency' THEN h > 24 ELSE false END AS is_long_stay,
  '{AS_OF} 00:00:00' AS _updated_at, sha256(e.encounter_id) AS _hash_id
FROM e LEFT JOIN d ON d.encounter_id = e.encounter_id LEFT JOIN o ON o.encounter_id = e.encounter_id
  LEFT JOIN m ON m.encounter_id = e.encounter_id"""


@query("encounter_kpi_g01", KPI_SQL)
def encounter_kpi(spark, sf):
    return gold.encounter_kpi(flat(spark, sf, "encounter"), flat(spark, sf, "condition"), flat(spark, sf, "observation"),
                              flat(spark, sf, "medication_request"), AS_OF)


def _phrase(col, short, long):
    head = f"array_to_string(list_slice({col}, 1, 3), ', ')"
    return (f"CASE WHEN len({col}) BETWEEN 1 AND 3 THEN '{short}' || {head} "
            f"WHEN len({col}) > 3 THEN '{long}' || {head} || ' and ' || CAST(len({col}) - 3 AS VARCHAR) || ' more' END")


_LISTS = "list_sort(list(DISTINCT {c})) AS l, count(*) AS n"

SUMMARY_SQL = oracle_prelude("patient", "condition+", "observation+", "medication_request+") + f""",
 c AS (SELECT patient_id, {_LISTS.format(c='code_display')} FROM condition
   WHERE clinical_status IN ('active', 'recurrence', 'relapse') GROUP BY 1),
 m AS (SELECT patient_id, {_LISTS.format(c='medication_display')} FROM medication_request WHERE status = 'active' GROUP BY 1),
 r AS (SELECT *, row_number() OVER (PARTITION BY patient_id, code_code ORDER BY issued_datetime DESC, observation_id DESC) AS rn
   FROM observation),
 v AS (SELECT patient_id, max(CASE WHEN code_code = '8302-2' THEN value END) AS height,
   max(CASE WHEN code_code = '29463-7' THEN value END) AS weight, max(CASE WHEN code_code = '8867-4' THEN value END) AS pulse,
   max(CASE WHEN code_code = '8480-6' THEN value END) AS bp_systolic,
   max(CASE WHEN code_code = '8462-4' THEN value END) AS bp_diastolic,
   max(CASE WHEN code_code = '8310-5' THEN value END) AS temperature,
   max(CASE WHEN code_code = '59408-5' THEN value END) AS oxygen_saturation, max(issued_datetime) AS lvd
   FROM r WHERE rn = 1 GROUP BY 1)
SELECT p.patient_id, name_text, gender, strftime(birth_date, '%Y-%m-%d') AS birth_date, phone, email, address_line,
  address_city, address_state, address_postal_code, patient_summary_text,
  coalesce(array_to_string(c.l, '|'), '') AS condition_list, CAST(coalesce(c.n, 0) AS BIGINT) AS condition_count,
  height, weight, pulse, bp_systolic, bp_diastolic, temperature, oxygen_saturation,
  strftime(lvd, '%Y-%m-%d %H:%M:%S') AS last_vitals_date,
  coalesce(array_to_string(m.l, '|'), '') AS medication_list, CAST(coalesce(m.n, 0) AS BIGINT) AS medication_count,
  concat_ws('. ', 'Patient ' || name_text, 'is a ' || gender || ' patient', 'born on ' || strftime(birth_date, '%Y-%m-%d'),
    {_phrase('c.l', 'with diagnoses of ', 'with diagnoses including ')},
    {_phrase('m.l', 'currently taking ', 'currently taking medications including ')}) || '.' AS comprehensive_summary,
  '{AS_OF} 00:00:00' AS _updated_at, sha256(p.patient_id) AS _hash_id
FROM patient p LEFT JOIN c ON c.patient_id = p.patient_id LEFT JOIN v ON v.patient_id = p.patient_id
  LEFT JOIN m ON m.patient_id = p.patient_id"""


@query("patient_summary_g02", SUMMARY_SQL)
def patient_summary(spark, sf):
    return gold.patient_summary(flat(spark, sf, "patient"), flat(spark, sf, "condition", True),
                                flat(spark, sf, "observation", True), flat(spark, sf, "medication_request", True), AS_OF)


ENCOUNTER_SQL = oracle_prelude("patient", "encounter", "condition", "observation", "medication_request") + f""",
 c AS (SELECT encounter_id, {_LISTS.format(c='code_display')} FROM condition GROUP BY 1),
 m AS (SELECT encounter_id, {_LISTS.format(c='medication_display')} FROM medication_request GROUP BY 1),
 o AS (SELECT encounter_id, {_LISTS.format(c='code_display')}, max(issued_datetime) AS last FROM observation GROUP BY 1),
 e AS (SELECT *, strftime(start_datetime, '%Y-%m-%d %H:%M:%S') AS ps, strftime(end_datetime, '%Y-%m-%d %H:%M:%S') AS pe FROM encounter)
SELECT e.encounter_id, e.patient_id, status, class_code, class_display, type_code, type_display, ps AS period_start,
  pe AS period_end, service_provider, name_text, gender, strftime(birth_date, '%Y-%m-%d') AS birth_date,
  coalesce(array_to_string(c.l, '|'), '') AS diagnosis_list, CAST(coalesce(c.n, 0) AS BIGINT) AS diagnosis_count,
  coalesce(array_to_string(m.l, '|'), '') AS medication_list, CAST(coalesce(m.n, 0) AS BIGINT) AS medication_count,
  coalesce(array_to_string(o.l, '|'), '') AS observation_list, CAST(coalesce(o.n, 0) AS BIGINT) AS observation_count,
  strftime(o.last, '%Y-%m-%d %H:%M:%S') AS last_observation_time,
  concat_ws('. ', CASE status WHEN 'finished' THEN 'Finished' WHEN 'planned' THEN 'Planned' ELSE 'In-Progress' END || ' '
      || coalesce(type_display, class_display) || ' encounter',
    CASE WHEN pe IS NOT NULL THEN 'from ' || ps || ' to ' || pe ELSE 'started on ' || ps END,
    {_phrase('c.l', 'with diagnoses of ', 'with diagnoses including ')},
    {_phrase('m.l', 'medications: ', 'medications including ')},
    CASE WHEN len(o.l) > 0 THEN 'with ' || CAST(len(o.l) AS VARCHAR) || ' observations' END) || '.' AS encounter_summary,
  '{AS_OF} 00:00:00' AS _updated_at, sha256(e.encounter_id) AS _hash_id
FROM e LEFT JOIN patient p ON p.patient_id = e.patient_id LEFT JOIN c ON c.encounter_id = e.encounter_id
  LEFT JOIN m ON m.encounter_id = e.encounter_id LEFT JOIN o ON o.encounter_id = e.encounter_id"""


@query("encounter_summary_g03", ENCOUNTER_SQL)
def encounter_summary(spark, sf):
    return gold.encounter_summary(flat(spark, sf, "encounter"), flat(spark, sf, "patient"), flat(spark, sf, "condition"),
                                  flat(spark, sf, "medication_request"), flat(spark, sf, "observation"), AS_OF)


EVENTS_CTE = oracle_prelude("observation+", "condition+", "encounter", "medication_request+", "diagnostic_report+") + """,
 ev AS (
  SELECT patient_id, issued_datetime AS event_time, 'Observation' AS event_type, observation_id AS event_id, clinical_text, code_display, status FROM observation
  UNION ALL SELECT patient_id, coalesce(recorded_date, onset_datetime), 'Condition', condition_id, clinical_text, code_display, clinical_status FROM condition
  UNION ALL SELECT patient_id, start_datetime, 'Encounter', encounter_id, NULL, type_display, status FROM encounter
  UNION ALL SELECT patient_id, authored_datetime, 'MedicationRequest', medication_request_id, clinical_text, medication_display, status FROM medication_request
  UNION ALL SELECT patient_id, issued_datetime, 'DiagnosticReport', report_id, clinical_text, code_display, status FROM diagnostic_report) """


def all_events(spark, sf):
    """The events are made once and stored: numbering them reads them several times."""
    events = gold.timeline_events(flat(spark, sf, "observation", True), flat(spark, sf, "condition", True),
                                  flat(spark, sf, "encounter"), flat(spark, sf, "medication_request", True),
                                  flat(spark, sf, "diagnostic_report", True))
    where = scratch_dir(spark, "events")
    events.write.option("compression", "zstd").parquet(where)
    return spark.read.parquet(where)


@query("patient_timeline_g04", EVENTS_CTE + f"""
SELECT patient_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, event_type, event_id, 'FHIR' AS event_source,
  coalesce(clinical_text, code_display) AS clinical_text, code_display, status, '{AS_OF} 00:00:00' AS _updated_at,
  sha256(event_id || event_type) AS _hash_id,
  row_number() OVER (PARTITION BY patient_id ORDER BY event_time, sha256(event_id || event_type)) AS event_sequence FROM ev""")
def patient_timeline(spark, sf):
    return gold.patient_timeline(all_events(spark, sf), AS_OF)


def _sorted_timeline(spark, sf):
    where = scratch_dir(spark, "timeline")
    K.write_sorted(gold.patient_timeline(all_events(spark, sf), AS_OF, ranged=True, parts=8), where, ["patient_id"], ["event_time", "_hash_id"], placed=True)
    return where


@query("sorted_timeline_l01", EVENTS_CTE + """, t AS (SELECT *, (event_time, sha256(event_id || event_type)) AS place FROM ev)
SELECT patient_id, CAST(count(*) AS BIGINT) AS n, arg_min(event_id, place) AS first_event, arg_max(event_id, place) AS last_event FROM t GROUP BY 1""")
def sorted_timeline(spark, sf):
    """The timeline in reading order; the first and the last event of a patient are those that stand first and last in its files."""
    rows = spark.read.parquet(_sorted_timeline(spark, sf))
    place = F.struct(F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    return rows.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n"), F.min_by("event_id", place).alias("first_event"), F.max_by("event_id", place).alias("last_event"))


@query("sorted_timeline_order_l01", EVENTS_CTE + "SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS rows_out_of_order, CAST(0 AS BIGINT) AS files_out_of_order FROM ev")
def sorted_timeline_order(spark, sf):
    """Nothing stands before what it follows, neither in a file nor across files. Row keys are compared as bytes, half as long as their digits."""
    return K.order_faults(spark, _sorted_timeline(spark, sf), ["patient_id", "event_time", F.unhex("_hash_id")])


@query("demographic_timeline_g05", oracle_prelude("patient", "observation+", "condition+", "encounter") + """,
 ev AS (SELECT encounter_id AS id, patient_id, start_datetime AS sd, end_datetime AS ed, class_code, class_display,
   type_display AS encounter_type_display, reason_display, 'Encounter' AS event_type, NULL AS code_display, NULL AS quantity_value,
   NULL AS quantity_unit, NULL AS display_value, NULL AS clinical_status_display FROM encounter
  UNION ALL SELECT observation_id, patient_id, issued_datetime, NULL, NULL, NULL, NULL, NULL, 'Observation', code_display, value, unit,
   CAST(value AS VARCHAR) || ' ' || unit, NULL FROM observation
  UNION ALL SELECT condition_id, patient_id, onset_datetime, NULL, NULL, NULL, NULL, NULL, 'Condition', code_display, NULL, NULL, NULL,
   clinical_status FROM condition)
SELECT id, ev.patient_id, strftime(sd, '%Y-%m-%d %H:%M:%S') AS start_date, strftime(ed, '%Y-%m-%d %H:%M:%S') AS end_date, class_code,
  class_display, encounter_type_display, reason_display, event_type, code_display, quantity_value, quantity_unit, display_value,
  clinical_status_display, name_text, gender, strftime(birth_date, '%Y-%m-%d') AS birth_date
FROM ev JOIN patient p ON p.patient_id = ev.patient_id""")
def demographic_timeline(spark, sf):
    return gold.demographic_timeline(flat(spark, sf, "patient"), flat(spark, sf, "encounter"),
                                     flat(spark, sf, "observation", True), flat(spark, sf, "condition", True))


@query("medication_summary_g06", oracle_prelude("patient", "encounter", "medication_request+") + """,
 u AS (SELECT medication_code, count(*) AS n, count(*) FILTER (WHERE status = 'active') AS a, count(DISTINCT patient_id) AS p,
   max(authored_datetime) AS l FROM medication_request GROUP BY 1)
SELECT medication_request_id, m.patient_id, m.encounter_id, m.medication_code, medication_display, m.status,
  strftime(authored_datetime, '%Y-%m-%d %H:%M:%S') AS authored_datetime, CAST(sk AS VARCHAR) AS requester_id,
  CAST(u.n AS BIGINT) AS medication_requests, CAST(u.a AS BIGINT) AS medication_active, CAST(u.p AS BIGINT) AS medication_patients,
  strftime(u.l, '%Y-%m-%d %H:%M:%S') AS medication_last_authored, name_text AS patient_name, gender, class_code,
  e.status AS encounter_status, s_name AS requester_name
FROM medication_request m JOIN u USING (medication_code) LEFT JOIN patient pt ON pt.patient_id = m.patient_id
  LEFT JOIN encounter e ON e.encounter_id = m.encounter_id LEFT JOIN supplier ON s_suppkey = sk""")
def medication_summary(spark, sf):
    practitioner = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("requester_id"),
                                                       F.col("s_name").alias("requester_name"))
    return gold.medication_summary(flat(spark, sf, "medication_request", True), flat(spark, sf, "patient"),
                                   flat(spark, sf, "encounter"), practitioner)
