"""Registered joins, cohorts, reference graph and window picks."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.codes import ACTIVE_CONDITION, LOINC, SNOMED
from ..functions.paths import path
from ..functions.skew import asof_last
from ..operators import aggregates as A
from ..operators import joins as J
from ..sources.star import AS_OF, CORE, flat, oracle_prelude, records, table, unmade
from .registry import query

TS = "'%Y-%m-%d %H:%M:%S'"


@query("reconciliation_j06", """WITH a AS (SELECT o_custkey AS k, count(*) AS a FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT c_custkey AS k, count(*) AS b FROM customer WHERE c_custkey % 3 <> 0 GROUP BY 1),
 j AS (SELECT * FROM a FULL JOIN b ON a.k = b.k)
SELECT CAST(sum(a) AS BIGINT) AS left_total, CAST(sum(b) AS BIGINT) AS right_total, CAST(sum(a * b) AS BIGINT) AS matched, CAST(sum(a) FILTER (WHERE b IS NULL) AS BIGINT) AS left_unmatched,
 CAST(coalesce(sum(b) FILTER (WHERE a IS NULL), 0) AS BIGINT) AS right_unmatched, round(sum(a * b) * 100.0 / sum(a), 2) AS match_percentage FROM j""")
def reconciliation(spark, sf):
    return J.reconcile(table(spark, sf, "orders").where("o_orderstatus = 'F'"), table(spark, sf, "customer").where("c_custkey % 3 <> 0"), "o_custkey", "c_custkey")


@query("reverse_reference_j08", oracle_prelude("patient", "encounter") + """SELECT patient_id, gender, CAST(count(*) AS BIGINT) AS encounters FROM encounter JOIN patient USING (patient_id)
 WHERE gender = 'male' GROUP BY 1, 2""")
def reverse_reference(spark, sf):
    men = records(spark, sf, "Patient").where("gender = 'male'").select(F.col("id").alias("patient_id"), "gender")
    kids = J.children_of(men, records(spark, sf, "Encounter"), "patient_id", path("subject.reference"))
    counts = kids.groupBy("patient_id").agg(F.count(F.lit(1)).alias("encounters"))
    return men.join(counts, "patient_id")


@query("wide_dataset_j09", oracle_prelude("patient", "observation+", "condition+") + """,
 x AS (SELECT 'a' AS col, patient_id, CAST(value AS VARCHAR) AS v, row_number() OVER (PARTITION BY patient_id ORDER BY issued_datetime, sha256(observation_id)) - 1 AS n FROM observation WHERE code_code = '8867-4'
  UNION ALL SELECT 'b', patient_id, code_code, row_number() OVER (PARTITION BY patient_id ORDER BY onset_datetime, sha256(condition_id)) - 1 FROM condition WHERE clinical_status = 'active'),
 g AS (SELECT patient_id, n // 3 AS chunk, list(v ORDER BY n) FILTER (WHERE col = 'a') AS a, list(v ORDER BY n) FILTER (WHERE col = 'b') AS b FROM x GROUP BY 1, 2)
SELECT p.patient_id, CAST(coalesce(chunk, 0) AS INT) AS chunk, coalesce(array_to_string(a, '|'), '') AS pulse, a[1] AS pulse_first, coalesce(array_to_string(b, '|'), '') AS active_code, b[1] AS active_code_first
FROM patient p LEFT JOIN g USING (patient_id)""")
def wide_dataset(spark, sf):
    obs = flat(spark, sf, "observation", True).where("code_code = '8867-4'").select("patient_id", F.col("observation_id").alias("id"), F.col("issued_datetime").alias("at"), "value")
    cond = flat(spark, sf, "condition", True).where("clinical_status = 'active'").select("patient_id", F.col("condition_id").alias("id"), F.col("onset_datetime").alias("at"), "code_code")
    return J.wide_dataset(flat(spark, sf, "patient"), "patient_id", {"pulse": (obs, F.col("value")), "active_code": (cond, F.col("code_code"))}, "at", "id", chunk_rows=3)


@query("having_lacking_j11_u05_u06_f06", oracle_prelude("patient", "condition+", "medication_request+") + """,
 h AS (SELECT DISTINCT patient_id FROM condition WHERE clinical_status IN ('active', 'recurrence', 'relapse')), m AS (SELECT DISTINCT patient_id FROM medication_request WHERE status = 'active')
SELECT patient_id, 'both' AS side FROM patient WHERE patient_id IN (SELECT patient_id FROM h) AND patient_id IN (SELECT patient_id FROM m)
UNION ALL SELECT patient_id, 'untreated' FROM patient WHERE patient_id IN (SELECT patient_id FROM h) AND patient_id NOT IN (SELECT patient_id FROM m)""")
def having_lacking(spark, sf):
    """J11, U05, U06, F02, F04, F06."""
    active = flat(spark, sf, "condition", True).where(F.col("clinical_status").isin(ACTIVE_CONDITION))
    meds = A.active(flat(spark, sf, "medication_request", True))
    sick = J.having(flat(spark, sf, "patient").select("patient_id"), active)
    return J.having(sick, meds).withColumn("side", F.lit("both")).unionByName(J.lacking(sick, meds).withColumn("side", F.lit("untreated")))


@query("cohort_j12_j13_j14", oracle_prelude("patient", "condition+", "observation+") + f"""SELECT patient_id FROM patient WHERE gender = 'female'
 AND year(DATE '{AS_OF}') - year(birth_date) BETWEEN 30 AND 75 AND patient_id IN (SELECT patient_id FROM condition WHERE code_code IN ('C7'))
 AND patient_id IN (SELECT patient_id FROM observation WHERE code_code = '8480-6' AND ln <> 5 AND value > 30)""")
def cohort(spark, sf):
    """Chained criteria are chained semi joins."""
    people = flat(spark, sf, "patient")
    ids = J.with_demographics(people.select("patient_id"), people, AS_OF, "female", 30, 75)
    ids = J.with_condition(ids, records(spark, sf, "Condition"), SNOMED, "C7")
    return J.with_observation(ids, records(spark, sf, "Observation"), LOINC, "8480-6", lambda v: v > 30)


@query("cohort_null_passes_j13_d9", oracle_prelude("patient", "observation+") + """SELECT patient_id FROM patient WHERE patient_id IN
 (SELECT patient_id FROM observation WHERE code_code = '8480-6' AND (ln = 5 OR value > 45))""")
def cohort_null_passes(spark, sf):
    return J.with_observation(flat(spark, sf, "patient").select("patient_id"), records(spark, sf, "Observation"), LOINC, "8480-6", lambda v: v > 45, null_passes=True)


@query("high_bp_cohort_j15_f10", oracle_prelude("patient", "observation+") + f"""SELECT patient_id, name_text, CAST(date_part('year', age(DATE '{AS_OF}', birth_date)) AS INT) AS age FROM patient
 WHERE patient_id IN (SELECT patient_id FROM observation WHERE code_code = '8480-6' AND 100 + value >= 140)""")
def high_bp_cohort(spark, sf):
    high = A.bp_readings(records(spark, sf, "Observation")).where("systolic >= 140")
    people = flat(spark, sf, "patient").select("patient_id", "name_text", S.age_years(F.col("birth_date"), F.lit(AS_OF).cast("date")).alias("age"))
    return J.having(people, high)


@query("point_in_time_j16", oracle_prelude("patient", "observation+") + """, n AS (SELECT patient_id, code_display, arg_max(value, (issued_datetime, observation_id)) AS v FROM observation
 WHERE issued_datetime <= TIMESTAMP '1999-06-30' AND code_display IN ('pulse', 'weight') GROUP BY 1, 2)
SELECT patient_id, max(v) FILTER (WHERE code_display = 'pulse') AS pulse, max(v) FILTER (WHERE code_display = 'weight') AS weight FROM n GROUP BY 1""")
def point_in_time(spark, sf):
    return J.value_at(flat(spark, sf, "observation", True), "patient_id", "code_display", "value", "issued_datetime", "observation_id", "1999-06-30", ["pulse", "weight"])


@query("asof_join_j16", oracle_prelude("encounter", "observation+") + """, o AS (SELECT patient_id, issued_datetime AS t, max_by(value, observation_id) AS v FROM observation WHERE code_code = '8867-4' GROUP BY 1, 2)
SELECT e.encounter_id, e.patient_id, o.v AS last_pulse FROM encounter e ASOF LEFT JOIN o ON e.patient_id = o.patient_id AND e.start_datetime >= o.t""")
def asof_join(spark, sf):
    """J16 with a reference time per row."""
    refs = flat(spark, sf, "encounter").select("encounter_id", "patient_id", "start_datetime")
    pulse = flat(spark, sf, "observation", True).where("code_code = '8867-4'")
    return asof_last(refs, pulse, "patient_id", "start_datetime", "issued_datetime", "observation_id", "value", "last_pulse").drop("start_datetime")


def _targets(kind, key, src, *targets):
    """Edges of a record type: (path, type, id, condition) of each."""
    return " UNION ALL ".join(f"SELECT '{kind}' AS src_type, {key} AS src_id, '{at}' AS path, '{to}' AS dst_type, {ident} AS dst_id FROM {src} WHERE {test}" for at, to, ident, test in targets)


_SUBJECT = [("subject", "Patient", "patient_id", "true"), ("encounter", "Encounter", "encounter_id", "true")]
_EDGES = " edges AS (" + " UNION ALL ".join([
    _targets("Patient", "patient_id", "patient", ("generalPractitioner[0].reference", "Practitioner", "CAST(nk AS VARCHAR)", "true")),
    _targets("Encounter", "encounter_id", "encounter", ("subject", "Patient", "patient_id", "true"), ("participant[0].individual", "Practitioner", "CAST(k % 30 AS VARCHAR)", "true"),
             ("diagnosis[0].condition", "Condition", "encounter_id", "true"), ("location[0].location", "Location", "CAST(k % 9 AS VARCHAR)", "true"),
             ("serviceProvider", "Organization", "CAST(k % 20 AS VARCHAR)", "true"), ("partOf", "Encounter", "CAST(k - 1 AS VARCHAR)", "k % 4 = 0")),
    _targets("Observation", "observation_id", "observation", *_SUBJECT),
    _targets("Condition", "condition_id", "condition", *_SUBJECT, ("recorder", "Practitioner", "CAST(sk AS VARCHAR)", "true")),
    _targets("MedicationRequest", "medication_request_id", "medication_request", ("medicationReference", "Medication", "medication_code", "ln = 3"), *_SUBJECT, ("requester", "Practitioner", "CAST(sk AS VARCHAR)", "true")),
    _targets("DiagnosticReport", "report_id", "diagnostic_report", *_SUBJECT, ("result[0].reference", "Observation", "report_id", "true"), ("result[1].reference", "Observation", "'missing-' || report_id", "true")),
]) + ")"
_ALL = oracle_prelude("patient", "encounter", "observation+", "condition+", "medication_request+", "diagnostic_report+")


def _edges(spark, sf):
    """The references of all six record types of the star."""
    return reduce(DataFrame.unionByName, [J.reference_edges(records(spark, sf, kind), kind) for kind in CORE])


@query("reference_edges_j17", _ALL + "," + _EDGES + " SELECT * FROM edges")
def reference_edges(spark, sf):
    return _edges(spark, sf)


@query("resolve_references_j18", _ALL + "," + _EDGES + """,
 h AS (SELECT DISTINCT src_type, src_id, dst_type, dst_id FROM edges WHERE dst_type NOT IN ('Location', 'Condition')),
 r AS (SELECT DISTINCT src_type AS root_type, src_id AS root_id FROM edges),
 a AS (SELECT DISTINCT root_type, root_id, dst_type AS type, dst_id AS id FROM r JOIN h ON src_type = root_type AND src_id = root_id WHERE NOT (dst_type = root_type AND dst_id = root_id)),
 b AS (SELECT DISTINCT a.root_type, a.root_id, dst_type AS type, dst_id AS id FROM a JOIN h ON src_type = a.type AND src_id = a.id WHERE NOT (dst_type = a.root_type AND dst_id = a.root_id))
SELECT *, 1 AS depth FROM a UNION ALL SELECT b.*, 2 FROM b ANTI JOIN a USING (root_type, root_id, type, id)""")
def resolve_references(spark, sf):
    """J18 from every record of six types; patients and practitioners are hubs."""
    edges = _edges(spark, sf)
    return J.resolve(edges.select("src_type", "src_id"), edges, 2, exclude=["Location", "Condition"])


@query("report_results_j19", oracle_prelude("diagnostic_report", "observation") + """SELECT report_id, 0 AS position, report_id AS observation_id, code_display AS display, value, false AS missing FROM
 (SELECT report_id FROM diagnostic_report) JOIN (SELECT observation_id, code_display, CASE WHEN ln <> 5 THEN value END AS value FROM observation) ON report_id = observation_id
 UNION ALL SELECT report_id, 1, 'missing-' || report_id, NULL, NULL, true FROM diagnostic_report""")
def report_results(spark, sf):
    return J.report_results(records(spark, sf, "DiagnosticReport"), records(spark, sf, "Observation"))


@query("patient_everything_j20", _ALL + """SELECT patient_id, 'Patient' AS resource_type, patient_id AS id, true AS ok FROM patient
 UNION ALL SELECT patient_id, 'Encounter', encounter_id, true FROM encounter UNION ALL SELECT patient_id, 'Condition', condition_id, true FROM condition
 UNION ALL SELECT patient_id, 'Observation', observation_id, true FROM observation UNION ALL SELECT patient_id, 'DiagnosticReport', report_id, true FROM diagnostic_report
 UNION ALL SELECT patient_id, 'MedicationRequest', medication_request_id, true FROM medication_request""")
def patient_everything(spark, sf):
    parts = {k: unmade(spark, sf, k) for k in CORE if k != "Patient"}
    rows = J.everything(records(spark, sf, "Patient"), {k: df for k, (df, *_) in parts.items()}, {k: how for k, (_, *how) in parts.items()})
    return rows.select("patient_id", "resource_type", "id", (F.get_json_object("json", "$.id") == F.col("id")).alias("ok"))


@query("code_lookup_j21_j22", oracle_prelude("medication_request") + """SELECT medication_request_id, max(p_name) IS NOT NULL AS valid, CAST(1 AS BIGINT) AS codings, max(p_name) AS display
 FROM medication_request LEFT JOIN (SELECT CAST(p_partkey AS VARCHAR) AS c, p_name FROM part WHERE p_size <= 25) ON c = medication_code WHERE ln <> 3 GROUP BY 1""")
def code_lookup(spark, sf):
    """The value set is the part list up to size 25."""
    known = table(spark, sf, "part").where("p_size <= 25").select(F.lit("http://www.nlm.nih.gov/research/umls/rxnorm").alias("system"),
                                                                  F.col("p_partkey").cast("string").alias("code"), F.col("p_name").alias("display"))
    meds = records(spark, sf, "MedicationRequest").select(F.col("id").alias("medication_request_id"), "medicationCodeableConcept")
    return J.code_lookup(meds, known, "medication_request_id", "medicationCodeableConcept")


@query("subject_consistency_j23", oracle_prelude("encounter") + """SELECT 'Encounter' AS resource_type, encounter_id AS resource_id, CASE WHEN k % 50 = 0 THEN 'Missing subject reference to patient'
 ELSE 'Subject reference ''Patient/' || patient_id || ''' does not match a patient' END AS message FROM encounter WHERE k % 50 = 0 OR CAST(patient_id AS BIGINT) % 7 = 0""")
def subject_consistency(spark, sf):
    enc = records(spark, sf, "Encounter").withColumn("subject", F.when(F.col("id").cast("bigint") % 50 != 0, F.col("subject")))
    return J.subject_issues(records(spark, sf, "Patient").where("cast(id AS bigint) % 7 <> 0"), enc, "Encounter")


@query("last_dates_w06_f11", oracle_prelude("observation+") + f""", d AS (SELECT *, dense_rank() OVER (PARTITION BY patient_id, category ORDER BY issued_datetime DESC) AS r FROM observation)
SELECT patient_id, category, observation_id, strftime(issued_datetime, {TS}) AS issued_datetime, value FROM d WHERE r <= CASE category WHEN 'vital-signs' THEN 5 ELSE 10 END""")
def last_dates(spark, sf):
    """Vitals of the last 5 dates and labs of the last 10."""
    obs = flat(spark, sf, "observation", True).select("patient_id", "category", "observation_id", "issued_datetime", "value")
    parts = [J.last_dates(obs.where(F.col("category") == c), ["patient_id"], "issued_datetime", n) for c, n in (("vital-signs", 5), ("laboratory", 10))]
    return parts[0].unionByName(parts[1]).select("patient_id", "category", "observation_id", "issued_datetime", "value")


@query("latest_encounter_w07_w08", oracle_prelude("encounter") + f"""SELECT patient_id, arg_max(encounter_id, (start_datetime, encounter_id)) AS encounter_id, strftime(max(start_datetime), {TS}) AS start_datetime,
 arg_max(status, (start_datetime, encounter_id)) AS status FROM encounter GROUP BY 1""")
def latest_encounter(spark, sf):
    from ..functions.skew import latest_per
    enc = flat(spark, sf, "encounter")
    return latest_per(enc, ["patient_id"], ["start_datetime", "encounter_id"], ["encounter_id", "start_datetime", "status"])


@query("patient_attributes_u07", oracle_prelude("patient") + """SELECT address_city, min(name_text) AS name_text, arg_min(gender, (name_text, gender)) AS gender FROM patient GROUP BY 1""")
def patient_attributes(spark, sf):
    return J.one_per(flat(spark, sf, "patient"), "address_city", ["name_text", "gender"])


@query("first_rows_l02_l03_l04", oracle_prelude("condition") + f"""SELECT condition_id, strftime(recorded_date, {TS}) AS recorded_date FROM condition
 ORDER BY condition.recorded_date DESC NULLS LAST, condition_id LIMIT 25""")
def first_rows(spark, sf):
    """Top rows by date, missing dates last; a top-k, so no global sort."""
    return flat(spark, sf, "condition").select("condition_id", "recorded_date").orderBy(F.desc_nulls_last("recorded_date"), "condition_id").limit(25)


@query("hash_sample_f07", """SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE hash(l_orderkey) IS NOT NULL""")
def hash_sample(spark, sf):
    """the two halves of a hash sample partition the table."""
    from ..sources.readers import hash_sample as sample
    rows = table(spark, sf, "lineitem")
    return sample(rows, ["l_orderkey"], 30).unionByName(sample(rows, ["l_orderkey"], 30, invert=True)).agg(F.count(F.lit(1)).alias("n"))


@query("batch_callback_du9_du10", oracle_prelude("observation") + "SELECT observation_id, value * 2 + 1 AS scaled FROM observation")
def batch_callback(spark, sf):
    """D-U9, D-U10: pandas callback per Arrow batch."""
    return J.map_batches(flat(spark, sf, "observation").select("observation_id", "value"), _scaled, "observation_id string, scaled double")


def _scaled(pdf):
    return pdf.assign(scaled=pdf["value"] * 2 + 1)[["observation_id", "scaled"]]
