"""Registered validation, quality and repair queries, on records with deterministic defects."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codes
from ..functions.paths import path
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import repair as E
from ..operators import rules as R
from ..operators import timeseries as M
from ..operators.specs import FLATTEN, apply_spec
from ..sources.star import AS_OF, CORE, FLAT, dirty_records, flat, messy_records, oracle_prelude, raw, records, stored_text
from .registry import query

Z = "'%Y-%m-%dT%H:%M:%SZ'"
NS = "CAST(NULL AS VARCHAR)"


def _set(values):
    return "[" + ", ".join(values) + "]"


# The defects, in plain SQL over the flat frames.
DIRTY = oracle_prelude("patient", "encounter", "observation+") + """,
 p AS (SELECT *, patient_id AS id, CASE WHEN k % 13 = 0 THEN 'M' ELSE gender END AS g,
   CASE WHEN k % 17 = 0 THEN strftime(birth_date, '%m/%d/%Y') ELSE strftime(birth_date, '%Y-%m-%d') END AS b FROM patient),
 e AS (SELECT *, encounter_id AS id, CASE WHEN k % 12 = 0 THEN NULL WHEN k % 10 = 0 THEN 'arrived-late' ELSE status END AS s,
   CASE WHEN k % 5 = 0 THEN strftime(start_datetime, '%Y-%m-%d %H:%M:%S') ELSE strftime(start_datetime, '%Y-%m-%dT%H:%M:%SZ') END AS st FROM encounter),
 o AS (SELECT *, observation_id AS id, CASE ln WHEN 2 THEN NULL WHEN 6 THEN 'done' ELSE status END AS s, NOT (ln = 7 AND pk % 2 = 0) AS has_code,
   CASE ln WHEN 4 THEN patient_id WHEN 3 THEN 'Patient' || patient_id ELSE 'Patient/' || patient_id END AS ref FROM observation)
"""


def _issue(kind, level, field, rule, message, src, cond):
    return (f"SELECT '{kind}' AS resource_type, id AS resource_id, '{level}' AS level, '{field}' AS field, '{rule}' AS rule, {message} AS message FROM {src} WHERE {cond}")


def _all(*parts):
    return " UNION ALL ".join(parts)


def _not_in(col, values):
    return f"'Value ''' || {col} || ''' is not one of the allowed values: {_set(values)}'"


def _no_match(col):
    return f"'Value ''' || {col} || ''' does not match pattern'"


KINDS = ("Patient", "Observation", "Encounter")


def _dirty(spark, sf):
    return {k: dirty_records(spark, sf, k) for k in KINDS}


def _union(parts):
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


_OBS_IN = ", ".join(f"'{v}'" for v in codes.OBSERVATION_STATUS)
_ENC_IN = ", ".join(f"'{v}'" for v in codes.ENCOUNTER_STATUS)


@query("declared_rules_q05", DIRTY + _all(
    _issue("Patient", "fatal", "name[0].family", "required", "'Missing required field: name[0].family'", "p", "k % 11 = 0"),
    _issue("Patient", "fatal", "gender", "regex", _no_match("g"), "p", "k % 13 = 0"), _issue("Patient", "fatal", "birthDate", "regex", _no_match("b"), "p", "k % 17 = 0"),
    _issue("Observation", "fatal", "code.coding[0].code", "required", "'Missing required field: code.coding[0].code'", "o", "NOT has_code"),
    _issue("Observation", "warning", "status", "allowed", _not_in("s", codes.OBSERVATION_STATUS), "o", "s = 'done'"),
    _issue("Observation", "warning", "code.coding[0].system", "regex", _no_match("'loinc'"), "o", "pk % 5 = 0 AND has_code"),
    _issue("Encounter", "fatal", "status", "required", "'Missing required field: status'", "e", "s IS NULL"),
    _issue("Encounter", "warning", "status", "allowed", _not_in("s", codes.ENCOUNTER_STATUS[:8]), "e", "s = 'arrived-late'")))
def declared_rules(spark, sf):
    """Q05, D-U5."""
    return _union(R.issue_rows(df, k, R.declared_rules(k)) for k, df in _dirty(spark, sf).items())


# the other types, with an id each
MORE = oracle_prelude("allergy_intolerance+", "procedure+", "immunization+", "document_reference", "care_plan", "related_person").replace("WITH ", ", ", 1) + """,
 al AS (SELECT *, allergy_id AS id FROM allergy_intolerance), pr AS (SELECT *, procedure_id AS id FROM procedure), im AS (SELECT *, immunization_id AS id FROM immunization),
 dr AS (SELECT *, document_id AS id FROM document_reference), cp AS (SELECT *, care_plan_id AS id FROM care_plan),
 rp AS (SELECT *, related_person_id AS id, CASE WHEN k % 10 = 0 THEN strftime(birth_date, '%m/%d/%Y') ELSE strftime(birth_date, '%Y-%m-%d') END AS b FROM related_person)
"""
_ABSENT = "'Required field is missing'"
_MORE_ISSUES = _all(
    _issue("AllergyIntolerance", "error", "patient", "required", _ABSENT, "al", "pk % 7 = 0"), _issue("Procedure", "error", "status", "required", _ABSENT, "pr", "status IS NULL"),
    _issue("Procedure", "error", "performedDateTime", "regex", _no_match("strftime(performed, '%Y-%m-%d')"), "pr", "sk % 5 = 0"),
    _issue("Immunization", "error", "occurrenceDateTime", "required", _ABSENT, "im", "occurred IS NULL"), _issue("DocumentReference", "error", "content", "required", _ABSENT, "dr", "k % 6 = 0"),
    _issue("CarePlan", "error", "intent", "required", _ABSENT, "cp", "intent IS NULL"), _issue("RelatedPerson", "error", "birthDate", "regex", _no_match("b"), "rp", "k % 10 = 0"),
    _issue("RelatedPerson", "error", "gender", "allowed", _not_in("gender", codes.GENDERS), "rp", "gender = 'X'"))
_FIELD_ISSUES = _all(
    _issue("Patient", "error", "birthDate", "regex", _no_match("b"), "p", "k % 17 = 0"), _issue("Patient", "error", "gender", "allowed", _not_in("g", codes.GENDERS), "p", "k % 13 = 0"),
    _issue("Observation", "error", "status", "required", "'Required field is missing'", "o", "s IS NULL"), _issue("Observation", "error", "code", "required", "'Required field is missing'", "o", "NOT has_code"),
    _issue("Observation", "error", "status", "allowed", _not_in("s", codes.RECORD_STATUS), "o", "s IS NOT NULL"), _issue("Encounter", "error", "status", "required", "'Required field is missing'", "e", "s IS NULL"))


def _field_issues(spark, sf):
    return _union(R.issue_rows(df, k, R.field_rules(k)) for k, df in _dirty(spark, sf).items())


@query("field_rules_q06", DIRTY + MORE + _FIELD_ISSUES + " UNION ALL " + _MORE_ISSUES)
def field_rules(spark, sf):
    """Q06: the field schemas of all twelve types; three of them have no defect in the star."""
    rest = [k for k in R.FIELDS if k not in KINDS]
    return _union([_field_issues(spark, sf), *(R.issue_rows(records(spark, sf, k), k, R.field_rules(k)) for k in rest)])


@query("errors_per_type_l05", DIRTY + MORE + ", i AS (" + _FIELD_ISSUES + " UNION ALL " + _MORE_ISSUES + """)
 SELECT resource_type, resource_id, field, message, CAST(row_number() OVER (PARTITION BY resource_type ORDER BY resource_id, field, rule) AS INT) AS position FROM i QUALIFY position <= 5""")
def errors_per_type(spark, sf):
    """Five errors of each type; the limit is the feature."""
    return M.first_of_each(field_rules(spark, sf), ["resource_type"], ["resource_id", "field", "rule"], 5).select("resource_type", "resource_id", "field", "message", "position")


@query("suggested_corrections_q12", DIRTY + ", i AS (" + _FIELD_ISSUES + f""") SELECT resource_type, resource_id, field,
 CASE rule WHEN 'required' THEN 'Add a valid value for this required field' WHEN 'allowed' THEN 'Change to one of the allowed values' ELSE 'Fix date format to YYYY-MM-DD' END AS suggestion,
 CASE WHEN rule = 'allowed' AND field = 'gender' THEN 'male' WHEN rule = 'allowed' THEN 'active' END AS suggested_value FROM i""")
def suggested_corrections(spark, sf):
    return R.suggestions(_field_issues(spark, sf))


@query("combined_report_q11", DIRTY + ", i AS (" + _FIELD_ISSUES + """) SELECT resource_type, 'validation' AS source, CAST(count(*) AS DOUBLE) AS value FROM i GROUP BY 1
 UNION ALL SELECT 'Encounter', 'consistency', count(*) FROM e WHERE CAST(patient_id AS BIGINT) % 7 = 0
 UNION ALL SELECT 'Patient', 'completeness:identifier', round(count(*) FILTER (WHERE k % 8 <> 0) * 1.0 / count(*), 6) FROM p UNION ALL SELECT 'Patient', 'completeness:id', 1.0""")
def combined_report(spark, sf):
    """Q11: validation errors, consistency errors (J23) and field completeness (A32) in one report."""
    dirty = _dirty(spark, sf)
    errors = _field_issues(spark, sf).groupBy("resource_type").agg(F.count(F.lit(1)).cast("double").alias("value")).withColumn("source", F.lit("validation"))
    known = dirty["Patient"].where("cast(id AS bigint) % 7 <> 0")
    stray = J.subject_issues(known, dirty["Encounter"], "Encounter").groupBy("resource_type").agg(F.count(F.lit(1)).cast("double").alias("value")).withColumn("source", F.lit("consistency"))
    filled = A.field_completeness(dirty["Patient"], ["id"], ["identifier"]).where("field IN ('id', 'identifier')").select(
        F.lit("Patient").alias("resource_type"), F.col("completeness").alias("value"), F.concat(F.lit("completeness:"), "field").alias("source"))
    return errors.unionByName(stray).unionByName(filled).select("resource_type", "source", "value")


@query("basic_validation_q02_d17", DIRTY + """SELECT 'Patient' AS resource_type, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE g = 'M') AS BIGINT) AS invalid,
  CAST(count(*) FILTER (WHERE g <> 'M') AS BIGINT) AS valid, CAST(count(*) FILTER (WHERE g = 'M') AS BIGINT) AS capped_failures, 'allowed gender: ' || count(*) FILTER (WHERE g = 'M') AS errors FROM p
 UNION ALL SELECT 'Observation', count(*), count(*) FILTER (WHERE s IS NULL OR s = 'done' OR NOT has_code), count(*) FILTER (WHERE NOT (s IS NULL OR s = 'done' OR NOT has_code)),
  least(count(*), count(*) FILTER (WHERE s IS NULL) + count(*) FILTER (WHERE NOT has_code) + count(*) FILTER (WHERE s = 'done')),
  'required status: ' || count(*) FILTER (WHERE s IS NULL) || '|required code: ' || count(*) FILTER (WHERE NOT has_code) || '|allowed status: ' || count(*) FILTER (WHERE s = 'done') FROM o
 UNION ALL SELECT 'Encounter', count(*), count(*) FILTER (WHERE s IS NULL OR s = 'arrived-late'), count(*) FILTER (WHERE s <> 'arrived-late'), count(*) FILTER (WHERE s IS NULL OR s = 'arrived-late'),
  'required status: ' || count(*) FILTER (WHERE s IS NULL) || '|allowed status: ' || count(*) FILTER (WHERE s = 'arrived-late') FROM e""")
def basic_validation(spark, sf):
    return _union(R.basic_validation(df, k) for k, df in _dirty(spark, sf).items())


@query("model_validation_q04", DIRTY + """SELECT 'Patient' AS resource_type, CAST(count(*) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS sampled,
 CAST(count(*) FILTER (WHERE g = 'M' OR k % 17 = 0) AS BIGINT) AS sample_invalid, round(count(*) FILTER (WHERE g = 'M' OR k % 17 = 0) * 1.0 / count(*), 6) AS error_rate,
 CAST(count(*) FILTER (WHERE g = 'M' OR k % 17 = 0) AS BIGINT) AS estimated_invalid, 'error' AS level FROM p""")
def model_validation(spark, sf):
    """Q04 on the whole table; smaller samples extrapolate."""
    rows = apply_spec(dirty_records(spark, sf, "Patient"), FLATTEN["Patient"])
    return R.sampled_validation(rows, "Patient", R.model_rules("Patient"), "patient_id", 100)


@query("raw_validation_q07", DIRTY + """, j AS (SELECT *, k % 19 = 0 AS broken, k % 23 = 0 AS untyped FROM p)
 SELECT 'Unknown' AS resource_type, NULL AS resource_id, 'error' AS level, '$' AS field, 'json' AS rule, 'Invalid JSON' AS message FROM j WHERE broken
 UNION ALL SELECT 'Unknown', id, 'error', 'resourceType', 'required', 'Missing required field: resourceType' FROM j WHERE NOT broken AND untyped
 UNION ALL SELECT 'Patient', id, 'error', 'identifier', 'required', 'Missing required field: identifier' FROM j WHERE NOT broken AND NOT untyped AND k % 8 = 0
 UNION ALL SELECT 'Patient', id, 'warning', 'gender', 'recommended', 'Missing recommended field: gender' FROM j WHERE NOT broken AND NOT untyped AND k % 29 = 0""")
def raw_validation(spark, sf):
    k = F.col("id").cast("bigint")
    rows = dirty_records(spark, sf, "Patient").withColumns({"resourceType": F.when(k % 23 != 0, F.col("resourceType")), "gender": F.when(k % 29 != 0, F.col("gender"))})
    text = F.to_json(F.struct("*"))
    return R.raw_validation(stored_text(rows, F.when(k % 19 == 0, F.substring(text, 1, 20)).otherwise(text)))


@query("structure_validity_q08_q09_q10", DIRTY + """SELECT id, CASE WHEN NOT has_code THEN 'Expected object' WHEN pk % 5 = 0 THEN 'Coding system not in allowed systems' END AS concept,
 CASE WHEN ln = 5 AND pk % 3 = 2 THEN 'No value[x] field found' WHEN ln = 5 AND pk % 3 = 0 THEN 'Type not in allowed types' END AS value,
 CASE WHEN ln NOT IN (3, 4) THEN 'Reference resource type not in allowed types' END AS subject FROM o""")
def structure_validity(spark, sf):
    return dirty_records(spark, sf, "Observation").select(
        "id", R.concept_error(F.col("code"), [codes.LOINC]).alias("concept"), R.value_error(["quantity", "codeableConcept"]).alias("value"),
        R.reference_error(F.col("subject"), ["Practitioner", "Group"]).alias("subject"))


@query("consistency_rules_q13_q14", DIRTY + _all(
    _issue("Patient", "warning", "name", "consistency", "'name missing family'", "p", "k % 11 = 0"),
    _issue("Patient", "warning", "Gender is valid", "consistency", "'Consistency rule failed: Gender is valid'", "p", "g = 'M'"),
    _issue("Patient", "warning", "Name has family", "consistency", "'Consistency rule failed: Name has family'", "p", "k % 11 = 0"),
    _issue("Observation", "warning", "code", "consistency", "'code missing coding array'", "o", "NOT has_code"),
    _issue("Observation", "warning", "Status is valid", "consistency", "'Consistency rule failed: Status is valid'", "o", "s = 'done'")))
def consistency_rules(spark, sf):
    """Q13, Q14 (D18)."""
    d = _dirty(spark, sf)
    parts = [R.issue_rows(d[k], k, R.consistency_rules(k) + (R.implied_rules(k) if k != "Encounter" else [])) for k in KINDS]
    return _union(parts + [R.issue_rows(records(spark, sf, "MedicationRequest"), "MedicationRequest", R.implied_rules("MedicationRequest"))])


@query("key_set_consistency_q13", oracle_prelude("patient") + """SELECT patient_id AS id, CASE WHEN k % 3 = 2 THEN 'extension' ELSE '' END AS missing, CASE WHEN k % 4 <> 0 THEN 'text' ELSE '' END AS extra
 FROM patient WHERE k % 3 = 2 OR k % 4 <> 0""")
def key_set_consistency(spark, sf):
    """Q13 for types without own checks; the first record (id 0) has an extension and no text."""
    return R.key_set_issues(raw(spark, sf, "Patient"))


def _dimensions(kind, src, completeness, invalid, inconsistent, updated):
    """The four dimensions of a type and their mean."""
    stale = f"date_diff('day', CAST({updated} AS DATE), DATE '2002-01-10') > 365"
    shares = [completeness, *(f"1 - count(*) FILTER (WHERE {test}) * 1.0 / count(*)" for test in (invalid, inconsistent, stale))]
    names = ("completeness", "conformance", "consistency", "timeliness")
    return (f"SELECT '{kind}' AS resource_type, CAST(count(*) AS BIGINT) AS resources, " + ", ".join(f"round({x}, 6) AS {n}" for x, n in zip(shares, names))
            + ", round((" + " + ".join(f"({x})" for x in shares) + f") / 4, 6) AS overall FROM {src}")


_GAPS = "1 - sum({}) * 1.0 / (count(*) * {})"


@query("dimension_report_q17_q16", DIRTY + ", cd AS (SELECT * FROM (" + FLAT["condition"].replace("{", "").replace("}", "") + ")), mr AS (SELECT * FROM (" + FLAT["medication_request"].replace("{", "").replace("}", "") + ")) " + " UNION ALL ".join([
    _dimensions("Patient", "p", "1.0::DOUBLE", "g = 'M' OR k % 17 = 0", "k % 11 = 0", "DATE '2001-01-01' + CAST(k % 28 AS INT)"),
    _dimensions("Encounter", "e", _GAPS.format("(s IS NULL)::INT", 5), "s IS NULL", "false", "start_datetime"),
    _dimensions("Observation", "o", _GAPS.format("(s IS NULL)::INT + (NOT has_code)::INT + (ln = 5)::INT", 6), "s IS NULL OR NOT has_code OR s NOT IN (" + ", ".join(f"'{v}'" for v in codes.RECORD_STATUS) + ")",
                "NOT has_code", "issued_datetime"),
    _dimensions("Condition", "cd", "1.0::DOUBLE", "false", "false", "onset_datetime"),
    _dimensions("MedicationRequest", "mr", _GAPS.format("(ln = 3)::INT", 6), "false", "false", "authored_datetime")]))
def dimension_report(spark, sf):
    """Q17 with A29, Q15, Q16 and the overall score, for five types."""
    return _union(R.dimension_report(dirty_records(spark, sf, k), k, "2002-01-10") for k in R.REQUIRED)


_GATE = """, x AS (SELECT id, coalesce((s IS NULL)::INT, 0) + (NOT has_code)::INT + coalesce((s IS NOT NULL AND s NOT IN (""" + _OBS_IN + """))::INT, 0) AS n,
   1 - ((s IS NULL)::INT + (NOT has_code)::INT + (ln = 5)::INT) / 6.0 AS score FROM o)"""


def _gate(spark, sf):
    rules = [R.required("status"), R.required("code"), R.allowed("status", codes.OBSERVATION_STATUS)]
    return R.gate(dirty_records(spark, sf, "Observation"), "Observation", rules)


@query("row_gate_q18_q30", DIRTY + _GATE + " SELECT id, n = 0 AS is_valid, CAST(n AS INT) AS issue_count, round(score, 6) AS score, n = 0 AND score > 0.7 AS passes FROM x")
def row_gate(spark, sf):
    return _gate(spark, sf)


@query("batch_gate_q18_q30_q31", DIRTY + _GATE + """ SELECT CAST(count(*) AS BIGINT) AS resources, round(avg((n = 0)::INT), 6) AS validation_rate, round(avg(score), 6) AS mean_score,
 CAST(sum(n) AS BIGINT) AS issues, avg((n = 0)::INT) > 0.7 AND avg(score) > 0.7 AS passes FROM x""")
def batch_gate(spark, sf):
    return R.batch_gate(_gate(spark, sf))


_ASSESS = """, a AS (SELECT 'Patient' AS resource_type, id AS resource_id,
  CASE WHEN k % 7 = 0 THEN 'SILVER' WHEN k % 4 <> 0 AND (k % 2 = 0 OR k % 5 = 0) THEN 'GOLD' WHEN k % 3 <> 2 OR k % 4 <> 0 THEN 'SILVER' ELSE 'BRONZE' END AS quality_tier,
  CAST((k % 6 = 0)::INT + CASE WHEN k % 2 = 1 THEN 2 ELSE 1 END + 2 + 2 * (k % 2 = 0)::INT + CASE k % 3 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 0 END + 2 AS INT) AS total_checks,
  concat_ws('|', CASE WHEN k % 6 = 0 THEN 'gender/_gender' END, CASE WHEN k % 11 = 0 THEN 'name[0]' || CASE WHEN k % 2 = 1 THEN '|name[1]' ELSE '' END END,
   CASE WHEN k % 2 = 0 AND k % 8 = 0 THEN 'identifier' END, CASE WHEN k % 3 = 1 THEN 'extension[0]' END, CASE WHEN k % 4 = 0 THEN 'text' END, CASE WHEN k % 5 <> 0 THEN 'meta.security' END) AS issues FROM p
 UNION ALL SELECT 'Observation', id, 'BRONZE', 7, concat_ws('|', CASE WHEN ln = 5 AND pk % 3 = 2 THEN 'Observation' END, CASE WHEN s IS NULL THEN 'status' END, CASE WHEN NOT has_code THEN 'code' END, 'text', 'meta.security') FROM o
 UNION ALL SELECT 'Encounter', id, 'BRONZE', 5, concat_ws('|', CASE WHEN s IS NULL THEN 'status' END, 'text', 'meta.security') FROM e),
 b AS (SELECT *, CASE WHEN issues = '' THEN 0 ELSE len(string_split(issues, '|')) END AS n FROM a),
 c AS (SELECT *, CAST(total_checks - n AS INT) AS passed_checks, CAST(floor(100.0 * (total_checks - n) / total_checks) AS INT) AS score FROM b)"""


def _assessed(spark, sf):
    return _union(R.assess(df, k) for k, df in _dirty(spark, sf).items())


@query("assessment_q19_q20_q21_q22_q23_q24_q25", DIRTY + _ASSESS + " SELECT * EXCLUDE (n) FROM c")
def assessment(spark, sf):
    return _assessed(spark, sf).withColumn("issues", F.col("issues.path"))


@query("assessment_summary_a33", DIRTY + _ASSESS + """, k AS (SELECT unnest(string_split(issues, '|')) AS path FROM c WHERE issues <> ''),
 t AS (SELECT CASE WHEN path IN ('gender/_gender', 'Observation') OR path LIKE 'name[%' THEN 'Data Consistency' WHEN path IN ('status', 'code') THEN 'Missing Required Field' WHEN path = 'identifier' THEN 'Profile Conformance'
   WHEN path LIKE 'extension%' THEN 'Extension Structure' WHEN path = 'text' THEN 'Narrative' ELSE 'Sensitive Data' END AS t FROM k)
SELECT 'type:' || resource_type AS scope, CAST(count(*) AS BIGINT) AS count, CAST(floor(avg(score)) AS INT) AS average_score FROM c GROUP BY 1
UNION ALL SELECT 'tier:' || quality_tier, count(*), CAST(floor(avg(score)) AS INT) FROM c GROUP BY 1 UNION ALL SELECT 'all', count(*), CAST(floor(avg(score)) AS INT) FROM c
UNION ALL SELECT 'issue:' || t, count(*), NULL FROM t GROUP BY 1""")
def assessment_summary(spark, sf):
    return R.assessment_summary(_assessed(spark, sf))


_X = R.expect
SUITE = [
    _X("column_to_exist", column="id"), _X("column_to_exist", column="photo"), _X("not_null", column="identifier"), _X("not_null", column="text.div", mostly=0.5), _X("unique", column="id"), _X("unique", column="gender"),
    _X("in_set", column="gender", value_set=codes.GENDERS + [None]), _X("of_type", column="birthDate", type_="StringType"), _X("of_type", column="active", type_="StringType"),
    _X("row_count_between", min_value=1, max_value=None), _X("row_count_be", value=7), _X("column_count_be", value=19), _X("columns_match_ordered_list", columns=["id"]),
    _X("between", column="birthDate", min_value="1940-01-01", max_value="1999-12-31"), _X("match_regex", column="birthDate", regex=r"^\d{4}-\d{2}-\d{2}$"),
    _X("match_strftime_format", column="birthDate", strftime_format="%Y-%m-%d"), _X("dateutil_parseable", column="birthDate"), _X("json_parseable", column="gender"),
    _X("pair_values_equal", a="address[0].country", b="address[0].city"), _X("pair_greater", a="birthDate", b="meta.lastUpdated"), _X("multicolumn_unique", columns=["gender", "birthDate"]),
    _X("quantile_magic", column="id"), _X("not_null", column="no.such.field"),
]


def _counts(cases):
    """One row per expectation; ``cases`` maps a position to (element_count, unexpected_count, success)."""
    rows = []
    for i, e in enumerate(SUITE):
        n, u, ok = cases[i]
        rows.append(f"SELECT {i} AS position, '{e.type}' AS expectation, '{e.label()}' AS arguments, '{R.CATEGORY.get(e.type, 'unknown')}' AS category, {ok} AS success, CAST({n} AS BIGINT) AS element_count, CAST({u} AS BIGINT) AS unexpected_count FROM q")
    return " UNION ALL ".join(rows)


@query("expectations_q26_q28_q29", DIRTY + """, q AS (SELECT count(*) AS n, count(*) FILTER (WHERE k % 8 = 0) AS ni, count(*) FILTER (WHERE k % 4 = 0) AS nt, count(*) FILTER (WHERE g = 'M') AS ng,
  count(*) FILTER (WHERE b > '1999-12-31' OR b < '1940-01-01') AS nb, count(*) FILTER (WHERE k % 17 = 0) AS nr, count(*) FILTER (WHERE NOT b > '2001-01-' || lpad(CAST(1 + k % 28 AS VARCHAR), 2, '0') || 'T00:00:00Z') AS np,
  (SELECT coalesce(sum(c) FILTER (WHERE c > 1), 0) FROM (SELECT count(*) AS c FROM p GROUP BY g)) AS ug, (SELECT coalesce(sum(c) FILTER (WHERE c > 1), 0) FROM (SELECT count(*) AS c FROM p GROUP BY g, b)) AS um FROM p) """ + _counts({
    0: (0, 0, "true"), 1: (0, 1, "false"), 2: ("n", "ni", "ni = 0"), 3: ("n", "nt", "nt <= 0.5 * n"), 4: ("n", 0, "true"), 5: ("n", "ug", "ug = 0"), 6: ("n", "ng", "ng = 0"), 7: ("n", 0, "true"), 8: ("n", "n", "false"),
    9: ("n", 0, "true"), 10: ("n", 0, "n = 7"), 11: (19, 0, "true"), 12: (19, 0, "false"), 13: ("n", "nb", "nb = 0"), 14: ("n", "nr", "nr = 0"), 15: ("n", "nr", "nr = 0"), 16: ("n", 0, "true"), 17: ("n", "n", "false"),
    18: ("n", "n", "false"), 19: ("n", "np", "np = 0"), 20: ("n", "um", "um = 0"), 21: (0, 0, "false"), 22: (0, 0, "false")}))
def expectations(spark, sf):
    """Q26, Q28, Q29: every expectation type on one table; failures and unknowns stay on their own rows."""
    return R.run_suite(dirty_records(spark, sf, "Patient"), SUITE)


#: Expectations of a type's gold suite, and those of its value set.
_SUITE_SIZES = {"Patient": (8, 1), "Observation": (9, 1), "Encounter": (9, 1), "Condition": (7, 0), "MedicationRequest": (9, 1), "DiagnosticReport": (8, 0), "AllergyIntolerance": (7, 0), "Procedure": (9, 1),
                "Immunization": (9, 1), "DocumentReference": (9, 1)}
#: Columns that the tiers above bronze ask for besides value sets.
_SILVER = {"Patient": 0}


def _suite_rows():
    """Expectations and successes of 30 suites: the dirty types miss their value set from silver on."""
    for kind, (gold, sets) in _SUITE_SIZES.items():
        silver_only = _SILVER.get(kind, 1)
        for level, n in (("bronze", gold - 1 - silver_only - sets), ("silver", gold - 1), ("gold", gold)):
            missed = int(level != "bronze" and kind in KINDS)
            yield f"SELECT '{kind}' AS resource_type, '{level}' AS tier, CAST({n} AS BIGINT) AS expectations, CAST({n - missed} AS BIGINT) AS successful, round({n - missed} * 1.0 / {n}, 6) AS success_ratio"


@query("suites_q27_q31_a45_k14", " UNION ALL ".join(_suite_rows()))
def suites(spark, sf):
    """The suites of ten types at three tiers; the dirty types miss their value set."""
    frames = {**_dirty(spark, sf), **{k: records(spark, sf, k) for k in R.SUITES if k not in KINDS}}
    return _union(R.tier_validation(frames, level).withColumn("tier", F.lit(level)) for level in ("bronze", "silver", "gold"))


@query("schema_check_q01", oracle_prelude("encounter") + """SELECT * FROM (SELECT 'photo' AS field, 'missing' AS rule, 'Missing field: photo' AS message, CAST(count(*) AS BIGINT) AS rows FROM encounter
 UNION ALL SELECT 'k', 'type', 'Expected string but got bigint', count(*) FROM encounter UNION ALL SELECT 'end_datetime', 'nullability', 'Null values in end_datetime', count(*) - count(end_datetime) FROM encounter)""")
def schema_check(spark, sf):
    expected = T.StructType([T.StructField("encounter_id", T.StringType(), False), T.StructField("photo", T.StringType()), T.StructField("k", T.StringType()),
                             T.StructField("end_datetime", T.TimestampType(), False), T.StructField("status", T.StringType())])
    return R.schema_issues(flat(spark, sf, "encounter"), expected)


# --- repair -----------------------------------------------------------------------------------------


def _fixed(kind, key, src, *items):
    """Expected corrections of a record type in the order of its fields: (path, old, new, condition)."""
    rows = ", ".join(f"CASE WHEN {test} THEN '{at}: ' || {old} || ' -> ' || {new} END" for at, old, new, test in items)
    return f"SELECT '{kind}' AS resource_type, {key} AS id, concat_ws('|', {rows}) AS corrections FROM {src}"


def _midnight(at, col):
    """An instant at midnight becomes its date."""
    day = f"strftime({col}, '%Y-%m-%d')"
    return at, f"{day} || 'T00:00:00Z'", day, f"{col} IS NOT NULL"


def _slash(at, kind, ident, test):
    return at, f"'{kind}' || {ident}", f"'{kind}/' || {ident}", test


def _system(at, old, new, test):
    return at, f"'{old}'", f"'{new}'", test


_LOINC, _TODAY = "http://loinc.org", "strftime(issued_datetime, '%Y-%m-%d')"
_SEEN = "'2001-01-' || lpad(CAST(1 + k % 28 AS VARCHAR), 2, '0')"
CORRECTED = oracle_prelude("patient", "encounter", "observation+", "condition+", "medication_request+", "diagnostic_report+") + " UNION ALL ".join([
    _fixed("Patient", "patient_id", "patient", ("meta.lastUpdated", f"{_SEEN} || 'T00:00:00Z'", _SEEN, "true"),
           ("birthDate", "strftime(birth_date, '%m/%d/%Y')", "strftime(birth_date, '%Y-%m-%d')", "k % 17 = 0"), _slash("generalPractitioner[0].reference", "Practitioner", "CAST(nk AS VARCHAR)", "k % 6 = 0"),
           _system("extension[0].extension[0].valueCoding", "loinc", _LOINC, "k % 3 < 2")),
    _fixed("Observation", "observation_id", "observation", _midnight("meta.lastUpdated", "issued_datetime"), _system("code.coding[0]", "loinc", _LOINC, "pk % 5 = 0"),
           _slash("subject.reference", "Patient", "patient_id", "ln = 4"), _midnight("effectiveDateTime", "issued_datetime"),
           ("issued", f"CASE WHEN ln = 3 THEN strftime(issued_datetime, '%Y%m%d') ELSE {_TODAY} || 'T00:00:00Z' END", _TODAY, "ln <> 6"),
           _system("component[1].code.coding[0]", "LOINC", _LOINC, "code_code = '8480-6' AND pk % 4 = 0")),
    _fixed("Encounter", "encounter_id", "encounter", _midnight("meta.lastUpdated", "start_datetime"), _system("type[0].coding[0]", "snomed", "http://snomed.info/sct", "k % 6 = 0"),
           _slash("participant[0].individual.reference", "Practitioner", "CAST(k % 30 AS VARCHAR)", "k % 4 = 0"), _slash("diagnosis[0].condition.reference", "Condition", "encounter_id", "k % 5 = 0")),
    _fixed("Condition", "condition_id", "condition", _midnight("meta.lastUpdated", "onset_datetime"), _slash("recorder.reference", "Practitioner", "CAST(sk AS VARCHAR)", "sk % 4 = 0"),
           _midnight("onsetDateTime", "onset_datetime"), _midnight("recordedDate", "recorded_date")),
    _fixed("MedicationRequest", "medication_request_id", "medication_request", _midnight("meta.lastUpdated", "authored_datetime"), _slash("requester.reference", "Practitioner", "CAST(sk AS VARCHAR)", "sk % 3 = 0"),
           _system("dosageInstruction[0].route.coding[0]", "RxNorm", "http://www.nlm.nih.gov/research/umls/rxnorm", "ln = 2")),
    _fixed("DiagnosticReport", "report_id", "diagnostic_report", _midnight("meta.lastUpdated", "issued_datetime"), _slash("encounter.reference", "Encounter", "encounter_id", "pk % 3 = 0"),
           _midnight("issued", "issued_datetime"), _midnight("effectiveDateTime", "issued_datetime")),
])


@query("auto_correction_e01_e02_e03_e04", CORRECTED)
def auto_correction(spark, sf):
    """All that is corrected in the records of six types, at any depth."""
    def listed(kind):
        line = F.transform("corrections", lambda x: F.concat(x["path"], F.lit(": "), x["old"], F.lit(" -> "), x["new"]))
        # the test keeps the list out of the interpreted ``transform``: it is used twice, so it is made in a projection of its own
        lines = F.when(F.size("corrections") == 0, "").otherwise(F.array_join(line, "|"))
        return E.correct(messy_records(spark, sf, kind)).select(F.lit(kind).alias("resource_type"), "id", lines.alias("corrections"))
    return reduce(DataFrame.unionByName, [listed(kind) for kind in CORE])


@query("corrected_records_e01_e02_e03_e04", DIRTY + """SELECT 'Observation' AS resource_type, id, 'http://loinc.org' AS system, CASE ln WHEN 6 THEN 'soon' ELSE strftime(issued_datetime, '%Y-%m-%d') END AS date,
  'Patient/' || patient_id AS reference FROM o
 UNION ALL SELECT 'Encounter', id, CASE WHEN k % 6 = 0 THEN 'http://snomed.info/sct' ELSE 'urn:visit' END, strftime(start_datetime, '%Y-%m-%d'), 'Practitioner/' || CAST(k % 30 AS VARCHAR) FROM e""")
def corrected_records(spark, sf):
    """The corrected values themselves, nested ones included."""
    obs, enc = (E.correct(messy_records(spark, sf, kind)) for kind in ("Observation", "Encounter"))
    obs = obs.select(F.lit("Observation").alias("resource_type"), "id", path("code.coding[0].system").alias("system"), F.col("issued").alias("date"), path("subject.reference").alias("reference"))
    return obs.unionByName(enc.select(F.lit("Encounter").alias("resource_type"), "id", path("type[0].coding[0].system").alias("system"), path("meta.lastUpdated").alias("date"),
                                      path("participant[0].individual.reference").alias("reference")))


def _day_of(col):
    return F.to_date(F.substring(col, 1, 10))


@query("value_suggestions_e05", oracle_prelude("encounter") + """, v AS (SELECT encounter_id, k % 5 AS m, patient_id, start_datetime AS s FROM encounter)
SELECT encounter_id AS id, CASE m WHEN 0 THEN strftime(s, '%Y-%m-%d') WHEN 1 THEN 'http://loinc.org' WHEN 2 THEN 'finished' WHEN 3 THEN 'Patient/' || patient_id ELSE '' END AS suggestions FROM v""")
def value_suggestions(spark, sf):
    m, s = F.col("k") % 5, F.col("start_datetime")
    field = F.when(m == 0, "Encounter.birthDate").when(m == 1, "Encounter.code.system").when(m == 2, "Encounter.status").when(m == 3, "Encounter.subject.reference").otherwise("Encounter.id")
    value = F.when(m == 0, F.date_format(s, "yyyyMMdd")).when(m == 1, "Loinc").when(m == 2, "Finished!").when(m == 3, F.concat(F.lit("Patient"), "patient_id")).otherwise("x")
    found = E.suggest_values(F.lit("Encounter"), field, value)
    return flat(spark, sf, "encounter").select(F.col("encounter_id").alias("id"), F.transform(found, lambda x: x["value"]).alias("suggestions"))


_G = "'G' || CAST(k % 50 AS VARCHAR) || ' ' || 'M' || CAST(k % 7 AS VARCHAR)"


@query("patient_to_silver_e06_e09_e10", DIRTY + f"""SELECT id,
 CASE WHEN k % 11 = 0 OR k % 14 = 0 THEN CASE WHEN k % 2 = 1 THEN 'usual|usual' ELSE 'usual' END ELSE CASE WHEN k % 2 = 1 THEN 'usual|official' ELSE 'official' END END AS uses,
 CASE WHEN k % 11 = 0 THEN {_G} END AS text0, CASE WHEN k % 8 = 0 THEN 'TEMP-' || id ELSE 'I' || id END AS identifier, k % 17 = 0 AS marked, CASE WHEN k % 9 = 0 THEN 'other' ELSE 'phone' END AS system0,
 CASE WHEN k % 9 = 1 THEN 'temp' ELSE 'home' END AS use0, CASE WHEN k % 6 = 0 THEN 0 END AS gender_ext, 'SILVER' AS tags,
 concat_ws('|', CASE WHEN k % 11 = 0 THEN 'name[0].use' || CASE WHEN k % 2 = 1 THEN '|name[1].use' ELSE '' END END, CASE WHEN k % 11 = 0 THEN 'name[0].text' || CASE WHEN k % 2 = 1 THEN '|name[1].text' ELSE '' END END,
  CASE WHEN k % 11 <> 0 AND k % 14 = 0 THEN 'name[0].use' || CASE WHEN k % 2 = 1 THEN '|name[1].use' ELSE '' END END, CASE WHEN k % 8 = 0 THEN 'identifier' END, CASE WHEN k % 17 = 0 THEN '_birthDate.extension' END,
  CASE WHEN k % 9 = 0 THEN 'telecom[0].system' || CASE WHEN email IS NOT NULL THEN '|telecom[1].system' ELSE '' END END, CASE WHEN k % 9 = 1 THEN 'telecom[0].use' || CASE WHEN email IS NOT NULL THEN '|telecom[1].use' ELSE '' END END) AS modifications FROM p""")
def patient_to_silver(spark, sf):
    out = E.to_silver(dirty_records(spark, sf, "Patient"), "Patient")
    return out.select("id", F.col("name.use").alias("uses"), F.when(F.col("id").cast("bigint") % 11 == 0, path("name[0].text")).alias("text0"), path("identifier[0].value").alias("identifier"),
                      F.col("_birthDate").isNotNull().alias("marked"), path("telecom[0].system").alias("system0"), path("telecom[0].use").alias("use0"),
                      F.size(F.col("_gender.extension")).alias("gender_ext"), F.col("meta.tag.code").alias("tags"), F.col("modifications.path").alias("modifications"))


@query("records_to_silver_e07", DIRTY + f"""SELECT id, coalesce(s, 'unknown') AS status, CASE WHEN has_code THEN code_code ELSE 'unknown' END AS code,
 CASE WHEN ln = 3 THEN 'Patient/Patient' || patient_id ELSE 'Patient/' || patient_id END AS subject, NULL AS start,
 concat_ws('|', CASE WHEN s IS NULL THEN 'status' END, CASE WHEN NOT has_code THEN 'code' END, CASE WHEN ln IN (3, 4) THEN 'subject.reference' END) AS modifications FROM o
UNION ALL SELECT id, CASE WHEN s IS NULL OR s = 'arrived-late' THEN 'unknown' ELSE s END, NULL, 'Patient/' || patient_id, replace(st, ' ', 'T'),
 concat_ws('|', CASE WHEN s IS NULL OR s = 'arrived-late' THEN 'status' END, CASE WHEN k % 5 = 0 THEN 'period.start' END) FROM e
UNION ALL SELECT condition_id, NULL, code_code, 'Patient/' || patient_id, NULL, '' FROM ({oracle_prelude('condition+')} SELECT * FROM condition)""")
def records_to_silver(spark, sf):
    obs = E.to_silver(dirty_records(spark, sf, "Observation"), "Observation").select(
        "id", "status", path("code.coding[0].code").alias("code"), path("subject.reference").alias("subject"), F.lit(None).cast("string").alias("start"), F.col("modifications.path").alias("modifications"))
    enc = E.to_silver(dirty_records(spark, sf, "Encounter"), "Encounter").select(
        "id", "status", F.lit(None).cast("string").alias("code"), path("subject.reference").alias("subject"), path("period.start").alias("start"), F.col("modifications.path").alias("modifications"))
    other = E.to_silver(records(spark, sf, "Condition"), "Condition").select(
        "id", F.lit(None).cast("string").alias("status"), path("code.coding[0].code").alias("code"), path("subject.reference").alias("subject"), F.lit(None).cast("string").alias("start"),
        F.col("modifications.path").alias("modifications"))
    return obs.unionByName(enc).unionByName(other)


_X0 = "'<div xmlns=''http://www.w3.org/1999/xhtml''>"


@query("patient_to_gold_e08_e11_e12", oracle_prelude("patient") + f"""SELECT patient_id AS id, 'GOLD' AS tags, 1 AS profiles, CASE WHEN k % 5 = 0 THEN 'PHI|PHI|PHI-RESTRICTED' ELSE 'PHI|PHI-RESTRICTED' END AS security,
 CASE k % 3 WHEN 0 THEN 'ombCategory|text' WHEN 1 THEN 'ombCategory|text' END AS race_parts, CASE k % 3 WHEN 0 THEN 'White race' WHEN 1 THEN 'White' END AS race_text,
 {_X0}<h1>Patient: ' || CASE WHEN k % 2 = 1 THEN {_G} || ' Nick' WHEN k % 3 <> 0 THEN name_text ELSE {_G} || ' ' || name_text END || '</h1><p><b>Gender:</b> ' || upper(substring(gender, 1, 1)) || substring(gender, 2) || '</p><p><b>Date of Birth:</b> '
  || strftime(birth_date, '%Y-%m-%d') || '</p><h2>Identifiers</h2><ul><li>ID: I' || patient_id || ' (urn:oid:1.2.3)</li><li>ID: MRN' || patient_id || ' (http://hospital.example.org/mrn)</li></ul><h2>Contact Information</h2><ul><li>Phone (home): '
  || phone || '</li>' || coalesce('<li>Email (work): ' || email || '</li>', '') || '</ul><h2>Addresses</h2><ul>' || CASE WHEN k % 3 = 1 THEN '<li>Work Address: 1 Office Rd, Worktown, S0, 00000, ' || address_country || '</li>' ELSE '' END
  || '<li>Home Address: ' || address_line || ', ' || address_city || ', ' || address_state || ', ' || address_postal_code || ', ' || address_country || '</li></ul></div>' AS div FROM patient""")
def patient_to_gold(spark, sf):
    out = E.to_gold(records(spark, sf, "Patient"), "Patient")
    race = path(f"extension[?url='{codes.RACE_URL}']")
    return out.select("id", F.col("meta.tag.code").alias("tags"), F.size("meta.profile").alias("profiles"), F.col("meta.security.code").alias("security"), F.transform(race["extension"], lambda c: c["url"]).alias("race_parts"),
                      F.get(F.filter(race["extension"], lambda c: c["url"] == "text"), F.lit(0))["valueString"].alias("race_text"), path("text.div").alias("div"))


@query("records_to_gold_e08_e12", oracle_prelude("observation+", "encounter", "condition") + f"""SELECT observation_id AS id, 1 AS profiles, {_X0}<h1>Observation: ' || code_display || '</h1><p><b>Status:</b> '
 || upper(substring(status, 1, 1)) || substring(status, 2) || '</p><p><b>Effective Date:</b> ' || strftime(issued_datetime, {Z}) || '</p><p><b>Subject:</b> Patient/' || patient_id || '</p><p><b>Value:</b> '
 || CASE WHEN ln <> 5 THEN CAST(value AS VARCHAR) || ' ' || unit WHEN pk % 3 = 0 THEN 'v' || CAST(value AS VARCHAR) WHEN pk % 3 = 1 THEN 'Positive result' ELSE 'No value recorded' END || '</p></div>' AS div FROM observation
UNION ALL SELECT encounter_id, NULL, {_X0}<h1>Encounter: ' || coalesce(type_display, 'Unknown Encounter') || '</h1><p><b>Status:</b> ' || upper(substring(status, 1, 1)) || substring(status, 2) || '</p><p><b>Class:</b> ' || class_display
 || '</p><p><b>Period:</b> ' || strftime(start_datetime, {Z}) || ' to ' || coalesce(strftime(end_datetime, {Z}), 'Ongoing') || '</p><p><b>Subject:</b> Patient/' || patient_id || '</p></div>' FROM encounter
UNION ALL SELECT condition_id, NULL, {_X0}<p>Condition resource with ID: ' || condition_id || '</p></div>' FROM condition""")
def records_to_gold(spark, sf):
    return _union(E.to_gold(records(spark, sf, k), k).select("id", F.size("meta.profile").alias("profiles"), path("text.div").alias("div")) for k in ("Observation", "Encounter", "Condition"))


@query("modification_log_e10", DIRTY + f"""SELECT 'Encounter' AS resource_type, id AS resource_id, 'status' AS path, CASE WHEN s IS NULL THEN 'Added missing required status' ELSE 'Corrected invalid status value' END AS reason, '{AS_OF}' AS timestamp
 FROM e WHERE s IS NULL OR s = 'arrived-late' UNION ALL SELECT 'Encounter', id, 'period.start', 'Fixed datetime format', '{AS_OF}' FROM e WHERE k % 5 = 0""")
def modification_log(spark, sf):
    return E.modification_log(E.to_silver(dirty_records(spark, sf, "Encounter"), "Encounter"), AS_OF)


@query("tier_report_e14", DIRTY + """SELECT 'Encounter' AS resource_type, 'SILVER' AS tier, CAST(count(*) AS BIGINT) AS records, CAST(sum((s IS NULL OR s = 'arrived-late')::INT + (k % 5 = 0)::INT) AS BIGINT) AS modifications FROM e
 UNION ALL SELECT 'Observation', 'SILVER', count(*), CAST(sum((s IS NULL)::INT + (NOT has_code)::INT + (ln IN (3, 4))::INT) AS BIGINT) FROM o""")
def tier_report(spark, sf):
    return E.tier_report({k: E.to_silver(dirty_records(spark, sf, k), k) for k in ("Observation", "Encounter")})


@query("fill_required_e13_d19", DIRTY + """SELECT id, 'Patient' AS kind, CASE WHEN k % 8 = 0 THEN id ELSE 'I' || id END AS a, 'gold' AS tier, CASE WHEN k % 4 = 0 THEN '<div xmlns="http://www.w3.org/1999/xhtml"><p>Patient resource</p></div>' END AS div,
 CASE WHEN k % 3 = 0 THEN 3 WHEN k % 3 = 1 THEN 2 ELSE 1 END AS extensions FROM p
UNION ALL SELECT id, 'Observation', coalesce(s, 'final') || ' ' || CASE WHEN has_code THEN code_code ELSE 'unknown' END, 'gold', '<div xmlns="http://www.w3.org/1999/xhtml"><p>Observation resource</p></div>', NULL FROM o
UNION ALL SELECT id, 'Encounter', coalesce(s, 'finished') || ' ' || class_code, 'gold', '<div xmlns="http://www.w3.org/1999/xhtml"><p>Encounter resource</p></div>', NULL FROM e""")
def fill_required(spark, sf):
    d = {k: E.fill_required(df, k, "gold", default_subject="0") for k, df in _dirty(spark, sf).items()}
    tier = F.element_at("meta.tag", -1)["code"].alias("tier")
    div = path("text.div")
    none = F.lit(None).cast("int").alias("extensions")
    return _union([
        d["Patient"].select("id", F.lit("Patient").alias("kind"), path("identifier[0].value").alias("a"), tier, F.when(div.contains("resource"), div).alias("div"), F.size("extension").alias("extensions")),
        d["Observation"].select("id", F.lit("Observation").alias("kind"), F.concat_ws(" ", "status", path("code.coding[0].code")).alias("a"), tier, div.alias("div"), none),
        d["Encounter"].select("id", F.lit("Encounter").alias("kind"), F.concat_ws(" ", "status", path("class.code")).alias("a"), tier, div.alias("div"), none)])


@query("deidentify_e15", oracle_prelude("patient") + f"""SELECT patient_id AS id, 'XXXXX' AS family, 'XXXXX|XXXXX' AS given, 'XXXXX' AS identifier, 0 AS telecom, 0 AS address,
 CASE WHEN k % 4 <> 0 THEN '<div>De-identified</div>' END AS div FROM patient""")
def deidentify(spark, sf):
    out = E.deidentify(records(spark, sf, "Patient"), "Patient")
    return out.select("id", path("name[0].family").alias("family"), path("name[0].given").alias("given"), path("identifier[1].value").alias("identifier"), F.size("telecom").alias("telecom"),
                      F.size("address").alias("address"), path("text.div").alias("div"))
