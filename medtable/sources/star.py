"""Projection of the star tables to record-shaped frames.

The star holds no clinical records, so every operator runs on a deterministic projection of it.
``FLAT`` is plain SQL that any engine can run (names in braces are its input tables), which lets a
check build the same inputs. The nested record frames add the list and struct fields.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import types, walk
from ..functions.codes import LOINC, RACE_URL, TIER_SYSTEM, US_CORE, VITALS

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

AS_OF = "2002-01-01"
#: Patient id of an order.
OWNER = "CAST(o_custkey AS STRING)"
BASE = {"patient": "customer", "encounter": "orders", "care_plan": "orders", "related_person": "customer", "practitioner": "supplier", "organization": "nation",
        "document_reference": "documents"}


def _pick(expr: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


_CLASS = ("CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'EMER' WHEN '2' THEN 'IMP' WHEN '3' THEN 'AMB' "
          "WHEN '4' THEN 'HH' ELSE 'OTH' END")
_LINE_ID = ("CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || "
            "CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(l_shipdate AS DATE) AS STRING)")

FLAT = {
    "patient": f"""
        SELECT c_custkey AS k, c_nationkey AS nk, CAST(c_custkey AS STRING) AS patient_id, c_name AS name_text,
          {_pick("c_custkey % 4", ["male", "female", "other", "unknown"])} AS gender,
          DATE '1940-01-01' + CAST((c_custkey * 37) % 22000 AS INT) AS birth_date,
          '555-010-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') AS phone,
          CASE WHEN c_custkey % 5 <> 0 THEN 'p' || CAST(c_custkey AS STRING) || '@example.org' END AS email,
          CAST(c_custkey AS STRING) || ' Main St' AS address_line, n_name AS address_city,
          'S' || CAST(c_nationkey % 10 AS STRING) AS address_state,
          lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') AS address_postal_code, r_name AS address_country,
          {_pick("c_nationkey % 3", ["en", "es", "fr"])} AS language,
          CASE WHEN c_custkey % 4 <> 0 THEN 'Seen in ' || n_name END AS patient_summary_text
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey""",
    "encounter": f"""
        SELECT o_orderkey AS k, CAST(o_orderkey AS STRING) AS encounter_id, CAST(o_custkey AS STRING) AS patient_id,
          CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'in-progress' ELSE 'planned' END AS status,
          {_CLASS} AS class_code,
          CASE {_CLASS} WHEN 'EMER' THEN 'emergency' WHEN 'IMP' THEN 'inpatient' WHEN 'AMB' THEN 'ambulatory'
            WHEN 'HH' THEN 'home health' ELSE 'other' END AS class_display,
          'T' || CAST(o_orderkey % 5 AS STRING) AS type_code,
          CASE WHEN o_orderkey % 7 <> 0 THEN 'Visit type ' || CAST(o_orderkey % 5 AS STRING) END AS type_display,
          o_orderdate AS start_datetime,
          CASE WHEN o_orderstatus <> 'O'
            THEN o_orderdate + CAST((o_orderkey * 13) % 400 AS INT) * INTERVAL '1' HOUR END AS end_datetime,
          'Organization/' || CAST(o_orderkey % 20 AS STRING) AS service_provider,
          CASE WHEN o_orderkey % 3 = 0 THEN 'Reason ' || CAST(o_orderkey % 11 AS STRING) END AS reason_display
        FROM {{orders}}""",
    "observation": f"""
        SELECT {_LINE_ID} AS observation_id, CAST(l_orderkey AS STRING) AS encounter_id, '{LOINC}' AS code_system,
          {_pick("l_partkey % 7", list(VITALS))} AS code_code, {_pick("l_partkey % 7", list(VITALS.values()))} AS code_display,
          l_quantity AS value, 'u' || CAST(l_partkey % 7 AS STRING) AS unit, l_shipdate AS issued_datetime,
          CASE l_linestatus WHEN 'F' THEN 'final' ELSE 'preliminary' END AS status,
          CASE WHEN l_partkey % 7 < 5 THEN 'vital-signs' ELSE 'laboratory' END AS category,
          CASE WHEN l_linenumber % 2 = 1 THEN 'note ' || CAST(l_linenumber AS STRING) END AS clinical_text,
          l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk
        FROM {{lineitem}}""",
    "condition": f"""
        SELECT {_LINE_ID} AS condition_id, CAST(l_orderkey AS STRING) AS encounter_id,
          {_pick("l_suppkey % 5", ["active", "recurrence", "relapse", "inactive", "resolved"])} AS clinical_status,
          'C' || CAST(l_partkey % 50 AS STRING) AS code_code, p_type AS code_display,
          CASE WHEN l_linenumber % 4 <> 0 THEN l_shipdate END AS recorded_date, l_shipdate AS onset_datetime,
          {_pick("l_suppkey % 3", ["mild", "moderate", "severe"])} AS severity,
          CASE WHEN l_linenumber % 2 = 0 THEN 'problem-list-item' ELSE 'encounter-diagnosis' END AS category,
          CASE WHEN l_linenumber % 3 = 0 THEN 'finding ' || CAST(l_partkey % 9 AS STRING) END AS clinical_text,
          l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey WHERE l_returnflag = 'R'""",
    "medication_request": f"""
        SELECT {_LINE_ID} AS medication_request_id, CAST(l_orderkey AS STRING) AS encounter_id,
          CAST(l_partkey AS STRING) AS medication_code, p_brand AS medication_display,
          CASE l_linestatus WHEN 'O' THEN 'active' ELSE 'completed' END AS status, l_shipdate AS authored_datetime,
          'Practitioner/' || CAST(l_suppkey AS STRING) AS requester,
          CAST(NULL AS STRING) AS clinical_text, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey WHERE l_returnflag = 'A'""",
    "diagnostic_report": f"""
        SELECT {_LINE_ID} AS report_id, CAST(l_orderkey AS STRING) AS encounter_id, l_shipdate AS issued_datetime,
          CASE WHEN l_partkey % 6 = 0 THEN 'Cardiac echo' WHEN l_partkey % 6 = 1 THEN 'Renal ultrasound'
            ELSE 'Blood panel ' || CAST(l_partkey % 6 AS STRING) END AS code_display,
          CASE WHEN l_partkey % 6 = 2 THEN '45030-7' ELSE 'R' || CAST(l_partkey % 6 AS STRING) END AS code_code,
          CASE l_linestatus WHEN 'F' THEN 'final' ELSE 'registered' END AS status,
          CASE WHEN l_suppkey % 2 = 0 THEN 'Conclusion ' || CAST(l_suppkey AS STRING) END AS conclusion,
          CAST(NULL AS STRING) AS clinical_text, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk
        FROM {{lineitem}} WHERE l_returnflag = 'N' AND l_linenumber = 1""",
    "allergy_intolerance": f"""
        SELECT {_LINE_ID} AS allergy_id, CAST(l_orderkey AS STRING) AS encounter_id, 'A' || CAST(l_partkey % 40 AS STRING) AS code_code, p_brand AS substance,
          {_pick("l_suppkey % 3", ["active", "inactive", "resolved"])} AS clinical_status, {_pick("l_suppkey % 4", ["mild", "moderate", "severe"])} AS severity,
          CASE WHEN l_partkey % 5 <> 0 THEN 'Rash ' || CAST(l_partkey % 6 AS STRING) END AS manifestation, l_shipdate AS recorded_date,
          l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey WHERE l_linenumber = 5 AND l_partkey % 2 = 0""",
    "procedure": f"""
        SELECT {_LINE_ID} AS procedure_id, CAST(l_orderkey AS STRING) AS encounter_id, 'P' || CAST(l_partkey % 30 AS STRING) AS code_code, 'Procedure ' || CAST(l_partkey % 30 AS STRING) AS code_display,
          CASE WHEN l_partkey % 9 <> 0 THEN 'completed' END AS status, l_shipdate AS performed, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk
        FROM {{lineitem}} WHERE l_linenumber = 6""",
    "immunization": f"""
        SELECT {_LINE_ID} AS immunization_id, CAST(l_orderkey AS STRING) AS encounter_id, 'V' || CAST(l_partkey % 20 AS STRING) AS code_code, 'Vaccine ' || CAST(l_partkey % 20 AS STRING) AS code_display,
          CASE l_linestatus WHEN 'F' THEN 'completed' ELSE 'not-done' END AS status, CASE WHEN l_partkey % 8 <> 0 THEN l_shipdate END AS occurred, l_quantity AS dose,
          l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk
        FROM {{lineitem}} WHERE l_linenumber = 7""",
    "care_plan": """
        SELECT o_orderkey AS k, 'CP' || CAST(o_orderkey AS STRING) AS care_plan_id, CAST(o_orderkey AS STRING) AS encounter_id, CAST(o_custkey AS STRING) AS patient_id,
          CASE o_orderstatus WHEN 'F' THEN 'completed' ELSE 'active' END AS status, CASE WHEN o_orderkey % 4 <> 0 THEN 'plan' END AS intent,
          o_orderpriority AS title, o_orderdate AS created
        FROM {orders} WHERE o_orderkey % 3 = 0""",
    "related_person": f"""
        SELECT c_custkey AS k, 'RP' || CAST(c_custkey AS STRING) AS related_person_id, CAST(c_custkey AS STRING) AS patient_id, c_name AS name_text,
          CASE WHEN c_custkey % 15 = 0 THEN 'X' ELSE {_pick("c_custkey % 2", ["male", "female"])} END AS gender,
          DATE '1945-01-01' + CAST((c_custkey * 41) % 20000 AS INT) AS birth_date, {_pick("c_nationkey % 3", ["parent", "spouse", "sibling"])} AS relationship
        FROM {{customer}}""",
    "practitioner": """
        SELECT s_suppkey AS k, CAST(s_suppkey AS STRING) AS practitioner_id, s_name AS name_text, s_nationkey AS nk FROM {supplier}""",
    "organization": """
        SELECT n_nationkey AS k, CAST(n_nationkey AS STRING) AS organization_id, n_name AS name_text, r_name AS address_country FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "document_reference": f"""
        SELECT doc_id AS k, 'D' || CAST(doc_id AS STRING) AS document_id, CAST(doc_id AS STRING) AS patient_id, lang, text,
          {_pick("doc_id % 4", ["Progress note", "Discharge summary", "Imaging report", "Consent form"])} AS type_display, DATE '2024-01-01' + CAST(doc_id % 365 AS INT) AS note_date
        FROM {{documents}}""",
    "metric": f"""
        SELECT event_id, ts, 'quality.' || event_type AS metric, event_type AS dimension,
          {_pick("user_id % 4", ["Patient", "Observation", "Encounter", "Condition"])} AS resource_type,
          {_pick("CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 3", ["bronze", "silver", "gold"])} AS pipeline_stage,
          value / 1000 AS value, user_id
        FROM {{events}}""",
    "validation": f"""
        SELECT event_id, CAST(event_id AS STRING) AS resource_id, ts,
          {_pick("user_id % 4", ["Patient", "Observation", "Encounter", "Condition"])} AS resource_type,
          CASE WHEN event_id % 2 = 0 THEN 'schema' ELSE 'profile' END AS validation_type,
          {_pick("user_id % 3", ["bronze", "silver", "gold"])} AS pipeline_stage,
          event_type <> 'error' AS is_valid, CAST(event_id % 4 AS INT) AS issue_count,
          {_pick("event_id % 5", ["fatal", "error", "warning", "information", "odd"])} AS severity,
          {_pick("user_id % 9", ["Property is missing", "Unknown target", "Does not conform to profile", "Invalid minimum",
                                 "Constraint violated", "Code not in binding", "No permission", "Conflict between fields",
                                 "Something else"])} || CASE WHEN event_id % 2 = 0 THEN '' ELSE ' (' || event_type || ')' END AS message
        FROM {{events}}""",
    "note": f"""
        SELECT doc_id, CAST(doc_id AS STRING) AS patient_id, text,
          {_pick("doc_id % 4", ["Progress note", "Discharge summary", "Imaging report", "Consent form"])} AS type_display,
          DATE '2024-01-01' + CAST(doc_id % 365 AS INT) AS note_date
        FROM {{documents}}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one stored table; a missing one raises."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flat(spark: SparkSession, sf_dir: str, name: str, with_patient: bool = False, spread: bool = False) -> DataFrame:
    """One flat (silver) frame; ``with_patient`` adds the patient id of line-level frames.

    Stored rows are moved as they are: the order of a line is joined, and a single file spread, before the texts of
    a record are made of them.
    """
    rows, make = _stored(spark, sf_dir, name, with_patient, spread)
    return make(rows)


def _stored(spark: SparkSession, sf_dir: str, name: str, with_patient: bool, spread: bool) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """The stored rows of a flat frame, and the function that makes the frame of them; it keeps columns named after the rows."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in FLAT[name]}
    base = BASE.get(name, "lineitem")
    if spread and base in used:
        used[base] = spread_out(used[base])
    base = base if base in used else next(iter(used))
    of_lines = with_patient and "lineitem" in used
    if of_lines:
        owner = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        used["lineitem"] = used["lineitem"].join(owner, F.col("l_orderkey") == F.col("o_orderkey"))

    def make(rows: DataFrame, *keep: str) -> DataFrame:
        more = [*([f"{OWNER} AS patient_id"] if of_lines else []), *keep]
        df = spark.sql(FLAT[name].replace(f"FROM {{{base}}}", f"{''.join(f', {c}' for c in more)} FROM {{{base}}}"), **used | {base: rows})
        # Stored instants carry no zone; records use UTC instants.
        df = df.select(*[F.col(n).cast("timestamp").alias(n) if t == "timestamp_ntz" else F.col(n) for n, t in df.dtypes])
        if of_lines:
            df = df.select("encounter_id", *[c for c in df.columns if c not in ("encounter_id", "patient_id")], "patient_id")
        return df

    return used[base], make


def spread_out(stored: DataFrame) -> DataFrame:
    """Give a table that is a single file as many partitions as there are cores.

    A file of one row group is a single task, however costly the projection on top of it. A table stored as a folder of
    files is left alone: its splits already are the parallelism.
    """
    if len(stored.inputFiles()) != 1:
        return stored
    return stored.repartition(int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions")), stored.columns[0])


def _instant(col: str) -> str:
    return f"date_format({col}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


_CODING = "named_struct('system', {s}, 'code', {c}, 'display', {d})"


def _coding(system: str, code: str, display: str) -> str:
    return _CODING.format(s=system, c=code, d=display)


def _concept(system: str, code: str, display: str, text: str = "CAST(NULL AS STRING)") -> str:
    return f"named_struct('coding', array({_coding(system, code, display)}), 'text', {text})"


def _ref(expr: str) -> str:
    return f"named_struct('reference', {expr}, 'display', CAST(NULL AS STRING))"


_HOME = ("named_struct('use', 'home', 'line', array(address_line), 'city', address_city, 'state', address_state, "
         "'postalCode', address_postal_code, 'country', address_country)")
_WORK = ("named_struct('use', 'work', 'line', array('1 Office Rd'), 'city', 'Worktown', 'state', 'S0', "
         "'postalCode', '00000', 'country', address_country)")
_GIVEN = "array('G' || CAST(k % 50 AS STRING), 'M' || CAST(k % 7 AS STRING))"
_OFFICIAL = f"named_struct('use', 'official', 'family', name_text, 'given', {_GIVEN}, 'text', CASE WHEN k % 3 <> 0 THEN name_text END)"
_USUAL = f"named_struct('use', 'usual', 'family', 'Nick', 'given', {_GIVEN}, 'text', CAST(NULL AS STRING))"
_OMB = (f"named_struct('url', 'ombCategory', 'valueString', CAST(NULL AS STRING), 'valueCoding', "
        f"{_coding(chr(39) + 'urn:oid:2.16.840.1.113883.6.238' + chr(39), chr(39) + '2106-3' + chr(39), chr(39) + 'White' + chr(39))})")
_RTEXT = ("named_struct('url', 'text', 'valueString', 'White race', 'valueCoding', "
          "CAST(NULL AS STRUCT<system:STRING,code:STRING,display:STRING>))")
_NO_CHILD = "CAST(NULL AS ARRAY<STRUCT<url:STRING,valueString:STRING,valueCoding:STRUCT<system:STRING,code:STRING,display:STRING>>>)"
_LANG = f"named_struct('coding', array({_coding(chr(39) + 'urn:ietf:bcp:47' + chr(39), 'language', 'CAST(NULL AS STRING)')}), 'text', CAST(NULL AS STRING))"
_OTHER_LANG = _LANG.replace("language", "'xx'")


def _race(children: str) -> str:
    return f"named_struct('url', '{RACE_URL}', 'valueCode', CAST(NULL AS STRING), 'extension', {children})"


RECORDS = {
    "Patient": [
        "'Patient' AS resourceType", "patient_id AS id", "k % 10 <> 0 AS active", "gender",
        "date_format(birth_date, 'yyyy-MM-dd') AS birthDate",
        f"CASE WHEN k % 2 = 1 THEN array({_USUAL}, {_OFFICIAL}) ELSE array({_OFFICIAL}) END AS name",
        "array(named_struct('system', 'urn:oid:1.2.3', 'value', 'I' || patient_id), "
        "named_struct('system', 'http://hospital.example.org/mrn', 'value', 'MRN' || patient_id)) AS identifier",
        "filter(array(named_struct('system', 'phone', 'value', phone, 'use', 'home'), "
        "named_struct('system', 'email', 'value', email, 'use', 'work')), x -> x.value IS NOT NULL) AS telecom",
        f"CASE WHEN k % 3 = 1 THEN array({_WORK}, {_HOME}) ELSE array({_HOME}) END AS address",
        _concept("'http://terminology.hl7.org/CodeSystem/v3-MaritalStatus'", "CASE WHEN k % 2 = 0 THEN 'M' ELSE 'S' END",
                 "CASE WHEN k % 2 = 0 THEN 'Married' ELSE 'Single' END") + " AS maritalStatus",
        f"CASE WHEN k % 4 = 0 THEN array(named_struct('language', {_OTHER_LANG}, 'preferred', false), "
        f"named_struct('language', {_LANG}, 'preferred', true)) "
        f"ELSE array(named_struct('language', {_LANG}, 'preferred', CAST(NULL AS BOOLEAN))) END AS communication",
        "array(" + _ref("'Practitioner/' || CAST(nk AS STRING)") + ") AS generalPractitioner",
        f"CASE WHEN k % 3 = 0 THEN array({_race(f'array({_OMB}, {_RTEXT})')}, "
        f"named_struct('url', '{US_CORE}us-core-birthsex', 'valueCode', 'F', 'extension', {_NO_CHILD})) "
        f"WHEN k % 3 = 1 THEN array({_race(f'array({_OMB})')}) END AS extension",
        "CASE WHEN patient_summary_text IS NOT NULL THEN named_struct('status', 'generated', 'div', "
        "'<div xmlns=\"http://www.w3.org/1999/xhtml\"><p>' || patient_summary_text || '</p></div>') END AS text",
        "named_struct('versionId', '1', 'lastUpdated', '2001-01-' || lpad(CAST(1 + k % 28 AS STRING), 2, '0') || 'T00:00:00Z', "
        f"'profile', CASE WHEN k % 2 = 0 THEN array('{US_CORE}us-core-patient') END, "
        f"'tag', CASE WHEN k % 7 = 0 THEN array({_coding(chr(39) + TIER_SYSTEM + chr(39), chr(39) + 'SILVER' + chr(39), chr(39) + 'Silver Quality Tier' + chr(39))}) END, "
        "'security', CASE WHEN k % 5 = 0 THEN array("
        + _coding("'http://terminology.hl7.org/CodeSystem/v3-ActCode'", "'PHI'", "'PHI'") + ") END) AS meta",
    ],
    "Observation": [
        "'Observation' AS resourceType", "observation_id AS id", "status",
        "array(" + _concept("'http://terminology.hl7.org/CodeSystem/observation-category'", "category", "category") + ") AS category",
        _concept("code_system", "code_code", "code_display", "code_display") + " AS code",
        _ref("'Patient/' || patient_id") + " AS subject", _ref("'Encounter/' || encounter_id") + " AS encounter",
        _instant("issued_datetime") + " AS effectiveDateTime", _instant("issued_datetime") + " AS issued",
        "CASE WHEN ln <> 5 THEN named_struct('value', value, 'unit', unit, 'system', 'http://unitsofmeasure.org', 'code', unit) END AS valueQuantity",
        "CASE WHEN ln = 5 AND pk % 3 = 0 THEN 'v' || CAST(value AS STRING) END AS valueString",
        "CASE WHEN ln = 5 AND pk % 3 = 1 THEN " + _concept("'urn:result'", "'POS'", "'Positive'", "'Positive result'") + " END AS valueCodeableConcept",
        "CASE WHEN value > 40 THEN array(" + _concept("'urn:interp'", "'H'", "'High'") + ") END AS interpretation",
        "CASE WHEN pk % 2 = 0 THEN array(named_struct('low', named_struct('value', 10.0D, 'unit', unit), "
        "'high', named_struct('value', 40.0D, 'unit', unit))) END AS referenceRange",
        "CASE WHEN code_code = '8480-6' THEN array("
        "named_struct('code', " + _concept("code_system", "'8480-6'", "'bp_systolic'") + ", 'valueQuantity', named_struct('value', 100 + value, 'unit', 'mmHg')), "
        "named_struct('code', " + _concept("code_system", "'8462-4'", "'bp_diastolic'") + ", 'valueQuantity', named_struct('value', 55 + value, 'unit', 'mmHg'))) END AS component",
        "named_struct('lastUpdated', " + _instant("issued_datetime") + ") AS meta",
    ],
    "Encounter": [
        "'Encounter' AS resourceType", "encounter_id AS id", "status",
        _coding("'http://terminology.hl7.org/CodeSystem/v3-ActCode'", "class_code", "class_display") + " AS class",
        "array(" + _concept("'urn:visit'", "type_code", "type_display") + ") AS type",
        _ref("'Patient/' || patient_id") + " AS subject",
        "named_struct('start', " + _instant("start_datetime") + ", 'end', " + _instant("end_datetime") + ") AS period",
        "array(named_struct('type', array(" + _concept("'urn:part'", "'ATND'", "'attender'") + "), 'individual', "
        + _ref("'Practitioner/' || CAST(k % 30 AS STRING)") + ")) AS participant",
        "CASE WHEN reason_display IS NOT NULL THEN array(" + _concept("'urn:reason'", "'R' || CAST(k % 11 AS STRING)", "reason_display") + ") END AS reasonCode",
        "array(named_struct('condition', " + _ref("'Condition/' || encounter_id") + ", 'use', "
        + _concept("'urn:use'", "'AD'", "'Admission'") + ", 'rank', 1)) AS diagnosis",
        "array(named_struct('location', " + _ref("'Location/' || CAST(k % 9 AS STRING)") + ")) AS location",
        _ref("service_provider") + " AS serviceProvider",
        "CASE WHEN k % 4 = 0 THEN " + _ref("'Encounter/' || CAST(k - 1 AS STRING)") + " END AS partOf",
        "named_struct('lastUpdated', " + _instant("start_datetime") + ") AS meta",
    ],
    "Condition": [
        "'Condition' AS resourceType", "condition_id AS id",
        _concept("'urn:clinical'", "clinical_status", "clinical_status") + " AS clinicalStatus",
        _concept("'urn:verification'", "'confirmed'", "'Confirmed'") + " AS verificationStatus",
        _concept("'urn:severity'", "severity", "severity") + " AS severity",
        _concept(f"'{'http://snomed.info/sct'}'", "code_code", "code_display") + " AS code",
        "array(" + _concept("'urn:category'", "category", "category") + ") AS category",
        _ref("'Patient/' || patient_id") + " AS subject", _ref("'Encounter/' || encounter_id") + " AS encounter",
        _ref("'Practitioner/' || CAST(sk AS STRING)") + " AS recorder",
        _instant("onset_datetime") + " AS onsetDateTime", _instant("recorded_date") + " AS recordedDate",
        "named_struct('lastUpdated', " + _instant("onset_datetime") + ") AS meta",
    ],
    "MedicationRequest": [
        "'MedicationRequest' AS resourceType", "medication_request_id AS id", "status", "'order' AS intent",
        "CASE WHEN ln <> 3 THEN " + _concept("'http://www.nlm.nih.gov/research/umls/rxnorm'", "medication_code", "medication_display") + " END AS medicationCodeableConcept",
        "CASE WHEN ln = 3 THEN " + _ref("'Medication/' || medication_code") + " END AS medicationReference",
        _ref("'Patient/' || patient_id") + " AS subject", _ref("'Encounter/' || encounter_id") + " AS encounter",
        _ref("requester") + " AS requester", _instant("authored_datetime") + " AS authoredOn",
        "array(named_struct('text', 'take ' || CAST(ln AS STRING), 'route', " + _concept("'urn:route'", "'PO'", "'Oral'")
        + ", 'timing', named_struct('code', CAST(NULL AS STRUCT<text:STRING>), 'repeat', named_struct('frequency', ln, 'period', 1.0D, 'periodUnit', 'd')))) AS dosageInstruction",
        "named_struct('lastUpdated', " + _instant("authored_datetime") + ") AS meta",
    ],
    "DiagnosticReport": [
        "'DiagnosticReport' AS resourceType", "report_id AS id", "status",
        _concept("'http://loinc.org'", "code_code", "code_display") + " AS code",
        _ref("'Patient/' || patient_id") + " AS subject", _ref("'Encounter/' || encounter_id") + " AS encounter",
        _instant("issued_datetime") + " AS issued", _instant("issued_datetime") + " AS effectiveDateTime", "conclusion",
        "array(" + _ref("'Observation/' || report_id") + ", " + _ref("'Observation/missing-' || report_id") + ") AS result",
        "CASE WHEN pk % 4 = 0 THEN array(named_struct('contentType', 'text/plain', 'data', "
        "base64(encode('Report ' || report_id, 'UTF-8')))) END AS presentedForm",
        "named_struct('lastUpdated', " + _instant("issued_datetime") + ") AS meta",
    ],
}

RECORDS |= {
    "AllergyIntolerance": [
        "'AllergyIntolerance' AS resourceType", "allergy_id AS id", _concept("'urn:clinical'", "clinical_status", "clinical_status") + " AS clinicalStatus",
        _concept("'http://snomed.info/sct'", "code_code", "substance") + " AS code", "CASE WHEN pk % 7 <> 0 THEN " + _ref("'Patient/' || patient_id") + " END AS patient",
        _ref("'Encounter/' || encounter_id") + " AS encounter", _ref("'Practitioner/' || CAST(sk AS STRING)") + " AS recorder", _instant("recorded_date") + " AS recordedDate",
        "array(named_struct('substance', " + _concept("'urn:substance'", "code_code", "substance") + ", 'manifestation', CASE WHEN manifestation IS NOT NULL THEN array("
        + _concept("'urn:manifestation'", "manifestation", "manifestation") + ") END, 'severity', severity)) AS reaction",
    ],
    "Procedure": [
        "'Procedure' AS resourceType", "procedure_id AS id", "status", _concept("'http://snomed.info/sct'", "code_code", "code_display") + " AS code",
        _ref("'Patient/' || patient_id") + " AS subject", _ref("'Encounter/' || encounter_id") + " AS encounter",
        "CASE WHEN sk % 5 = 0 THEN date_format(performed, 'yyyy-MM-dd') ELSE " + _instant("performed") + " END AS performedDateTime",
        "array(named_struct('actor', " + _ref("'Practitioner/' || CAST(sk AS STRING)") + ")) AS performer",
    ],
    "Immunization": [
        "'Immunization' AS resourceType", "immunization_id AS id", "status", _concept("'http://hl7.org/fhir/sid/cvx'", "code_code", "code_display") + " AS vaccineCode",
        _ref("'Patient/' || patient_id") + " AS patient", _ref("'Encounter/' || encounter_id") + " AS encounter", _instant("occurred") + " AS occurrenceDateTime",
        "named_struct('value', CAST(dose AS DOUBLE), 'unit', 'mL') AS doseQuantity",
    ],
    "DocumentReference": [
        "'DocumentReference' AS resourceType", "document_id AS id", "'current' AS status", _concept("'http://loinc.org'", "type_display", "type_display") + " AS type",
        _ref("'Patient/' || patient_id") + " AS subject", _instant("note_date") + " AS date",
        "CASE WHEN k % 6 <> 0 THEN array(named_struct('attachment', named_struct('contentType', 'text/plain', 'data', base64(encode(text, 'UTF-8'))))) END AS content",
    ],
    "CarePlan": [
        "'CarePlan' AS resourceType", "care_plan_id AS id", "status", "intent", "title", _ref("'Patient/' || patient_id") + " AS subject",
        _ref("'Encounter/' || encounter_id") + " AS encounter", "named_struct('start', " + _instant("created") + ") AS period", _instant("created") + " AS created",
    ],
    "RelatedPerson": [
        "'RelatedPerson' AS resourceType", "related_person_id AS id", "true AS active", _ref("'Patient/' || patient_id") + " AS patient", "gender",
        "CASE WHEN k % 10 = 0 THEN date_format(birth_date, 'MM/dd/yyyy') ELSE date_format(birth_date, 'yyyy-MM-dd') END AS birthDate",
        "array(" + _concept("'urn:relationship'", "relationship", "relationship") + ") AS relationship", "array(named_struct('use', 'official', 'text', name_text)) AS name",
    ],
    "Practitioner": [
        "'Practitioner' AS resourceType", "practitioner_id AS id", "true AS active", "array(named_struct('use', 'official', 'text', name_text)) AS name",
        "array(named_struct('code', " + _concept("'urn:qualification'", "'MD'", "'Doctor'") + ", 'issuer', " + _ref("'Organization/' || CAST(nk AS STRING)") + ")) AS qualification",
    ],
    "Organization": ["'Organization' AS resourceType", "organization_id AS id", "true AS active", "name_text AS name", "array(named_struct('country', address_country)) AS address"],
}

#: The six types that most operators are checked on.
CORE = ("Patient", "Encounter", "Observation", "Condition", "MedicationRequest", "DiagnosticReport")
FLAT_OF = {"AllergyIntolerance": "allergy_intolerance", "Procedure": "procedure", "Immunization": "immunization", "DocumentReference": "document_reference", "CarePlan": "care_plan",
           "RelatedPerson": "related_person", "Practitioner": "practitioner", "Organization": "organization", "Patient": "patient", "Encounter": "encounter", "Observation": "observation", "Condition": "condition",
           "MedicationRequest": "medication_request", "DiagnosticReport": "diagnostic_report"}


def _base(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return flat(spark, sf_dir, FLAT_OF[kind], with_patient=True, spread=True)


def raw(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Raw (bronze) frame of one record type: a single ``json_data`` column."""
    return stored_text(_base(spark, sf_dir, kind).selectExpr(*RECORDS[kind]), F.to_json(F.struct("*")))


def stored_text(df: DataFrame, text: Column) -> DataFrame:
    """Raw frame whose text is built once per row, as if read from storage.

    The generator keeps the optimiser from repeating the expression at every use of the column.
    """
    return df.select(F.explode(F.array(text)).alias("json_data"))


def records(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Nested frame of one record type in its declared schema; fields the star has no value for are null."""
    return as_records(_base(spark, sf_dir, kind), kind)


def as_records(rows: DataFrame, kind: str, *keep: str) -> DataFrame:
    """Records of flat rows of their type; columns to keep come first."""
    made = rows.selectExpr(*keep, *RECORDS[kind])
    own = {f.name: f.dataType for f in made.schema.fields}
    # not ``to``: it rebuilds every list by a lambda, also one that has its type already
    return made.select(*keep, *[(walk.conform(F.col(f"`{f.name}`"), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
                                for f in T.StructType.fromDDL(types.SCHEMAS[kind]).fields])


def unmade(spark: SparkSession, sf_dir: str, kind: str) -> tuple[DataFrame, Column, Callable[..., DataFrame]]:
    """What the records of a type that belongs to an order or its lines are made of: stored rows, the subject of a row, and the function
    that makes records of rows and keeps columns named after them."""
    rows, make = _stored(spark, sf_dir, FLAT_OF[kind], with_patient=True, spread=True)
    subject = next(text for text in RECORDS[kind] if text.endswith(" AS subject")).removesuffix(" AS subject")
    return rows, F.expr(subject.replace("patient_id", OWNER)), lambda some, *keep: as_records(make(some, *keep), kind, *keep)


def oracle_prelude(*names: str) -> str:
    """``WITH`` clause that defines the named flat frames for a check in another engine.

    ``name+`` adds the patient id to a line-level frame.
    """
    parts = []
    for name in names:
        base = FLAT[name.rstrip("+")].replace("{", "").replace("}", "")
        if name.endswith("+"):
            base = (f"SELECT s.*, CAST(o_custkey AS STRING) AS patient_id FROM ({base}) s "
                    f"JOIN orders ON CAST(o_orderkey AS STRING) = s.encounter_id")
        parts.append(f"{name.rstrip('+')} AS ({base})")
    return "WITH " + ", ".join(parts) + " "


def dirty_records(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Records with deterministic defects, for validation and repair."""
    df = records(spark, sf_dir, kind)
    if kind == "Patient":
        k = F.col("id").cast("bigint")
        empty = k % 11 == 0
        name = F.transform("name", lambda n: n.withField("family", F.when(~empty, n["family"])).withField("text", F.when(~empty, n["text"])).withField(
            "use", F.when(empty, F.lit(None)).when(k % 14 == 0, F.lit("alias")).otherwise(n["use"])))
        telecom = F.transform("telecom", lambda t: t.withField("system", F.when(k % 9 == 0, F.lit("carrier")).otherwise(t["system"])).withField(
            "use", F.when(k % 9 == 1, F.lit("primary")).otherwise(t["use"])))
        slashed = F.date_format(F.col("birthDate").cast("date"), "MM/dd/yyyy")
        absent = F.array(F.named_struct(F.lit("url"), F.lit("http://hl7.org/fhir/StructureDefinition/data-absent-reason"), F.lit("valueCode"), F.lit("unknown")))
        marker = df.schema["_gender"].dataType.fields[0].dataType
        full = F.transform(absent, lambda e: _as(e, marker.elementType))
        return df.withColumns({
            "gender": F.when(k % 13 == 0, F.lit("M")).otherwise(F.col("gender")), "birthDate": F.when(k % 17 == 0, slashed).otherwise(F.col("birthDate")),
            "name": name, "telecom": telecom, "identifier": F.when(k % 8 != 0, F.col("identifier")),
            "_gender": F.when(k % 6 == 0, F.struct(full.alias("extension")))})
    if kind == "Encounter":
        k = F.col("id").cast("bigint")
        spaced = F.replace(F.replace(F.col("period")["start"], F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit(""))
        return df.withColumns({
            "status": F.when(k % 12 == 0, F.lit(None)).when(k % 10 == 0, F.lit("arrived-late")).otherwise(F.col("status")),
            "period": F.col("period").withField("start", F.when(k % 5 == 0, spaced).otherwise(F.col("period")["start"]))})
    if kind == "Observation":
        parts = F.split("id", "-")
        ln, pk = F.get(parts, F.lit(1)).cast("int"), F.get(parts, F.lit(2)).cast("bigint")
        bare = F.replace(F.col("subject")["reference"], F.lit("Patient/"), F.lit(""))
        coding = F.transform(F.col("code")["coding"], lambda c: c.withField("system", F.when(pk % 5 == 0, F.lit("loinc")).otherwise(c["system"])))
        return df.withColumns({
            "status": F.when(ln == 2, F.lit(None)).when(ln == 6, F.lit("done")).otherwise(F.col("status")),
            "code": F.when(~((ln == 7) & (pk % 2 == 0)), F.col("code").withField("coding", coding)),
            "subject": F.col("subject").withField("reference", F.when(ln == 4, bare).when(ln == 3, F.concat(F.lit("Patient"), bare)).otherwise(F.col("subject")["reference"]))})
    return df  # the projection of the other types has its defects in place


def _as(value, kind: T.StructType):
    """Widen a struct to a declared type; absent fields are null."""
    have = {"url", "valueCode"}
    return F.struct(*[(value[f.name] if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in kind.fields])


def messy_records(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Records with wrong code systems, dates and references at several depths, for the correction of whole records."""
    df = records(spark, sf_dir, kind)
    parts = F.split("id", "-")
    k, ln, pk, sk = F.try_to_number("id", F.lit("999999999999")).cast("bigint"), *(F.get(parts, F.lit(i)).cast("bigint") for i in (1, 2, 3))

    def coded(value: Column, test: Column, system: str) -> Column:
        return F.when(test, F.transform(value, lambda c: c.withField("system", F.lit(system)))).otherwise(value)

    def unslashed(value: Column, test: Column) -> Column:
        return value.withField("reference", F.when(test, F.replace(value["reference"], F.lit("/"), F.lit(""))).otherwise(value["reference"]))

    if kind == "Patient":
        race = lambda e: e.withField("extension", F.transform(e["extension"], lambda x: x.withField("valueCoding", F.when(
            x["valueCoding"].isNotNull(), x["valueCoding"].withField("system", F.lit("loinc"))))))
        return df.withColumns({"birthDate": F.when(k % 17 == 0, F.date_format(F.col("birthDate").cast("date"), "MM/dd/yyyy")).otherwise(F.col("birthDate")),
                               "generalPractitioner": F.transform("generalPractitioner", lambda r: unslashed(r, k % 6 == 0)), "extension": F.transform("extension", race)})
    if kind == "Observation":
        component = F.transform("component", lambda c, i: c.withField("code", c["code"].withField("coding", coded(c["code"]["coding"], i == 1, "LOINC"))))
        return df.withColumns({"code": F.col("code").withField("coding", coded(F.col("code")["coding"], pk % 5 == 0, "loinc")), "component": F.when(pk % 4 == 0, component).otherwise(F.col("component")), "subject": unslashed(F.col("subject"), ln == 4),
                               "issued": F.when(ln == 3, F.date_format(F.to_date(F.substring("issued", 1, 10)), "yyyyMMdd")).when(ln == 6, "soon").otherwise(F.col("issued"))})
    if kind == "Encounter":
        who = F.transform("participant", lambda p: p.withField("individual", unslashed(p["individual"], F.lit(True))))
        why = F.transform("diagnosis", lambda d: d.withField("condition", unslashed(d["condition"], F.lit(True))))
        what = F.transform("type", lambda t: t.withField("coding", coded(t["coding"], F.lit(True), "snomed")))
        return df.withColumns({name: F.when(test, wrong).otherwise(F.col(name)) for name, test, wrong in (("type", k % 6 == 0, what), ("participant", k % 4 == 0, who), ("diagnosis", k % 5 == 0, why))})
    if kind == "Condition":
        return df.withColumn("recorder", unslashed(F.col("recorder"), sk % 4 == 0))
    if kind == "MedicationRequest":
        dosage = F.transform("dosageInstruction", lambda d: d.withField("route", d["route"].withField("coding", coded(d["route"]["coding"], F.lit(True), "RxNorm"))))
        return df.withColumns({"dosageInstruction": F.when(ln == 2, dosage).otherwise(F.col("dosageInstruction")), "requester": unslashed(F.col("requester"), sk % 3 == 0)})
    return df.withColumn("encounter", unslashed(F.col("encounter"), pk % 3 == 0))
