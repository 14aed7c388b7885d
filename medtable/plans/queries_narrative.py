"""Registered narratives."""

from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.star import AS_OF, flat, oracle_prelude
from . import narrative as N
from .registry import query

_DAY = "strftime({}, '%Y-%m-%d')"
_EPOCH = "-CAST(epoch({}) AS BIGINT)"
_BIG, _UNDATED = 2**62, 2**61
CHUNK = 25


def _section(n, title, rows, foot=True):
    """Items of a section with its header and closing line; ``rows`` gives patient_id, ord, id, text."""
    out = f"""s{n} AS ({rows}), t{n} AS (SELECT patient_id, {n} AS section, ord, text, sha256(text || '#' || id) AS tie FROM s{n}
 UNION ALL SELECT DISTINCT patient_id, {n}, -{_BIG}, '## {title}' || chr(10), sha256('## {title}' || chr(10) || '#head') FROM s{n}"""
    if foot:
        out += f" UNION ALL SELECT DISTINCT patient_id, {n}, {_BIG}, '', sha256('#foot') FROM s{n}"
    return out + ")"


_HEAD = "code_display || ' (' || strftime(issued_datetime, '%Y-%m-%d') || ', Status: ' || status || ')'"
_ECHO = "(pk % 6 IN (0, 1, 2))"


def _by_date(cat, n, ref):
    rng = "|| CASE WHEN pk % 2 = 0 THEN ' (Reference: 10.0-40.0 ' || unit || ')' ELSE '' END" if ref else ""
    src = (f"(SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY patient_id ORDER BY issued_datetime DESC) AS r FROM observation WHERE category = '{cat}') WHERE r <= {n})")
    e = _EPOCH.format("issued_datetime") + " * 4"
    return (f"SELECT patient_id, {e} + 1 AS ord, observation_id AS id, '- ' || code_display || ': ' || CAST(value AS VARCHAR) || ' ' || unit {rng} AS text FROM {src} "
            f"UNION ALL SELECT DISTINCT patient_id, {e}, 'day', '### ' || strftime(issued_datetime, '%Y-%m-%d') FROM {src} "
            f"UNION ALL SELECT DISTINCT patient_id, {e} + 2, 'gap', '' FROM {src}")


def _sql(people):
    return oracle_prelude("patient", "condition+", "medication_request+", "diagnostic_report+", "observation+", "note", "allergy_intolerance+") + f""", people AS ({people}),
 t1 AS (SELECT patient_id, 1 AS section, 0 AS ord, '# PATIENT SUMMARY' || chr(10) || chr(10) || 'Name: ' || name_text || chr(10) || 'Gender: ' || gender || chr(10) || 'Birth Date: '
  || strftime(birth_date, '%Y-%m-%d') || chr(10) || 'Age: ' || CAST(CAST(floor(date_diff('day', birth_date, DATE '{AS_OF}') / 365.0) AS INT) AS VARCHAR) || ' years' || chr(10) AS text, '' AS tie FROM people),
 {_section(2, 'PROBLEMS', f"SELECT patient_id, coalesce({_EPOCH.format('recorded_date')}, {_UNDATED}) AS ord, condition_id AS id, '- ' || code_display || ' (Status: ' || clinical_status || ', Onset: ' || {_DAY.format('onset_datetime')} || ')' AS text FROM condition")},
 {_section(3, 'ALLERGIES', "SELECT patient_id, 0 AS ord, allergy_id AS id, '- ' || substance || ' (Severity: ' || coalesce(severity, 'Unknown') || ', Manifestation: ' || coalesce(manifestation, 'Unknown') || ')' AS text FROM allergy_intolerance")},
 {_section(4, 'MEDICATIONS', f"SELECT patient_id, {_EPOCH.format('authored_datetime')} AS ord, medication_request_id AS id, '- ' || medication_display || ' (' || status || ', take ' || CAST(ln AS VARCHAR) || ', Prescribed: ' || {_DAY.format('authored_datetime')} || ')' AS text FROM medication_request")},
 {_section(5, 'ECHOCARDIOGRAPHY / ULTRASOUND REPORTS', f"SELECT d.patient_id, {_EPOCH.format('d.issued_datetime')} AS ord, report_id AS id, concat_ws(chr(10), '### ' || d.code_display || ' (' || strftime(d.issued_datetime, '%Y-%m-%d') || ', Status: ' || d.status || ')', '', 'Conclusion:' || chr(10) || conclusion || chr(10), 'Results:' || chr(10) || '- ' || o.code_display || ': ' || CAST(o.value AS VARCHAR) || ' ' || o.unit || chr(10), CASE WHEN d.pk % 4 = 0 THEN 'Report Text:' || chr(10) || '```' || chr(10) || 'Report ' || report_id || chr(10) || '```' || chr(10) END) AS text FROM diagnostic_report d JOIN observation o ON o.observation_id = d.report_id WHERE d.pk % 6 IN (0, 1, 2)")},
 {_section(6, 'OTHER DIAGNOSTIC REPORTS', f"SELECT patient_id, {_EPOCH.format('issued_datetime')} AS ord, report_id AS id, concat_ws(chr(10), '- ' || {_HEAD}, '  Conclusion: ' || conclusion) AS text FROM diagnostic_report WHERE NOT {_ECHO}")},
 {_section(7, 'VITAL SIGNS', _by_date('vital-signs', 5, False), False)},
 {_section(8, 'LABORATORY RESULTS', _by_date('laboratory', 10, True), False)},
 {_section(9, 'CLINICAL NOTES', "SELECT patient_id, r AS ord, CAST(doc_id AS VARCHAR) AS id, '### ' || type_display || ' (' || strftime(note_date, '%Y-%m-%d') || ')' || chr(10) || chr(10) || text || chr(10) AS text FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY note_date DESC, doc_id) AS r FROM note WHERE doc_id % 4 <> 3) WHERE r <= 5", False)},
 u AS (SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3 UNION ALL SELECT * FROM t4 UNION ALL SELECT * FROM t5 UNION ALL SELECT * FROM t6 UNION ALL SELECT * FROM t7 UNION ALL SELECT * FROM t8 UNION ALL SELECT * FROM t9)
, v AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY section, ord, tie) - 1 AS n FROM u WHERE patient_id IN (SELECT patient_id FROM people))
SELECT patient_id, CAST(n // {CHUNK} AS INT) AS chunk, string_agg(text, chr(10) ORDER BY n) AS narrative FROM v GROUP BY 1, 2"""


def _narratives(spark, sf, patient, only=None):
    frames = {n: flat(spark, sf, n, True) for n in ("condition", "medication_request", "diagnostic_report", "observation", "allergy_intolerance")}
    note = flat(spark, sf, "note")
    if only is not None:
        frames, note = {n: df.join(only, "patient_id", "left_semi") for n, df in frames.items()}, note.join(only, "patient_id", "left_semi")
    meds = frames["medication_request"].withColumn("dosage_text", F.concat(F.lit("take "), F.col("ln").cast("string")))
    reports = frames["diagnostic_report"].withColumns({"results": F.array("report_id", F.concat(F.lit("missing-"), "report_id")),
                                                       "report_text": F.when(F.col("pk") % 4 == 0, F.concat(F.lit("Report "), "report_id"))})
    even = F.col("pk") % 2 == 0
    obs = frames["observation"].withColumns({"ref_low": F.when(even, 10.0), "ref_high": F.when(even, 40.0)})

    def store(df):
        where = scratch_dir(spark, "items")
        df.write.option("compression", "zstd").parquet(where)
        return spark.read.parquet(where)

    items = N.narrative_items(patient, frames["condition"], meds, reports, obs, note, AS_OF, frames["allergy_intolerance"], store)
    # the items are made once: numbering them reads them several times
    return N.narrative(store(items), CHUNK)


@query("patient_narrative_n01", _sql("SELECT * FROM patient"))
def patient_narrative(spark, sf):
    """N01 with J19, J20, W06, F11-F13, L04."""
    return _narratives(spark, sf, flat(spark, sf, "patient"))


@query("narrative_table_n02", _sql("SELECT * FROM patient ORDER BY patient_id LIMIT 20"))
def narrative_table(spark, sf):
    """The first 20 patients; the limit is the feature, and its 20 ids may be broadcast."""
    few = N.first_patients(flat(spark, sf, "patient"), 20)
    return _narratives(spark, sf, few, F.broadcast(few.select("patient_id")))
