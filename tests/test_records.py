"""Records, joins, gold jobs and repair on literal cases."""

from pyspark.sql import functions as F

from medtable.operators import aggregates as A
from medtable.operators import joins as J
from medtable.operators import projections as P
from medtable.operators import repair as E
from medtable.plans import gold
from medtable.plans import narrative as N
from tests.test_rules import frame

LOINC = "http://loinc.org"


def obs(ident, patient, code, value=None):
    q = f',"valueQuantity":{{"value":{value}}}' if value is not None else ""
    return f'{{"resourceType":"Observation","id":"{ident}","code":{{"coding":[{{"system":"{LOINC}","code":"{code}"}}]}},"subject":{{"reference":"Patient/{patient}"}}{q}}}'


def test_filter_then_first(spark):
    """The first official name wins, not the first name if it happens to be official."""
    doc = '{"id":"1","name":[{"use":"nickname","family":"N"},{"use":"official","family":"O","given":["G"]}],"address":[{"use":"work","city":"W"},{"use":"home","city":"H"}]}'
    row = P.patient_gold(frame(spark, "Patient", [doc])).collect()[0]
    assert (row["last_name"], row["first_name"], row["city"]) == ("O", "G", "H") and len(row) == 27


def test_gold_column_counts(spark):
    assert len(P.encounter_gold(frame(spark, "Encounter", ["{}"])).columns) == 35
    assert len(P.observation_gold(frame(spark, "Observation", ["{}"])).columns) == 29


def test_related_observations(spark):
    docs = ['{"id":"1","related":[{"type":"has-member","target":{"reference":"Observation/a"}},{"type":"derived-from","target":{"reference":"https://host/Observation/b"}},{"type":"x"}]}', '{"id":"2"}']
    got = {r["observation_id"]: [tuple(x) for x in r["related_observations"]] for r in P.observation_gold(frame(spark, "Observation", docs)).collect()}
    assert got == {"1": [("a", "has-member"), ("b", "derived-from"), (None, "x")], "2": []}


def test_cohort(spark):
    people = spark.createDataFrame([("patient-1",), ("patient-2",)], "patient_id STRING")
    conditions = frame(spark, "Condition", ['{"id":"c","code":{"coding":[{"system":"http://snomed.info/sct","code":"38341003"}]},"subject":{"reference":"Patient/patient-1"}}'])
    observations = frame(spark, "Observation", [obs("a", "patient-1", "8480-6", 140), obs("b", "patient-2", "8480-6", 100), obs("c", "patient-2", "8480-6")])

    def ids(df):
        return sorted(r["patient_id"] for r in df.collect())
    sick = J.with_condition(people, conditions, "http://snomed.info/sct", "38341003")
    high = J.with_observation(people, observations, LOINC, "8480-6", lambda v: v > 110)
    assert ids(sick) == ["patient-1"] and ids(high) == ["patient-1"] and ids(J.having(sick, high)) == ["patient-1"]
    loose = J.with_observation(people, observations, LOINC, "8480-6", lambda v: v > 110, null_passes=True)
    assert ids(loose) == ["patient-1", "patient-2"]  # D9


def test_reference_cycle_ends(spark):
    edges = spark.createDataFrame([("A", "1", "B", "1"), ("B", "1", "A", "1"), ("B", "1", "C", "1")], "src_type STRING, src_id STRING, dst_type STRING, dst_id STRING")
    roots = spark.createDataFrame([("A", "1")], "src_type STRING, src_id STRING")
    got = {(r["type"], r["depth"]) for r in J.resolve(roots, edges, 3).collect()}
    assert got == {("B", 1), ("C", 2)}
    assert {r["type"] for r in J.resolve(roots, edges, 3, include=["B"]).collect()} == {"B"}


def test_wide_dataset_is_always_a_list(spark):
    """Joined on the patient; one match is a list of one, none is an empty list."""
    index = spark.createDataFrame([("1",), ("2",)], "patient_id STRING")
    facts = spark.createDataFrame([("1", "x", "2020-01-01", 5.0)], "patient_id STRING, id STRING, d STRING, v DOUBLE").withColumn("at", F.col("d").cast("timestamp"))
    got = {r["patient_id"]: (r["v"], r["v_first"]) for r in J.wide_dataset(index, "patient_id", {"v": (facts, F.col("v"))}, "at", "id").collect()}
    assert got == {"1": (["5.0"], "5.0"), "2": ([], None)}


def test_subject_issues_without_patients(spark):
    got = J.subject_issues(frame(spark, "Patient", []).limit(0), frame(spark, "Encounter", ['{"id":"1"}']), "Encounter").collect()
    assert {r["message"] for r in got} == {"No patient resource found", "Missing subject reference to patient"}


def test_services_are_sorted(spark):
    """D10."""
    df = spark.createDataFrame([("T", "1", "finished", s) for s in ("b", "a", "b")], "type_code STRING, encounter_id STRING, status STRING, service_provider STRING")
    df = df.withColumns({"start_datetime": F.lit(None).cast("timestamp"), "end_datetime": F.lit(None).cast("timestamp")})
    assert A.encounter_type_summary(df).collect()[0]["service_types"] == "a, b"


def test_timeline_fills_missing_times(spark):
    """Null times become the run time; missing text becomes the display."""
    enc = spark.createDataFrame([("p", "e1", "Visit", "finished"), ("p", "e2", "Visit", "finished")], "patient_id STRING, encounter_id STRING, type_display STRING, status STRING")
    enc = enc.withColumn("start_datetime", F.when(F.col("encounter_id") == "e2", F.lit("2020-01-01").cast("timestamp")))
    rows = {r["event_id"]: r for r in gold.patient_timeline(gold.timeline_events(encounter=enc), "2024-06-01").collect()}
    assert str(rows["e1"]["event_time"])[:10] == "2024-06-01" and rows["e1"]["event_sequence"] == 2 and rows["e2"]["clinical_text"] == "Visit"


def test_kpi_without_optional_inputs(spark):
    enc = spark.createDataFrame([("e", "p", "in-progress", "EMER")], "encounter_id STRING, patient_id STRING, status STRING, class_code STRING")
    enc = enc.withColumns({"start_datetime": F.lit("2020-01-01").cast("timestamp"), "end_datetime": F.lit(None).cast("timestamp"), "class_display": F.lit(None), "type_code": F.lit(None), "type_display": F.lit(None)})
    row = gold.encounter_kpi(enc).collect()[0]
    assert row["diagnosis_count"] is None and row["is_active"] is True and row["previous_encounter_count"] == 0


def test_title_case(one):
    assert one(a=gold.title_case(F.lit("entered-in-error"))) == {"a": "Entered-In-Error"}


def test_deep_flatten(spark):
    doc = '{"id":"1","name":[{"family":"A","given":["x","y"]},{"family":"B"}]}'
    got = {(r["path"], r["value"]) for r in P.flatten_long(frame(spark, "Patient", [doc]), "id", ["name"]).collect()}
    assert got == {("name[0].family", "A"), ("name[0].given[0]", "x"), ("name[0].given[1]", "y"), ("name[1].family", "B")}
    row = P.flatten_first(frame(spark, "Patient", [doc])).collect()[0]
    assert row["name.family"] == "A" and row["name.given"] == "x,y"


def test_silver_repair(spark):
    doc = '{"resourceType":"Patient","id":"7","gender":"male","birthDate":"1/2/1990","_gender":{"extension":[{"url":"http://hl7.org/fhir/StructureDefinition/data-absent-reason"}]},"name":[{"given":["Ann","B"]}],"telecom":[{"system":"carrier","use":"primary"}]}'
    row = E.to_silver(frame(spark, "Patient", [doc]), "Patient").collect()[0]
    assert row["name"][0]["text"] == "Ann B" and row["name"][0]["use"] == "usual" and row["identifier"][0]["value"] == "TEMP-7"
    assert row["telecom"][0]["system"] == "other" and row["telecom"][0]["use"] == "temp" and row["_gender"]["extension"] == []
    assert row["birthDate"] == "1/2/1990" and row["_birthDate"]["extension"][0]["valueString"].startswith("Invalid date format")
    assert [m["path"] for m in row["modifications"]] == ["name[0].use", "name[0].text", "identifier", "_birthDate.extension", "telecom[0].system", "telecom[0].use"]
    assert [t["code"] for t in row["meta"]["tag"]] == ["SILVER"]


def test_tier_tag_is_replaced(spark):
    doc = '{"resourceType":"Condition","id":"1","meta":{"tag":[{"system":"http://terminology.hl7.org/CodeSystem/v3-ObservationValue","code":"BRONZE"},{"system":"s","code":"keep"}]}}'
    row = E.to_gold(frame(spark, "Condition", [doc]), "Condition").collect()[0]
    assert [t["code"] for t in row["meta"]["tag"]] == ["keep", "GOLD"] and "Condition resource with ID: 1" in row["text"]["div"]


def test_profile_is_claimed_only_when_eligible(spark):
    docs = ['{"resourceType":"Patient","id":"1","identifier":[{"value":"x"}],"name":[{"family":"F"}]}', '{"resourceType":"Patient","id":"2","name":[{"given":["F"]}]}']
    got = {r["id"]: r["meta"]["profile"] for r in E.to_gold(frame(spark, "Patient", docs), "Patient").collect()}
    assert len(got["1"]) == 1 and not got["2"]


def test_fill_required_uses_short_form(spark):
    """Defaults, tag and text only."""
    row = E.fill_required(frame(spark, "Condition", ['{"resourceType":"Condition","id":"1"}']), "Condition", "gold", "9").collect()[0]
    assert row["clinicalStatus"]["coding"][0]["code"] == "active" and row["subject"]["reference"] == "Patient/9" and row["text"]["status"] == "generated"


def test_narrative_text(spark):
    patient = spark.createDataFrame([("1", "Ann", "female", "1990-01-01")], "patient_id STRING, name_text STRING, gender STRING, b STRING").withColumn("birth_date", F.col("b").cast("date"))
    t = F.lit("2020-03-04").cast("timestamp")
    cond = spark.createDataFrame([("1", "c1", "Flu", "active"), ("2", "c2", "Other", "active")], "patient_id STRING, condition_id STRING, code_display STRING, clinical_status STRING").withColumns(
        {"recorded_date": t, "onset_datetime": F.lit(None).cast("timestamp")})
    med = spark.createDataFrame([], "patient_id STRING, medication_request_id STRING, medication_display STRING, status STRING, dosage_text STRING, authored_datetime TIMESTAMP")
    rep = spark.createDataFrame([], "patient_id STRING, report_id STRING, code_code STRING, code_display STRING, issued_datetime TIMESTAMP, status STRING, conclusion STRING, results ARRAY<STRING>, report_text STRING")
    ob = spark.createDataFrame([("1", "o1", "Pulse", 70.0, "bpm", "vital-signs", None, None)],
                               "patient_id STRING, observation_id STRING, code_display STRING, value DOUBLE, unit STRING, category STRING, ref_low DOUBLE, ref_high DOUBLE").withColumn("issued_datetime", t)
    note = spark.createDataFrame([("1", 5, "Progress note", "All well")], "patient_id STRING, doc_id INT, type_display STRING, text STRING").withColumn("note_date", F.lit("2020-05-06").cast("date"))
    allergy = spark.createDataFrame([("1", "a1", "Nuts", "severe", "Rash")], "patient_id STRING, allergy_id STRING, substance STRING, severity STRING, manifestation STRING")
    docs = N.narrative(N.narrative_items(patient, cond, med, rep, ob, note, "2020-12-31", allergy)).collect()
    assert len(docs) == 1
    assert docs[0]["narrative"] == ("# PATIENT SUMMARY\n\nName: Ann\nGender: female\nBirth Date: 1990-01-01\nAge: 31 years\n\n## PROBLEMS\n\n- Flu (Status: active, Onset: 2020-03-04)\n\n"
                                    "## ALLERGIES\n\n- Nuts (Severity: severe, Manifestation: Rash)\n\n## VITAL SIGNS\n\n### 2020-03-04\n- Pulse: 70.0 bpm\n\n"
                                    "## CLINICAL NOTES\n\n### Progress note (2020-05-06)\n\nAll well\n")
    small = N.narrative(N.narrative_items(patient, cond, med, rep, ob, note, "2020-12-31", allergy), chunk_rows=3)
    parts = [r["narrative"] for r in small.orderBy("chunk").collect()]
    assert len(parts) > 1 and "\n".join(parts) == docs[0]["narrative"]


def test_silver_rows_of_a_mixed_frame(spark):
    """Every row is in one frame, broken texts too, and only records of its own type are parsed."""
    from medtable.operators import projections as P
    raw = spark.createDataFrame([('{"resourceType":"Patient","id":"1"}',), ('{"resourceType":"Procedure","id":"2"}',), ('{"resou',), (None,)], "json_data STRING")
    got = {(r["frame"], r["resource_type"], r["Patient"]["id"] if r["Patient"] else None) for r in P.silver_rows(raw).collect()}
    assert got == {("Patient", "Patient", "1"), ("other", "Procedure", None), ("other", None, None)}
    frames = P.silver_by_type(raw)
    assert frames["other"].columns == ["json_data", "resource_type"] and frames["other"].count() == 3
    assert [r["id"] for r in frames["Patient"].collect()] == ["1"]


def test_silver_parses_only_the_fields_it_reads(spark):
    """F8: the text of a record is parsed for the fields of its projection; odd and broken texts give the same rows as a whole parse."""
    texts = ['{"resourceType":"Observation","id":"1","status":"final","code":{"coding":[{"system":"s","code":"c","display":"d"}]},"valueQuantity":{"value":1.5,"unit":"u"},"subject":{"reference":"Patient/1"},"component":[{"code":{}}]}',
             '{"id":"2","valueString":"x","valueCodeableConcept":{"coding":[{"code":"y"}]},"referenceRange":[{"low":{"value":1}}],"resourceType":"Observation"}',
             '{"resourceType":"Observation","id":"3","valueCodeableConcept":{"coding":[{"code":"POS","display":"Positive"}]},"meta":{"lastUpdated":"2001-01-01"}}',
             '{"resourceType":"Observation","id":"4","status":"fin', '{"resourceType":"Observation","id":5,"code":null,"valueQuantity":{"value":"odd"}}', '{"id":"6"}', "[]", None]
    raw = spark.createDataFrame([(t,) for t in texts], "json_data STRING")
    frames = P.silver_by_type(raw)
    assert "referenceRange" not in frames["Observation"]._jdf.queryExecution().analyzed().toString()
    whole = P.silver_rows(raw)
    for name, fn in P.SILVER.items():
        want = fn(whole.where(F.col("frame") == name).select(f"{name}.*")).collect()
        assert sorted(frames[name].collect(), key=str) == sorted(want, key=str)
    assert [r["id"] for r in frames["Observation"].orderBy("id").collect()] == ["1", "2", "3", "5"]
    assert frames["other"].count() == 4
