import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medtable.functions import types
from medtable.operators import aggregates as A
from medtable.operators import alerts as L
from medtable.operators import rules as R
from medtable.operators import timeseries as M


def frame(spark, kind, rows):
    """Records from JSON documents."""
    raw = spark.createDataFrame([(r,) for r in rows], "json_data STRING")
    return raw.select(F.from_json("json_data", types.SCHEMAS[kind]).alias("r")).select("r.*")


PATIENTS = ['{"resourceType":"Patient","id":"1","gender":"male","birthDate":"1990-01-01","name":[{"family":"A","given":["B"]}]}',
            '{"resourceType":"Patient","gender":"invalid","birthDate":"01/02/1990"}']


def test_row_rules(spark):
    rows = R.issue_rows(frame(spark, "Patient", PATIENTS), "Patient", R.declared_rules("Patient")).collect()
    assert {(r["field"], r["rule"], r["level"]) for r in rows} == {("id", "required", "fatal"), ("name[0].family", "required", "fatal"), ("gender", "regex", "fatal"), ("birthDate", "regex", "fatal")}


def test_invalid_rows_are_counted_once(spark):
    """Distinct invalid rows, beside the capped sum of failures."""
    row = R.basic_validation(frame(spark, "Patient", PATIENTS), "Patient").collect()[0]
    assert (row["total"], row["invalid"], row["valid"], row["capped_failures"]) == (2, 1, 1, 2)


def test_implication_is_boolean(spark):
    """A condition that yields false is a failure."""
    rows = R.issue_rows(frame(spark, "Patient", PATIENTS), "Patient", R.implied_rules("Patient")).collect()
    assert [r["field"] for r in rows] == ["Gender is valid"]


def test_sample_extrapolates(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("patient_id"), F.lit("odd").alias("gender"), F.lit("1990-01-01").alias("birth_date"))
    row = R.sampled_validation(df, "Patient", R.model_rules("Patient"), "patient_id", 30).collect()[0]
    assert 200 < row["sampled"] < 400 and row["error_rate"] == 1.0 and row["estimated_invalid"] == 1000 and row["level"] == "error"


def test_field_schemas_cover_twelve_types():
    assert len(R.FIELDS) == 12 and len(R.SUITES) == 10 and all(set(s) == {"bronze", "silver", "gold"} for s in R.SUITES.values())


def test_date_range(spark):
    rows = R.issue_rows(frame(spark, "Patient", ['{"resourceType":"Patient","id":"1","birthDate":"1850-01-01"}']), "Patient", R.field_rules("Patient")).collect()
    assert [r["rule"] for r in rows] == ["range"]


def test_concept_errors(spark):
    docs = ['{"id":"1","code":{"coding":[{"system":"http://loinc.org","code":"1"}]}}', '{"id":"2","code":{"coding":[{"code":"1"}]}}', '{"id":"3","code":{"coding":[]}}', '{"id":"4","code":{"coding":[],"text":"x"}}',
            '{"id":"5"}', '{"id":"6","code":{"coding":[{"system":"s"}]}}']
    got = {r["id"]: r["e"] for r in frame(spark, "Observation", docs).select("id", R.concept_error(F.col("code")).alias("e")).collect()}
    assert got == {"1": None, "2": "Coding missing system", "3": "Empty coding array requires text to be present", "4": None, "5": "Expected object", "6": "Coding missing code"}


def test_value_errors(spark):
    docs = ['{"id":"1","valueQuantity":{"value":1,"unit":"kg"}}', '{"id":"2","valueQuantity":{"unit":"kg"}}', '{"id":"3","valueQuantity":{"value":1}}', '{"id":"4"}', '{"id":"5","valueDateTime":"soon"}']
    got = {r["id"]: r["e"] for r in frame(spark, "Observation", docs).select("id", R.value_error().alias("e")).collect()}
    assert got == {"1": None, "2": "valueQuantity missing value", "3": "valueQuantity missing unit or code", "4": "No value[x] field found", "5": "valueDateTime has invalid format"}


def test_multiple_values(spark):
    doc = '{"id":"1","status":"final","code":{"coding":[]},"subject":{"reference":"Patient/1"},"valueString":"a","valueInteger":1}'
    assert [r["message"] for r in R.issue_rows(frame(spark, "Observation", [doc]), "Observation", R.consistency_rules("Observation")).collect()] == ["multiple value fields"]


def test_empty_table_passes_value_expectations(spark):
    df = frame(spark, "Patient", []).limit(0)
    got = R.run_suite(df, [R.expect("not_null", column="id"), R.expect("unique", column="id"), R.expect("in_set", column="gender", value_set=["x"])]).collect()
    assert all(r["success"] for r in got)


def test_suite_rollup_threshold(spark):
    res = spark.createDataFrame([(True,), (True,), (False,), (True,)], "success BOOLEAN")
    assert not R.suite_rollup(res).collect()[0]["success"] and R.suite_rollup(res, 0.25).collect()[0]["success"]


def test_schema_issues_none(spark):
    df = spark.createDataFrame([("a",)], "x STRING")
    assert R.schema_issues(df, T.StructType([T.StructField("x", T.StringType(), False)])).count() == 0


def test_trend_rules(spark):
    def series(name, values):
        return [(name, f"2024-01-{i + 1:02d}", float(v)) for i, v in enumerate(values)]
    rows = series("two", [1, 2]) + series("flat", [3, 3, 3, 3]) + series("up", [0, 1, 2, 3]) + series("down", [3, 2, 1, 0]) + series("slow", [1, 1.005, 1.01, 1.015]) + series("noise", [0, 5, 0, 5, 0, 5.5])
    df = spark.createDataFrame(rows, "k STRING, d STRING, value DOUBLE").withColumn("ts", F.col("d").cast("timestamp"))
    got = {r["k"]: r for r in M.trends(df, ["k"]).collect()}
    assert "two" not in got
    assert got["flat"]["r_squared"] == 0.0 and got["flat"]["direction"] == "stable"
    assert got["up"]["direction"] == "improving" and got["up"]["percent_change"] == 0.0 and round(got["up"]["slope"], 9) == 1.0
    assert got["down"]["direction"] == "declining" and got["slow"]["direction"] == "stable" and got["noise"]["direction"] == "stable"


def test_dimension_statistics_are_true(spark):
    """Median and deviation of a dimension come from all its rows."""
    df = spark.createDataFrame([("A", "x", 1.0), ("A", "x", 2.0), ("B", "x", 9.0), ("B", "y", 5.0)], "resource_type STRING, dimension STRING, value DOUBLE")
    got = {(r["scope"], r["resource_type"], r["dimension"]): r for r in M.metric_stats(df).collect()}
    x = got[("dimension", "*", "x")]
    assert x["median"] == 2.0 and round(x["std"], 6) == 4.358899 and x["count"] == 3
    assert got[("dimension", "*", "y")]["std"] == 0.0 and got[("overall", "*", "*")]["median"] == 3.5


def test_buckets_are_labelled_by_their_start(spark):
    """Monday weeks, first of the month."""
    df = spark.createDataFrame([("2024-05-15 10:20:00", 1.0), ("2024-05-19 23:00:00", 3.0)], "t STRING, value DOUBLE").withColumn("ts", F.col("t").cast("timestamp"))
    for interval, want in (("1w", "2024-05-13"), ("1m", "2024-05-01")):
        row = M.resample(df, [], interval).collect()
        assert [(str(r["ts"])[:10], r["value"]) for r in row] == [(want, 2.0)]


def test_cooldown_against_a_loop(spark):
    d = L.Definition("d", "m", "lt", 5.0, lookback_hours=1, min_samples=1, cooldown_minutes=150)
    values = [1, 9, 1, 1, 9, 1, 1, 1, 9, 1]
    df = spark.createDataFrame([(f"2024-01-01 {i:02d}:30:00", "m", float(v)) for i, v in enumerate(values)], "t STRING, metric STRING, value DOUBLE").withColumn("ts", F.col("t").cast("timestamp"))
    df = df.withColumns({"resource_type": F.lit("x"), "pipeline_stage": F.lit("y")})
    want, last = [], None
    for i, v in enumerate(values):
        if v < 5 and (last is None or (i - last) * 60 >= 150):
            want.append(i + 1)
            last = i
    assert sorted(r["triggered_at"].hour for r in L.alert_history(df, [d]).collect()) == want


def test_routing_falls_back(spark):
    df = spark.createDataFrame([("completeness", "high"), ("completeness", "low"), ("timeliness", "critical"), ("other", "low")], "category STRING, severity STRING")
    routes = [("completeness", "high", "a", 1), ("completeness", "*", "b", 2), ("*", "critical", "c", 3)]
    assert [(r["action"], r["priority"]) for r in L.route_alerts(df, routes).collect()] == [("a", 1), ("b", 2), ("c", 3), (None, None)]


def test_measure_without_denominator(spark):
    row = A.measure(spark.range(3), F.lit(True), F.lit(False)).collect()[0]
    assert row["denominator"] == 0 and row["score"] is None


@pytest.mark.parametrize("status,want", [("ERROR", True), ("SUCCESS", False)])
def test_run_alert(spark, status, want):
    df = spark.createDataFrame([("Patient", status, 10, 10, '{"loss_pct":"0.5"}')], "resource_type STRING, transform_status STRING, input_record_count INT, output_record_count INT, details STRING")
    assert A.run_summary(df).collect()[0]["should_alert"] is want


def test_run_alert_on_loss(spark):
    df = spark.createDataFrame([("Patient", "SUCCESS", 10, 9, '{"loss_pct":"10.0"}')], "resource_type STRING, transform_status STRING, input_record_count INT, output_record_count INT, details STRING")
    row = A.run_summary(df).collect()[0]
    assert row["should_alert"] is True and row["loss_pct"] == 10.0
