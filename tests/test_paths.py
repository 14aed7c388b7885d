from pyspark.sql import functions as F

from medtable.functions import paths as P
from medtable.operators import specs

SCHEMA = """id STRING, subject STRUCT<reference:STRING>, name ARRAY<STRUCT<use:STRING,family:STRING,given:ARRAY<STRING>>>,
valueQuantity STRUCT<value:DOUBLE,unit:STRING>, valueString STRING, text STRUCT<div:STRING>, extension ARRAY<STRUCT<url:STRING,valueString:STRING>>"""
ROW = ("obs1", ("Patient/pat123",), [("usual", "Nick", ["N"]), ("official", "Smith", ["John", "Q"])], (75.0, "beats/min"), None,
       ("<div><p>Heart <b>rate</b></p></div>",), [("http://a.b/c", "x")])


def get(spark, **cols):
    df = spark.createDataFrame([ROW], SCHEMA)
    return df.select(*[c.alias(n) for n, c in cols.items()]).collect()[0].asDict()


def test_steps(spark):
    out = get(spark, nested=P.path("valueQuantity.value"), index=P.path("name[1].given[0]"), past=P.path("name[7].family"), negative=P.path("name[0].given[5]"),
              wild=P.path("name[*].family"), cond=P.path("name[?use='official'].family"), none=P.path("name[?use='old'].family"), url=P.path("extension[?url='http://a.b/c'].valueString"))
    assert out == {"nested": 75.0, "index": "John", "past": None, "negative": None, "wild": ["Nick", "Smith"], "cond": "Smith", "none": None, "url": "x"}


def test_wildcard_empty_is_null(spark):
    df = spark.createDataFrame([("a", [])], "id STRING, name ARRAY<STRUCT<family:STRING>>")
    assert df.select(P.path("name[*].family").alias("x")).collect()[0]["x"] is None


def test_navigation(spark):
    out = get(spark, flat=P.nav("name").all().flat("given").values(), exists=P.nav("name").where("use", "official").exists(), absent=P.nav("name").where("use", "x").exists(),
              default=P.nav("name").where("use", "x").f("family").first("nobody"))
    assert out == {"flat": ["N", "John", "Q"], "exists": True, "absent": False, "default": "nobody"}


def test_rules(spark):
    df = spark.createDataFrame([ROW], SCHEMA)
    spec = {"patient_id": "subject.reference.replace('Patient/','')", "value": "valueString | valueQuantity.value", "note": "text.div", "kind": '"vital"',
            "label": "{{name[1].family}} {{valueQuantity.unit}}", "ref_id": "subject.reference.substring(8)", "has": "valueString.exists()", "missing": "valueString"}
    row = specs.apply_spec(df, spec, keep=["id"]).collect()[0].asDict()
    assert row == {"id": "obs1", "patient_id": "pat123", "value": "75.0", "note": "Heart rate", "kind": "vital", "label": "Smith beats/min", "ref_id": "pat123", "has": False, "missing": None}


def test_rules_keep_source_types(spark):
    """A list stays a list, a number a number."""
    df = specs.apply_spec(spark.createDataFrame([ROW], SCHEMA), {"given": "name[1].given", "value": "valueQuantity.value"})
    assert [t for _, t in df.dtypes] == ["array<string>", "double"]


def test_getters(one):
    out = one(t=P.as_bool(F.lit(" Yes")), f=P.as_bool(F.lit("no")), n=P.as_bool(F.lit(None).cast("string")), i=P.as_int(F.lit("12x")), d=P.as_float(F.lit("1.5")),
              a=P.as_array(F.lit("x")), s=P.as_timestamp(F.lit("nonsense")))
    assert out == {"t": True, "f": False, "n": None, "i": None, "d": 1.5, "a": ["x"], "s": None}


def test_raw_parse_carries_ingest_columns(spark):
    """D3: no join on a row id, the columns are simply kept."""
    raw = spark.createDataFrame([('{"resourceType":"Observation","id":"1","status":"final"}', "2024-01-01")], "json_data STRING, ingest_date STRING")
    row = specs.parse_raw(raw, "Observation", {"id": "id", "status": "status"}, keep=["ingest_date"]).collect()[0]
    assert tuple(row) == ("2024-01-01", "1", "final")


def test_loss_check(spark):
    import pytest
    df = spark.range(100).withColumnRenamed("id", "x")
    out, seen, kept = specs.transform_template(df, {"x": F.col("x")}, pre=lambda d: d.where("x < 90"))
    assert out.count() == 90
    with pytest.raises(ValueError, match="lost 10.0%"):
        specs.check_loss(seen, kept)
    empty, seen, kept = specs.transform_template(df.where("x < 0"), {"x": F.col("x")})
    empty.count()
    assert specs.check_loss(seen, kept) == 0.0
    with pytest.raises(ValueError, match="no input rows"):
        specs.check_loss(seen, kept, strict_empty=True)
