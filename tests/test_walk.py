"""Walkers over record types against plain recursion over the same rows."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medtable.functions import codes, types, walk
from medtable.functions import scalars as S
from medtable.operators import joins as J
from medtable.operators import repair as E
from medtable.operators.specs import union_drifting
from medtable.plans.catalog import QUERIES

NESTED_DDL = """id STRING, `class` STRUCT<system:STRING,code:STRING>, issued STRING, subject STRUCT<reference:STRING,display:STRING>,
    contained ARRAY<STRUCT<id:STRING,recordedDate:STRING,code:STRUCT<coding:ARRAY<STRUCT<system:STRING,code:STRING>>>,actor:STRUCT<reference:STRING,inner:STRUCT<reference:STRING>>>>,
    extension ARRAY<STRUCT<url:STRING,extension:ARRAY<STRUCT<valueReference:STRUCT<reference:STRING>,valueCoding:STRUCT<system:STRING,code:STRING>>>>>,
    performer ARRAY<STRUCT<reference:STRING>>, quantity STRUCT<value:DOUBLE,system:STRING>, names ARRAY<STRING>"""
TEXTS = {"reference": ["Patient/1", "Patient7", "Encounter/9", "", "x-y", "123e4567-e89b-12d3-a456-426614174000"], "system": ["loinc", "http://loinc.org", "snomed", "urn:x"],
         "issued": ["20200105", "2020-01-05", "01/05/2020", "soon"], "recordedDate": ["20200105", "2020-01-05T00:00:00Z", "x"]}


def random_value(rnd, kind, name=""):
    if rnd.random() < 0.15:
        return None
    if isinstance(kind, T.StructType):
        return {f.name: random_value(rnd, f.dataType, f.name) for f in kind.fields}
    if isinstance(kind, T.ArrayType):
        return [random_value(rnd, kind.elementType, name) for _ in range(rnd.randrange(4))]
    return 1.5 if isinstance(kind, T.DoubleType) else rnd.choice(TEXTS.get(name, ["a", "b"]))


@pytest.fixture(scope="module")
def nested(spark):
    return T.StructType.fromDDL(NESTED_DDL)


@pytest.fixture(scope="module")
def rows(spark, nested):
    rnd = random.Random(4)
    data = [random_value(rnd, nested) or {} for _ in range(300)]
    for k, r in enumerate(data):
        r["id"] = str(k)
    return data, spark.createDataFrame([json.dumps(r) for r in data], "string").select(F.from_json("value", nested).alias("r")).select("r.*")


def plain_references(value, path=""):
    out = []
    for key, x in value.items():
        here = f"{path}.{key}" if path else key
        if key == "reference" and x:
            out.append((here, x))
        elif isinstance(x, dict):
            if x.get("reference"):
                out.append((here, x["reference"]))
                out += [p for p in plain_references(x, here) if p[0] != f"{here}.reference"]
            else:
                out += plain_references(x, here)
        elif isinstance(x, list):
            for i, item in enumerate(x):
                if isinstance(item, dict):
                    out += plain_references(item, f"{here}[{i}]")
    return out


def test_references_of_any_record(rows):
    data, df = rows
    got = {r["id"]: [tuple(x) for x in r["refs"]] for r in df.select("id", walk.references(df.schema).alias("refs")).collect()}
    for r in data:
        assert sorted(got[r["id"]]) == sorted(plain_references(r))
    assert sum(map(len, got.values())) > 500


def test_references_of_a_type_without_any(spark):
    df = spark.range(1).select("id", F.struct(F.lit(1).alias("x")).alias("s"))
    assert df.select(walk.references(df.schema).alias("r")).first()["r"] == []


def test_correction_of_any_record(spark, nested, rows):
    data, df = rows
    values = sorted({v for texts in TEXTS.values() for v in texts})
    table = spark.createDataFrame([(v,) for v in values], "v STRING").select("v", E.fix_system(F.col("v")).alias("system"), E.fix_datetime(F.col("v")).alias("date"), E.fix_reference(F.col("v")).alias("reference"))
    fixes = {r["v"]: r for r in table.collect()}

    def plain(value, path, log):
        out = {}
        for key, x in value.items():
            here = f"{path}.{key}" if path else key
            if isinstance(x, dict):
                x = plain(x, here, log)
            elif isinstance(x, list):
                x = [plain(item, f"{here}[{i}]", log) if isinstance(item, dict) else item for i, item in enumerate(x)]
            elif isinstance(x, str):
                kind = "reference" if key == "reference" else "date" if "date" in key.lower() or key in ("issued", "authored", "recorded") else None
                if key == "system" and path and value.get("code") is not None and "code" in value:
                    kind = "system"
                if kind and fixes[x][kind] != x:
                    log.append((path if kind == "system" else here, x, fixes[x][kind]))
                    x = fixes[x][kind]
            out[key] = x
        return out

    fixed = E.correct(df)
    assert fixed.schema["contained"].dataType.simpleString() == df.schema["contained"].dataType.simpleString()
    got = {r["id"]: r for r in fixed.collect()}
    changes = 0
    for r in data:
        log = []
        want = plain(r, "", log)
        row = got[r["id"]].asDict(recursive=True)
        assert sorted((x["path"], x["old"], x["new"]) for x in row.pop("corrections")) == sorted(log)
        assert row == {f.name: want.get(f.name) for f in nested.fields}
        changes += len(log)
    assert changes > 500


def test_untouched_branches_are_not_rebuilt(nested):
    new = walk.rewrite(nested, E.correction_rule)
    assert set(new) == {"class", "issued", "subject", "contained", "extension", "performer"}
    assert "withField" not in str(walk.rewrite(T.StructType.fromDDL(f"a {types.QUANTITY}, b STRING"), lambda *_: None))


def test_lists_with_nothing_to_correct_are_not_walked(spark):
    df = spark.createDataFrame([
        (1, [([("loinc", "a")], "Patient/1"), (None, None)]), (2, [(None, "Patient2"), ([("http://loinc.org", "a")], "Patient/1")]),
        (3, [(None, None), ([(None, "a"), ("urn:x", "b"), None], "Group/9")]), (4, [(None, "x/y"), None, ([("snomed", None)], "not one\n")]), (5, []), (6, None),
        (7, [([], "a/b"), (None, "x\nPatient2/"), (None, "0a1b2c3d-0000-1111-2222-0123456789ab")])],
        "id INT, part ARRAY<STRUCT<coding:ARRAY<STRUCT<system:STRING,code:STRING>>,reference:STRING>>")
    copy = walk.makings(df.schema, E.correction_rule, E.correction_test)["part"]
    # a null system (3) and a text without a slash (4) only may be wrong
    assert {r["id"] for r in df.select("id", copy.alias("c")).collect() if r["c"] is not None} == {1, 2, 3, 4, 7}
    plain = df.filter("id IN (5, 6)").union(spark.createDataFrame([(8, [([("urn:x", "b")], "Group/9"), (None, None), None])], df.schema))
    assert all(r["c"] is None for r in plain.select(copy.alias("c")).collect())
    got = {r["id"]: r for r in E.correct(df.union(plain)).collect()}
    assert {i: [tuple(c) for c in r["corrections"]] for i, r in got.items() if r["corrections"]} == {
        1: [("part[0].coding[0]", "loinc", "http://loinc.org")], 2: [("part[0].reference", "Patient2", "Patient/2")],
        7: [("part[2].reference", "0a1b2c3d-0000-1111-2222-0123456789ab", "Patient/0a1b2c3d-0000-1111-2222-0123456789ab")]}
    before = {r["id"]: r["part"] for r in df.union(plain).collect()}
    assert all(r["part"] == before[i] for i, r in got.items() if not r["corrections"])


def test_dates_by_shape_are_those_of_all_layouts(spark):
    def tried(text):
        options = []
        for pattern, target in codes.DATE_FIXES:
            iso = F.regexp_replace(text, pattern, target)
            options.append(F.when(text.rlike(pattern) & F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).isNotNull(), iso))
        for layout in ("M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "yyyy/M/d", "d MMM yyyy", "MMM d, yyyy"):
            options.append(F.when(~text.rlike(r"^\d{4}-\d{2}"), F.date_format(F.try_to_timestamp(text, F.lit(layout)), "yyyy-MM-dd")))
        return F.coalesce(*options, text)

    days = [f"{y}-{m:02d}-{d:02d}" for y in ("0000", "0001", "1582", "1900", "2000", "2023", "9999") for m in (0, 1, 2, 4, 10, 12, 13) for d in (0, 1, 5, 14, 28, 29, 30, 31, 32)]
    tails = ["", "T00:00:00", "T00:00:00Z", "T00:00:00.000Z", "T00:00:00+02:00", "T00:00:00-0200", "T00:00:01Z", "T00:00:00Z\n", "T00:00:00Z\r\n", "T00:00:00Z ", " 00:00:00", "\n"]
    odd = [None, "", " ", "soon", "2001", "2001-02", "2001-2-3", "2/3/2001", "13/2/2001", "2/13/2001", "31/2/2001", "2-3-2001", "2001/2/3", "20010203", "20011303", "3 Feb 2001", "Feb 3, 2001", "1/2/20011", "1/2/2001\n",
           "\u0662/\u0663/2001", "20010203\n", " 2001-02-03T00:00:00Z", "12001-02-03", "2001-02-03T00:00:00Z2", "+2001/2/3", "Mai 3, 2001"]
    df = spark.createDataFrame([(t,) for t in [d + x for d in days for x in tails] + odd], "t STRING")
    got = df.select("t", S.fix_date(F.col("t")).alias("now"), tried(F.col("t")).alias("was")).collect()
    assert [(r["t"], r["now"]) for r in got if r["now"] != r["was"]] == [] and sum(r["now"] != r["t"] for r in got) > 500


def test_correction_list_is_not_made_inside_a_lambda(spark, sf):
    text = QUERIES["auto_correction_e01_e02_e03_e04"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "corrections" in text and "transform(concat(" not in text


def test_resolve_splits_hubs_and_takes_the_smallest_depth(spark):
    rnd = random.Random(3)
    edges = [("E", str(k), "P", "hub") for k in range(400)] + [("P", "hub", "O", str(k)) for k in range(5)]
    edges += [("E", str(rnd.randrange(400)), "E", str(rnd.randrange(400))) for _ in range(300)] + [("O", "1", "E", "7"), ("E", "7", "E", "7")]
    frame = spark.createDataFrame(edges, "src_type STRING, src_id STRING, dst_type STRING, dst_id STRING").withColumn("path", F.lit("x"))
    hops = {}
    for a, b, c, d in edges:
        hops.setdefault((a, b), set()).add((c, d))
    roots = [("E", str(k)) for k in range(0, 400, 2)] + [("E", "0")]
    got = J.resolve(spark.createDataFrame(roots, "src_type STRING, src_id STRING"), frame, 3)
    want = set()
    for root in set(roots):
        seen, front = {root}, {root}
        for depth in (1, 2, 3):
            front = {n for x in front for n in hops.get(x, ())} - seen
            seen |= front
            want |= {(*root, *n, depth) for n in front}
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_widest_types(spark):
    def ddl(text):
        return T.StructType.fromDDL(text)
    one = ddl("a INT, s STRUCT<x:INT,y:ARRAY<STRUCT<p:FLOAT>>>, d DATE, m MAP<STRING,INT>, t STRING")
    two = ddl("s STRUCT<z:STRING,x:BIGINT,y:ARRAY<STRUCT<p:DOUBLE,q:STRING>>>, a DOUBLE, d TIMESTAMP, m MAP<STRING,BIGINT>, t STRUCT<u:INT>")
    assert walk.widest(one, two) == ddl("a DOUBLE, s STRUCT<x:BIGINT,y:ARRAY<STRUCT<p:DOUBLE,q:STRING>>,z:STRING>, d TIMESTAMP, m MAP<STRING,BIGINT>, t STRING")


def test_union_of_drifting_frames(spark):
    one = spark.sql("SELECT 1 AS a, named_struct('x', 1, 'y', array(named_struct('p', 1))) AS s, CAST(NULL AS STRUCT<q:INT>) AS n, 'text' AS t")
    two = spark.sql("SELECT named_struct('u', 2) AS t, named_struct('y', array(named_struct('p', 2.5D, 'q', 'z'), NULL), 'w', true) AS s, 2.5D AS a, named_struct('q', 9L) AS n")
    three = spark.sql("SELECT CAST(NULL AS STRUCT<x:INT>) AS s")
    got = sorted((r.asDict(recursive=True) for r in union_drifting([one, two, three]).collect()), key=str)
    assert got == sorted([
        {"a": 1.0, "s": {"x": 1, "y": [{"p": 1.0, "q": None}], "w": None}, "n": None, "t": "text"},
        {"a": 2.5, "s": {"x": None, "y": [{"p": 2.5, "q": "z"}, None], "w": True}, "n": {"q": 9}, "t": '{"u":2}'},
        {"a": None, "s": None, "n": None, "t": None}], key=str)


def test_type_at(nested):
    at = {spec: walk.type_at(nested, spec) for spec in ("id", "class.code", "contained[0].code.coding[1].system", "performer[*].reference", "extension[?url='x'].extension", "names[0]", "names", "nope", "id.x",
                                                        "class[0]", "contained[0].nope")}
    text = T.StringType()
    assert at == {"id": text, "class.code": text, "contained[0].code.coding[1].system": text, "performer[*].reference": T.ArrayType(text), "extension[?url='x'].extension": nested["extension"].dataType.elementType["extension"].dataType,
                  "names[0]": text, "names": T.ArrayType(text), "nope": None, "id.x": None, "class[0]": None, "contained[0].nope": None}


def test_resolve_moves_the_edges_once(spark):
    """The edges are dealt out by their record in one exchange that every step reads again; loops and null ids are kept apart."""
    names = "src_type STRING, src_id STRING, dst_type STRING, dst_id STRING"
    rows = [("A", "1", "A", "1"), ("A", "1", "B", "2"), ("A", "1", "B", "2"), ("B", "2", "C", "3"), ("B", "2", "A", "1"), ("C", "3", "D", None), ("A", None, "B", "2")]
    edges = spark.createDataFrame(rows, names)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = J.resolve(edges.select("src_type", "src_id"), edges, 2)
        got = {tuple(r) for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert got == {("A", "1", "B", "2", 1), ("A", "1", "C", "3", 2), ("B", "2", "C", "3", 1), ("B", "2", "A", "1", 1), ("B", "2", "D", None, 2),
                   ("C", "3", "D", None, 1), ("A", None, "B", "2", 1), ("A", None, "C", "3", 2), ("A", None, "A", "1", 2)}
    # all exchanges of pairs that are not read again: the edges, the first frontier at its records, and what comes back to the roots
    moved = [line for line in plan.split("\n") if " Exchange hashpartitioning(" in line and "ReusedExchange" not in line]
    assert len([line for line in moved if "REPARTITION" in line]) == 2 and "cast(node" not in plan


def test_records_are_made_after_they_met_their_patients(spark, sf):
    """What moves to the patients is flat rows; the records are those that ``records`` gives."""
    from medtable.sources import star

    people = star.records(spark, sf, "Patient").where("cast(id AS bigint) % 3 = 0")
    df, *how = star.unmade(spark, sf, "Observation")
    got, want = J.everything(people, {"Observation": df}, {"Observation": how}), J.everything(people, {"Observation": star.records(spark, sf, "Observation")})
    assert got.count() > 1000 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    plan = QUERIES["patient_everything_j20"](spark, sf)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    joins = [k for k, line in enumerate(plan) if "Join LeftSemi" in line]
    assert len(joins) == 5 and not any("named_struct(" in plan[k + 1] or " struct(" in plan[k + 1] for k in joins)
