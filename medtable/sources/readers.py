"""Sources (S01-S21). Schemas are declared, so no read infers one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import types
from ..functions.paths import path as at
from ..operators.specs import union_drifting

# Lower-case file stem -> record type. Fixed values.
STEMS = {k.lower(): k for k in (
    "Patient", "Observation", "Encounter", "Condition", "MedicationRequest", "DiagnosticReport", "AllergyIntolerance", "Procedure", "Immunization", "DocumentReference", "CarePlan",
    "Practitioner", "Organization", "RelatedPerson")}


def schema_of(kind: str) -> T.StructType:
    return T.StructType.fromDDL(types.SCHEMAS[kind])


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path pattern matches anything, on whatever file system holds it."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hpath.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hpath)
    return found is not None and len(found) > 0


def detect_format(spark: SparkSession, path: str) -> str | None:
    """Delta before parquet before JSON, by what the folder holds."""
    for fmt, marks in (("delta", ["_delta_log"]), ("parquet", ["*.parquet", "*/*.parquet"]), ("json", ["*.json", "*/*.json", "*.ndjson"])):
        if any(exists(spark, f"{path}/{m}") for m in marks):
            return fmt
    return None


def read_auto(spark: SparkSession, path: str, schema: T.StructType | None = None, strict: bool = False) -> DataFrame | None:
    """Read in the detected format; nothing there gives None, or an error in strict mode.

    Delta tables need the session to have that source; without it the error says so.
    """
    fmt = detect_format(spark, path)
    if fmt is None:
        if strict:
            raise FileNotFoundError(f"no readable data in {path}")
        return None
    reader = spark.read.format(fmt)
    if fmt == "delta":
        try:
            return reader.load(path)
        except Exception as e:  # the name of the error differs with what is missing
            raise NotImplementedError(f"{path} is a Delta table, and this session cannot read Delta: {str(e).splitlines()[0]}") from e
    return (reader.schema(schema) if schema is not None and fmt == "json" else reader).load(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S03."""
    return spark.read.schema(schema).json(path)


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One document per file, over several lines."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def envelope_schema(kind: str) -> T.StructType:
    """Bundle, wrapped bundle page and bare record of one type, in one schema."""
    record = schema_of(kind)
    entry = T.ArrayType(T.StructType([T.StructField("resource", record)]))
    bundle = T.StructType([T.StructField("entry", entry)])
    return T.StructType([T.StructField("entry", entry), T.StructField("bundle", bundle), *record.fields])


def unwrap(df: DataFrame) -> DataFrame:
    """S05-S07 (D1): one row per record from any of the three envelopes; an empty bundle gives none."""
    fields = [c for c in df.columns if c not in ("entry", "bundle")]
    record = next(f for f in df.schema["entry"].dataType.elementType.fields if f.name == "resource").dataType
    own = F.struct(*[F.col(f"`{c}`") for c in fields]).cast(record)
    alone = F.when(F.col("id").isNotNull(), F.array(F.struct(own.alias("resource"))))
    return df.select(F.explode(F.coalesce(F.col("entry"), F.col("bundle.entry"), alone)).alias("e")).select("e.resource.*")


def read_records(spark: SparkSession, path: str, kind: str, multi_line: bool = False) -> DataFrame:
    """Records of one type from a folder of envelopes; a missing folder gives a typed empty frame."""
    read = read_json_documents if multi_line else read_json_lines
    if not exists(spark, path):
        return spark.createDataFrame([], schema_of(kind))
    return unwrap(read(spark, path, envelope_schema(kind)))


def import_views(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """NDJSON per type as temporary views."""
    out = {}
    for kind, path in paths.items():
        out[kind] = read_json_lines(spark, path, schema_of(kind))
        out[kind].createOrReplaceTempView(kind.lower())
    return out


def stem_type(file_name: Column) -> Column:
    """Record type from a file or folder name."""
    stem = F.lower(F.regexp_extract(file_name, r"([A-Za-z]+)", 1))
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in STEMS.items() for x in kv]), stem)


def import_directory(spark: SparkSession, root: str) -> DataFrame:
    """Every JSON line below a folder, with the type named by its folder or by the record itself."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(root)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    named = stem_type(F.element_at(F.split(folder, "="), -1))
    return lines.select(F.col("value").alias("json_data"), F.coalesce(named, F.get_json_object("value", "$.resourceType")).alias("resource_type"))


def of_types(raw: DataFrame, kinds: Sequence[str] | None = None) -> DataFrame:
    """Optional type filter of a raw frame."""
    return raw if kinds is None else raw.where(F.col("resource_type").isin(list(kinds)))


def read_pages(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """Records of well-formed pages, and the text of malformed ones, from a permissive read."""
    schema = T.StructType([*envelope_schema(kind).fields, T.StructField("_corrupt_record", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    pages = spark.read.text(path).select("value", F.from_json("value", schema, options).alias("p"))
    broken = F.col("p._corrupt_record").isNotNull()
    return unwrap(pages.where(~broken).select("p.*").drop("_corrupt_record")), pages.where(broken).select(F.col("value").alias("text"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Many CSV files as one frame."""
    return spark.read.schema(schema).option("header", True).csv(path)


def to_raw(df: DataFrame, as_of: str) -> DataFrame:
    """Records to raw rows with the ingest time and date."""
    now = F.lit(as_of).cast("timestamp")
    return df.select(F.to_json(F.struct("*")).alias("json_data"), now.alias("ingest_timestamp"), F.to_date(now).alias("ingest_date"))


def lift_raw(raw: DataFrame) -> DataFrame:
    """Type, id and last update lifted out of the raw text, from one parse."""
    head = raw.select("*", F.from_json("json_data", "resourceType STRING, id STRING, meta STRUCT<lastUpdated:STRING>").alias("_h"))
    return head.select(*raw.columns, F.coalesce(at("_h.resourceType"), F.lit("Unknown")).alias("resource_type"), F.coalesce(at("_h.id"), F.lit("")).alias("resource_id"),
                       F.coalesce(at("_h.meta.lastUpdated"), F.lit("")).alias("last_updated"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; a missing path is an error."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def read_drifting(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet paths, each a file or the files of one write, whose schemas drift, as one frame.

    One footer of each path is read for its schema. Paths of equal schema are one scan with that schema, so filters and
    columns still reach the files; a scan is cast to the united type afterwards.
    """
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for path in paths:
        schema = spark.read.parquet(path).schema
        groups.setdefault(schema.json(), (schema, []))[1].append(path)
    return union_drifting([spark.read.schema(schema).parquet(*group) for schema, group in groups.values()])


def read_optional(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """None, or a typed empty frame, when the input is missing."""
    if exists(spark, path):
        return spark.read.parquet(path)
    return None if schema is None else spark.createDataFrame([], schema)


def with_placeholders(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Null columns for what an optional input would have given."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def read_run_metrics(performance: DataFrame, transform: DataFrame) -> DataFrame:
    """Performance metrics united with transform counts reshaped to metric rows."""
    pairs = F.array(F.struct(F.lit("input_record_count").alias("name"), F.col("input_record_count").cast("double").alias("value")),
                    F.struct(F.lit("output_record_count").alias("name"), F.col("output_record_count").cast("double").alias("value")),
                    F.struct(F.lit("transform_time_seconds").alias("name"), F.col("transform_time_seconds").cast("double").alias("value")))
    counts = transform.select(F.col("step"), "resource_type", F.inline(pairs))
    return performance.unionByName(counts, allowMissingColumns=True)


def hash_sample(df: DataFrame, keys: Sequence[str], percent: int, invert: bool = False) -> DataFrame:
    """repeatable sample by key hash, so a re-run or a lost executor gives the same rows."""
    inside = F.pmod(F.xxhash64(*keys), F.lit(100)) < percent
    return df.where(~inside if invert else inside)
