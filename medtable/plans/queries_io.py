"""Registered sources, sinks and incremental jobs. Files go to the shared scratch folder."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import projections as P
from ..operators import rules as R
from ..operators import timeseries as M
from ..session import scratch_dir
from ..sources import readers as S
from ..sources import writers as K
from ..sources.star import AS_OF, dirty_records, flat, oracle_prelude, raw, records, table
from ..streaming import incremental as I
from .queries_metrics import _HITS, DEFINITIONS, with_total
from .registry import query

TS = "'%Y-%m-%d %H:%M:%S'"
PAGE = 500


def _envelopes(df, kind):
    """Bundle pages, wrapped bundle pages and bare records, one JSON document per row, from blocks of at most PAGE ids."""
    k = F.col("id").cast("bigint")
    rows = df.withColumn("_page", F.floor(k / PAGE))
    entry = F.collect_list(F.struct(F.struct(*[F.col(c) for c in df.columns]).alias("resource")))
    pages = rows.where("_page % 3 <> 2").groupBy("_page").agg(entry.alias("entry"))
    bundle = F.struct(F.lit("Bundle").alias("resourceType"), F.col("entry"))
    wrapped = F.struct(F.struct(F.lit(1).alias("page")).alias("metadata"), F.struct(F.col("entry")).alias("bundle"))
    docs = pages.select(F.when(F.col("_page") % 3 == 0, F.to_json(bundle)).otherwise(F.to_json(wrapped)).alias("value"))
    return docs.unionByName(rows.where("_page % 3 = 2").drop("_page").select(F.to_json(F.struct("*")).alias("value")))


_PATIENTS = oracle_prelude("patient") + "SELECT patient_id AS id, gender, strftime(birth_date, '%Y-%m-%d') AS \"birthDate\" FROM patient"


@query("read_envelopes_s03_s05_s06_s07", _PATIENTS)
def read_envelopes(spark, sf):
    """S03, S05-S07 (D1): JSON lines with the three envelopes."""
    where = scratch_dir(spark, "envelopes")
    _envelopes(records(spark, sf, "Patient"), "Patient").write.text(where)
    return S.read_records(spark, where, "Patient").select("id", "gender", "birthDate")


@query("read_documents_s04", _PATIENTS)
def read_documents(spark, sf):
    """One multi-line document per file, each a bundle of at most PAGE patients."""
    where = scratch_dir(spark, "documents")
    pages = records(spark, sf, "Patient").select(F.floor(F.col("id").cast("bigint") / PAGE).alias("page"), F.struct(F.struct("id", "gender", "birthDate").alias("resource")).alias("e"))
    docs = pages.groupBy("page").agg(F.collect_list("e").alias("entry")).select("page", F.to_json(F.struct("entry"), {"pretty": "true"}).alias("value"))
    docs.write.partitionBy("page").text(where)
    return S.read_records(spark, f"{where}/*", "Patient", multi_line=True).select("id", "gender", "birthDate")


@query("read_auto_s01_s14_s15_s16_k01", oracle_prelude("encounter") + """SELECT fmt, CAST(n AS BIGINT) AS n, missing FROM (SELECT 'parquet' AS fmt, count(*) AS n, true AS missing FROM encounter
 UNION ALL SELECT 'json', count(*), true FROM encounter)""")
def read_auto(spark, sf):
    """Detected format; a missing folder is None, or typed and empty with placeholders."""
    where, enc = scratch_dir(spark, "auto"), flat(spark, sf, "encounter").select("encounter_id", "status")
    K.write_parquet(enc, f"{where}/parquet")
    enc.write.json(f"{where}/json")
    absent = S.read_auto(spark, f"{where}/none") is None and S.read_optional(spark, f"{where}/none") is None
    typed = S.with_placeholders(S.read_optional(spark, f"{where}/none", enc.schema), {"note": "string"})
    parts = [S.read_auto(spark, f"{where}/{f}", enc.schema, strict=True).unionByName(typed, allowMissingColumns=True).agg(F.count("encounter_id").alias("n")).withColumn("fmt", F.lit(f)) for f in ("parquet", "json")]
    return parts[0].unionByName(parts[1]).withColumn("missing", F.lit(absent))


@query("ndjson_views_s08_s09_s10_s18_k07", oracle_prelude("patient", "encounter") + """SELECT 'Patient' AS resource_type, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT patient_id) AS BIGINT) AS ids FROM patient
 UNION ALL SELECT 'Encounter', count(*), count(DISTINCT encounter_id) FROM encounter""")
def ndjson_views(spark, sf):
    """Documents in one folder per type, then found again by folder name and as views."""
    where = scratch_dir(spark, "ndjson")
    for kind in ("Patient", "Encounter"):
        rows = records(spark, sf, kind)
        rows.select(*rows.columns).write.json(f"{where}/{kind.lower()}")
    views = S.import_views(spark, {k: f"{where}/{k.lower()}" for k in ("Patient", "Encounter")})
    found = S.of_types(S.import_directory(spark, where), ["Patient", "Encounter"])
    ids = found.select("resource_type", F.get_json_object("json_data", "$.id").alias("id"))
    known = views["Patient"].select("id").unionByName(views["Encounter"].select("id")).distinct()
    return ids.join(known, "id", "left_semi").groupBy("resource_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"))


@query("documents_by_type_k07_s10", oracle_prelude("patient", "encounter") + """SELECT 'Patient' AS resource_type, CAST(count(*) AS BIGINT) AS n FROM patient UNION ALL SELECT 'Encounter', count(*) FROM encounter""")
def documents_by_type(spark, sf):
    """Mixed documents under ``resourceType=`` folders, typed again by their folder."""
    where = scratch_dir(spark, "bytype")
    mixed = records(spark, sf, "Patient").select("resourceType", "id", "gender").unionByName(records(spark, sf, "Encounter").select("resourceType", "id", "status"), allowMissingColumns=True)
    K.write_documents(mixed, where)
    return S.import_directory(spark, where).groupBy("resource_type").agg(F.count(F.lit(1)).alias("n"))


@query("drifting_files_u03", oracle_prelude("encounter") + """, b AS (SELECT *, k % 4 AS w FROM encounter)
SELECT encounter_id AS id, status, CAST(CASE w WHEN 0 THEN k WHEN 1 THEN k WHEN 2 THEN k + 0.5 END AS DOUBLE) AS weight, CASE WHEN w > 0 THEN class_display END AS display,
 CASE WHEN w = 2 THEN CAST(k AS VARCHAR) END AS first_rank, CASE w WHEN 1 THEN CAST(k AS VARCHAR) WHEN 2 THEN '{"n":' || CAST(k AS VARCHAR) || '}' END AS note FROM b""")
def drifting_files(spark, sf):
    """Four writes that lack, add and widen columns and nested fields, and one column that changes its kind."""
    where, k = scratch_dir(spark, "drift"), F.col("k")
    enc, rank = flat(spark, sf, "encounter"), F.struct(F.lit("x").alias("use"), k.cast("string").alias("rank"))
    base = [F.col("encounter_id").alias("id")]
    coded = F.struct(F.col("class_code").alias("code"), F.col("class_display").alias("display"))
    writes = [[*base, "status", k.cast("int").alias("weight"), F.struct(F.col("class_code").alias("code")).alias("class"), F.array(F.struct(F.lit("x").alias("use"))).alias("parts")],
              [*base, "status", k.cast("bigint").alias("weight"), coded.alias("class"), k.cast("string").alias("note")],
              [coded.alias("class"), *base, (k + 0.5).cast("double").alias("weight"), "status", F.array(rank).alias("parts"), F.struct(k.alias("n")).alias("note")],
              [*base, "status", coded.alias("class")]]
    for w, columns in enumerate(writes):
        enc.where(k % 4 == w).select(*columns).write.parquet(f"{where}/{w}")
    rows = S.read_drifting(spark, [f"{where}/{w}" for w in range(4)])
    return rows.select("id", "status", "weight", F.col("class.display").alias("display"), F.get("parts", F.lit(0))["rank"].alias("first_rank"), "note")


@query("malformed_pages_s19", oracle_prelude("patient") + """SELECT 'record' AS kind, CAST(count(*) AS BIGINT) AS n FROM patient WHERE k % 40 <> 0 UNION ALL SELECT 'malformed', count(*) FROM patient WHERE k % 40 = 0""")
def malformed_pages(spark, sf):
    where = scratch_dir(spark, "pages")
    raw(spark, sf, "Patient").select(F.when(F.get_json_object("json_data", "$.id").cast("bigint") % 40 == 0, F.substring("json_data", 1, 60)).otherwise(F.col("json_data")).alias("value")).write.text(where)
    good, bad = S.read_pages(spark, where, "Patient")
    return good.agg(F.count("id").alias("n")).withColumn("kind", F.lit("record")).unionByName(bad.agg(F.count("text").alias("n")).withColumn("kind", F.lit("malformed")))


@query("csv_roundtrip_s20_k08_k09", oracle_prelude("encounter") + """SELECT encounter_id AS id, status, class_code, type_code FROM encounter""")
def csv_roundtrip(spark, sf):
    """Nested records to flat CSV and back."""
    where = scratch_dir(spark, "csv")
    enc = records(spark, sf, "Encounter").select("id", "status", "class", "type")
    K.export_csv(enc, f"{where}/part=1")
    flat_schema = P.flatten_first(enc).schema
    back = S.read_csv(spark, f"{where}/*", T.StructType([T.StructField(f.name, T.StringType()) for f in flat_schema.fields]))
    return back.select("id", "status", F.col("`class.code`").alias("class_code"), F.col("`type.coding.code`").alias("type_code"))


@query("raw_rows_s11_s12_k03", oracle_prelude("encounter") + f"""SELECT 'Encounter' AS resource_type, encounter_id AS resource_id, strftime(start_datetime, '%Y-%m-%dT%H:%M:%SZ') AS last_updated, '{AS_OF}' AS ingest_date FROM encounter""")
def raw_rows(spark, sf):
    """Raw rows appended by ingest date, with type, id and last update lifted out."""
    where = scratch_dir(spark, "raw")
    K.write_partitioned(S.to_raw(records(spark, sf, "Encounter"), AS_OF), where, "ingest_date", mode="append")
    return S.lift_raw(spark.read.parquet(where)).select("resource_type", "resource_id", "last_updated", "ingest_date")


@query("partitioned_overwrite_k02_k04_k11_k12", oracle_prelude("encounter") + """SELECT CAST(year(start_datetime) AS INT) AS start_datetime_year, CASE WHEN year(start_datetime) = 1996 THEN 'replaced' ELSE status END AS status,
 CAST(count(*) AS BIGINT) AS n FROM encounter GROUP BY 1, 2""")
def partitioned_overwrite(spark, sf):
    """Derived year partition; a second write replaces one partition only."""
    where = scratch_dir(spark, "years")
    enc = K.with_year(flat(spark, sf, "encounter").select("encounter_id", "status", "start_datetime"), "start_datetime")
    K.write_partitioned(enc, where, "start_datetime_year")
    K.write_partitioned(enc.where("start_datetime_year = 1996").withColumn("status", F.lit("replaced")), where, "start_datetime_year")
    return spark.read.parquet(where).groupBy("start_datetime_year", "status").agg(F.count(F.lit(1)).alias("n"))


@query("upsert_k05_u04", oracle_prelude("encounter") + """SELECT encounter_id, CASE WHEN k % 3 = 0 THEN 'changed' ELSE status END AS status FROM encounter WHERE k % 2 = 0 OR k % 3 = 0""")
def upsert(spark, sf):
    """Even ids first, then every third id changed or inserted."""
    where, enc = scratch_dir(spark, "upsert"), flat(spark, sf, "encounter")
    K.upsert(spark, where, enc.where("k % 2 = 0").select("encounter_id", "status"), ["encounter_id"])
    return K.upsert(spark, where, enc.where("k % 3 = 0").select("encounter_id", F.lit("changed").alias("status")), ["encounter_id"])


@query("upsert_partitions_k05", oracle_prelude("encounter") + """SELECT encounter_id, class_code, CASE WHEN class_code IN ('IMP', 'AMB') AND k % 3 = 0 THEN 'changed' ELSE status END AS status FROM encounter
 WHERE k % 2 = 0 OR (class_code IN ('IMP', 'AMB') AND k % 3 = 0)""")
def upsert_partitions(spark, sf):
    """K05 by partition: only the two named classes are rewritten."""
    where, enc = scratch_dir(spark, "upsertp"), flat(spark, sf, "encounter")
    K.upsert_partitions(spark, where, enc.where("k % 2 = 0").select("encounter_id", "status", "class_code"), ["encounter_id"], "class_code")
    change = enc.where("k % 3 = 0 AND class_code IN ('IMP', 'AMB')").select("encounter_id", F.lit("changed").alias("status"), "class_code")
    K.upsert_partitions(spark, where, change, ["encounter_id"], "class_code")
    return spark.read.parquet(where).select("encounter_id", "class_code", "status")


@query("issue_sink_k06_k14", oracle_prelude("encounter") + """SELECT 'required' AS rule, 'fatal' AS level, CAST(count(*) AS BIGINT) AS n FROM encounter WHERE k % 12 = 0 UNION ALL SELECT 'allowed', 'warning', count(*) FROM encounter WHERE k % 10 = 0 AND k % 12 <> 0""")
def issue_sink(spark, sf):
    """Issues appended as JSON, once per rule group."""
    where, df = scratch_dir(spark, "issues"), dirty_records(spark, sf, "Encounter")
    rules = R.declared_rules("Encounter")
    K.append_json(R.issue_rows(df, "Encounter", rules[:3]), where)
    K.append_json(R.issue_rows(df, "Encounter", rules[3:]), where)
    issues = spark.read.schema("rule STRING, level STRING, resource_id STRING").json(where)
    return issues.groupBy("rule", "level").agg(F.count(F.lit(1)).alias("n"))


@query("metric_append_k10_s21", oracle_prelude("metric") + """SELECT resource_type, metric_version, CAST(count(*) AS BIGINT) AS n, round(sum(value), 6) AS total FROM (SELECT resource_type, '1.0' AS metric_version, value FROM metric
 UNION ALL SELECT resource_type, '1.1', user_id * 1.0 FROM metric UNION ALL SELECT resource_type, '1.1', user_id - event_id % 2 FROM metric UNION ALL SELECT resource_type, '1.1', value FROM metric) GROUP BY 1, 2""")
def metric_append(spark, sf):
    """Metrics appended with their version; transform counts arrive reshaped."""
    where, m = scratch_dir(spark, "metrics"), flat(spark, sf, "metric")
    perf = m.select(F.lit("transform").alias("step"), "resource_type", F.lit("score").alias("name"), "value")
    done = m.select(F.lit("transform").alias("step"), "resource_type", F.col("user_id").alias("input_record_count"), (F.col("user_id") - F.col("event_id") % 2).alias("output_record_count"),
                    F.col("value").alias("transform_time_seconds"))
    K.append_metrics(perf, where)
    K.append_metrics(S.read_run_metrics(perf.limit(0), done), where, "1.1")
    return spark.read.parquet(where).groupBy("resource_type", "metric_version").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query("lineage_columns_r19", "SELECT o_orderkey, 'orders.parquet' AS source_file, 'orders' AS _source FROM orders")
def lineage_columns(spark, sf):
    """R19."""
    rows = P.with_lineage(table(spark, sf, "orders"), AS_OF, "orders")
    return rows.select("o_orderkey", F.substring_index("_source_path", "/", -1).alias("source_file"), "_source")


@query("transform_template_p14_q32", oracle_prelude("patient") + "SELECT patient_id AS id, upper(gender) AS gender, 'kept' AS loss FROM patient WHERE k % 50 <> 0")
def transform_template(spark, sf):
    """Hooks around a mapping; the loss check (2 % here) runs on the counts observed by the write."""
    from ..operators.specs import check_loss, transform_template as run
    where = scratch_dir(spark, "template")
    out, seen, kept = run(records(spark, sf, "Patient"), {"id": "id", "gender": "gender"}, pre=lambda d: d.where("cast(id AS bigint) % 50 <> 0"),
                          post=lambda d: d.withColumn("gender", F.upper("gender")))
    K.write_parquet(out, where)
    loss = check_loss(seen, kept)
    return spark.read.parquet(where).withColumn("loss", F.lit("kept" if 0 < loss <= 0.05 else "wrong"))


# --- incremental ------------------------------------------------------------------------------------


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


_LATE = """, a AS (SELECT * FROM events WHERE event_id % 10 <> 0 AND ts < TIMESTAMP '2024-01-15'), b AS (SELECT * FROM events WHERE event_id % 10 <> 0 AND ts >= TIMESTAMP '2024-01-15'),
 c AS (SELECT * FROM events WHERE event_id % 10 = 0 AND ts > (SELECT max(ts) FROM (SELECT ts FROM a UNION ALL SELECT ts FROM b)))"""


def _pull(spark, sf, late="0 seconds"):
    """Three arrivals of the event table, each pulled before the next one comes; the third is mostly late."""
    where, ev = scratch_dir(spark, "pull"), _events(spark, sf)
    early = F.col("event_id") % 10 != 0
    for rows in (ev.where(early & (F.col("ts") < "2024-01-15")), ev.where(early & (F.col("ts") >= "2024-01-15")), ev.where(~early)):
        rows.write.mode("append").parquet(f"{where}/in")
        I.pull(spark, f"{where}/in", rows.schema, f"{where}/bronze", f"{where}/cursor", f"{where}/ckpt", "ts", "Event", AS_OF, late)
    return where


@query("incremental_pull_t01_t04_t05", "WITH z AS (SELECT 1)" + _LATE + f""" SELECT event_id, '{AS_OF}' AS ingest_date FROM (SELECT event_id FROM a UNION ALL SELECT event_id FROM b UNION ALL SELECT event_id FROM c)""")
def incremental_pull(spark, sf):
    """The table has the rows after the mark."""
    return I.accepted(spark, f"{_pull(spark, sf)}/bronze").select("event_id", "ingest_date")


@query("late_rows_t04", "WITH z AS (SELECT 1)" + _LATE + f""", m AS (SELECT max(ts) AS mark FROM (SELECT ts FROM a UNION ALL SELECT ts FROM b))
 SELECT event_id, NULL AS missed_mark FROM (SELECT event_id FROM a UNION ALL SELECT event_id FROM b UNION ALL SELECT event_id FROM c)
 UNION ALL SELECT event_id, strftime(mark, {TS}) FROM events, m WHERE event_id % 10 = 0 AND ts <= mark""")
def late_rows(spark, sf):
    """Every row of the input, those that came too late with the mark they missed."""
    where = f"{_pull(spark, sf)}/bronze"
    taken = I.accepted(spark, where).select("event_id", F.lit(None).cast("timestamp").alias("missed_mark"))
    return taken.unionByName(I.rejected(spark, where).select("event_id", "missed_mark"))


@query("cursor_table_t02_t03", "WITH z AS (SELECT 1)" + _LATE + f""" SELECT 'Event' AS resource_type, strftime(max(ts), {TS}) AS last_updated, '{AS_OF}' AS extracted_at FROM (SELECT ts FROM a UNION ALL SELECT ts FROM b UNION ALL SELECT ts FROM c)""")
def cursor_table(spark, sf):
    """One cursor row with the typed maximum."""
    return K.read_state(spark, f"{_pull(spark, sf)}/cursor").select("resource_type", "last_updated", "extracted_at")


@query("late_allowance_t04", "SELECT CAST(count(*) AS BIGINT) AS n FROM events")
def late_allowance(spark, sf):
    """An allowance of 60 days keeps every late row."""
    return I.accepted(spark, f"{_pull(spark, sf, '60 days')}/bronze").agg(F.count(F.lit(1)).alias("n"))


@query("batch_since_t01", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-20'")
def batch_since(spark, sf):
    return I.since(_events(spark, sf), "ts", "2024-01-20T00:00:00Z").select("event_id")


def _event_stream(spark, sf, parts=6):
    """The event table as a stream of several files, a batch each."""
    where, ev = scratch_dir(spark, "stream"), _events(spark, sf)
    ev.repartition(parts, F.col("event_id")).write.parquet(f"{where}/in")
    return where, I.file_stream(spark, f"{where}/in", ev.schema, files_per_batch=1)


@query("merge_stream_t06_t09_t10", f"""SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type, strftime(max(ts), {TS}) AS ts FROM events GROUP BY 1""")
def merge_stream(spark, sf):
    """Newest event per key, whatever order the batches arrive in."""
    where, stream = _event_stream(spark, sf)
    I.merge_stream(stream.select("user_id", "event_id", "event_type", "ts"), f"{where}/state", f"{where}/ckpt", ["user_id"], ["ts", "event_id"])
    return K.read_state(spark, f"{where}/state")


@query("metric_stream_t07", f"""SELECT strftime(date_trunc('day', ts), {TS}) AS ts, event_type, round(sum(value), 6) AS total, CAST(count(value) AS BIGINT) AS samples FROM events GROUP BY 1, 2""")
def metric_stream(spark, sf):
    """Daily tumbling windows; a watermark longer than the data's disorder loses nothing."""
    where, stream = _event_stream(spark, sf)
    I.bucketed_metrics(stream, f"{where}/state", f"{where}/ckpt", ["event_type"], "60 days", "1 day")
    return K.read_state(spark, f"{where}/state")


def _metric_columns(df):
    """The metric projection of the events, for a stream."""
    kinds, tiers = ["Patient", "Observation", "Encounter", "Condition"], ["bronze", "silver", "gold"]
    level = F.regexp_extract("props", "([0-9]+)", 1).cast("int") % 3
    return df.select("ts", F.concat(F.lit("quality."), "event_type").alias("metric"), F.element_at(F.array(*[F.lit(x) for x in kinds]), (F.col("user_id") % 4 + 1).cast("int")).alias("resource_type"),
                     F.element_at(F.array(*[F.lit(x) for x in tiers]), level + 1).alias("pipeline_stage"), (F.col("value") / 1000).alias("value"))


@query("alert_stream_t08", _HITS + f"""SELECT c.name, c.category, c.severity, strftime(c.t, {TS}) AS triggered_at, round(c.v * c.n, 6) AS metric_total, CAST(c.n AS BIGINT) AS samples FROM c JOIN a ON a.name = c.name AND a.t = c.t""")
def alert_stream(spark, sf):
    """T08 as a stream: the same alerts as the batch history. Two late marks close the hours that are still open."""
    where, stream = _event_stream(spark, sf)
    for day in ("2100-01-01", "2100-01-02"):
        _events(spark, sf).limit(1).withColumn("ts", F.lit(day).cast("timestamp")).write.mode("append").parquet(f"{where}/in")
    return with_total(I.alert_stream(_metric_columns(stream), f"{where}/alerts", f"{where}/ckpt", DEFINITIONS, "60 days"))


@query("quality_tracking_q34", oracle_prelude("metric") + """, d AS (SELECT resource_type, dimension, date_trunc('day', ts) AS ts, avg(value) AS value FROM metric GROUP BY 1, 2, 3)
SELECT resource_type, round(avg(value), 6) AS mean, round(min(value), 6) AS min, round(max(value), 6) AS max, CAST(count(value) AS BIGINT) AS count FROM d GROUP BY 1""")
def quality_tracking(spark, sf):
    """Q34: track by day, then statistics per type over the daily series."""
    daily = M.resample(flat(spark, sf, "metric"), ["resource_type", "dimension"], "1d")
    return M.metric_stats(daily).where("scope = 'resource_type'").select("resource_type", "mean", "min", "max", "count")
