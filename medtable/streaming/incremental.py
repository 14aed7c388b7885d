"""Incremental behaviour (T01-T10) with Structured Streaming file sources.

Each function runs a query to the end of the available input and returns; a second call goes on where
the checkpoint stopped. State that later batches need lives in state tables beside the checkpoint. How late a row may come is
always an argument.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import alerts as L
from ..sources import writers as K

START = "1900-01-01T00:00:00Z"
STORE, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None, name_filter: str | None = None) -> DataFrame:
    """Parquet folder as a stream."""
    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(path)


def run_batches(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process everything available in micro-batches, then stop."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
    query.awaitTermination()


def since(df: DataFrame, ts: str, mark: str = START) -> DataFrame:
    """T01, T04 batch variant: rows strictly after the mark."""
    return df.where(F.col(ts) > F.lit(mark).cast("timestamp"))


def read_cursor(spark: SparkSession, path: str, kind: str):
    """High-water mark of a record type, or the start value; one row per type."""
    cursors = K.read_state(spark, path)
    row = None if cursors is None else cursors.where(F.col("resource_type") == kind).select("last_updated").first()
    return F.lit(START).cast("timestamp") if row is None else F.lit(row["last_updated"])


def update_cursor(spark: SparkSession, path: str, batch: DataFrame, ts: str, kind: str, as_of: str) -> None:
    """Typed maximum and count of the new rows, merged by type; the mark never moves back."""
    mark = batch.agg(F.max(ts).alias("last_updated"), F.count(F.lit(1)).alias("record_count")).where("last_updated IS NOT NULL")
    row = mark.select(F.lit(kind).alias("resource_type"), "last_updated", F.lit(as_of).alias("extracted_at"), "record_count")
    K.upsert_latest(spark, path, row, ["resource_type"], ["last_updated"], buckets=1)


def begin_batch(spark: SparkSession, log: str, batch_id: int, mark: Column, as_of: str):
    """The mark and the ingest date that a batch started with, stored before any of its data.

    A batch that is run again, at whatever point it failed and on whatever day, gets what it got the first time.
    """
    if K.exists(spark, f"{log}/batch_id={batch_id}/*.parquet"):
        entry = spark.read.schema("mark timestamp, ingest_date date").parquet(f"{log}/batch_id={batch_id}")
    else:
        entry = spark.range(1).select(mark.alias("mark"), F.lit(as_of).cast("date").alias("ingest_date"))
        entry.coalesce(1).write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")
        entry = spark.read.schema(entry.schema).parquet(f"{log}/batch_id={batch_id}")
    row = entry.first()
    return row["mark"], row["ingest_date"]


def pull(spark: SparkSession, source: str, schema: T.StructType, bronze: str, cursor: str, checkpoint: str, ts: str, kind: str, as_of: str,
         allow_late: str) -> None:
    """Append rows after the high-water mark to bronze by ingest date, then store the new mark.

    Rows at or before the mark less ``allow_late``, and rows without a time, are too late. Both kinds are stored by one
    write, told apart by the partition ``late``: ``accepted`` reads the table, ``rejected`` the others with the mark
    they missed, so each row of the input is in one of them. The batch id is part of the partition, and its files are
    replaced by a retry, which decides and dates every row as the first run did (``begin_batch``).
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        mark, day = begin_batch(spark, f"{cursor}.batches", batch_id, read_cursor(spark, cursor, kind) - F.expr(f"INTERVAL {allow_late}"), as_of)
        late = ~F.coalesce(F.col(ts) > F.lit(mark), F.lit(False))
        out = batch.withColumns({"missed_mark": F.when(late, F.lit(mark)), "late": late, "ingest_date": F.lit(day), "batch_id": F.lit(batch_id)})
        K.write_partitioned(out, bronze, "late", "ingest_date", "batch_id")
        stored = accepted(spark, bronze, batch.schema)
        if stored is not None:
            update_cursor(spark, cursor, stored.where(F.col("batch_id") == batch_id), ts, kind, as_of)

    run_batches(file_stream(spark, source, schema), checkpoint, each)


def _side(spark: SparkSession, bronze: str, late: bool, schema: T.StructType | None) -> DataFrame | None:
    where = f"{bronze}/late={str(late).lower()}"
    if not K.exists(spark, where):
        return None
    fields = None if schema is None else T.StructType([*schema.fields, T.StructField("missed_mark", T.TimestampType()), T.StructField("ingest_date", T.DateType()), T.StructField("batch_id", T.IntegerType())])
    rows = (spark.read if fields is None else spark.read.schema(fields)).parquet(where)
    return rows if late else rows.drop("missed_mark")


def accepted(spark: SparkSession, bronze: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The rows that ``pull`` took, or None."""
    return _side(spark, bronze, False, schema)


def rejected(spark: SparkSession, bronze: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The rows that came too late, with the mark they missed, or None."""
    return _side(spark, bronze, True, schema)


def merge_stream(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], buckets: int = K.BUCKETS) -> None:
    """Newest row per key kept in a state table; a batch touches the partitions of its keys only."""
    spark = stream.sparkSession

    def each(batch: DataFrame, _: int) -> None:
        K.upsert_latest(spark, path, batch, keys, order, buckets)

    run_batches(stream, checkpoint, each)


def bucketed_metrics(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], late: str, bucket: str = "1 day") -> None:
    """Tumbling sums and counts with a watermark ``late`` behind; changed buckets are merged by key.

    The table is partitioned by the day of the bucket, so a batch replaces the days it has rows of.
    """
    spark = stream.sparkSession
    agg = stream.withWatermark("ts", late).groupBy(F.window("ts", bucket).alias("w"), *keys).agg(F.sum("value").alias("total"), F.count("value").alias("samples"))
    flat = agg.select(F.col("w.start").alias("ts"), *keys, "total", "samples")

    def each(batch: DataFrame, _: int) -> None:
        K.upsert(spark, path, batch, ["ts", *keys], part=F.to_date("ts"))

    run_batches(flat, checkpoint, each, "update")


class Cooldown(StatefulProcessor):
    """State of one alert definition: the hours inside its look-back and the time it last triggered."""

    def __init__(self, definitions: Sequence[L.Definition]):
        self.definitions = {d.name: d for d in definitions}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("cooldown", "hours array<bigint>, totals array<double>, samples array<bigint>, last bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rule = self.definitions[key[0]]
        held = self.state.get() if self.state.exists() else ([], [], [], None)
        window, last = list(zip(*map(list, held[:3]))), held[3]
        for hour, total, samples in sorted((r["hour"], r["total"], r["samples"]) for r in rows):
            window = [x for x in window if x[0] > hour - rule.lookback_hours] + [(hour, total, samples)]
            n = sum(x[2] for x in window)
            value, at = sum(x[1] for x in window) / n, (hour + 1) * 3600
            if n >= rule.min_samples and L.crosses(rule, value) and (last is None or at - last >= rule.cooldown_minutes * 60):
                last = at
                yield Row(name=rule.name, category=rule.category, severity=rule.severity, triggered_at=at, metric_value=value, samples=n)
        hours, totals, counts = (list(x) for x in zip(*window))
        self.state.update((hours, totals, counts, last))

    def close(self) -> None:
        pass


def alert_stream(stream: DataFrame, path: str, checkpoint: str, definitions: Sequence[L.Definition], late: str) -> DataFrame:
    """Alerts with look-back and cool-down, appended to ``path`` once no more rows of their hour can come.

    Metrics meet their definitions by a generated array and are added up by hour before the shuffle, so no
    definition's metrics gather in one task. Closed hours come in order and meet a state per definition that holds
    the look-back's hours and the last alert, however long the history is. An hour closes when a metric ``late`` after
    its end has come. Needs the RocksDB state store, which is set for this query.
    """
    spark = stream.sparkSession
    names = F.array_compact(F.array(*[F.when(d.matches(), F.lit(d.name)) for d in definitions]))
    matched = stream.withWatermark("ts", late).select("ts", "value", F.explode(names).alias("name")).where("value IS NOT NULL")
    hourly = matched.groupBy(F.window("ts", "1 hour").alias("w"), "name").agg(F.sum("value").alias("total"), F.count("value").alias("samples"))
    hourly = hourly.select("name", F.floor(F.unix_seconds(F.col("w.start")) / 3600).alias("hour"), "total", "samples")
    schema = "name STRING, category STRING, severity STRING, triggered_at BIGINT, metric_value DOUBLE, samples BIGINT"
    raised = hourly.groupBy("name").transformWithState(statefulProcessor=Cooldown(definitions), outputStructType=T.StructType.fromDDL(schema), outputMode="Append", timeMode="None")
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        query = raised.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(path)
        query.awaitTermination()
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)
    return spark.read.schema(schema).parquet(path).withColumn("triggered_at", F.timestamp_seconds("triggered_at"))
