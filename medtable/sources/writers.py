"""Sinks (K01-K12). Output file counts follow AQE; partitioned writes are clustered by their partition first."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.skew import match
from ..operators.projections import flatten_first
from ..session import scratch_dir
from .readers import exists


def write_parquet(df: DataFrame, path: str) -> None:
    """Overwrite."""
    df.write.mode("overwrite").parquet(path)


def clustered(df: DataFrame, *cols: str) -> DataFrame:
    """Rows of one partition value close together, in files AQE keeps at a sensible size.

    ``REBALANCE`` splits a large partition value over several tasks, unlike a plain repartition.
    """
    return df.hint("rebalance", *cols) if cols else df.hint("rebalance")


def write_partitioned(df: DataFrame, path: str, *cols: str, mode: str = "overwrite") -> None:
    """Partitioned write; overwrite replaces only the partitions present in the frame."""
    writer = clustered(df, *cols).write.mode(mode).partitionBy(*cols)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], files: int | None = None,
                 made: dict[str, Column] | None = None, placed: bool = False) -> None:
    """Files that follow each other in the order of ``keys`` and ``order``, each sorted inside.

    Rows are dealt out by ranges of the whole order, so a hot key spans as many files as it needs if ``order`` tells its
    rows apart, and a reader of one key and time skips the others by Parquet's own minima and maxima. Nulls
    come first. Without ``files`` their number follows the size that AQE aims at. ``made`` names columns of the frame, row
    keys for example, that follow from the others: they are not moved but made again where the rows have arrived. ``placed`` says that the rows
    stand in that order already, as those that ``sequence_within`` ranged; they are neither moved nor sorted again.
    """
    if placed:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return
    cols, made = [*keys, *order], made or {}
    moved, by = df.drop(*made), [made.get(c, F.col(c)) for c in cols]
    ranged = moved.repartitionByRange(files, *by) if files else moved.repartitionByRange(*by)
    rows = ranged.withColumns(made).select(*df.columns).sortWithinPartitions(*cols)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


#: Rows of a file that one task compares with the ones ahead of them.
BLOCK_ROWS = 200_000


def order_faults(spark: SparkSession, path: str, cols: Sequence[str | Column]) -> DataFrame:
    """Rows, rows that come before the one ahead of them in their file, and files that start before the end of the
    one ahead, of a table that ``write_sorted`` wrote; one row."""
    rows = spark.read.parquet(path).select(F.struct(*cols).alias("at"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    # blocks of a file are put in order by tasks of their own, and the ends of blocks that follow each other are compared
    ahead = F.lag("at").over(Window.partitionBy("file", "block").orderBy("row"))
    inside = rows.withColumn("block", F.floor(F.col("row") / BLOCK_ROWS)).withColumn("wrong", F.coalesce((F.col("at") < ahead).cast("int"), F.lit(0)))
    blocks = inside.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("wrong").alias("wrong"), F.min("at").alias("first"), F.max("at").alias("last"),
                                                 F.min_by("at", "row").alias("head"), F.max_by("at", "row").alias("tail"))
    ends = F.lag("tail").over(Window.partitionBy("file").orderBy("block"))
    blocks = blocks.withColumn("wrong", F.col("wrong") + F.coalesce((F.col("head") < ends).cast("int"), F.lit(0)))
    files = blocks.groupBy("file").agg(F.sum("n").alias("n"), F.sum("wrong").alias("wrong"), F.min("first").alias("first"), F.max("last").alias("last"))
    # a row for each file, in one group: files are far fewer than rows
    before = F.max("last").over(Window.partitionBy(F.lit(1)).orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    overlap = F.coalesce((F.col("first") < before).cast("int"), F.lit(0))
    return files.withColumn("overlap", overlap).agg(F.sum("n").alias("n"), F.sum("wrong").alias("rows_out_of_order"), F.sum("overlap").alias("files_out_of_order"))


def with_year(df: DataFrame, col: str) -> DataFrame:
    """``<col>_year`` partition column; null when the value is no date."""
    return df.withColumn(f"{col}_year", F.year(S.parse_datetime(F.col(col).cast("string"))))


# ---- state tables: rows by key, in partitions of the key's hash ----

#: Partitions of a state table unless its caller says otherwise; a table keeps the number it was made with.
BUCKETS = 64
PART = "_part"


def key_part(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    """Partition of a row: the hash of its key."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _pending(path: str) -> str:
    return f"{path.rstrip('/')}.pending"


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of a state table, or None before the first merge; a merge that died while it swapped its partitions in is finished first."""
    _finish(spark, path)
    return spark.read.option("mergeSchema", True).parquet(path).drop(PART) if exists(spark, f"{path}/{PART}=*") else None


def _swap(spark: SparkSession, path: str) -> None:
    write_partitioned(spark.read.parquet(_pending(path)), path, PART)


def _finish(spark: SparkSession, path: str) -> None:
    """Swap in what a failed merge had ready. A folder without its mark of success is a merge that changed nothing."""
    pending = _pending(path)
    if exists(spark, f"{pending}/_SUCCESS") and exists(spark, f"{pending}/*.parquet"):
        ready = spark.read.parquet(pending)
        if not ready.isEmpty():
            _swap(spark, path)
            _clear(spark, path, ready.schema)


def _clear(spark: SparkSession, path: str, schema) -> None:
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(_pending(path))


def merge_state(spark: SparkSession, path: str, source: DataFrame, combine: Callable[[DataFrame | None, DataFrame], DataFrame], part: Column) -> DataFrame:
    """Replace the partitions that ``source`` touches by ``combine(their rows, source)``; the others are neither read nor written.

    ``part`` is a function of the key, so a key never changes its partition. The new partitions are made ready beside the
    table and then swapped in by a dynamic overwrite. A merge that dies before they are ready leaves the table
    as it is; one that dies later is finished by the next reader or writer. Single writer.
    """
    _finish(spark, path)
    # the batch is computed once, and its partitions, at most as many as the table has, come to the driver
    batch = scratch_dir(spark, "batch")
    source.withColumn(PART, part).write.parquet(batch)
    rows = spark.read.parquet(batch)
    touched = [r[0] for r in rows.select(PART).distinct().collect()]
    if touched:
        target = None
        if exists(spark, f"{path}/{PART}=*"):
            old = spark.read.option("mergeSchema", True).parquet(path)
            hit = F.col(PART).isin([t for t in touched if t is not None])
            target = old.where(hit | F.col(PART).isNull() if None in touched else hit)
        merged = combine(target, rows)
        merged.write.mode("overwrite").parquet(_pending(path))
        _swap(spark, path)
        _clear(spark, path, merged.schema)
    return read_state(spark, path)


def upsert(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], buckets: int = BUCKETS, part: Column | None = None) -> DataFrame:
    """Update matched keys, insert the others. ``source`` has one row per key; null keys match each other.

    A batch that is run again changes nothing.
    """
    def combine(target, rows):
        return rows if target is None else match(target, rows.select(*keys), list(keys), "left_anti").unionByName(rows, allowMissingColumns=True)
    return merge_state(spark, path, source, combine, key_part(keys, buckets) if part is None else part)


def upsert_latest(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Like ``upsert``, but an older source row never replaces a newer one; duplicates reduce to the newest."""
    def combine(target, rows):
        both = rows if target is None else target.unionByName(rows, allowMissingColumns=True)
        cols = [c for c in both.columns if c not in keys]
        return both.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_r")).select(*keys, "_r.*")
    return merge_state(spark, path, source, combine, key_part(keys, buckets))


def upsert_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition: str) -> None:
    """K05 for large tables whose keys never change partition: only partitions named by the source are read and replaced.

    The merged partitions are first written to the shared scratch folder, then swapped in by a dynamic
    overwrite, so a lost executor or a failed job cannot damage the table's other partitions. Null keys match each
    other, and null is a partition like any other.
    """
    if not exists(spark, path):
        write_partitioned(source, path, partition)
        return
    target = match(spark.read.parquet(path), source.select(partition).distinct(), [partition], "left_semi")
    by = list(dict.fromkeys([*keys, partition]))
    kept = match(target, source.select(*by).distinct(), by, "left_anti")
    staged = scratch_dir(spark, "merge")
    kept.unionByName(source, allowMissingColumns=True).write.parquet(staged)
    write_partitioned(spark.read.parquet(staged), path, partition)


def append_json(df: DataFrame, path: str) -> None:
    """K06."""
    df.write.mode("append").json(path)


def write_documents(df: DataFrame, path: str, kind: str = "resourceType") -> None:
    """JSON documents under one folder per type."""
    clustered(df, kind).write.mode("overwrite").partitionBy(kind).json(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Flat CSV; nested fields become dotted columns."""
    flatten_first(df).write.mode("overwrite").option("header", True).csv(path)


def append_metrics(df: DataFrame, path: str, version: str = "1.0") -> None:
    """K10."""
    df.withColumn("metric_version", F.lit(version)).write.mode("append").parquet(path)
