"""Pieces the training-data operators share: reading, scratch tables and Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

PIECE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The whole text, null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_text(name: str = "doc_id") -> Column:
    """An identifier as text; null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fold(name: str, parts: int) -> Column:
    """Remainder of the CRC-32 of an identifier's text."""
    return F.crc32(id_text(name).cast("binary")) % F.lit(parts)


def written(df: DataFrame, label: str) -> DataFrame:
    """Store a table in the shared scratch folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shielded(docs: DataFrame, stage: Callable[[DataFrame], DataFrame], own: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """Apply a stage that returns the columns it gets; columns other than ``own`` have neutral names meanwhile, so none
    can clash with those of the stage."""
    names = {c: c if c in own else f"col{k}" for k, c in enumerate(docs.columns)}
    out = stage(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])


def parts_for(total_bytes: int, each: int = 16 << 20) -> int:
    """How many buckets of about ``each`` bytes a corpus of ``total_bytes`` needs."""
    return max(1, -(-int(total_bytes) // each))


def text_bytes(docs: DataFrame, name: str = "text") -> int:
    return int(docs.agg(F.sum(F.octet_length(whole_text(name))).alias("n")).first()["n"] or 0)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and the offsets between them; null as empty."""
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], name: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text; a longer text stands alone."""
    for batch in batches:
        _, at = flat(batch.column(name))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def grouped_rows(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of a partition that is sorted by ``keys``, one list for each key."""
    last, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if rows and key != last:
                yield last, rows
                rows = []
            last = key
            rows.append(row)
    if rows:
        yield last, rows
