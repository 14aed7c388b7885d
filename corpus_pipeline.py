"""Corpus pipeline: toxic documents go, repeated lines go, one of each near-duplicate group stays, the rest is packed.

Every stage takes the documents that its predecessor kept, reread from Parquet. Stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medtable.llm import bpe, lines, near, packing, toxicity
from medtable.llm.common import shielded, table, written
from medtable.session import configure


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 7: documents predicted to be toxic go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return shielded(docs, lambda rows: toxicity.score(rows, model, rows.columns).where(F.col("predicted") == 0).select(*rows.columns))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 6: lines that come earlier, alike or nearly so, go, and documents that have no other line."""
    return lines.clean(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 4: one document of each class of near duplicates stays."""
    return near.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 8: the pieces of all documents with their places in sequences."""
    return packing.pack(docs, bpe.default_vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic), ("line_dedup", drop_lines), ("near_dedup", drop_near), ("packing", pack),
]

#: SQL can express neither the decoder nor the signatures nor the packing; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
