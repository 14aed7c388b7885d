"""Registry of named queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the same result in plain SQL over the stored tables."""
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return report(fn(configure(spark), sf_dir.rstrip("/")))
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn
    return wrap


def _plain(name: str, kind: T.DataType) -> Column:
    col = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.round(col, 6).alias(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(name)
    if isinstance(kind, T.DateType):
        return F.date_format(col, "yyyy-MM-dd").alias(name)
    if isinstance(kind, T.ArrayType):
        return F.array_join(col.cast("array<string>"), "|").alias(name)
    return col


def report(df: DataFrame) -> DataFrame:
    """Engine-neutral presentation: doubles to six places, times as text, lists joined by ``|``."""
    return df.select(*[_plain(f.name, f.dataType) for f in df.schema.fields])
