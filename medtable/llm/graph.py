"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` for every node of ``links`` (a bigint, b bigint); a component's nodes share one of them as label.

    In each round every node moves to the neighbour (or itself) that comes first in a new random order, and from
    there on to that one's choice. Links inside a group then vanish and equal ones are merged, so the table
    shrinks by a factor in every round, also for long chains. Rounds are cut by tables in the shared
    folder; only whether links are left comes to the driver.
    """
    links = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels, turn = None, 0
    while True:
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))

        def place(name: str):
            return F.struct(F.xxhash64(F.lit(turn), F.col(name)).alias("at"), F.col(name).alias("node"))  # noqa: B023
        first = both.groupBy("node").agg(F.min(place("other")).alias("_first"))
        first = first.select("node", F.least(place("node"), F.col("_first")).getField("node").alias("to"))
        step = first.select(F.col("node").alias("to"), F.col("to").alias("_next"))
        moved = written(first.join(step, "to").select("node", F.col("_next").alias("to")), "moves")
        if labels is None:
            labels = moved.select("node", F.col("to").alias("label"))
        else:
            then = moved.select(F.col("node").alias("label"), F.col("to").alias("_to"))
            labels = written(labels.join(then, "label", "left").select("node", F.coalesce("_to", "label").alias("label")), "labels")
        left = links.join(moved.select(F.col("node").alias("a"), F.col("to").alias("_a")), "a")
        left = left.join(moved.select(F.col("node").alias("b"), F.col("to").alias("_b")), "b").where("_a <> _b")
        links = written(left.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "links")
        turn += 1
        if links.isEmpty():
            return labels
