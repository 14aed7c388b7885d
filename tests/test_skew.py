"""Skew-safe building blocks against brute force, with one key holding a third of the rows."""

import datetime as dt
import random
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from medtable.functions import scalars as S
from medtable.functions import skew as K


@pytest.fixture(scope="module")
def rows():
    rnd, start = random.Random(7), dt.datetime(2020, 1, 1)
    out = []
    for i in range(1500):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rnd.randrange(40)}")
        when = start + dt.timedelta(days=rnd.randrange(6), hours=rnd.randrange(2)) if i % 4 else start
        out.append((key, when, str(i), float(rnd.randrange(200)), "abc"[rnd.randrange(3)]))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k STRING, ts TIMESTAMP, id STRING, v DOUBLE, c STRING").withColumns({"day": F.to_date("ts"), "tie": S.row_key(F.col("id"))})


@pytest.mark.parametrize("levels", [["day", "ts"], ["ts"], ["month", "day", "ts"]])
def test_sequence(df, levels):
    got = K.sequence_within(df.withColumn("month", F.trunc("day", "month")), ["k"], levels, "tie", "n").select("k", "ts", "tie", "n").toPandas()
    assert len(got) == 1500
    got = got.sort_values(["ts", "tie"])
    want = got.groupby("k", dropna=False).cumcount() + 1
    assert (got["n"] == want).all()


def test_earlier_count_is_strict(df):
    """D13."""
    got = K.earlier_count(df, "k", "ts", "n").select("k", "ts", "n").toPandas().dropna()
    for _, g in got.groupby("k"):
        assert [int((g["ts"] < t).sum()) for t in g["ts"]] == list(g["n"])


def test_sequence_starts_no_job_and_no_task_holds_a_key(spark):
    """A key with a third of the rows, most of them at one instant: cells stay small, and planning reads nothing."""
    n = 6000
    rows = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k"),
                                 F.when(F.col("id") % 9 < 6, F.lit("2020-01-01")).otherwise(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 30).cast("int"))).cast("timestamp").alias("ts"), "id")
    rows = rows.withColumns({"day": F.to_date("ts"), "tie": S.row_key(F.col("id").cast("string"))})
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "numbering")
    try:
        out = K.sequence_within(rows, ["k"], ["day", "ts"], "tie", "n")
        assert len(tracker.getJobIdsForGroup("planning")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k#" not in text and "SinglePartition" not in text  # nothing is dealt out by the key alone
    largest = rows.groupBy("k", "day", "ts", F.substring("tie", 1, 2)).count().agg(F.max("count")).first()[0]
    assert largest < n / 3 / 20
    got = out.groupBy("k").agg(F.count("n").alias("c"), F.countDistinct("n").alias("d"), F.min("n").alias("a"), F.max("n").alias("b")).collect()
    assert all(r["c"] == r["d"] == r["b"] and r["a"] == 1 for r in got)


def test_chunks_are_whole_and_ordered(df):
    got = K.chunked_list(df, ["k"], ["day", "ts"], "tie", F.col("id"), "ids", chunk_rows=64).toPandas()
    assert got["ids"].map(len).max() <= 64 and got["ids"].map(len).sum() == 1500
    hot = got[got["k"] == "hot"].sort_values("chunk")
    want = df.where("k = 'hot'").orderBy("ts", "tie").toPandas()["id"].tolist()
    assert [x for ids in hot["ids"] for x in ids] == want


def test_quantiles(df, rows):
    got = K.exact_quantiles(df, ["k"], "v", {"p10": 0.1, "p50": 0.5, "p90": 0.9}, cells=8).toPandas()
    for _, r in got.iterrows():
        vals = [v for k, _, _, v, _ in rows if k == r["k"] or (k is None and pd.isna(r["k"]))]
        assert np.allclose([r["p10"], r["p50"], r["p90"]], np.quantile(vals, [0.1, 0.5, 0.9]))
        assert r["p50"] == statistics.median(vals)


def test_outliers_leave_quantile_cells_even(spark):
    """A value of 1e12 among 20,000 small ones, and one of 1e300: no cell holds much more than its share."""
    vals = spark.range(20_000).select(F.lit("k").alias("k"), (F.col("id") * F.col("id") / 1e9).alias("_v"), F.lit(1).alias("_n"))
    vals = vals.unionByName(spark.createDataFrame([("k", 1e12, 1), ("k", -1e300, 1), ("k", 1e300, 1), (None, 5.0, 3)], "k STRING, _v DOUBLE, _n INT"))
    sizes = K.quantile_cells(vals, ["k"], 64).groupBy("k", "_cell").count().collect()
    assert sum(r["count"] for r in sizes) == 20_004 and max(r["count"] for r in sizes) < 2 * 20_000 / 64
    got = K.exact_quantiles(vals, ["k"], "_v", {"m": 0.5, "p99": 0.99}).where("k = 'k'").first()
    want = np.quantile([r["_v"] for r in vals.where("k = 'k'").collect()], [0.5, 0.99])
    assert np.allclose([got["m"], got["p99"]], want)


def test_quantile_of_constant(spark):
    df = spark.createDataFrame([("a", 2.0)] * 5 + [("b", None)], "k STRING, v DOUBLE")
    assert [tuple(r) for r in K.exact_quantiles(df, ["k"], "v", {"m": 0.5}).collect()] == [("a", 2.0)]


def test_mode_takes_smallest_on_ties(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", None), ("a", None), ("b", None)], "k STRING, v STRING")
    assert [tuple(r) for r in K.mode_per(df, ["k"], "v", "m").collect()] == [("a", "x")]


def test_latest(df, rows):
    got = {r["k"]: r["id"] for r in K.latest_per(df.where("k IS NOT NULL"), ["k"], ["ts", "id"], ["id"]).collect()}
    best = {}
    for k, ts, i, _, _ in rows:
        if k is not None and (k not in best or (ts, i) > best[k]):
            best[k] = (ts, i)
    assert got == {k: i for k, (_, i) in best.items()}


def test_asof(df, rows):
    refs = df.where("cast(id AS int) % 7 = 0").select("k", F.col("ts").alias("at"), F.col("id").alias("ref"))
    facts = df.where("cast(id AS int) % 5 = 0")
    got = {r["ref"]: r["found"] for r in K.asof_last(refs, facts, "k", "at", "ts", "id", "v", "found").collect()}
    facts_py = [r for r in rows if int(r[2]) % 5 == 0]
    for k, ts, i, _, _ in rows:
        if int(i) % 7 == 0:
            seen = [(t, j, v) for kk, t, j, v, _ in facts_py if kk == k and kk is not None and t <= ts]
            assert got[i] == (max(seen)[2] if seen else None), i
    assert len(got) == sum(int(r[2]) % 7 == 0 for r in rows)


def test_distinct_list(df, rows):
    got = {r["k"]: (r["l"], r["n"]) for r in K.distinct_list(df.where("k IS NOT NULL"), ["k"], "c", "l", "n").collect()}
    for k in {r[0] for r in rows if r[0]}:
        vals = [r[4] for r in rows if r[0] == k]
        assert got[k] == (sorted(set(vals)), len(vals))


@pytest.mark.parametrize("limit", [1, 100, 10**6])
def test_sequence_moves_rows_once_whatever_is_hot(spark, df, monkeypatch, limit):
    """Numbers do not depend on which keys are cut into cells, and what ``made`` names is not moved with the rows."""
    monkeypatch.setattr(K, "HOT_ROWS", limit)
    got = K.sequence_within(df.drop("tie", "day"), ["k"], ["day", "ts"], "tie", "n", {"tie": S.row_key(F.col("id")), "day": F.to_date("ts")})
    assert got.columns == ["k", "ts", "id", "v", "c", "tie", "day", "n"]
    rows = got.select("k", "ts", "tie", "n").toPandas().sort_values(["ts", "tie"])
    assert len(rows) == 1500 and (rows["n"] == rows.groupby("k", dropna=False).cumcount() + 1).all()


def test_lines_meet_their_orders_as_stored_rows(spark, sf):
    """The join of lines and orders moves numbers, not the texts of records."""
    from medtable.sources.star import flat
    text = flat(spark, sf, "observation", with_patient=True)._jdf.queryExecution().optimizedPlan().toString()
    below = text[text.index("Join"):]
    assert "observation_id" not in below and "l_orderkey" in below


def test_ranged_rows_stand_in_order_and_move_once(spark, df, tmp_path, monkeypatch):
    """Cells dealt out by ranges: written as they are, the rows are sorted in their files and across them, hot keys and null keys too."""
    from medtable.sources import writers as W

    monkeypatch.setattr(K, "HOT_ROWS", 100)
    rows = df.drop("tie", "day").unionByName(df.where("id < '2'").drop("tie", "day").withColumns({"ts": F.lit(None).cast("timestamp"), "id": F.concat("id", F.lit("x"))}))
    made = {"tie": S.row_key(F.col("id")), "day": F.to_date("ts")}
    out = K.sequence_within(rows, ["k"], ["day", "ts"], "tie", "n", made, ranged=True)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_off" in plan and "Join LeftOuter, (_cell" not in plan  # offsets come with the rows, which are not joined with them
    where = str(tmp_path / "sorted")
    W.write_sorted(out, where, ["k"], ["ts", "tie"], placed=True)
    assert tuple(W.order_faults(spark, where, ["k", "ts", F.unhex("tie")]).first()) == (rows.count(), 0, 0)
    assert tuple(W.order_faults(spark, where, ["k", "ts", "tie"]).first()) == (rows.count(), 0, 0)
    got = spark.read.parquet(where)
    want = K.sequence_within(rows.withColumns(made), ["k"], ["day", "ts"], "tie", "n").select(got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    for _, g in got.toPandas().groupby("k", dropna=False):
        g = g.sort_values("n")
        assert list(g["n"]) == list(range(1, len(g) + 1))
        assert list(zip(g["ts"].isna().map(lambda x: not x), g["ts"].fillna(pd.Timestamp(0)), g["tie"])) == sorted(zip(g["ts"].isna().map(lambda x: not x), g["ts"].fillna(pd.Timestamp(0)), g["tie"]))


def test_the_sorted_timeline_is_not_dealt_out_again(spark, sf, monkeypatch):
    """One pass writes the sorted files from the numbered rows, and the events are made once."""
    from medtable.plans import queries_gold as Q
    from medtable.sources import writers as W

    seen = []
    kept = W.write_sorted
    monkeypatch.setattr(W, "write_sorted", lambda df, *a, **k: (seen.append(df._jdf.queryExecution().optimizedPlan().toString()), kept(df, *a, **k))[1])
    where = Q._sorted_timeline(spark, sf)
    [plan] = seen
    assert "o_orderkey" not in plan and plan.count("RepartitionByExpression") == 1
    assert spark.read.parquet(where).count() == Q.all_events(spark, sf).count()


def test_narrative_reads_stored_observations(spark, sf):
    """The observations and those of the last dates of both categories are handed to ``store`` before their sections read them."""
    from medtable.plans import narrative as N
    from medtable.sources.star import AS_OF, flat

    frames = {n: flat(spark, sf, n, True) for n in ("condition", "medication_request", "diagnostic_report", "observation")}
    meds = frames["medication_request"].withColumn("dosage_text", F.lit("take"))
    reports = frames["diagnostic_report"].withColumns({"results": F.array("report_id"), "report_text": F.lit(None).cast("string")})
    obs = frames["observation"].withColumns({"ref_low": F.lit(1.0), "ref_high": F.lit(2.0)})
    kept = []
    N.narrative_items(flat(spark, sf, "patient"), frames["condition"], meds, reports, obs, flat(spark, sf, "note"), AS_OF, store=lambda df: kept.append(df.columns) or df)
    assert len(kept) == 3 and "pk" not in kept[0] and all("_d" in c for c in kept[1:])
