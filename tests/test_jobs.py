"""Files, merges and incremental runs."""

import pytest
from pyspark.sql import functions as F

from medtable.session import scratch_dir
from medtable.sources import readers as S
from medtable.sources import writers as K
from medtable.streaming import incremental as I


def test_envelopes(spark):
    """The nested entry list is exploded; empty bundles give nothing."""
    where = scratch_dir(spark, "t")
    docs = ['{"resourceType":"Bundle","entry":[{"resource":{"id":"1"}},{"resource":{"id":"2"}}]}', '{"metadata":{},"bundle":{"entry":[{"resource":{"id":"3"}}]}}', '{"resourceType":"Patient","id":"4"}',
            '{"resourceType":"Bundle","entry":[]}']
    spark.createDataFrame([(d,) for d in docs], "value STRING").write.text(where)
    assert sorted(r["id"] for r in S.read_records(spark, where, "Patient").collect()) == ["1", "2", "3", "4"]
    empty = S.read_records(spark, where + "/none", "Patient")
    assert empty.count() == 0 and "birthDate" in empty.columns


def test_missing_inputs(spark):
    where = scratch_dir(spark, "none")
    assert S.read_auto(spark, where) is None and S.read_optional(spark, where) is None
    with pytest.raises(FileNotFoundError):
        S.read_auto(spark, where, strict=True)
    with pytest.raises(FileNotFoundError):
        S.read_table(spark, where)


def keyed(spark, *rows):
    return spark.createDataFrame(rows, "k STRING, v STRING")


def test_failed_upsert_changes_nothing(spark):
    where = scratch_dir(spark, "t")
    K.upsert(spark, where, keyed(spark, ("1", "a"), ("2", "a")), ["k"])
    broken = keyed(spark, ("2", "x")).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        K.upsert(spark, where, broken, ["k"])
    assert sorted(tuple(r) for r in K.read_state(spark, where).collect()) == [("1", "a"), ("2", "a")]
    K.upsert(spark, where, keyed(spark, ("2", "b"), ("3", "b")), ["k"])
    assert sorted(tuple(r) for r in K.read_state(spark, where).collect()) == [("1", "a"), ("2", "b"), ("3", "b")]


@pytest.mark.parametrize("step", ["_swap", "_clear"])
def test_upsert_that_dies_half_way_is_finished_later(spark, monkeypatch, step):
    where = scratch_dir(spark, "t")
    K.upsert(spark, where, keyed(spark, ("1", "a"), ("2", "a")), ["k"])
    with monkeypatch.context() as m:
        m.setattr(K, step, lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            K.upsert(spark, where, keyed(spark, ("2", "b"), ("3", "b")), ["k"])
    assert sorted(tuple(r) for r in K.read_state(spark, where).collect()) == [("1", "a"), ("2", "b"), ("3", "b")]
    K.upsert(spark, where, keyed(spark, ("2", "b"), ("3", "b")), ["k"])  # the batch again
    assert sorted(tuple(r) for r in K.read_state(spark, where).collect()) == [("1", "a"), ("2", "b"), ("3", "b")]


def test_upsert_writes_what_its_batch_touches(spark):
    from pathlib import Path

    where = scratch_dir(spark, "t")
    K.upsert(spark, where, spark.range(4000).select(F.col("id").cast("string").alias("k"), F.lit("a").alias("v")), ["k"])

    def files():
        return {str(f): f.stat().st_mtime_ns for f in Path(where.removeprefix("file:")).rglob("*.parquet")}
    before = files()
    assert len({f.split("_part=")[1].split("/")[0] for f in before}) == K.BUCKETS
    K.upsert(spark, where, keyed(spark, ("7", "b"), ("new", "b")), ["k"])
    after = files()
    changed = {f.split("_part=")[1].split("/")[0] for f in before.items() ^ after.items() for f in f[:1]}
    assert 1 <= len(changed) <= 2
    rows = K.read_state(spark, where)
    assert rows.count() == 4001 and rows.where("v = 'b'").count() == 2


def test_state_with_null_and_new_columns(spark):
    where = scratch_dir(spark, "t")
    K.upsert(spark, where, keyed(spark, (None, "a"), ("1", "a")), ["k"])
    K.upsert(spark, where, keyed(spark, (None, "b"), ("2", None)).withColumn("more", F.lit(1)), ["k"])
    assert sorted(((r["k"] or "", r["v"] or "", r["more"]) for r in K.read_state(spark, where).collect()), key=str) == [("", "b", 1), ("1", "a", None), ("2", "", 1)]


def test_upsert_partitions_keeps_null_keys_and_partitions(spark):
    where = scratch_dir(spark, "t")
    cols = "k INT, v STRING, p STRING"
    K.upsert_partitions(spark, where, spark.createDataFrame([(1, "a", "x"), (None, "b", "x"), (3, "c", None), (4, "d", None), (5, "e", "y")], cols), ["k"], "p")
    K.upsert_partitions(spark, where, spark.createDataFrame([(None, "B", "x"), (3, "C", None)], cols), ["k"], "p")
    got = sorted(((r["k"], r["v"], r["p"]) for r in spark.read.parquet(where).collect()), key=str)
    assert got == sorted([(1, "a", "x"), (None, "B", "x"), (3, "C", None), (4, "d", None), (5, "e", "y")], key=str)


def test_upsert_latest_ignores_older_rows(spark):
    where = scratch_dir(spark, "t")
    for rows in ([("1", 5, "new")], [("1", 3, "old"), ("2", 1, "first"), ("2", 2, "second")]):
        K.upsert_latest(spark, where, spark.createDataFrame(rows, "k STRING, t INT, v STRING"), ["k"], ["t"])
    assert sorted(tuple(r) for r in K.read_state(spark, where).collect()) == [("1", 5, "new"), ("2", 2, "second")]


def test_sorted_files_follow_each_other_and_split_a_hot_key(spark):
    """One patient owns a third of the rows, and no file holds much more than its share."""
    import pyarrow.parquet as pq
    from pathlib import Path

    where = scratch_dir(spark, "t")
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 100)).alias("patient_id"),
                                      F.when(F.col("id") % 5 > 0, F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(10**6)))).alias("event_time"), F.sha2(F.col("id").cast("string"), 256).alias("tie"))
    cols = ["patient_id", "event_time", "tie"]
    K.write_sorted(rows, where, cols[:1], cols[1:], files=12)
    assert tuple(K.order_faults(spark, where, cols).first()) == (30_000, 0, 0)
    parts = sorted(Path(where.removeprefix("file:")).glob("*.parquet"))
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in parts]
    assert len(sizes) == 12 and sum(sizes) == 30_000 and max(sizes) < 2 * 30_000 / 12
    holding = 0
    for f in parts:  # minima and maxima of the files leave few for one ordinary patient
        group = pq.ParquetFile(f).metadata.row_group(0).column(0).statistics
        holding += group.min <= "p50" <= group.max
    assert holding <= 2
    rows.write.mode("overwrite").parquet(where)
    assert K.order_faults(spark, where, cols).first()["rows_out_of_order"] > 0


def test_year_partition(spark):
    df = K.with_year(spark.createDataFrame([("2020-05",), ("x",)], "d STRING"), "d")
    assert sorted((r["d"], r["d_year"]) for r in df.collect()) == [("2020-05", 2020), ("x", None)]


def test_pull_restarts_where_it_stopped(spark):
    """A second run sees only new files, and a late row only with an allowance."""
    where = scratch_dir(spark, "t")
    schema = "id INT, ts TIMESTAMP"

    def arrive(*rows):
        spark.createDataFrame([(i, t) for i, t in rows], "id INT, t STRING").select("id", F.col("t").cast("timestamp").alias("ts")).write.mode("append").parquet(f"{where}/in")

    def run(late="0 seconds"):
        from pyspark.sql import types as T
        I.pull(spark, f"{where}/in", T.StructType.fromDDL(schema), f"{where}/bronze", f"{where}/cursor", f"{where}/ckpt", "ts", "Event", "2024-02-01", late)
        return sorted(r["id"] for r in I.accepted(spark, f"{where}/bronze").collect())

    arrive((1, "2024-01-01"), (2, "2024-01-05"))
    assert run() == [1, 2]
    assert run() == [1, 2]
    arrive((3, "2024-01-03"), (4, "2024-01-06"))
    assert run() == [1, 2, 4]
    arrive((5, "2024-01-04"))
    assert run("3 days") == [1, 2, 4, 5]
    late = {(r["id"], str(r["missed_mark"])[:10]) for r in I.rejected(spark, f"{where}/bronze").collect()}
    assert late == {(3, "2024-01-05")}
    arrive((6, None))
    assert run("3 days") == [1, 2, 4, 5]
    assert sorted(r["id"] for r in I.rejected(spark, f"{where}/bronze").collect()) == [3, 6]
    row = K.read_state(spark, f"{where}/cursor").collect()[0]
    assert row["resource_type"] == "Event" and str(row["last_updated"])[:10] == "2024-01-06"


@pytest.mark.parametrize("fails", ["begin_batch", "write_partitioned", "update_cursor", "after"])
def test_pull_retried_on_another_day(spark, monkeypatch, fails):
    """Whichever write a batch fails after, its retry decides and dates every row as the first run did."""
    where = scratch_dir(spark, "t")
    schema = spark.range(1).select("id", F.lit("2024-01-03").cast("timestamp").alias("ts")).schema

    def arrive(first, last):
        spark.range(first, last).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).cast("timestamp").alias("ts")).write.mode("append").parquet(f"{where}/in")

    def run(day):
        I.pull(spark, f"{where}/in", schema, f"{where}/bronze", f"{where}/cursor", f"{where}/ckpt", "ts", "Event", day, "5 days")

    def rows():
        return sorted((r["id"], str(r["ingest_date"])) for r in I.accepted(spark, f"{where}/bronze").collect())

    arrive(10, 12)
    run("2024-02-01")
    arrive(0, 20)
    target, name = (K, fails) if fails == "write_partitioned" else (I, "update_cursor" if fails == "after" else fails)
    real = getattr(target, name)

    def broken(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(target, name, broken)
        with pytest.raises(Exception):
            run("2024-02-02")
    run("2024-02-03")
    # the mark was the 12th less five days
    day = "2024-02-02"
    assert rows() == sorted([(10, "2024-02-01"), (11, "2024-02-01")] + [(k, day) for k in range(7, 20)])
    assert sorted(r["id"] for r in I.rejected(spark, f"{where}/bronze").collect()) == list(range(7))
    assert str(K.read_state(spark, f"{where}/cursor").first()["last_updated"])[:10] == "2024-01-20"


def test_hash_sample_is_repeatable(spark):
    df = spark.range(1000)
    a = S.hash_sample(df, ["id"], 30)
    assert 200 < a.count() < 400 and a.count() == S.hash_sample(df.repartition(7), ["id"], 30).count()
    assert S.hash_sample(df, ["id"], 30, invert=True).count() == 1000 - a.count()


def test_upsert_of_a_null_key_replaces_it(spark, tmp_path):
    from medtable.sources import writers

    path = str(tmp_path / "table")
    for value in (1, 2):
        out = writers.upsert(spark, path, spark.createDataFrame([(None, value), ("a", value)], "k string, v int"), ["k"])
    assert sorted((r.k or "", r.v) for r in out.collect()) == [("", 2), ("a", 2)]


def test_health_summary_of_shared_and_missing_names(spark):
    from medtable.operators.aggregates import health_summary

    patient = spark.createDataFrame([("p", "n", "male", "1980-01-01")], "patient_id string, name_text string, gender string, birth_date string")
    patient = patient.withColumn("birth_date", patient.birth_date.cast("date"))
    seen = [("p", "o1", "c1", "Glucose", 1.0, "u", "2024-01-01"), ("p", "o2", "c2", "Glucose", 2.0, "u", "2024-01-02"), ("p", "o3", None, None, 3.0, "u", "2024-01-03")]
    observation = spark.createDataFrame(seen, "patient_id string, observation_id string, code_code string, code_display string, value double, unit string, issued_datetime string")
    condition = spark.createDataFrame([], "patient_id string, clinical_status string, code_display string")
    encounter = spark.createDataFrame([("p", "e", None, "2024-01-01", "r")], "patient_id string, encounter_id string, type_display string, start_datetime string, reason_display string")
    row = health_summary(patient, observation, condition, encounter, "2024-06-01").collect()[0]
    assert {k: v["value"] for k, v in row.lab_results.items()} == {"Glucose": 2.0, "Unknown": 3.0} and row.encounters_by_type == {"Unknown": 1}


@pytest.mark.parametrize("sizes", [(400,), (37, 200, 5, 158)])
def test_alert_stream_equals_the_batch_for_any_split(spark, sizes):
    """Rows up to six hours out of order, in any batches."""
    import datetime
    import random

    from medtable.operators import alerts as L

    rnd = random.Random(8)
    start = datetime.datetime(2024, 1, 1)
    rules = [L.Definition("low", "m.*", "lt", 0.45, lookback_hours=6, min_samples=3, cooldown_minutes=300), L.Definition("high", "m.a", "gt", 0.6, lookback_hours=2, cooldown_minutes=60)]
    cols = "ts TIMESTAMP, metric STRING, resource_type STRING, pipeline_stage STRING, value DOUBLE"
    rows = [(start + datetime.timedelta(minutes=15 * k + rnd.randrange(360)), rnd.choice(["m.a", "m.b", "x"]), "P", "gold", rnd.choice([None, *[round(rnd.random(), 3)] * 9])) for k in range(400)]
    where, at = scratch_dir(spark, "t"), 0
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for n in sizes:
            spark.createDataFrame(rows[at:at + n], cols).coalesce(1).write.mode("append").parquet(f"{where}/in")
            at += n
            out = I.alert_stream(I.file_stream(spark, f"{where}/in", spark.createDataFrame([], cols).schema, 1), f"{where}/out", f"{where}/ckpt", rules, "8 hours")
        for day in (1, 2):
            spark.createDataFrame([(datetime.datetime(2100, 1, day), "x", "P", "gold", 0.0)], cols).coalesce(1).write.mode("append").parquet(f"{where}/in")
            out = I.alert_stream(I.file_stream(spark, f"{where}/in", spark.createDataFrame([], cols).schema, 1), f"{where}/out", f"{where}/ckpt", rules, "8 hours")
        want = L.alert_history(spark.createDataFrame(rows, cols), rules)
        both = [sorted((r["name"], r["triggered_at"], round(r["metric_value"], 9), r["samples"]) for r in df.collect()) for df in (out, want)]
        assert both[0] == both[1] and len(both[0]) > 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_alert_state_does_not_grow_with_history():
    from medtable.operators import alerts as L

    class Held:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    rule = L.Definition("d", "m", "gt", 0.5, lookback_hours=5, cooldown_minutes=120)
    cooldown = I.Cooldown([rule])
    cooldown.state, raised = Held(), []
    for hour in range(1000):
        raised += cooldown.handleInputRows(("d",), iter([{"hour": hour, "total": 1.0, "samples": 1}]), None)
        assert len(cooldown.state.value[0]) <= 5
    assert [r.triggered_at // 3600 for r in raised] == list(range(1, 1001, 2))


@pytest.mark.parametrize("op", ["lt", "lte", "gt", "gte", "eq", "between", "between_excl", "not_between", "not_between_excl", "odd"])
def test_threshold_of_a_value_is_that_of_a_column(spark, op):
    from medtable.functions import scalars
    from medtable.operators import alerts as L

    for upper in (None, 0.6):
        values = [0.0, 0.3, 0.30005, 0.5, 0.6, 0.9]
        rows = spark.createDataFrame([(v,) for v in values], "v DOUBLE").coalesce(1).select("v", scalars.crosses(F.lit(op), F.col("v"), F.lit(0.3), F.lit(upper).cast("double")).alias("hit"))
        rule = L.Definition("d", "m", op, 0.3, upper)
        assert {r["v"]: r["hit"] for r in rows.collect()} == {v: L.crosses(rule, v) for v in values}


def test_delta_without_its_source_is_a_clear_error(spark, tmp_path):
    (tmp_path / "_delta_log").mkdir()
    (tmp_path / "_delta_log" / "00000000000000000000.json").write_text("{}")
    with pytest.raises(NotImplementedError, match="is a Delta table"):
        S.read_auto(spark, str(tmp_path))


def test_order_faults_where_blocks_meet(spark, monkeypatch):
    """A fault between the last row of a block and the first of the next is counted once."""
    where = scratch_dir(spark, "t")
    spark.createDataFrame([(1,), (2,), (5,), (3,), (4,), (6,), (1,)], "a INT").coalesce(1).write.parquet(where)
    for size in (1, 2, 3, 4, 100):
        monkeypatch.setattr(K, "BLOCK_ROWS", size)
        assert tuple(K.order_faults(spark, where, ["a"]).first()) == (7, 2, 0)


def test_made_columns_of_a_sorted_table_are_whole(spark):
    where = scratch_dir(spark, "t")
    rows = spark.range(500).select(F.col("id").cast("string").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("tie"), "id")
    K.write_sorted(rows, where, ["k"], ["tie"], files=3, made={"tie": F.sha2("k", 256)})
    back = spark.read.parquet(where)
    assert back.columns == rows.columns and back.exceptAll(rows).isEmpty() and back.count() == 500
    assert tuple(K.order_faults(spark, where, ["k", "tie"]).first()) == (500, 0, 0)
