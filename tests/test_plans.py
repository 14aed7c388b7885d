"""Shapes of the physical plans."""

import re

import pytest

from medtable.operators import aggregates as A
from medtable.operators import rules as R
from medtable.plans import gold
from medtable.plans.catalog import QUERIES
from medtable.sources.star import flat, records, table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return len(re.findall(r"FileScan parquet", plan(df)))


def test_only_the_callback_leaves_the_jvm(spark, sf):
    for name in ("encounter_kpi_g01", "patient_summary_g02", "assessment_q19_q20_q21_q22_q23_q24_q25", "patient_to_gold_e08_e11_e12", "alert_history_t08", "flatten_observation_p12"):
        assert not re.search("BatchEvalPython|ArrowEvalPython|MapInPandas", plan(QUERIES[name](spark, sf))), name
    assert "MapInPandas" in plan(QUERIES["batch_callback_du9_du10"](spark, sf))


def test_no_cartesian_product_anywhere(spark, sf):
    for name in ("patient_summary_g02", "encounter_summary_g03", "patient_timeline_g04", "asof_join_j16", "resolve_references_j18", "alert_routing_j24", "metric_stats_a20_a21_q34", "reconciliation_j06"):
        text = plan(QUERIES[name](spark, sf))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(table(spark, sf, "lineitem").where("l_returnflag = 'R'").select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in text
    text = plan(A.value_stats(flat(spark, sf, "observation").where("status = 'final'"), ["code_code"], "value"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_partkey", "l_quantity", "l_linestatus"}


def test_nested_projection_is_pruned(spark, sf):
    text = plan(records(spark, sf, "Patient").select("id", "gender"))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", text)[0].startswith("c_custkey:bigint")
    assert "c_name" not in text


def test_one_scan_for_all_counters(spark, sf):
    pat = records(spark, sf, "Patient")
    base = scans(pat.select("id"))
    values = [R.expect("not_null", column="gender"), R.expect("in_set", column="gender", value_set=["male"]), R.expect("match_regex", column="birthDate", regex="^1")]
    assert scans(R.run_suite(pat, values)) == base
    assert scans(A.null_counts(flat(spark, sf, "patient"))) == scans(flat(spark, sf, "patient"))
    assert scans(R.basic_validation(pat, "Patient")) == base
    assert scans(R.dimension_report(pat, "Patient", "2002-01-01")) == base


def test_aggregates_are_partial(spark, sf):
    text = plan(gold.active_conditions(flat(spark, sf, "condition")).groupBy("code_code").count())
    assert text.count("HashAggregate") == 2


@pytest.mark.parametrize("name", ["patient_timeline_g04", "wide_dataset_j09"])
def test_no_window_frame_spans_the_table(spark, sf, name):
    assert "Exchange SinglePartition" not in plan(QUERIES[name](spark, sf))
