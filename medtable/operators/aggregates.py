"""Aggregations (A04-A19, A29-A33, A36-A45): single-pass, with partial aggregation before each shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import scalars as S
from ..functions.skew import exact_quantiles, latest_per, mode_per


def aggregate(df: DataFrame, aggs: dict[str, Column], groupings: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """Filtered, grouped aggregation; the filter is any Column."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(*groupings).agg(*[c.alias(n) for n, c in aggs.items()])


def count_by(df: DataFrame, *cols: str) -> DataFrame:
    """Rows per value."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))


def value_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Count, min, max, mean and sample deviation."""
    return df.groupBy(*keys).agg(F.count(value).alias("count"), F.min(value).alias("min"), F.max(value).alias("max"),
                                 F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def component_values(observation: DataFrame) -> DataFrame:
    """One row per component of an observation, with the subject id."""
    return observation.select(S.last_segment(F.col("subject.reference")).alias("patient_id"), "id", F.explode("component").alias("c")).select(
        "patient_id", "id", S.concept_code(F.col("c.code")).alias("code"), F.col("c.valueQuantity.value").alias("value"))


def measure(df: DataFrame, numerator: Column, denominator: Column, stratify: Sequence[str] = ()) -> DataFrame:
    """Population counts and score in percent, per stratum."""
    n, d = F.count_if(numerator & denominator), F.count_if(denominator)
    return df.groupBy(*stratify).agg(F.count(F.lit(1)).alias("initial_population"), d.alias("denominator"), n.alias("numerator"),
                                     (100 * n / F.nullif(d, F.lit(0))).alias("score"))


def _unpivot(row: DataFrame, cols: Sequence[str], name: str, value: str, prefix: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(f"{prefix}{c}").alias(value)) for c in cols])
    kept = [c for c in row.columns if not c.startswith(prefix)]
    return row.select(*kept, F.inline(pairs))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column and missing share, from one pass over the table."""
    cols = list(cols or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(c).isNull()).alias(f"_n_{c}") for c in cols])
    return _unpivot(row, cols, "field", "null_count", "_n_").withColumn(
        "missing_pct", F.when(F.col("total") > 0, 100 * F.col("null_count") / F.col("total")))


def completeness(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Share of filled cells of a table, in percent."""
    cols = list(cols or df.columns)
    filled = sum((F.count(c) for c in cols[1:]), F.count(cols[0]))
    cells = F.count(F.lit(1)) * len(cols)
    return df.agg(F.count(F.lit(1)).alias("rows"), (100 * filled / F.nullif(cells, F.lit(0))).alias("completeness_pct"))


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows minus distinct keys. Keys are counted where they hash, never in one task."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.sum("_n").alias("total"), F.count(F.lit(1)).alias("distinct"),
                       (F.sum("_n") - F.count(F.lit(1))).alias("duplicates"))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Count per value and percentage of the total.

    The total is a scalar subquery over the counts, so the values never meet in one task.
    """
    counts = count_by(df, col)
    return counts.withColumn("percentage", 100 * F.col("count") / counts.agg(F.sum("count")).scalar())


def demographics(patient: DataFrame, as_of: str) -> DataFrame:
    """Gender and age-group distributions, stacked."""
    ages = patient.withColumn("age_group", S.age_group5(S.age_years(F.col("birth_date"), F.lit(as_of).cast("date"))))
    parts = [distribution(ages, c).select(F.lit(c).alias("attribute"), F.col(c).alias("value"), "count", "percentage")
             for c in ("gender", "age_group")]
    return parts[0].unionByName(parts[1])


def observation_summary(observation: DataFrame) -> DataFrame:
    """Count, mean, min, max, sample deviation and unit per code."""
    return observation.groupBy("code_code", "code_display").agg(
        F.count("observation_id").alias("count"), F.avg("value").alias("mean"), F.min("value").alias("min"),
        F.max("value").alias("max"), F.stddev_samp("value").alias("std"), F.min("unit").alias("unit"))


def condition_summary(condition: DataFrame) -> DataFrame:
    """Count, first category and most common severity and status per code."""
    keys = ["code_code", "code_display"]
    counts = condition.groupBy(*keys).agg(F.count("condition_id").alias("count"),
                                          F.min_by("category", "condition_id").alias("primary_category"))
    return (counts.join(mode_per(condition, keys, "severity", "common_severity"), keys, "left")
            .join(mode_per(condition, keys, "clinical_status", "common_status"), keys, "left"))


def encounter_type_summary(encounter: DataFrame) -> DataFrame:
    """Count, length in hours, most common status and the sorted service list per type."""
    hours = S.stay_hours(F.col("start_datetime"), F.col("end_datetime"))
    stats = encounter.withColumn("_h", hours).groupBy("type_code").agg(
        F.count("encounter_id").alias("count"), F.avg("_h").alias("avg_length_hours"), F.min("_h").alias("min_length_hours"),
        F.max("_h").alias("max_length_hours"))
    services = encounter.where("service_provider IS NOT NULL").select("type_code", "service_provider").distinct()
    services = services.groupBy("type_code").agg(F.concat_ws(", ", F.array_sort(F.collect_list("service_provider"))).alias("service_types"))
    return stats.join(mode_per(encounter, ["type_code"], "status", "common_status"), "type_code", "left").join(services, "type_code", "left")


def bp_readings(observation: DataFrame) -> DataFrame:
    """Systolic and diastolic component values of an observation with their category."""
    def part(code):
        hit = F.filter("component", lambda c: F.exists(c["code"]["coding"], lambda x: x["code"] == code))
        return F.get(hit, F.lit(0))["valueQuantity"]["value"]
    rows = observation.where("component IS NOT NULL").select(
        S.last_segment(F.col("subject.reference")).alias("patient_id"), "id", part("8480-6").alias("systolic"), part("8462-4").alias("diastolic"))
    return rows.withColumn("bp_category", S.bp_category(F.col("systolic"), F.col("diastolic")))


def bp_by_patient(readings: DataFrame) -> DataFrame:
    """Mean, min and max of both pressures and the most common category per patient."""
    aggs = [f(c).alias(f"{c}_{n}") for c in ("systolic", "diastolic") for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max))]
    return readings.groupBy("patient_id").agg(*aggs).join(mode_per(readings, ["patient_id"], "bp_category", "common_category"), "patient_id", "left")


# Fixed: LOINC codes counted as vital signs in the health summary.
HEALTH_VITALS = ["8867-4", "8480-6", "8462-4", "8310-5", "8302-2", "8287-5", "8280-0", "8478-0"]


def health_summary(patient: DataFrame, observation: DataFrame, condition: DataFrame, encounter: DataFrame, as_of: str) -> DataFrame:
    """Newest vital and lab per name, active conditions, encounter counts, newest encounter.

    Maps are keyed by code names, a bounded vocabulary; of several codes with one name the newest value
    wins, and rows without a name or type count as "Unknown". Lab results carry the reference range of that value
    (``ref_low`` and ``ref_high``, if the frame has them) as ``low-high``, empty where there is none. Encounters are counted
    by type. The detail rows of active conditions are a separate, chunked table.
    """
    low, high = (F.col(c).cast("string") if c in observation.columns else F.lit(None).cast("string") for c in ("ref_low", "ref_high"))
    observation = observation.withColumn("_range", F.when(low.isNotNull(), F.concat(low, F.lit("-"), F.coalesce(high, F.lit("")))).otherwise(""))
    rows = observation.where("value IS NOT NULL").withColumns({
        "_name": F.coalesce("code_display", F.lit("Unknown")), "_vital": F.coalesce(F.col("code_code").isin(HEALTH_VITALS), F.lit(False))})
    newest = latest_per(rows, ["patient_id", "_vital", "_name"], ["issued_datetime", "observation_id"], ["value", "unit", "issued_datetime", "_range"])
    reading = ["value", "unit", F.col("issued_datetime").alias("date")]
    entry, lab = F.struct("_name", F.struct(*reading)), F.struct("_name", F.struct(*reading, F.col("_range").alias("reference_range")))
    is_vital = F.col("_vital")
    obs = newest.groupBy("patient_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.when(is_vital, entry)))).alias("vital_signs"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(~is_vital, lab)))).alias("lab_results"))
    active = condition.where("clinical_status = 'active'").groupBy("patient_id", "code_display").agg(F.count(F.lit(1)).alias("_n"))
    conditions = active.groupBy("patient_id").agg(F.array_sort(F.collect_list("code_display")).alias("conditions"), F.sum("_n").alias("active_condition_count"))
    by_type = encounter.withColumn("type", F.coalesce("type_display", F.lit("Unknown"))).groupBy("patient_id", "type").agg(
        F.count(F.lit(1)).alias("_n"), F.max_by(F.struct("type", "start_datetime", "reason_display"), F.struct("start_datetime", "encounter_id")).alias("_last"),
        F.max(F.struct("start_datetime", "encounter_id")).alias("_at"))
    encounters = by_type.groupBy("patient_id").agg(
        F.sum("_n").alias("encounter_count"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "_n")))).alias("encounters_by_type"),
        F.max_by("_last", "_at").alias("most_recent"))
    return (patient.select("patient_id", "name_text", "gender", "birth_date", S.age_years(F.col("birth_date"), F.lit(as_of).cast("date")).alias("age"))
            .join(obs, "patient_id", "left").join(conditions, "patient_id", "left").join(encounters, "patient_id", "left")
            .fillna(0, ["active_condition_count", "encounter_count"]))


def top_code_series(observation: DataFrame, k: int = 5) -> DataFrame:
    """Rows of the k most frequent codes that have more than one row; k rows are broadcast."""
    top = count_by(observation, "code_code").where("count > 1").orderBy(F.desc("count"), "code_code").limit(k)
    return (observation.join(F.broadcast(top.select("code_code")), "code_code", "left_semi")
            .select("code_code", "code_display", F.col("issued_datetime").alias("date"), "value", "unit"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per numeric column count, mean, sample deviation, min, exact quartiles and max."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value")) for c in cols])))
    stats = value_stats(long, ["field"], "value")
    quartiles = exact_quantiles(long, ["field"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return stats.join(F.broadcast(quartiles), "field", "left")


def completeness_score(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Per row 1 - missing / required, with the missing names."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    return df.withColumn("missing_fields", missing).withColumn("completeness", 1 - F.size("missing_fields") / F.lit(float(len(required))))


def batch_quality(scores: DataFrame, kind: str, score: str) -> DataFrame:
    """Mean, min, max and count overall and per type (grouping sets)."""
    return scores.groupingSets([[kind], []], kind).agg(
        F.coalesce(F.col(kind), F.lit("ALL")).alias("scope"), F.avg(score).alias("mean"), F.min(score).alias("min"),
        F.max(score).alias("max"), F.count(score).alias("count")).drop(kind)


def overall_score(weights: dict[str, float]) -> Column:
    """Weighted mean of dimension columns, weights normalised to 1."""
    total = sum(weights.values())
    return sum((F.coalesce(F.col(c), F.lit(0.0)) * (w / total) for c, w in weights.items()), F.lit(0.0))


def field_completeness(df: DataFrame, required: Sequence[str], optional: Sequence[str]) -> DataFrame:
    """Per-field, required and overall completeness from the same single pass."""
    fields = [*required, *optional]
    per_field = null_counts(df, fields).select("field", (1 - F.col("null_count") / F.col("total")).alias("completeness"))
    roll = per_field.agg(F.avg(F.when(F.col("field").isin(list(required)), F.col("completeness"))).alias("required"), F.avg("completeness").alias("overall"))
    total = roll.select(F.inline(F.array(F.struct(F.lit("REQUIRED").alias("field"), F.col("required").alias("completeness")),
                                         F.struct(F.lit("OVERALL").alias("field"), F.col("overall").alias("completeness")))))
    return per_field.unionByName(total)


def high_water(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Newest typed time and row count."""
    return df.groupBy(*keys).agg(F.max(ts).alias("last_updated"), F.count(F.lit(1)).alias("record_count"))


def count_match(left: DataFrame, right: DataFrame, kind: str) -> DataFrame:
    """Row counts per type on both sides, match flag and ratio; joins counts, not rows."""
    a = left.groupBy(kind).agg(F.count(F.lit(1)).alias("source_count"))
    b = right.groupBy(kind).agg(F.count(F.lit(1)).alias("target_count"))
    out = a.join(b, kind, "full").fillna(0, ["source_count", "target_count"])
    return out.withColumns({"matches": F.col("source_count") == F.col("target_count"),
                            "ratio": F.col("target_count") / F.nullif(F.col("source_count"), F.lit(0))})


def run_metric(step: str, kind: str, inputs: DataFrame, outputs: DataFrame, as_of: str) -> DataFrame:
    """One metric row of a transform step, with its loss and status."""
    counts = inputs.agg(F.count(F.lit(1)).alias("i")).withColumn("o", outputs.agg(F.count(F.lit(1))).scalar())
    loss = F.when(F.col("i") > 0, 100 * (F.col("i") - F.col("o")) / F.col("i")).otherwise(0.0)
    return counts.select(F.lit(step).alias("step"), F.lit(kind).alias("resource_type"), F.col("i").alias("input_record_count"),
                         F.col("o").alias("output_record_count"), loss.alias("loss_pct"),
                         F.when(loss > 5, "ERROR").otherwise("SUCCESS").alias("transform_status"), F.lit(as_of).alias("run_time"))


def run_summary(metrics: DataFrame, loss_threshold: float = 5.0) -> DataFrame:
    """Status counts, totals, loss, sorted errors and the alert flag of a run."""
    error = F.col("transform_status") == "ERROR"
    loss = F.try_to_number(F.get_json_object("details", "$.loss_pct"), F.lit("999.9999"))
    totals = metrics.agg(
        F.count(F.lit(1)).alias("resources"), F.count_if(error).alias("errors"), F.count_if(~error).alias("successes"),
        F.sum("input_record_count").alias("total_input"), F.sum("output_record_count").alias("total_output"),
        F.array_sort(F.collect_set(F.when(error, F.concat_ws(": ", "resource_type", F.coalesce(F.get_json_object("details", "$.error"), F.lit("Unknown error")))))).alias("error_list"),
        F.coalesce(F.bool_or(error | (loss > loss_threshold)), F.lit(False)).alias("should_alert"))
    return totals.withColumn("loss_pct", F.when(F.col("total_input") > 0, 100 * (F.col("total_input") - F.col("total_output")) / F.col("total_input")).otherwise(0.0))


def run_checks(metrics: DataFrame, row_threshold: float = 0.99, quality_threshold: float = 0.95,
               step_seconds: dict[str, float] | None = None, memory_max: float = 90, cpu_max: float = 95) -> DataFrame:
    """Parity between tiers, step times, quality and resource use as check rows, all from one aggregate.

    ``metrics`` has step, name, value, metric_type and resource_type.
    """
    steps = step_seconds or {"extract": 300.0, "transform": 600.0, "load": 300.0}
    name, step, value = F.lower("name"), F.col("step"), F.col("value")

    def total(s, word):
        return F.sum(F.when((step == s) & name.rlike(word), value))

    row = metrics.agg(
        *[total(t, "count").alias(f"c_{t}") for t in ("bronze", "silver", "gold")],
        *[total(s, "duration|time").alias(f"d_{s}") for s in steps],
        F.avg(F.when(F.col("metric_type") == "QUALITY", value)).alias("q"),
        F.max(F.when(name.contains("memory"), value)).alias("mem"), F.max(F.when(name.contains("cpu"), value)).alias("cpu"))

    def check(label, measured, limit, good, bad):
        status = F.when(measured.isNull(), "SKIPPED").when(good, "SUCCESS").otherwise(bad)
        return F.struct(F.lit(label).alias("check"), status.alias("status"), measured.cast("double").alias("measured"), F.lit(float(limit)).alias("threshold"))

    checks = []
    for a, b in (("bronze", "silver"), ("silver", "gold")):
        ratio = F.col(f"c_{b}") / F.nullif(F.col(f"c_{a}"), F.lit(0.0))
        checks.append(check(f"{a}_to_{b}_rows", ratio, row_threshold, ratio >= row_threshold, "FAILURE"))
    for s, limit in steps.items():
        checks.append(check(f"{s}_seconds", F.col(f"d_{s}"), limit, F.col(f"d_{s}") <= limit, "WARNING"))
    checks += [check("quality", F.col("q"), quality_threshold, F.col("q") >= quality_threshold, "WARNING"),
               check("memory", F.col("mem"), memory_max, F.col("mem") <= memory_max, "WARNING"),
               check("cpu", F.col("cpu"), cpu_max, F.col("cpu") <= cpu_max, "WARNING")]
    rows = row.select(F.inline(F.array(*checks)))
    rank = F.when(F.col("status") == "FAILURE", 3).when(F.col("status") == "WARNING", 2).when(F.col("status") == "SUCCESS", 1).otherwise(0)
    worst = rows.agg(F.max_by("status", rank).alias("status")).select(F.lit("overall").alias("check"), "status")
    return rows.unionByName(worst, allowMissingColumns=True)


def validity_by_type(results: DataFrame, kind: str) -> DataFrame:
    """Valid count, issues and valid share per type."""
    return results.groupBy(kind).agg(
        F.count(F.lit(1)).alias("total"), F.count_if("is_valid").alias("valid"), F.sum("issue_count").alias("issues"),
        (100.0 * F.count_if("is_valid") / F.count(F.lit(1))).alias("valid_pct"))


def score_matrix(metrics: DataFrame, row: str, col: str, value: str, values: Sequence[str]) -> DataFrame:
    """Pivot of mean scores; the column values are given, so no extra job finds them."""
    return metrics.groupBy(row).pivot(col, list(values)).agg(F.avg(value))


def active(medication: DataFrame) -> DataFrame:
    """F04."""
    return medication.where(F.col("status") == "active")


def vitals_only(observation: DataFrame) -> DataFrame:
    """rows of the vital-sign code set."""
    return observation.where(F.col("code_code").isin(list(codes.VITALS)))
