"""Metric series (W04, W05, W10, A20-A28, F14, Q34): buckets first, so later steps see a row per bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.skew import exact_quantiles

# Fixed: interval name -> truncation unit (weeks start on Monday, labels are bucket starts).
INTERVALS = {"1h": "hour", "1d": "day", "1w": "week", "1m": "month"}
STABLE_SLOPE, STABLE_R2 = 0.01, 0.3


def query_metrics(df: DataFrame, pattern: str = "*", labels: dict[str, Sequence[str]] | None = None,
                  start: str | None = None, end: str | None = None) -> DataFrame:
    """name wildcard, label filters and time range."""
    if "*" not in pattern:
        rows = df.where(F.col("metric") == pattern)
    else:
        rows = df.where(F.col("metric").like(_like(pattern)))
    for name, allowed in (labels or {}).items():
        rows = rows.where(F.col(name).isin(list(allowed)))
    if start:
        rows = rows.where(F.col("ts") >= F.lit(start).cast("timestamp"))
    if end:
        rows = rows.where(F.col("ts") <= F.lit(end).cast("timestamp"))
    return rows


def _like(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_").replace("*", "%")


def resample(df: DataFrame, keys: Sequence[str], interval: str) -> DataFrame:
    """Mean per time bucket; empty buckets are absent."""
    return df.groupBy(*keys, F.date_trunc(INTERVALS[interval], "ts").alias("ts")).agg(F.avg("value").alias("value"), F.count("value").alias("samples"))


def _stats(value: str) -> list[Column]:
    return [F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"),
            F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std"), F.count(value).alias("count")]


def metric_stats(df: DataFrame, kind: str = "resource_type", dimension: str = "dimension") -> DataFrame:
    """Statistics per (type, dimension), per type, per dimension and overall, with exact medians.

    One grouping-sets aggregate gives everything but the median; the medians start from value counts,
    which are expanded to the four levels.
    """
    rows = df.select(F.col(kind).alias("resource_type"), F.col(dimension).alias("dimension"), "value")
    both = ["resource_type", "dimension"]
    stats = rows.groupingSets([both, ["resource_type"], ["dimension"], []], *both).agg(F.grouping_id().alias("_g"), *_stats("value"))
    stats = stats.select(_scope(F.col("_g").cast("int")).alias("scope"), _level("resource_type"), _level("dimension"), "mean", "min", "max", "std", "count")
    counts = rows.groupBy(*both, "value").agg(F.count(F.lit(1)).alias("_n"))
    levels = F.explode(F.array(*[F.lit(g) for g in range(4)])).alias("_g")
    wide = counts.select("*", levels).select(
        _scope(F.col("_g")).alias("scope"), F.when(F.col("_g") < 2, F.col("resource_type")).otherwise("*").alias("resource_type"),
        F.when(F.col("_g") % 2 == 0, F.col("dimension")).otherwise("*").alias("dimension"), "value", "_n")
    keys = ["scope", "resource_type", "dimension"]
    medians = exact_quantiles(wide, keys, "value", {"median": 0.5}, weight="_n")
    return stats.join(medians, keys, "left")


def _level(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("*")).alias(name)


def _scope(g: Column) -> Column:
    return F.when(g == 0, "both").when(g == 1, "resource_type").when(g == 2, "dimension").otherwise("overall")


def trends(series: DataFrame, keys: Sequence[str], min_points: int = 3) -> DataFrame:
    """Least-squares trend over the position 0..n-1 of a bucketed series.

    Input has one row per key and bucket, so the window holds a key's buckets, not its metrics.
    """
    position = (F.row_number().over(Window.partitionBy(*keys).orderBy("ts")) - 1).cast("double")
    fit = series.withColumn("_x", position).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("points"), F.regr_slope("value", "_x").alias("slope"), F.regr_intercept("value", "_x").alias("intercept"),
        F.when(F.var_pop("value") == 0, 0.0).otherwise(F.regr_r2("value", "_x")).alias("r_squared"),
        F.min_by("value", "ts").alias("initial_value"), F.max_by("value", "ts").alias("final_value"))
    change = F.col("final_value") - F.col("initial_value")
    return fit.where(F.col("points") >= min_points).withColumns({
        "change": change,
        "percent_change": F.when(F.col("initial_value") != 0, change / F.col("initial_value") * 100).otherwise(0.0),
        "direction": F.when((F.abs("slope") < STABLE_SLOPE) | (F.col("r_squared") < STABLE_R2), "stable")
        .when(F.col("slope") > 0, "improving").otherwise("declining")})


def trend_rollup(fitted: DataFrame, by: str = "dimension") -> DataFrame:
    """Mean slope and direction per dimension, and the counts of each direction."""
    counts = {d: F.count_if(F.col("direction") == d).alias(f"{d}_count") for d in ("improving", "declining", "stable")}
    rolled = fitted.groupBy(by).agg(F.avg("slope").alias("slope"), F.count(F.lit(1)).alias("series_count"), *counts.values())
    return rolled.withColumn("direction", F.when(F.abs("slope") < STABLE_SLOPE, "stable").when(F.col("slope") > 0, "improving").otherwise("declining"))


def compare_periods(df: DataFrame, baseline: tuple[str, str], comparison: tuple[str, str]) -> DataFrame:
    """Change of mean, min and max overall, per dimension, per type and per both, from one pass.

    Only keys that occur in both periods are kept.
    """
    def inside(p):
        return (F.col("ts") >= F.lit(p[0]).cast("timestamp")) & (F.col("ts") <= F.lit(p[1]).cast("timestamp"))

    rows = df.where(inside(baseline) | inside(comparison)).select(
        "resource_type", "dimension", F.when(inside(baseline), F.col("value")).alias("b"), F.when(inside(comparison), F.col("value")).alias("c"))
    both = ["resource_type", "dimension"]
    agg = rows.groupingSets([both, ["resource_type"], ["dimension"], []], *both).agg(
        F.grouping_id().cast("int").alias("_g"), F.avg("b").alias("bm"), F.avg("c").alias("cm"), F.min("b").alias("bn"), F.min("c").alias("cn"),
        F.max("b").alias("bx"), F.max("c").alias("cx"))
    diff = F.col("cm") - F.col("bm")
    return agg.where("bm IS NOT NULL AND cm IS NOT NULL").select(
        _scope(F.col("_g")).alias("scope"), _level("resource_type"), _level("dimension"), diff.alias("mean_change"),
        F.when(F.col("bm") != 0, diff / F.col("bm") * 100).otherwise(0.0).alias("mean_percent_change"),
        (F.col("cn") - F.col("bn")).alias("min_change"), (F.col("cx") - F.col("bx")).alias("max_change"),
        F.when(diff > 0, "improving").when(diff < 0, "declining").otherwise("stable").alias("direction"))


def severity_norm(severity: Column) -> Column:
    """Fatal counts as error, unknown names as warning."""
    return F.when(severity == "fatal", "error").when(severity.isin("error", "warning", "information"), severity).otherwise("warning")


def issue_counts(issues: DataFrame) -> DataFrame:
    """Issues per severity and category with the five most frequent messages of each.

    The rank is filtered before anything is collected, so Spark limits each group ahead of the shuffle.
    """
    keys = ["severity", "category"]
    labelled = issues.select(severity_norm(F.col("severity")).alias("severity"), S.issue_category(F.col("message")).alias("category"), "message")
    counts = labelled.groupBy(*keys, "message").agg(F.count(F.lit(1)).alias("_n"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_n"), "message"))
    top = counts.withColumn("_r", rank).where(F.col("_r") <= 5).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_r", "message"))).alias("_t"))
    totals = labelled.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return totals.join(top, keys).select(*keys, "count", F.transform("_t", lambda x: x["message"]).alias("top_messages"))


def first_of_each(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int) -> DataFrame:
    """The first ``k`` rows of each key. The rank is filtered, so Spark keeps ``k`` rows of a key in each task
    before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("position", rank).where(F.col("position") <= k)


def batch_validation(results: DataFrame) -> DataFrame:
    """Validation rate and issues per resource, per type and in total (rollup)."""
    return results.rollup("resource_type").agg(
        F.count(F.lit(1)).alias("resources"), F.count_if("is_valid").alias("valid"), F.sum("issue_count").alias("issues"),
        (F.count_if("is_valid") / F.count(F.lit(1))).alias("validation_rate"), (F.sum("issue_count") / F.count(F.lit(1))).alias("issues_per_resource")
    ).withColumn("resource_type", F.coalesce("resource_type", F.lit("ALL")))


def validation_summary(results: DataFrame) -> DataFrame:
    """Overall, by type, by validation type, by stage and by all three, from one grouping-sets pass."""
    keys = ["resource_type", "validation_type", "pipeline_stage"]
    out = results.groupingSets([[], [keys[0]], [keys[1]], [keys[2]], keys], *keys).agg(
        F.count(F.lit(1)).alias("resources"), F.count_if("is_valid").alias("valid"), F.sum("issue_count").alias("issues"),
        (F.count_if("is_valid") / F.count(F.lit(1))).alias("validation_rate"))
    return out.withColumns({k: F.coalesce(k, F.lit("*")) for k in keys})


def validation_metrics(results: DataFrame) -> DataFrame:
    """Q33: one metric row per measure of a validation result."""
    pairs = F.array(F.struct(F.lit("validation.valid").alias("metric"), F.col("is_valid").cast("double").alias("value")),
                    F.struct(F.lit("validation.issue_count").alias("metric"), F.col("issue_count").cast("double").alias("value")))
    return results.select("resource_type", "validation_type", "pipeline_stage", "ts", F.inline(pairs))
