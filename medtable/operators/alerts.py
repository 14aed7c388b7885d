"""Alerts and interventions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import scalars as S
from .timeseries import _like, first_of_each


@dataclass(frozen=True)
class Definition:
    """One alert definition; a handful per deployment, so they are compiled into columns."""

    name: str
    pattern: str
    op: str
    lower: float
    upper: float | None = None
    category: str = "validation"
    severity: str = "high"
    resource_types: tuple[str, ...] = ()
    pipeline_stages: tuple[str, ...] = ()
    lookback_hours: int = 24
    min_samples: int = 1
    cooldown_minutes: int = 60

    def matches(self) -> Column:
        hit = F.col("metric").like(_like(self.pattern))
        if self.resource_types:
            hit = hit & F.col("resource_type").isin(list(self.resource_types))
        if self.pipeline_stages:
            hit = hit & F.col("pipeline_stage").isin(list(self.pipeline_stages))
        return hit


def crosses(d: Definition, value: float, tolerance: float = 1e-4) -> bool:
    """C35 for one value, where a state is kept row by row; ``scalars.crosses`` is the same for columns."""
    low, high = d.lower, d.upper
    plain = {"lt": value < low, "lte": value <= low, "gt": value > low, "gte": value >= low, "eq": abs(value - low) <= tolerance}
    if d.op in plain:
        return plain[d.op]
    if high is None:  # what lies below is outside of any range
        return {"not_between": value < low, "not_between_excl": value <= low}.get(d.op, False)
    return {"between": low <= value <= high, "between_excl": low < value < high, "not_between": not low <= value <= high, "not_between_excl": not low < value < high}.get(d.op, False)


def _rules(definitions: Sequence[Definition]) -> Column:
    return F.array(*[F.struct(F.lit(d.name).alias("name"), F.lit(d.category).alias("category"), F.lit(d.severity).alias("severity"),
                              F.lit(d.op).alias("op"), F.lit(float(d.lower)).alias("lower"),
                              F.lit(None if d.upper is None else float(d.upper)).cast("double").alias("upper"),
                              F.lit(d.lookback_hours).alias("lookback_hours"), F.lit(d.min_samples).alias("min_samples"),
                              F.lit(d.cooldown_minutes).alias("cooldown_minutes"),
                              F.col(f"_s{i}").alias("total"), F.col(f"_n{i}").alias("samples")) for i, d in enumerate(definitions)])


def check_alerts(metrics: DataFrame, definitions: Sequence[Definition], as_of: str) -> DataFrame:
    """Mean over each definition's look-back window and whether it triggers.

    All definitions are conditional aggregates of one scan; no join, no shuffle of metrics.
    """
    now = F.lit(as_of).cast("timestamp")
    aggs = []
    for i, d in enumerate(definitions):
        hit = d.matches() & (F.col("ts") >= now - F.expr(f"INTERVAL '{d.lookback_hours}' HOUR")) & (F.col("ts") <= now)
        aggs += [F.sum(F.when(hit, F.col("value"))).alias(f"_s{i}"), F.count(F.when(hit, F.col("value"))).alias(f"_n{i}")]
    rows = metrics.agg(*aggs).select(F.inline(_rules(definitions)))
    value = F.col("total") / F.nullif(F.col("samples"), F.lit(0))
    return rows.withColumn("metric_value", value).withColumn("triggered", (F.col("samples") >= F.col("min_samples")) & (F.col("samples") > 0) & S.crosses(
        F.col("op"), F.col("metric_value"), F.col("lower"), F.col("upper"))).drop("total")


def alert_samples(metrics: DataFrame, definitions: Sequence[Definition], as_of: str, order: Sequence[str], k: int = 10) -> DataFrame:
    """The first ``k`` metrics that each definition's check looks at, as examples for its alert."""
    now = F.lit(as_of).cast("timestamp")
    seen = [F.when(d.matches() & (F.col("ts") >= now - F.expr(f"INTERVAL '{d.lookback_hours}' HOUR")) & (F.col("ts") <= now), F.lit(d.name)) for d in definitions]
    rows = metrics.withColumn("name", F.explode(F.array_compact(F.array(*seen))))
    return first_of_each(rows, ["name"], order, k)


def hourly_totals(metrics: DataFrame, definitions: Sequence[Definition]) -> DataFrame:
    """Sum and count per definition and hour, from one partial aggregate."""
    aggs = []
    for i, d in enumerate(definitions):
        aggs += [F.sum(F.when(d.matches(), F.col("value"))).alias(f"_s{i}"), F.count(F.when(d.matches(), F.col("value"))).alias(f"_n{i}")]
    wide = metrics.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(d.name).alias("name"), F.col(f"_s{i}").alias("total"), F.col(f"_n{i}").alias("samples")) for i, d in enumerate(definitions)])
    return wide.select("hour", F.inline(rows)).where("samples > 0")


def raise_alerts(hourly: DataFrame, definitions: Sequence[Definition]) -> DataFrame:
    """Alerts of an hourly check, honouring look-back, minimum sample and cool-down.

    Input has at most one row per definition and hour of history. A check runs at the end of each hour
    with new metrics and sees the look-back hours up to and including it; the greedy cool-down scan folds
    over the sorted hits.
    """
    if not definitions:
        raise ValueError("no alert definitions")
    hourly = hourly.withColumn("_h", F.floor(F.unix_seconds("hour") / 3600))
    parts = None
    for d in definitions:
        back = Window.partitionBy("name").orderBy("_h").rangeBetween(1 - d.lookback_hours, 0)
        part = hourly.where(F.col("name") == d.name).select("name", "hour", F.sum("total").over(back).alias("_total"), F.sum("samples").over(back).alias("_samples"))
        value = F.col("_total") / F.col("_samples")
        hit = S.crosses(F.lit(d.op), value, F.lit(float(d.lower)), F.lit(None if d.upper is None else float(d.upper)).cast("double"))
        part = part.where((F.col("_samples") >= d.min_samples) & hit).select(
            "name", F.lit(d.category).alias("category"), F.lit(d.severity).alias("severity"), F.lit(d.cooldown_minutes).alias("cooldown_minutes"),
            F.struct((F.unix_seconds("hour") + 3600).alias("at"), value.alias("value"), F.col("_samples").cast("bigint").alias("samples")).alias("_event"))
        parts = part if parts is None else parts.unionByName(part)
    per = parts.groupBy("name", "category", "severity", "cooldown_minutes").agg(F.array_sort(F.collect_list("_event")).alias("_e"))
    empty = F.array().cast("array<struct<at:bigint,value:double,samples:bigint>>")

    def step(kept, x):
        last = F.try_element_at(kept, F.lit(-1))["at"]
        return F.when(last.isNull() | (x["at"] - last >= F.col("cooldown_minutes") * 60), F.concat(kept, F.array(x))).otherwise(kept)

    raised = per.withColumn("_k", F.aggregate("_e", empty, step))
    return raised.select("name", "category", "severity", F.inline("_k")).select(
        "name", "category", "severity", F.timestamp_seconds("at").alias("triggered_at"), F.col("value").alias("metric_value"), "samples")


def alert_history(metrics: DataFrame, definitions: Sequence[Definition]) -> DataFrame:
    """T08 over a stored metric table."""
    return raise_alerts(hourly_totals(metrics, definitions), definitions)


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Counts by status, by severity and by category."""
    keys = ["status", "severity", "category"]
    out = alerts.groupingSets([[k] for k in keys] + [[]], *keys).agg(F.count(F.lit(1)).alias("count"))
    return out.withColumns({k: F.coalesce(k, F.lit("*")) for k in keys})


def current_state(log: DataFrame, key: str, at: str, seq: str, cols: Sequence[str]) -> DataFrame:
    """Latest event per alert or intervention from its status-event log."""
    return log.groupBy(key).agg(F.max_by(F.struct(*cols, at), F.struct(at, seq)).alias("_s"), F.count(F.lit(1)).alias("events"),
                                F.min(at).alias("opened_at")).select(key, "_s.*", "events", "opened_at")


def interventions(state: DataFrame, as_of: str, deadline_hours: int = 24) -> DataFrame:
    """Deadline and overdue flag of interventions that are not finished."""
    due = F.col("opened_at") + F.expr(f"INTERVAL '{deadline_hours}' HOUR")
    open_ = ~F.col("status").isin("completed", "failed")
    return state.withColumn("deadline", due).withColumn("overdue", open_ & (due < F.lit(as_of).cast("timestamp")))


def route_alerts(alerts: DataFrame, routes: Sequence[tuple[str, str, str, int]] = tuple(codes.ROUTES)) -> DataFrame:
    """(category, severity), then (category, any), then (any, severity); null action when none fits.

    The routing rules are configuration, so they become an expression instead of a join.
    """
    def chain(test) -> Column:
        out = F.lit(None).cast("struct<action:string,priority:int>")
        for category, severity, action, priority in reversed(routes):
            cond = test(category, severity)
            if cond is not None:
                out = F.when(cond, F.struct(F.lit(action).alias("action"), F.lit(priority).alias("priority"))).otherwise(out)
        return out

    cat, sev = F.col("category"), F.col("severity")
    exact = chain(lambda c, s: (cat == c) & (sev == s) if "*" not in (c, s) else None)
    by_cat = chain(lambda c, s: (cat == c) if c != "*" and s == "*" else None)
    by_sev = chain(lambda c, s: (sev == s) if c == "*" and s != "*" else None)
    return alerts.withColumn("_r", F.coalesce(exact, by_cat, by_sev)).select(
        *alerts.columns, F.col("_r.action").alias("action"), F.col("_r.priority").alias("priority"))
