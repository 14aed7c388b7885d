"""Joins, cohorts and the reference graph.

Children are reduced to one row per key before they meet a unique parent wherever the result allows it.
Plain child-to-parent joins carry no hint: AQE broadcasts a small side and splits a hot partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.paths import path
from ..functions.skew import sequence_within
from ..functions.walk import references


def reconcile(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """Joined pairs, unmatched rows of both sides and match percentage, from counts per key."""
    a = left.groupBy(F.col(left_key).alias("_k")).agg(F.count(F.lit(1)).alias("a"))
    b = right.groupBy(F.col(right_key or left_key).alias("_k")).agg(F.count(F.lit(1)).alias("b"))
    both = a.join(b, "_k", "full")
    known = F.col("_k").isNotNull()
    total = both.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("left_total"), F.coalesce(F.sum("b"), F.lit(0)).alias("right_total"),
                     F.coalesce(F.sum(F.when(known, F.col("a") * F.col("b"))), F.lit(0)).alias("matched"),
                     F.coalesce(F.sum(F.when(F.col("b").isNull(), F.col("a"))), F.lit(0)).alias("left_unmatched"),
                     F.coalesce(F.sum(F.when(F.col("a").isNull(), F.col("b"))), F.lit(0)).alias("right_unmatched"))
    return total.withColumn("match_percentage", F.when(F.col("left_total") > 0, F.round(F.col("matched") / F.col("left_total") * 100, 2)).otherwise(0.0))


def children_of(parent: DataFrame, child: DataFrame, parent_key: str, reference: Column) -> DataFrame:
    """Children whose reference ends in the parent's id; equi-join on the parsed id."""
    return child.withColumn("_pid", S.last_segment(reference)).join(parent.select(F.col(parent_key).alias("_pid")), "_pid").withColumnRenamed("_pid", parent_key)


def wide_dataset(index: DataFrame, key: str, related: dict[str, tuple[DataFrame, Column]], order: str, ident: str,
                 chunk_rows: int = 10_000) -> DataFrame:
    """J09 (D8): one list column per related frame, with its first value as ``<name>_first``.

    Rows of an index entry are numbered per column and cut into chunks of ``chunk_rows``, whatever their number;
    an entry without related rows has chunk 0 with empty lists.
    """
    rows = None
    for name, (df, value) in related.items():
        part = df.select(F.col(key), F.lit(name).alias("_col"), value.cast("string").alias("_v"), F.col(order).alias("_at"), F.to_date(order).alias("_day"),
                         S.row_key(F.col(ident)).alias("_tie")).where("_v IS NOT NULL")
        rows = part if rows is None else rows.unionByName(part)
    rows = sequence_within(rows, [key, "_col"], ["_day", "_at"], "_tie", "_seq").withColumn("chunk", F.floor((F.col("_seq") - 1) / chunk_rows).cast("int"))
    lists = []
    for name in related:
        items = F.array_sort(F.collect_list(F.when(F.col("_col") == name, F.struct("_seq", "_v"))))
        values = F.transform(items, lambda x: x["_v"])
        lists += [values.alias(name), F.get(values, F.lit(0)).alias(f"{name}_first")]
    wide = index.select(key).join(rows.groupBy(key, "chunk").agg(*lists), key, "left")
    empty = F.array().cast("array<string>")
    return wide.withColumns({"chunk": F.coalesce("chunk", F.lit(0)), **{n: F.coalesce(n, empty) for n in related}})


def with_subject(df: DataFrame, patient: DataFrame, *cols: str) -> DataFrame:
    """Attributes of the resolved subject."""
    return df.join(patient.select("patient_id", *cols), "patient_id")


def having(patient: DataFrame, child: DataFrame) -> DataFrame:
    """Patients with at least one child row; child ids are deduplicated before the shuffle."""
    return patient.join(child.select("patient_id").distinct(), "patient_id", "left_semi")


def lacking(patient: DataFrame, child: DataFrame) -> DataFrame:
    """Patients without any child row."""
    return patient.join(child.select("patient_id").distinct(), "patient_id", "left_anti")


def with_condition(cohort: DataFrame, condition: DataFrame, system: str, code: str) -> DataFrame:
    """Cohort members with a condition coded so (nested records)."""
    hits = condition.where(S.has_coding(F.col("code"), system, code))
    return having(cohort, hits.select(S.last_segment(path("subject.reference")).alias("patient_id")))


def with_observation(cohort: DataFrame, observation: DataFrame, system: str, code: str, test: Callable[[Column], Column] | None = None,
                     null_passes: bool = False) -> DataFrame:
    """J13 (D9): cohort members with an observation whose value passes a test."""
    hits = observation.where(S.has_coding(F.col("code"), system, code))
    if test is not None:
        value = path("valueQuantity.value")
        hits = hits.where(F.coalesce(test(value), F.lit(null_passes) & value.isNull()))
    return having(cohort, hits.select(S.last_segment(path("subject.reference")).alias("patient_id")))


def with_demographics(cohort: DataFrame, patient: DataFrame, as_of: str, gender: str | None = None, min_age: int | None = None,
                      max_age: int | None = None) -> DataFrame:
    """Gender and age range (difference of calendar years)."""
    age = S.age_by_year(F.col("birth_date"), F.lit(as_of).cast("date"))
    keep = F.lit(True)
    if gender is not None:
        keep = keep & (F.col("gender") == gender)
    if min_age is not None:
        keep = keep & (age >= min_age)
    if max_age is not None:
        keep = keep & (age <= max_age)
    return having(cohort, patient.where(keep))


def value_at(facts: DataFrame, key: str, column: str, value: str, ts: str, tie: str, as_of: str, values: Sequence[str]) -> DataFrame:
    """Newest value per column at one reference time, one output column each; a pure aggregate."""
    known = facts.where(F.col(ts) <= F.lit(as_of).cast("timestamp")).where(F.col(column).isin(list(values)))
    newest = known.groupBy(key, column).agg(F.max_by(value, F.struct(ts, tie)).alias("_v"))
    return newest.groupBy(key).pivot(column, list(values)).agg(F.max("_v"))


def reference_edges(df: DataFrame, kind: str) -> DataFrame:
    """One row per reference of a record, wherever it stands: source, path with list indices, and parsed target;
    unparsable ones are dropped."""
    found = F.transform(references(df.schema), lambda r: F.struct(r["path"].alias("path"), S.reference_parts(r["reference"]).alias("t")))
    edges = df.select(F.lit(kind).alias("src_type"), F.col("id").alias("src_id"), F.explode(found).alias("e"))
    return edges.where("e.t IS NOT NULL").select("src_type", "src_id", "e.path", F.col("e.t.type").alias("dst_type"), F.col("e.t.id").alias("dst_id"))


#: A record that more than one in ``SHARES`` rows of a frontier have reached is a hub; there can be no more hubs than that.
SHARES = 1_000


def _step(front: DataFrame, hops: DataFrame) -> DataFrame:
    """The records that the edges of a frontier lead to, for each root; several edges may lead to one.

    The roots at a hub are dealt to groups by their hash, one for each share of the frontier that the hub has, and its edges
    stand in all of its groups. The list of hubs has at most ``SHARES`` rows, whatever the data. All other roots move to the edges, which
    are where their record is already.
    """
    sizes = front.groupBy("node").agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n")).scalar()
    hubs = F.broadcast(sizes.where(F.col("_n") * SHARES > total).select("node", F.ceil(F.col("_n") * SHARES / total).cast("int").alias("_groups")))
    cold = front.join(hubs, "node", "left_anti").join(hops, "node")
    dealt = front.join(hubs, "node").withColumn("_group", F.pmod(F.xxhash64("root"), "_groups").cast("int")).drop("_groups")
    edges = hops.join(hubs, "node").select("node", "to", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)).alias("_group"))
    hot = dealt.join(edges, ["node", "_group"])
    return cold.select("root", "to").unionByName(hot.select("root", "to")).withColumnRenamed("to", "node")


def resolve(roots: DataFrame, edges: DataFrame, depth: int = 2, include: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Records reachable from each root within ``depth`` steps, each once at its smallest depth.

    One plan without jobs of its own: a frontier is the distinct (root, record) pairs of a step, and the smallest depth
    is taken at the end, so circles end with the depth. The edges are dealt out by their record once: the first frontier is made of them
    where they are, later ones come to them, and what was found comes back to its root.
    """
    hops = edges.where(~F.col("dst_type").isin(list(exclude))) if exclude else edges
    hops = hops.where(F.col("dst_type").isin(list(include))) if include else hops
    # one type for both ends, else joins compare casts of them and move the edges again
    start, end = (F.struct(F.col(f"{x}_type").alias("type"), F.col(f"{x}_id").alias("id")).cast("struct<type:string,id:string>") for x in ("src", "dst"))
    # an edge from a record to itself leads nowhere
    hops = hops.select(start.alias("node"), end.alias("to")).where("node <> to").repartition("node").distinct()
    # edges are distinct, so the first frontier is; the last one is not walked any further, and is reduced with the others at the end
    front = hops.join(roots.select(start.alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias("root"), F.col("to").alias("node"))
    found = front.withColumn("depth", F.lit(1))
    for level in range(2, depth + 1):
        # the roots of the first step are distinct, so none of them is a hub
        front = _step(front if level == 2 else front.distinct(), hops)
        found = found.unionByName(front.where("node <> root").repartition("root").withColumn("depth", F.lit(level)))
    best = found.groupBy("root", "node").agg(F.min("depth").alias("depth"))
    return best.select(F.col("root.type").alias("root_type"), F.col("root.id").alias("root_id"), "node.type", "node.id", "depth")


def report_results(report: DataFrame, observation: DataFrame) -> DataFrame:
    """Observations of a report's result list; a reference without a record is marked missing."""
    refs = report.select(F.col("id").alias("report_id"), F.posexplode("result").alias("position", "ref")).select(
        "report_id", "position", S.last_segment(F.col("ref.reference")).alias("observation_id"))
    obs = observation.select(F.col("id").alias("observation_id"), path("code.coding[0].display").alias("display"), path("valueQuantity.value").alias("value"), F.lit(True).alias("_hit"))
    return refs.join(obs, "observation_id", "left").withColumn("missing", F.col("_hit").isNull()).drop("_hit")


def everything(patient: DataFrame, frames: dict[str, DataFrame], made: dict[str, tuple[Column, Callable[..., DataFrame]]] | None = None) -> DataFrame:
    """A patient's record and every record that refers to it, as (patient_id, resource_type, id, json).

    ``made`` names types whose frames hold the rows that records are made of: the subject of a row, and a function that makes the
    records and keeps the columns named after the frame. Those are made after the rows have met their patients, so no record is moved.
    """
    def row(kind, df):
        whole = F.to_json(F.struct(*[c for c in df.columns if c != "patient_id"]))
        return df.select("patient_id", F.lit(kind).alias("resource_type"), F.col("id"), whole.alias("json"))

    ids = patient.select(F.col("id").alias("_of"))
    out = row("Patient", patient.withColumn("patient_id", F.col("id")))
    for kind, df in frames.items():
        subject, make = (made or {}).get(kind, (F.col("subject"), lambda rows, *keep: rows))
        # a record becomes text after the join, so the text is not moved
        of = df.withColumn("_of", S.last_segment(subject["reference"])).join(ids, "_of", "left_semi")
        out = out.unionByName(row(kind, make(of, "_of").withColumnRenamed("_of", "patient_id")))
    return out


def code_lookup(concepts: DataFrame, codes_table: DataFrame, key: str, concept: str) -> DataFrame:
    """Display of each coding from a (system, code, display) table; a concept is valid if any coding is.

    Codings are reduced to distinct (key, system, code); the table side is broadcast by AQE when small.
    """
    codings = concepts.select(key, F.explode(F.col(concept)["coding"]).alias("c")).select(key, "c.system", "c.code").distinct()
    hit = codings.join(codes_table.select("system", "code", F.col("display").alias("known_display")), ["system", "code"], "left")
    return hit.groupBy(key).agg(F.bool_or(F.col("known_display").isNotNull()).alias("valid"), F.count(F.lit(1)).alias("codings"),
                                F.min("known_display").alias("display"))


def subject_issues(patient: DataFrame, child: DataFrame, kind: str) -> DataFrame:
    """Children without a subject, or whose subject is no known patient; one row if there is no patient at all."""
    ref = path("subject.reference")
    rows = child.select("id", ref.alias("ref"), S.last_segment(ref).alias("patient_id"))
    missing = rows.where("ref IS NULL").select(F.lit(kind).alias("resource_type"), F.col("id").alias("resource_id"), F.lit("Missing subject reference to patient").alias("message"))
    ids = patient.select(F.col("id").alias("patient_id"))
    stray = rows.where("ref IS NOT NULL").join(ids, "patient_id", "left_anti").select(
        F.lit(kind).alias("resource_type"), F.col("id").alias("resource_id"), F.concat(F.lit("Subject reference '"), "ref", F.lit("' does not match a patient")).alias("message"))
    none = ids.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(
        F.lit("Patient").alias("resource_type"), F.lit(None).cast("string").alias("resource_id"), F.lit("No patient resource found").alias("message"))
    return missing.unionByName(stray).unionByName(none)


def last_dates(df: DataFrame, keys: Sequence[str], date: str, n: int) -> DataFrame:
    """Rows on the last ``n`` distinct dates of each key. The rank sees distinct dates, not rows."""
    dates = df.where(F.col(date).isNotNull()).select(*keys, date).distinct()
    recent = dates.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(date)))).where(F.col("_r") <= n).drop("_r")
    return df.join(recent, [*keys, date], "left_semi")


def one_per(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """One deterministic row of attributes per key."""
    return df.groupBy(key).agg(F.min(F.struct(*cols)).alias("_s")).select(key, "_s.*")


def map_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """D-U9, D-U10: escape hatch, a callback on Arrow batches of a frame as pandas."""
    def run(batches: Iterator):
        for batch in batches:
            yield fn(batch)
    return df.mapInPandas(run, schema)
