"""Building blocks that stay balanced when one key holds a large share of the rows.

None of them hands a whole key to one task: they aggregate before the shuffle, or split a key
into ordered sub-groups and add the offsets of the earlier sub-groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Newest row per key as a partial and a final aggregate.

    No window: a hot key is reduced before the shuffle. Aggregates of structs are sorted by key, so rows are sorted
    before and after it.
    """
    best = F.max_by(F.struct(*cols), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*")


def distinct_list(df: DataFrame, keys: Sequence[str], value: str, out: str, count_out: str,
                  extra: Sequence[Column] = (), extra_merge: Sequence[Column] = ()) -> DataFrame:
    """Sorted distinct values and the row count per key.

    The first aggregate is keyed by (key, value), which spreads a hot key over its values and
    leaves the second one a row per distinct value.
    """
    first = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"), *extra)
    return first.groupBy(*keys).agg(
        F.array_sort(F.collect_list(value)).alias(out), F.sum("_n").alias(count_out), *extra_merge)


def match(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join on equally named columns, keeping the left names."""
    other = right.select(*[F.col(c).alias(f"_r_{c}") if c in cols else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    joined = left.join(other, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{c}" for c in cols])


def prefix_counts(counts: DataFrame, steps: Sequence[str], n: str, out: str) -> DataFrame:
    """Segmented prefix sum: for each row of ``counts`` the sum of ``n`` over the rows of its segment that come before.

    ``steps`` are nested structs, from the segment to the row: each holds the one before as ``up`` and a further part of the
    order as ``at``. A window sees the distinct ``at`` values under one ``up``, never a whole segment: sums of
    the coarse parts are added to those inside a part.
    """
    *coarse, last = steps
    total = counts.withColumn(out, _before(n, last))
    for step in reversed(coarse):
        sums = counts.groupBy(step).agg(F.sum(n).alias("_s")).withColumn("_earlier", _before("_s", step)).drop("_s")
        total = total.join(sums, step).withColumn(out, F.col(out) + F.col("_earlier")).drop("_earlier")
    return total


def _before(n: str, step: str) -> Column:
    earlier = Window.partitionBy(F.col(step)["up"]).orderBy(F.col(step)["at"]).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(earlier), F.lit(0))


#: Rows of a key that one task may put in order; a key with more of them is cut into cells.
HOT_ROWS = 50_000


def sequence_within(df: DataFrame, keys: Sequence[str], levels: Sequence[str], tie: str, out: str, made: dict[str, Column] | None = None,
                    ranged: bool = False, parts: int | None = None) -> DataFrame:
    """Exact 1..n position per key in the order of ``levels`` (coarse to fine, each a prefix of the next one's
    order, such as the day of a time and the time) and ``tie``, a hex digest.

    One plan for all keys, whatever they hold. A key of at most ``HOT_ROWS`` rows is one cell. The rows of any other key
    are cut into cells (key, levels, first digits of the tie), and a segmented prefix sum over their counts gives each its
    offset, which arrives as a row of its own ahead of the cell's; there are no more such keys than the rows of the table over ``HOT_ROWS``.
    Rows move once and are sorted once. Keys and levels may be null, which groups like a value.

    ``made`` names columns, levels and tie among them, that follow from the others: they are computed where the rows have
    arrived, so they are not moved. ``ranged`` deals the cells out by ranges instead of hashes: the partitions of the result then
    follow each other in the order of keys, levels and tie, each sorted inside, as ``write_sorted`` stores them.
    Without ``parts`` their number follows the size that AQE aims at.
    """
    made, key = made or {}, F.struct(*keys)

    def value(name: str) -> Column:
        return made.get(name, F.col(name))

    sizes = df.select(key.alias("_key")).groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(sizes.where(F.col("_n") > HOT_ROWS).select("_key", F.lit(True).alias("_hot")))

    # counts of the hot keys' cells: structs compare null with null
    step, steps = key, {}
    for k, level in enumerate(levels[:-1]):
        step = F.struct(step.alias("up"), value(level).alias("at"))
        steps[f"_step{k}"] = step
    steps["_cell"] = F.struct(step.alias("up"), F.struct(value(levels[-1]).alias("_l"), F.substring(value(tie), 1, 2).alias("_p")).alias("at"))
    counts = df.withColumn("_key", key).join(hot, "_key", "left_semi").select(*[c.alias(n) for n, c in steps.items()])
    offsets = prefix_counts(counts.groupBy(*steps).agg(F.count(F.lit(1)).alias("_n")), [*steps], "_n", "_off")

    cells = [*[f"_at{k}" for k in range(len(levels))], "_first"]
    inside = [value(level) for level in levels] + [F.substring(value(tie), 1, 2)]
    rows = df.withColumn("_key", key).join(hot, "_key", "left").withColumns({c: F.when(F.col("_hot"), v) for c, v in zip(cells, inside)}).drop("_key", "_hot")
    at = [F.col("_cell.at._l"), F.col("_cell.at._p")]
    up = F.col("_cell")["up"]
    for _ in levels[:-1]:
        at.insert(0, up["at"])
        up = up["up"]
    marks = offsets.select(*[up[k].alias(k) for k in keys], *[v.alias(c) for c, v in zip(cells, at)], (F.col("_off") - 1).alias("_off"))
    rows = rows.unionByName(marks, allowMissingColumns=True)
    number = [parts] if parts else []
    rows = (rows.repartitionByRange(*number, *keys, *cells) if ranged else rows.repartition(*number, *cells, *keys)).withColumns(made)
    in_cell = Window.partitionBy(*keys, *cells).orderBy(F.col("_off").isNull(), *levels, tie)
    before = F.coalesce(F.first("_off").over(in_cell.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0))
    placed = rows.withColumn(out, (F.row_number().over(in_cell) + before).cast("bigint")).where(F.col("_off").isNull())
    return placed.select(*df.columns, *[c for c in made if c not in df.columns], out)


def earlier_count(df: DataFrame, key: str, ts: str, out: str) -> DataFrame:
    """Rows of the same key with a strictly earlier time.

    Works on counts per (key, instant): a running sum over the days of a key, then over the
    instants of a day. Rows without a time count nothing and get 0.
    """
    counts = df.where(F.col(ts).isNotNull()).groupBy(key, ts).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_day", F.to_date(ts))
    days = counts.groupBy(key, "_day").agg(F.sum("_n").alias("_day_n"))
    prior_days = Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(key, "_day", F.sum("_day_n").over(prior_days).alias("_a"))
    prior = Window.partitionBy(key, "_day").orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("_b", F.sum("_n").over(prior)).join(days, [key, "_day"])
               .select(key, ts, (F.coalesce("_a", F.lit(0)) + F.coalesce("_b", F.lit(0))).alias(out)))
    return df.join(offsets, [key, ts], "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def chunked_list(df: DataFrame, keys: Sequence[str], levels: Sequence[str], tie: str, value: Column, out: str, chunk_rows: int = 10_000,
                 made: dict[str, Column] | None = None) -> DataFrame:
    """All values per key in order, as one array for every ``chunk`` of ``chunk_rows`` rows, numbered from 0.

    The rule is the same for every key and size; results stay whole and no array outgrows a task. ``made`` as for
    ``sequence_within``.
    """
    seq = sequence_within(df, keys, levels, tie, "_seq", made)
    seq = seq.withColumn("chunk", F.floor((F.col("_seq") - 1) / chunk_rows).cast("int"))
    items = F.array_sort(F.collect_list(F.struct(F.col("_seq"), value.alias("_v"))))
    return seq.groupBy(*keys, "chunk").agg(F.transform(items, lambda x: x["_v"]).alias(out))


def mode_per(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Most frequent non-null value per key, smallest value on ties; counts first, then picks."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(F.col(value), F.struct(-F.col("_n"), F.col(value))).alias(out))


def quantile_cells(vals: DataFrame, keys: Sequence[str], cells: int) -> DataFrame:
    """Distinct values (keys, ``_v``) with their weight ``_n``, the total weight ``_t`` of their key, and a cell each.

    A mergeable sketch of each key's distinct values gives the borders, so every cell has about an equal number of them,
    wherever they lie: an outlier moves no border.
    """
    step = [k / cells for k in range(1, cells)]
    cuts = vals.groupBy(*keys).agg(F.percentile_approx("_v", step, 20 * cells).alias("_cuts"), F.sum("_n").alias("_t"))
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    rows = vals.alias("a").join(cuts.alias("b"), on)
    # how many borders lie below the value, by halved steps
    halves = F.array(*[F.lit(1 << k) for k in range(cells.bit_length() - 1, -1, -1)])
    below = F.aggregate(halves, F.lit(0), lambda p, s: F.when((p + s < cells) & (F.get(F.col("_cuts"), p + s - 1) < F.col("_v")), p + s).otherwise(p))
    return rows.select(*[f"a.{k}" for k in keys], "_v", "_n", "_t", below.alias("_cell"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, wanted: dict[str, float],
                    weight: str | None = None, cells: int = 256) -> DataFrame:
    """Exact interpolated quantiles per key by narrowing, so that no task holds a key's values.

    Values are first reduced to (key, value, count) and dealt to ``cells`` cells of about equally many values. The weights of
    the cells tell which of them hold the wanted ranks, and only those are put in order.
    """
    keys = list(keys)
    vals = df.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("_v"), (F.col(weight) if weight else F.lit(1)).alias("_w"))
    vals = quantile_cells(vals.groupBy(*keys, "_v").agg(F.sum("_w").alias("_n")), keys, cells)
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    hist = vals.groupBy(*keys, "_cell").agg(F.sum("_n").alias("_c"), F.max("_t").alias("_t"))
    upto = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn("_before", F.coalesce(F.sum("_c").over(upto), F.lit(0)))

    def ranks(q: float) -> list[Column]:
        at = (F.col("_t") - 1) * F.lit(q)
        return [F.floor(at) + 1, F.ceil(at) + 1]

    def holds(rank: Column) -> Column:
        return (F.col("_before") < rank) & (F.col("_before") + F.col("_c") >= rank)

    need = F.lit(False)
    for q in wanted.values():
        for rank in ranks(q):
            need = need | holds(rank)
    hits = hist.where(need).select(*keys, "_cell", "_before")
    on.append(F.col("a._cell") == F.col("b._cell"))
    part = vals.alias("a").join(hits.alias("b"), on)
    part = part.select(*[f"a.{k}" for k in keys], "a._cell", "_v", "_n", "_t", "_before")
    run = Window.partitionBy(*keys, "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    part = part.withColumn("_last", F.col("_before") + F.sum("_n").over(run))
    part = part.withColumn("_first", F.col("_last") - F.col("_n") + 1)

    def at_rank(rank: Column) -> Column:
        return F.max(F.when(rank.between(F.col("_first"), F.col("_last")), F.col("_v")))

    picks = []
    for name, q in wanted.items():
        low, high = ranks(q)
        share = F.max((F.col("_t") - 1) * F.lit(q) - F.floor((F.col("_t") - 1) * F.lit(q)))
        picks.append((at_rank(low) + (at_rank(high) - at_rank(low)) * share).alias(name))
    return part.groupBy(*keys).agg(*picks)


def asof_last(refs: DataFrame, facts: DataFrame, key: str, ref_ts: str, fact_ts: str, fact_tie: str,
              value: str, out: str) -> DataFrame:
    """Newest fact at or before each reference row, without a range join.

    The last fact of a day is carried over the days of a key, the last one of a minute over the minutes of a day, and
    inside a minute references and facts are merged in time order. Work per task is bounded by a key's days, a
    day's minutes or the rows of one key in one minute.
    """
    facts = facts.select(key, F.col(fact_ts).alias("_ts"), F.col(fact_tie).cast("string").alias("_tie"),
                         F.struct(F.col(value).alias("v")).alias("_v"))
    facts = facts.where(F.col("_ts").isNotNull()).withColumns({"_day": F.to_date("_ts"), "_minute": F.date_trunc("minute", "_ts")})
    known = refs.where(F.col(ref_ts).isNotNull() & F.col(key).isNotNull())
    unknown = refs.where(F.col(ref_ts).isNull() | F.col(key).isNull())
    cols = refs.columns
    marks = known.select(key, F.col(ref_ts).alias("_ts"), F.to_date(ref_ts).alias("_day"), F.date_trunc("minute", ref_ts).alias("_minute"), F.struct(*cols).alias("_row"))
    in_minutes = facts.groupBy(key, "_day", "_minute").agg(F.max_by("_v", F.struct("_ts", "_tie")).alias("_end"))
    in_days = in_minutes.groupBy(key, "_day").agg(F.max_by("_end", "_minute").alias("_end"))

    def carried(ends: DataFrame, segment: list[str], step: str, out_col: str) -> DataFrame:
        """For each step of a reference, the last fact of the earlier steps of its segment."""
        at = [*segment, step]
        steps = marks.select(*at).distinct().unionByName(ends.select(*at, "_end"), allowMissingColumns=True)
        steps = steps.groupBy(*at).agg(F.first("_end", ignorenulls=True).alias("_end"))
        prior = Window.partitionBy(*segment).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
        return steps.select(*at, F.last("_end", ignorenulls=True).over(prior).alias(out_col))

    by_day, by_minute = carried(in_days, [key], "_day", "_before_day"), carried(in_minutes, [key, "_day"], "_minute", "_before_minute")
    stream = (facts.withColumn("_is_ref", F.lit(0))
              .unionByName(marks.withColumn("_is_ref", F.lit(1)), allowMissingColumns=True))
    merged = Window.partitionBy(key, "_day", "_minute").orderBy("_ts", "_is_ref", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    seen = (stream.withColumn("_inside", F.last("_v", ignorenulls=True).over(merged)).where(F.col("_is_ref") == 1)
            .join(by_minute, [key, "_day", "_minute"], "left").join(by_day, [key, "_day"], "left"))
    found = seen.select("_row.*", F.coalesce("_inside", "_before_minute", "_before_day").getField("v").alias(out))
    return found.unionByName(unknown, allowMissingColumns=True)
