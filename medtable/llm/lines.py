"""Op 6: line deduplication by a segment-partition edit join, in DataFrame functions only.

Lines of at least ``LEAST`` code points are linked if they are within ``EDITS`` edits; shorter ones, from ``SHORT`` code
points on, within ``SHORT_EDITS``, so that a line of n code points has one edit for every 20 of them. All links between
different lines are found. A line is dropped if the same line comes earlier, or one linked to it and both have
``LEAST`` code points: a small edit in a short line may be all that it says.

For the links every line is cut into one segment more than its edits. A line within that distance leaves one segment
whole, so each line probes an index of (segment number, line length, segment) with those of its substrings that can
match, for its own length and the lengths down to its edits less. Lines that meet become a pair unless their character
counts are too far apart, and pairs are verified by a banded bit-parallel edit distance of what is left without their
shared ends. The lines of a key shared by more than ``CELL`` are dealt to cells, each of which meets all of them.

Every row is a document of its own, also with a repeated or null doc_id: rows are ordered by (doc_id, hash of the text,
a number written once), null ids last. Lines are compared without outer white space; blank lines stay. Null and empty
texts have one blank line. Lines are known by 63 bits of a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shielded, table, whole_text, written
from .graph import components
from .registry import query

EDITS = 2
LEAST = 40
SHORT, SHORT_EDITS = 20, 1
#: Lines of a key that meet all its lines in one task.
CELL = 500
#: Characters that are counted to tell lines apart before their texts are compared.
TALLIED = "etaoinshrdlucmfwygpb"
#: Pairs that one task should verify.
PAIRS = 1_000


#: Number of a row, and the hash of its text.
ROW, TEXT = "_line_row", "_line_text"


def numbered(docs: DataFrame) -> DataFrame:
    """Adds what tells rows with one doc_id apart; the numbers hold once they are written."""
    return docs.withColumn(ROW, F.monotonically_increasing_id()).withColumn(TEXT, F.xxhash64(whole_text()))


def split_lines(docs: DataFrame) -> DataFrame:
    """doc_id, number and hash of the row, line_no (from 0), the line without outer white space, its hash and its size."""
    rows = docs.select(F.col("doc_id").cast("bigint"), ROW, TEXT, F.posexplode(F.split(whole_text(), "\n")).alias("line_no", "line"))
    rows = rows.withColumn("line", F.btrim("line", F.lit(" \t\v\f\r")))
    return rows.withColumn("node", F.shiftrightunsigned(F.xxhash64("line"), 1)).withColumn("size", F.length("line"))


def _places(edits: int) -> list[Column]:
    """Segment, how much shorter the other line is, and shift, for every substring of a line that may match a segment."""
    return [F.struct(F.lit(edits).alias("edits"), F.lit(i).alias("i"), F.lit(less).alias("less"), F.lit(shift).alias("shift"))
            for less in range(edits + 1) for i in range(edits + 1) for shift in range(max(-i, less - (edits - i)), min(i, less + (edits - i)) + 1)]


def probes(lines: DataFrame, edits: int, least: int, short_edits: int = SHORT_EDITS) -> DataFrame:
    """(node, key, indexed) for every substring of a line that may match a segment of a line of its length or up to
    ``edits`` shorter; the substrings at the segments' own places are the line's entries in the index (``indexed`` 1).
    Lines under ``least`` have ``short_edits``; lines that are at most so many longer may be near a short one and have both.

    A line is cut into even segments, the longer ones last. Segment ``i`` of a line ``less`` shorter can only match at
    few places: its own, moved by less than what the edits before and after it allow. Each place is a row of its own,
    so that the substring is made by compiled code.
    """
    size = F.col("size")
    places = F.when(size < least, F.array(*_places(short_edits))).when(size < least + short_edits, F.array(*_places(short_edits), *_places(edits))).otherwise(F.array(*_places(edits)))
    rows = lines.select("node", "line", "size", F.explode(places).alias("p"))
    segments, part, other = F.col("p.edits") + F.lit(1), F.col("p.i"), F.col("size") - F.col("p.less")
    longer = other % segments
    size = ((other - longer) / segments).cast("int")
    beyond = part - (segments - longer)  # how many longer segments stand before, from 0 on
    start = size * part + F.greatest(beyond, F.lit(0)) + F.lit(1) + F.col("p.shift")
    whole = size + (beyond >= 0).cast("int")
    own = (F.col("p.less") == 0) & (F.col("p.shift") == 0)
    inside = (start >= 1) & (start + whole - 1 <= F.col("size"))
    return rows.where(inside).select("node", F.xxhash64(F.col("p.edits"), part, other, F.substring("line", start, whole)).alias("key"), own.cast("bigint").alias("indexed"))


def tally(line: Column) -> list[Column]:
    """How often the line has each character of ``TALLIED``, modulo 64, in bigints of ten counts."""
    counts = [((F.length(line) - F.length(F.replace(line, F.lit(c), F.lit("")))) % 64).cast("bigint") for c in TALLIED]
    return [sum((F.shiftleft(c, 6 * k) for k, c in enumerate(counts[a:a + 10])), F.lit(0).cast("bigint")) for a in range(0, len(TALLIED), 10)]


def tallies_near(a: list[Column], b: list[Column], edits: int) -> Column:
    """False only for lines that are further apart: an edit changes the counts of two characters at most, by one each."""
    mask = F.lit(63).cast("bigint")
    apart = [F.abs(F.shiftrightunsigned(x, 6 * k).bitwiseAND(mask) - F.shiftrightunsigned(y, 6 * k).bitwiseAND(mask)) for x, y in zip(a, b) for k in range(10)]
    return sum((F.least(d, F.lit(64) - d) for d in apart), F.lit(0).cast("bigint")) <= 2 * edits


def may_match(a: Column, b: Column, edits: int, parts: int = 8) -> Column:
    """False only for texts that are further apart: each edit spoils at most one of the parts of ``a``, and
    every other part stands in ``b`` at most ``edits`` places away."""
    size = F.floor(F.length(a) / F.lit(parts)).cast("int")

    def stands(k: Column) -> Column:
        start = size * k + F.lit(1)
        return F.exists(F.array(*[F.lit(x) for x in range(-edits, edits + 1)]),
                        lambda s: (start + s >= 1) & (F.substring(b, start + s, size) == F.substring(a, start, size)))
    return F.size(F.filter(F.array(*[F.lit(k) for k in range(parts)]), stands)) >= parts - edits


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether two texts are within ``edits`` edits: Hyyro's banded form of the bit-vector algorithm.

    Bit k of the vectors stands for row j - edits + k of column j; the band has 2 * edits + 1 rows. The distance is
    followed along the lowest diagonal of the band and then along the last row.
    """
    # values are bound to variables, or they would be made anew for each look at one
    def bound(t: Column, then) -> Column:
        return F.element_at(F.transform(F.array(t), then), 1)

    def both(c: Column, f) -> Column:
        return F.struct(f(c["a"]).alias("a"), f(c["b"]).alias("b"))

    def shared(x: Column, y: Column, place) -> Column:
        """Length of the common start or end (up to 8,191), by halved steps."""
        most = F.least(F.length(x), F.length(y))
        return F.aggregate(F.array(*[F.lit(1 << k) for k in range(12, -1, -1)]), F.lit(0), lambda p, step: F.when(
            (p + step <= most) & (F.substring(x, place(x, p, step), step) == F.substring(y, place(y, p, step), step)), p + step).otherwise(p))

    def apart(t: Column) -> Column:
        m, n = F.length(t["a"]), F.length(t["b"])
        chars = F.struct(F.split(t["a"], "").alias("rows"), F.split(t["b"], "").alias("columns"), m.alias("m"), n.alias("n"))
        near = bound(chars, lambda c: _distance(c["rows"], c["columns"], c["m"], c["n"], edits) <= edits)
        return F.when((m == 0) | (n == 0), F.greatest(m, n) <= edits).otherwise(near)

    def ends(t: Column) -> Column:
        a, b = t["a"], t["b"]
        cut = F.struct(a.alias("a"), b.alias("b"), shared(a, b, lambda x, p, step: F.length(x) - p - step + 1).alias("q"))
        return bound(cut, lambda c: bound(both(c, lambda x: F.substring(x, F.lit(1), F.length(x) - c["q"])), apart))

    # what both start or end with does not change the distance
    starts = F.struct(a.alias("a"), b.alias("b"), shared(a, b, lambda x, p, step: p + 1).alias("p"))
    near = bound(starts, lambda c: bound(both(c, lambda x: F.substring(x, c["p"] + 1, F.length(x))), ends))
    return F.when(F.abs(F.length(a) - F.length(b)) > edits, False).otherwise(near)


def _distance(rows: Column, columns: Column, m: Column, n: Column, edits: int) -> Column:
    width = 2 * edits + 1
    full, low = (1 << width) - 1, 1 << (width - 1)

    def long(x: int) -> Column:
        return F.lit(x).cast("bigint")

    def step(acc: Column, j: Column) -> Column:
        char = F.get(columns, j)
        # row j - edits + k of the band, counted from 0
        match = sum((F.when(F.get(rows, j + F.lit(k - edits)).eqNullSafe(char) & (j + F.lit(k - edits) < m), long(1 << k)).otherwise(long(0)) for k in range(width)), long(0))
        state = F.struct(acc["vp"].alias("vp"), acc["vn"].alias("vn"), acc["d"].alias("d"), match.alias("pm"), j.alias("j"))

        def diagonal(s: Column) -> Column:
            d0 = ((((s["pm"].bitwiseAND(s["vp"])) + s["vp"]).bitwiseXOR(s["vp"])).bitwiseOR(s["pm"]).bitwiseOR(s["vn"])).bitwiseAND(long(full))
            return F.struct(s["vp"].alias("vp"), s["vn"].alias("vn"), s["d"].alias("d"), s["j"].alias("j"), d0.alias("d0"))

        def horizontal(s: Column) -> Column:
            hp = s["vn"].bitwiseOR(F.bitwise_not(s["d0"].bitwiseOR(s["vp"])).bitwiseAND(long(full)))
            return F.struct(s["d"].alias("d"), s["j"].alias("j"), s["d0"].alias("d0"), hp.alias("hp"), s["d0"].bitwiseAND(s["vp"]).alias("hn"))

        def vertical(s: Column) -> Column:
            # the last row, m - 1, is bit m - 1 - j + edits of the column, until then the lowest bit of the band
            on_diagonal = s["j"] + F.lit(edits) < m
            last = F.expr("1L")
            bit = F.call_function("shiftleft", last, F.greatest(m - 1 - s["j"] + F.lit(edits), F.lit(0)).cast("int"))
            along = F.when(s["hp"].bitwiseAND(bit) != 0, 1).when(s["hn"].bitwiseAND(bit) != 0, -1).otherwise(0)
            down = F.when(s["d0"].bitwiseAND(long(low)) != 0, 0).otherwise(1)
            half = F.shiftright(s["d0"], 1)
            vp = s["hn"].bitwiseOR(F.bitwise_not(half.bitwiseOR(s["hp"])).bitwiseAND(long(full)))
            return F.struct(vp.alias("vp"), half.bitwiseAND(s["hp"]).alias("vn"), (s["d"] + F.when(on_diagonal, down).otherwise(along)).cast("int").alias("d"))

        chain = F.array(state)
        for f in (diagonal, horizontal, vertical):
            chain = F.transform(chain, f)
        return F.element_at(chain, 1)

    start = F.struct(long(full & ~((1 << edits) - 1)).alias("vp"), long(0).alias("vn"), F.least(m, F.lit(edits)).alias("d"))
    return F.aggregate(F.sequence(F.lit(0), n - 1), start, step, lambda acc: acc["d"])


def drops(docs: DataFrame, edits: int = EDITS, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """All lines of ``numbered`` rows (doc_id, row, text hash, line_no, node, blank, exact, near), and all links (later
    node, earlier node, and whether the link drops the later one).

    ``exact`` and ``near`` tell why a line is dropped; a near line is near in all its places.
    """
    lines = split_lines(docs)
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col(TEXT), F.col(ROW), F.col("line_no"))
    seen = written(lines.select("doc_id", ROW, TEXT, "line_no", "node", (F.col("line") == "").alias("blank")), "lines")
    firsts = written(seen.where("not blank").groupBy("node").agg(F.min(order).alias("first")), "first_lines")

    # keys of substrings; a key matters if an indexed line and another line have it
    distinct = lines.where(F.col("size") >= min(least, SHORT)).select("node", "line", "size")
    keyed = probes(distinct, edits, least).select("key", F.shiftleft("node", 1).bitwiseOR(F.col("indexed")).alias("tagged")).repartition("key")
    node, flag = F.shiftrightunsigned("tagged", 1), F.col("tagged").bitwiseAND(F.lit(1).cast("bigint"))
    shared = keyed.groupBy("key").agg(F.min(node).alias("_a"), F.max(node).alias("_b"), F.max(flag).alias("_i")).where("_a <> _b and _i = 1").select("key")
    # an inner join, as keys of ``shared`` are distinct: a semi join would move below the shuffle that both sides share
    met = keyed.join(shared.hint("shuffle_hash"), "key").groupBy("key", node.alias("node")).agg(F.max(flag).alias("indexed"))
    met = written(met, "met")
    texts = distinct.join(met.select("node").distinct().hint("merge"), "node", "left_semi").dropDuplicates(["node"])
    counts = [c.alias(f"t{k}") for k, c in enumerate(tally(F.col("line")))]
    names = [f"t{k}" for k in range(len(counts))]
    texts = written(texts.join(firsts, "node").select("*", *counts), "met_lines")
    met = met.join(texts.select("node", "size", *names), "node")
    # every line of a key stands in one cell, and the indexed lines, which all meet, in all of them
    cells = met.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(CELL)).cast("int").alias("cells"))
    met = written(met.join(cells, "key"), "met_sizes")

    one = met.select("key", F.pmod(F.xxhash64("node"), F.col("cells")).cast("int").alias("cell"), F.col("node").alias("a"), F.col("indexed").alias("_i"), F.col("size").alias("_m"), *[F.col(x).alias(f"_a{x}") for x in names])
    other = met.where("indexed = 1").select("key", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), F.col("node").alias("b"), F.col("size").alias("_n"), *[F.col(x).alias(f"_b{x}") for x in names])
    alike = tallies_near([F.col(f"_a{x}") for x in names], [F.col(f"_b{x}") for x in names], edits)
    pairs = one.join(other, ["key", "cell"]).where("a <> b and (_i = 0 or a > b)").where(alike & (F.abs(F.col("_m") - F.col("_n")) <= edits))
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "line_pairs")

    # verification is work for all cores, though the pairs take few bytes; as a generated column it is done after
    # they are dealt out, where a filter would move into the join
    def side(name: str) -> DataFrame:
        return texts.select(F.col("node").alias(name), F.col("line").alias(f"_{name}"), F.col("first").alias(f"_{name}_first"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").repartition(max(1, -(-pairs.count() // PAIRS)), "a", "b")
    long_enough = F.least(F.length("_a"), F.length("_b")) >= least
    near = may_match(F.col("_a"), F.col("_b"), edits) & F.when(long_enough, within(F.col("_a"), F.col("_b"), edits)).otherwise(within(F.col("_a"), F.col("_b"), SHORT_EDITS))
    swap = F.col("_a_first") > F.col("_b_first")
    links = both.select(F.when(swap, F.col("a")).otherwise(F.col("b")).alias("later"), F.when(swap, F.col("b")).otherwise(F.col("a")).alias("earlier"),
                        long_enough.alias("drops"), F.explode_outer(F.array(near)).alias("_near"))
    links = written(links.where("_near").select("later", "earlier", "drops"), "line_links")

    near = links.where("drops").select(F.col("later").alias("node")).distinct().withColumn("near", F.lit(True))
    marked = seen.join(firsts, "node", "left").join(near, "node", "left")
    near_here = F.coalesce("near", F.lit(False)) & ~F.col("blank")
    repeated = ~F.col("blank") & ~near_here & ~order.eqNullSafe(F.col("first"))
    return marked.select("doc_id", ROW, TEXT, "line_no", "node", "blank", repeated.alias("exact"), near_here.alias("near")), links


def line_classes(links: DataFrame) -> DataFrame:
    """node, class_id (the smallest node of all that links join) and number of links of every linked line."""
    counts = links.select(F.col("later").alias("node")).union(links.select("earlier")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    labels = components(links.select(F.col("later").alias("a"), F.col("earlier").alias("b")))
    names = labels.groupBy("label").agg(F.min("node").alias("class_id"))
    return labels.join(names, "label").join(counts, "node").select("node", "class_id", "links")


def report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: lines that are not blank, those dropped as equal and as near, and their numbers;
    and the lines that are linked to different ones, with their class and number of links."""
    marked, links = drops(numbered(docs.select("doc_id", "text")))
    gone = F.col("exact") | F.col("near")
    marked = marked.join(line_classes(links), "node", "left")
    linked = F.when(F.col("class_id").isNotNull(), F.struct("line_no", "class_id", "links"))
    rows = marked.groupBy("doc_id", ROW, F.col(TEXT).alias("text_hash")).agg(
        F.count_if(~F.col("blank")).alias("n_lines"), F.count_if("exact").alias("n_exact"), F.count_if("near").alias("n_near"),
        F.array_join(F.array_sort(F.collect_list(F.when(gone, F.col("line_no")))).cast("array<string>"), ",").alias("dropped"),
        F.array_sort(F.collect_list(linked)).alias("linked"))
    return rows.drop(ROW)


def clean(docs: DataFrame) -> DataFrame:
    """The documents without their dropped lines, with the columns they have.

    A document all of whose lines are dropped goes: all it says is said earlier. Others keep all columns but text as they are,
    whatever their names.
    """
    return shielded(docs, _clean)


def _clean(docs: DataFrame) -> DataFrame:
    rows = written(numbered(docs), "numbered")
    marked, _ = drops(rows)
    gone = F.col("exact") | F.col("near")
    cut = marked.groupBy(ROW).agg(F.collect_set(F.when(gone, F.col("line_no"))).alias("_cut"), F.count_if(~gone & ~F.col("blank")).alias("_left"))
    cut = written(cut.where(F.size("_cut") > 0), "cuts")
    rows = rows.join(cut.hint("merge"), ROW, "left").where("_left is null or _left > 0")
    kept = F.filter(F.split(whole_text(), "\n"), lambda line, k: ~F.array_contains("_cut", k))
    text = F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return rows.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])


@query("op6_line_edit_join")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
