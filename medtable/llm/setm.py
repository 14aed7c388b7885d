"""Op 12: phrases of a corpus by set-oriented mining (SETM) of sorted occurrence relations.

A text, lower-cased in A-Z, is split into pieces and those into words; everything is per language. Relation ``R1`` holds
all occurrences of frequent words as (place, word), sorted by place; the places of two pieces never touch. ``R(k+1)`` is
the merge-join of ``R(k)`` with itself at adjacent places: a phrase of k + 1 words is known by its first k and its
last k, both of which must be frequent. Groups are counted, and only occurrences that a semi-join with the frequent
groups keeps are extended further. All relations are stored.

A relation is stored in blocks, each with the sorted occurrences of about ``BLOCK_BYTES`` of pieces of one language, so
the merge-join needs no shuffle: a block is joined and its groups are counted in one task. The counts are then added up
over all blocks and each block is told which of its groups are frequent. What moves is every different group of a
block, never each occurrence, so a phrase that is everywhere moves once a block. Words move as rows; pairs move
in sorted arrays, one for each bucket that a block has pairs in, which are a sixth of the size of rows.

Words and phrases are compared as they are, never by a hash alone: a frequent word is named by the first place (block and
number there) that has it, a frequent pair by its bucket and its rank there. Null text counts as empty, null lang as ``und``. Documents need no id; equal rows count each.
Other columns are ignored. A document without words, or a table without rows, adds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, grouped_rows, table, whole_text, written
from .registry import query
from .words import mix

LEAST, LONGEST, TOP = 30, 4, 2000
SCALE, COVERED, OF = 2_000_000, 100, 80
BLOCK_BYTES = 8 << 20
#: Pairs, counted as they occur, for each bucket in which they are added up; and the bits of a rank in a bucket.
BUCKET_PAIRS, RANK = 1 << 20, 40
#: A place is a block (number of the task, number of the block in it) and a number inside the block.
INSIDE, IN_TASK = 26, 16
#: Groups that a language's candidates are ranked in first.
RANK_GROUPS = 64

_FOLD = bytes(ord(".") if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))


# ---- relations of one block ----

def shrink(values: np.ndarray) -> bytes:
    """Numbers from 0 on in the fewest bytes each, after a byte that tells how many."""
    size = np.min_scalar_type(int(values.max()) if len(values) else 0).itemsize
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def grown(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def cut(text: bytes, limit: int) -> Iterator[bytes]:
    """A text whose pieces end at full stops, in parts of about ``limit`` bytes; a piece stays whole."""
    start = 0
    while len(text) - start > limit:
        stop = text.rfind(b".", start, start + limit)
        stop = stop if stop >= 0 else text.find(b".", start + limit)
        if stop < 0:
            break
        yield text[start:stop]
        start = stop + 1
    yield text[start:]


def tokens(parts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The different words of parts, and the numbers of their words in order, from 1 on; 0 stands between pieces."""
    words = b".".join(parts).replace(b".", b" . ").split()
    number = {b".": 0}
    found = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    return list(number)[1:], found


def joined(at: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge-join of a sorted relation with itself at adjacent places: the places, the number of the pair at each, the
    left and right group of every different pair, and how often it occurs."""
    near = np.flatnonzero(at[1:] - at[:-1] == 1)
    pairs, number, counts = np.unique(group[near] * groups + group[near + 1], return_inverse=True, return_counts=True)
    return at[near], number, pairs // max(groups, 1), pairs % max(groups, 1), counts


def kept(at: np.ndarray, number: np.ndarray, different: int, known: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Semi-join of occurrences with the frequent groups of their block (numbers there and names): the names, and the
    occurrences with places into them."""
    place = np.full(different, -1, np.int64)
    place[known] = np.arange(len(known))
    group = place[number]
    stays = group >= 0
    return names, at[stays], group[stays]


def bucket_of(left: np.ndarray, right: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(left.astype(np.uint64) + np.uint64(1) ^ mix(right.astype(np.uint64))) % np.uint64(buckets)).astype(np.int64)


def squeeze(values: np.ndarray) -> bytes:
    """64-bit numbers, compressed byte by byte of their places."""
    planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unsqueeze(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<i8").reshape(n).astype(np.int64)


# ---- Spark ----

OCCURRENCES = "block bigint, lang string, words array<string>, counts array<bigint>, n bigint, tokens binary"
RELATION = "block bigint, names array<bigint>, at binary, groups binary, near bigint"


def _read(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def block(lang: str) -> pa.RecordBatch:
            nonlocal made
            words, found = tokens(held.pop(lang))
            del sizes[lang]
            if made >> IN_TASK or task >> (63 - INSIDE - IN_TASK) or len(found) >> INSIDE:
                raise ValueError("too many blocks or a block too large for its number")
            counts = np.bincount(found, minlength=len(words) + 1)[1:]
            number, made = task << IN_TASK | made, made + 1
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([lang]), pa.array([words], pa.list_(pa.binary())).cast(pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64())),
                 pa.array([int(counts.sum())], pa.int64()), pa.array([shrink(found)], pa.binary())], ["block", "lang", "words", "counts", "n", "tokens"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                for part in cut(text.as_buffer().to_pybytes().lower().translate(_FOLD), limit):
                    held.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part) + 1
                    if sizes[lang] >= limit:
                        yield block(lang)
                # of many languages no more than four blocks are held
                while sum(sizes.values()) >= 4 * limit:
                    yield block(max(sizes, key=sizes.get))
        for lang in sorted(held):
            yield block(lang)
    return run


def _first_relation(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """R1 of every block: the places of its frequent words."""
    for batch in batches:
        for row in batch.to_pylist():
            found = grown(row["tokens"])
            at = np.flatnonzero(found)
            known, names = (np.array([x[c] for x in row["known"]], np.int64) for c in ("k", "name"))
            yield _stored(row["block"], *kept(at, found[at] - 1, row["different"], known, names))


def _next_relation(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = np.array(row["names"], np.int64)
                at, number, left, right, _ = joined(np.cumsum(grown(row["at"])), grown(row["groups"]), len(own))
                bucket = bucket_of(own[left], own[right], buckets)
                known, names = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for x in row["known"]:
                    mine = np.flatnonzero(bucket == x["bucket"])  # in the order they were sent
                    known.append(mine[np.unpackbits(np.frombuffer(x["mask"], np.uint8), count=len(mine)).astype(bool)])
                    names.append((x["bucket"] << RANK) + grown(x["ranks"]))
                yield _stored(row["block"], *kept(at, number, len(left), np.concatenate(known), np.concatenate(names)))
    return run


def _stored(block: int, names: np.ndarray, at: np.ndarray, groups: np.ndarray) -> pa.RecordBatch:
    near = int((at[1:] - at[:-1] == 1).sum())
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([names], pa.list_(pa.int64())), pa.array([shrink(np.diff(at, prepend=0))], pa.binary()),
                                       pa.array([shrink(groups)], pa.binary()), pa.array([near], pa.int64())], ["block", "names", "at", "groups", "near"])


def _pairs(buckets: int):
    """The different pairs of a block and their counts, one row for each bucket that has any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                names = np.array(row["names"], np.int64)
                _, _, left, right, counts = joined(np.cumsum(grown(row["at"])), grown(row["groups"]), len(names))
                left, right = names[left], names[right]
                bucket = bucket_of(left, right, buckets)
                order = np.argsort(bucket, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
                    yield pa.RecordBatch.from_arrays([pa.array([int(bucket[part[0]])], pa.int32()), pa.array([row["block"]], pa.int64()), pa.array([squeeze(left[part])], pa.binary()),
                                                      pa.array([squeeze(right[part])], pa.binary()), pa.array([shrink(counts[part])], pa.binary())], ["bucket", "block", "left", "right", "n"])
    return run


def _frequent_pairs(least: int):
    """Adds up a bucket's counts. For each block the pairs that are frequent (a bit each) and their ranks; and, in a row
    without block, the frequent pairs themselves with their totals, in the order of the ranks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), rows in grouped_rows(batches, ["bucket"]):
            left, right = (np.concatenate([unsqueeze(r[c]) for r in rows]) for c in ("left", "right"))
            counts = [grown(r["n"]) for r in rows]
            ends = np.cumsum([len(c) for c in counts])
            order = np.lexsort((right, left))
            a, b = left[order], right[order]
            first = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            total = np.add.reduceat(np.concatenate(counts)[order], np.flatnonzero(first))
            good = total >= least
            rank = np.cumsum(good) - 1
            group = np.empty(len(order), np.int64)
            group[order] = np.cumsum(first) - 1
            heads = order[first][good]
            out = [(bucket, None, None, None, squeeze(left[heads]), squeeze(right[heads]), squeeze(total[good]))] if good.any() else []
            for row, mine in zip(rows, np.split(group, ends[:-1])):
                hit = good[mine]
                if hit.any():
                    out.append((bucket, row["block"], np.packbits(hit).tobytes(), shrink(rank[mine[hit]]), None, None, None))
            kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["bucket", "block", "mask", "ranks", "left", "right", "total"])
    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each frequent pair."""
    for batch in batches:
        for row in batch.to_pylist():
            left, right, total = (unsqueeze(row[c]) for c in ("left", "right", "total"))
            for a in range(0, len(left), 1 << 16):
                part = slice(a, a + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array((row["bucket"] << RANK) + np.arange(len(left))[part]), pa.array(left[part]), pa.array(right[part]), pa.array(total[part])], ["name", "left", "right", "total"])


def frequent_pairs(relation: DataFrame, least: int, label: str) -> tuple[DataFrame, DataFrame, int]:
    """The frequent pairs (name, left, right, total), what each block has of them, and the number of buckets."""
    near = relation.agg(F.sum("near").alias("n")).first()["n"] or 0
    buckets = max(int(relation.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-near // BUCKET_PAIRS))
    sent = arrow_map(relation, _pairs(buckets), "bucket int, block bigint, left binary, right binary, n binary").repartition("bucket").sortWithinPartitions("bucket")
    found = written(arrow_map(sent, _frequent_pairs(least), "bucket int, block bigint, mask binary, ranks binary, left binary, right binary, total binary"), label)
    entries = arrow_map(found.where("block is null").select("bucket", "left", "right", "total"), _entries, "name bigint, left bigint, right bigint, total bigint")
    known = found.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("bucket", "mask", "ranks")).alias("known"))
    return entries, known, buckets


def frequent_words(blocks: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """The frequent words (name, lang, word, total), and the numbers and names of those that each block has. Counting and
    the semi-join share one shuffle."""
    words = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("k", "w"))
    words = words.select((F.shiftleft("block", INSIDE) + F.col("k")).alias("place"), "lang", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    keyed = words.repartition("lang", "word")
    groups = keyed.groupBy("lang", "word").agg(F.sum("n").alias("total"), F.min("place").alias("name")).where(F.col("total") >= least)
    # an inner join, as the groups are distinct: a semi-join would move below the shuffle and make it twice
    found = written(keyed.join(groups.hint("shuffle_hash"), ["lang", "word"]).select("place", "name", "total", "lang", "word"), "frequent_1")
    inside = F.col("place").bitwiseAND(F.lit((1 << INSIDE) - 1)).cast("int")
    known = found.groupBy(F.shiftright("place", INSIDE).alias("block")).agg(F.collect_list(F.struct(inside.alias("k"), "name")).alias("known"))
    return found.where("place = name").drop("place"), known


def occurrences(docs: DataFrame, limit: int = BLOCK_BYTES) -> DataFrame:
    """The stored blocks: language, different words, how often each occurs, and all word numbers in order."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole_text().alias("text"))
    return written(arrow_map(rows, _read(limit), OCCURRENCES), "occurrences")


def mine(blocks: DataFrame, least: int = LEAST, longest: int = LONGEST) -> list[DataFrame]:
    """The frequent phrases of 1, 2, ... ``longest`` words: name, lang, phrase, last word, total; the totals of their
    first 1, 2, ... words (``heads``) and of their last ones (``tails``); and the phrases of two words or more inside (``inner``)."""
    entries, known = frequent_words(blocks, least)
    total = F.array("total")
    nothing = F.array().cast("array<struct<size:int,name:bigint>>")
    level = entries.select("name", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "total", total.alias("heads"), total.alias("tails"), nothing.alias("inner"))
    out = [written(level, "phrases_1")]
    relation = blocks.select("block", "tokens", F.size("words").alias("different")).join(known, "block")
    relation = written(arrow_map(relation, _first_relation, RELATION), "relation_1")
    for size in range(2, longest + 1):
        entries, known, buckets = frequent_pairs(relation, least, f"frequent_{size}")
        before = out[-1]
        left = before.select(F.col("name").alias("left"), "lang", F.col("phrase").alias("_phrase"), F.col("heads").alias("_heads"), F.col("inner").alias("_left"))
        right = before.select(F.col("name").alias("right"), "last", F.col("tails").alias("_tails"), F.col("inner").alias("_right"))
        level = entries.join(left, "left").join(right, "right")
        own = F.array(*[F.struct(F.lit(size - 1).alias("size"), F.col(c).alias("name")) for c in ("left", "right")]) if size > 2 else nothing
        level = level.select("name", "lang", F.concat("_phrase", F.lit(" "), "last").alias("phrase"), "last", "total", F.concat("_heads", total).alias("heads"),
                             F.concat("_tails", total).alias("tails"), F.array_union(F.array_union("_left", "_right"), own).alias("inner"))
        out.append(written(level, f"phrases_{size}"))
        if size < longest:
            relation = written(arrow_map(relation.join(known, "block"), _next_relation(buckets), RELATION), f"relation_{size}")
    return out


def _exact(c: Column | str) -> Column:
    """A count of which products with a constant are exact."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def scored(level: DataFrame, size: int) -> DataFrame:
    """name, size, lang, phrase, a, and l, r and score of the cut that scores lowest, the earliest of several."""
    cuts = []
    for k in range(1, size):
        head, tail = F.element_at("heads", k), F.element_at("tails", size - k)
        score = F.call_function("div", _exact("total") * F.lit(SCALE), _exact(head) + _exact(tail))
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), head.alias("l"), tail.alias("r")))
    best = F.array_min(F.array(*cuts))
    return level.select("name", F.lit(size).alias("size"), "lang", "phrase", F.col("total").alias("a"), best.alias("_c")).select("name", "size", "lang", "phrase", "a", "_c.l", "_c.r", "_c.score")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, limit: int = BLOCK_BYTES) -> DataFrame:
    """Each language's first ``top`` phrases that no longer one covers: lang, rank, phrase, a, l, r, n and score."""
    blocks = occurrences(docs, limit)
    levels = mine(blocks, least, longest)
    rows = scored(levels[1], 2)
    for size, level in enumerate(levels[2:], 3):
        rows = rows.unionByName(scored(level, size))
    inner = levels[1].select(F.explode("inner").alias("_i"), "total").limit(0)
    for level in levels[2:]:
        inner = inner.unionByName(level.select(F.explode("inner").alias("_i"), "total"))
    covers = inner.groupBy(F.col("_i.size").alias("size"), F.col("_i.name").alias("name")).agg(F.max("total").alias("_longer"))
    covered = F.coalesce(_exact("_longer") * F.lit(COVERED) >= _exact("a") * F.lit(OF), F.lit(False))
    rows = rows.join(covers, ["size", "name"], "left").where(~covered)
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may own most candidates: its groups are cut to ``top`` each before they are ranked as one
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
    rows = rows.withColumn("_group", group).withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_group").orderBy(*best))).where(F.col("_place") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    words = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    return rows.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def check_sql(least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> str:
    """The same in SQL, with a row for every occurrence."""
    lead = ", ".join(f"lead(w, {k}) OVER piece AS w{k}" for k in range(1, longest))
    grams = " UNION ALL ".join(f"SELECT lang, {k} AS k, {'w' if k == 1 else 'concat_ws(chr(32), w, ' + ', '.join(f'w{j}' for j in range(1, k)) + ')'} AS phrase FROM x" + (f" WHERE w{k - 1} IS NOT NULL" if k > 1 else "")
                               for k in range(1, longest + 1))
    return rf"""WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
      p AS (SELECT doc, lang, unnest(s) AS piece, generate_subscripts(s, 1) AS nr FROM (SELECT doc, lang, regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]') AS s FROM d)),
      o AS (SELECT doc, lang, nr, unnest(s) AS w, generate_subscripts(s, 1) AS pos FROM (SELECT doc, lang, nr, regexp_extract_all(piece, '[^\x20\x09]+') AS s FROM p)),
      x AS (SELECT lang, w, {lead} FROM o WINDOW piece AS (PARTITION BY doc, nr ORDER BY pos)),
      f AS (SELECT lang, k, phrase, count(*) AS n FROM ({grams}) GROUP BY ALL HAVING count(*) >= {least}),
      c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS s FROM f WHERE k > 1),
      t AS (SELECT c.lang, c.phrase, c.a, fl.n AS l, fr.n AS r, cut, CAST(CAST({SCALE} AS HUGEINT) * c.a // (fl.n + fr.n) AS BIGINT) AS score
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c JOIN f fl ON fl.lang = c.lang AND fl.k = cut AND fl.phrase = array_to_string(s[1:cut], ' ')
        JOIN f fr ON fr.lang = c.lang AND fr.k = c.k - cut AND fr.phrase = array_to_string(s[cut + 1:], ' ')),
      i AS (SELECT lang, array_to_string(s[b:b + m - 1], ' ') AS phrase, max(a) AS longer
        FROM (SELECT *, unnest(range(1, k - m + 2)) AS b FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL),
      z AS (SELECT t.* FROM t LEFT JOIN i ON t.lang = i.lang AND t.phrase = i.phrase WHERE i.longer IS NULL OR CAST({COVERED} AS HUGEINT) * i.longer < CAST({OF} AS HUGEINT) * t.a
        QUALIFY row_number() OVER (PARTITION BY t.lang, t.phrase ORDER BY score, cut) = 1),
      n AS (SELECT lang, count(*) AS n FROM o GROUP BY lang)
    SELECT z.lang, CAST(row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank, phrase, a, l, r, n.n, score
    FROM z JOIN n ON z.lang = n.lang QUALIFY rank <= {top}"""


@query("op12_setm_phrases", check_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
