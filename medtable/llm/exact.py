"""Op 5: exact duplicates by composable polynomial fingerprints.

A text is compared without the characters ``[\\x20\\x09-\\x0D]``. Chunks of it are hashed on their own, modulo two
primes, and combined by shifting with the base raised to the length that follows, so a huge text is hashed in
parts of fixed size. Rows of equal fingerprint and length are compared chunk by chunk with the row that
leads them; rows that differ from it (a collision) form a new round with a leader of their own.

Null and empty texts are equal to each other. Rows may share a doc_id; a null doc_id comes last among ties.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, flat, pieces, table, whole_text, written
from .registry import query

CHUNK = 1 << 16
PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
BASES = (1_103_515_245, 1_500_450_271)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, prime: int) -> np.ndarray:
    """base ** k modulo the prime for every place of a chunk."""
    out = np.ones(CHUNK, np.int64)
    size = 1
    while size < CHUNK:  # doubling
        out[size:2 * size] = out[:size] * pow(base, size, prime) % prime
        size *= 2
    return out


_POWERS = [_powers(b, p) for b, p in zip(BASES, PRIMES)]


def chunk_hashes(data: np.ndarray) -> tuple[int, int]:
    """Fingerprint of one chunk of at most ``CHUNK`` bytes: sum of (byte + 1) * base ** (place from the end)."""
    values = data.astype(np.int64) + 1
    return tuple(int(values @ powers[:len(data)][::-1] % prime) for powers, prime in zip(_POWERS, PRIMES))


def combine(left: tuple[int, int], right: tuple[int, int], right_size: int) -> tuple[int, int]:
    """Fingerprint of two parts in a row from theirs: the left one is shifted by the right one's length."""
    return tuple((a * pow(base, right_size, prime) + b) % prime for a, b, base, prime in zip(left, right, BASES, PRIMES))


def fingerprint(data: np.ndarray) -> tuple[int, int]:
    out = (0, 0)
    for start in range(0, len(data), CHUNK):
        part = data[start:start + CHUNK]
        out = combine(out, chunk_hashes(part), len(part))
    return out


def _short_prints(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Fingerprints of many texts of at most one chunk each, in one pass."""
    sizes = np.diff(at)
    place = np.repeat(at[1:], sizes) - 1 - np.arange(len(data))
    values = data.astype(np.int64) + 1
    out = []
    full = np.flatnonzero(sizes)
    for powers, prime in zip(_POWERS, PRIMES):
        sums = np.zeros(len(sizes), np.int64)
        if len(full):
            sums[full] = np.add.reduceat(values * powers[place], at[:-1][full]) % prime
        out.append(sums)
    return out


def _prints(chunked: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=2 << 20):
            raw, at = flat(batch.column("text"))
            points = np.concatenate([np.zeros(1, np.int64), np.cumsum((raw & 0xC0) != 0x80)])
            points = points[at[1:]] - points[at[:-1]]
            solid = ~_SPACE[raw]
            kept = np.concatenate([np.zeros(1, np.int64), np.cumsum(solid)])[at]
            data = raw[solid]
            sizes = np.diff(kept)
            if (sizes <= CHUNK).all():
                one, two = _short_prints(data, kept)
            else:
                both = [fingerprint(data[a:b]) for a, b in zip(kept[:-1], kept[1:])]
                one, two = (np.array(x, np.int64) for x in zip(*both))
            spans = list(zip(kept[:-1].tolist(), kept[1:].tolist()))
            view = memoryview(np.ascontiguousarray(data))
            columns = [batch.column("doc_id"), pa.array(one << 31 | two), pa.array(sizes), pa.array(points),
                       pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in spans], pa.string())]
            names = ["doc_id", "print", "size", "points", "text_sha256"]
            if chunked:
                columns.append(pa.array([[bytes(view[k:min(b, k + CHUNK)]) for k in range(a, b, CHUNK)] for a, b in spans], pa.list_(pa.binary())))
                names.append("chunks")
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


KEY = ["print", "size"]
_MARK = "doc_id bigint, print bigint, size bigint, points bigint, text_sha256 string"


#: Cells that the rows of a fingerprint are dealt to, and the rows for which a group has one cell more.
CELLS, CELL_ROWS = 32, 64


def _best(*more: str) -> Column:
    """Orders the rows of a group: most code points first, then the smallest doc_id, null last."""
    return F.struct(F.col("points"), F.col("doc_id").isNotNull().alias("known"), F.bitwise_not("doc_id").alias("order"), *more)


def _same_chunks() -> Column:
    """Streaming comparison: one chunk of each side at a time, up to the first that differs. Fingerprints have equal sizes, so
    both sides have equally many chunks."""
    place = F.sequence(F.lit(0), F.size("chunks") - 1)
    differ = F.exists(place, lambda k: ~F.get("chunks", k).eqNullSafe(F.get("_chunks", k)))
    return F.when(F.size("chunks") == 0, F.lit(True)).otherwise(~differ)


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept and text_sha256.

    The rows of a group are dealt to cells by their own hash, each with a copy of the group's leading row, so a large group
    of copies is the work of many tasks.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text"))
    marks = written(arrow_map(docs, _prints(False), _MARK), "prints")
    groups = marks.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n"), F.max(_best()).alias("_lead"))
    cells = F.least(F.ceil(F.col("_n") / CELL_ROWS), F.lit(CELLS)).cast("int").alias("_cells")
    twins = written(groups.where("_n > 1").select(*KEY, "_lead", cells), "twins")
    single = marks.join(twins, KEY, "left_anti").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
                                                        F.lit(True).alias("kept"), "text_sha256")
    # only here do texts move, and only those of rows that have a twin are stored
    # (twins grow with the data, so they are never broadcast, and small runs move texts as large ones do)
    texts = arrow_map(docs, _prints(True), _MARK + ", chunks array<binary>").withColumn("_cell", F.pmod(F.monotonically_increasing_id(), F.lit(CELLS)).cast("int"))
    wanted = twins.withColumn("_cell", F.explode(F.sequence(F.lit(0), F.lit(CELLS - 1))))
    rest = written(texts.join(wanted.hint("merge"), [*KEY, "_cell"]).withColumn("_cell", F.col("_cell") % F.col("_cells")), "twin_texts")
    classes, number = [], 0
    while True:
        leaders = rest.where(_best().eqNullSafe(F.col("_lead"))).dropDuplicates(KEY)
        leaders = leaders.select(*KEY, F.col("chunks").alias("_chunks"), F.explode(F.sequence(F.lit(0), F.col("_cells") - 1)).alias("_cell"))
        compared = rest.join(leaders, [*KEY, "_cell"]).withColumn("_same", _same_chunks())
        done = compared.where("_same").select("doc_id", *KEY, "points", "text_sha256", F.lit(number).alias("_round"), F.monotonically_increasing_id().alias("_row"))
        done = written(done, "compared")
        classes.append(done)
        other = compared.where(~F.col("_same")).drop("_same", "_chunks", "_lead")
        if done.count() == rest.count():
            break
        leads = other.groupBy(*KEY).agg(F.max(_best()).alias("_lead"))
        rest, number = written(other.join(leads, KEY), "collisions"), number + 1
    rows = classes[0]
    for more in classes[1:]:
        rows = rows.unionByName(more)
    same_key = [*KEY, "_round"]
    # of rows that share the leading doc_id and length, the one with the largest number stays
    sums = rows.groupBy(*same_key).agg(F.count(F.lit(1)).alias("group_size"), F.max(_best("_row")).alias("_lead"))
    kept = _best("_row").eqNullSafe(F.col("_lead"))
    grouped = rows.join(sums, same_key).select("doc_id", F.bitwise_not("_lead.order").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256")
    return single.unionByName(grouped)


@query("op5_exact_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "documents"))
