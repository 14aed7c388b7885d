"""Op 8: shortest-pack-first packing over the histogram of lengths.

A document longer than a sequence is cut into whole sequences and a rest. Pieces of one length are alike, so
packing works on their histogram, which has at most ``size`` entries whatever the input: lengths are placed
longest first, each into the shortest packs that have room, and only the counts of packing patterns change.
The patterns are joined back to the documents by the rank of a piece among those of its length.

Null and empty texts have the end id only. Rows with the same doc_id are packed one by one.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import ENCODE_BYTES, default_vocabulary, encoder
from .common import arrow_map, pieces, table, whole_text, written
from .registry import query

SIZE = 4096
END_ID = 2
#: Pieces that one group of equal length and hash should hold.
GROUP_ROWS = 20_000


def cut(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document: doc_id, start, length, ids_crc32 and doc_tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in pieces(batches, limit=ENCODE_BYTES):
            ids, at = enc.encode(batch.column("text").to_pylist())
            raw = ids.astype("<u4")
            owner, starts, lengths, sums, totals = [], [], [], [], []
            tail = np.array([end_id], "<u4").tobytes()
            for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                total = b - a + 1
                for start in range(0, total, size):
                    stop = min(total, start + size)
                    crc = zlib.crc32(raw[a + start:min(b, a + stop)])
                    owner.append(k)
                    starts.append(start)
                    lengths.append(stop - start)
                    sums.append(zlib.crc32(tail, crc) if stop == total else crc)
                    totals.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return arrow_map(docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")), run,
                     "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def pack_histogram(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, list[int]]]:
    """Patterns of lengths with the number of sequences that follow each; every piece is placed once."""
    packs: dict[int, list[tuple[int, list[int]]]] = {}  # free room -> (count, lengths)
    rooms: list[int] = []  # free rooms in use, in order

    def put(count: int, pattern: list[int]) -> None:
        free = size - sum(pattern)
        if free not in packs:
            packs[free] = []
            insort(rooms, free)
        packs[free].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not rooms or rooms[-1] < length:  # no pack has room: open new ones
                put(left, [length])
                break
            free = rooms[-1]  # the shortest packs
            count, pattern = packs[free].pop()
            if not packs[free]:
                del packs[free]
                del rooms[bisect_left(rooms, free)]
            used = min(count, left)
            if count > used:
                put(count - used, pattern)
            put(used, [*pattern, length])
            left -= used
    return [p for free in rooms for p in packs[free]]


def slots(patterns: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: the first rank, the first sequence and the offset of its runs of equal slots."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    next_rank: dict[int, int] = {}
    sequence = 0
    for count, pattern in patterns:
        offset = 0
        for length in pattern:
            rank = next_rank.get(length, 0)
            runs.setdefault(length, []).append((rank, sequence, offset))
            next_rank[length] = rank + count
            offset += length
        sequence += count
    return {k: tuple(np.array(x, np.int64) for x in zip(*v)) for k, v in runs.items()}


def ranked(rows: DataFrame, total: int) -> DataFrame:
    """Adds ``rank``, from 0 among the pieces of a length, without ordering a whole length in one task."""
    groups = max(1, -(-total // GROUP_ROWS))
    rows = rows.withColumn("_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))
    counts = rows.groupBy("length", "_group").agg(F.count(F.lit(1)).alias("_n"))
    # counts of a length: one row for each group, so this window holds rows / GROUP_ROWS rows of a length
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_group").orderBy("doc_id", "start", "ids_crc32")
    return (rows.withColumn("_in", F.row_number().over(inside) - 1).join(offsets, ["length", "_group"])
            .withColumn("rank", (F.col("_before") + F.col("_in")).cast("bigint")).drop("_group", "_in", "_before"))


def pack(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Every piece with its sequence_id and its offset there."""
    rows = written(cut(docs, path, size, end_id), "pieces")
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = slots(pack_histogram(histogram, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                first, base, at = places[int(length[part[0]])]
                k = np.searchsorted(first, rank[part], "right") - 1
                sequence[part], offset[part] = base[k] + rank[part] - first[k], at[k]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in PIECE), pa.array(sequence), pa.array(offset)], [*PIECE, "sequence_id", "offset"])
    return arrow_map(ranked(rows, sum(histogram.values())).select(*PIECE, "rank"), run,
                     ", ".join(f"{c} bigint" for c in [*PIECE, "sequence_id", "offset"]))


PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


@query("op8_histogram_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_vocabulary())
