"""Op 4: near duplicates by ProbMinHash over weighted word shingles.

A shingle is five words in a row (all words of a shorter text), weighted by how often the text has it. Every
shingle sends a Poisson process of arrivals, at the rate of its weight, to the registers of a signature;
a register keeps the shingle that arrives first. Two registers agree with the probability Jaccard similarity

    J_P = sum over common x of 1 / (sum over y of max(a_y / a_x, b_y / b_x)),

which is the Jaccard similarity for texts that have each shingle once. Arrivals after the last register's
first one change nothing, so a text's processes end there. Bands of registers propose groups; the similarity
is then computed from the shingles, and links of 0.8 or more join texts into classes.

Texts of equal weighted shingles are one node from the start, so a large group of copies costs one node.
Proposed groups are worked off in pairs of blocks of bounded size; a block task returns a spanning forest of
its links, not all of them, and skips what its links have joined. Null texts are empty, and empty texts
are equal to each other. Rows may share a doc_id, and ids may be null: a class is told by its ``class_key``, the
smallest fingerprint in it, and keeps one row, of the smallest id if it has any.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, flat, grouped_rows, pieces, shielded, table, whole_text, written
from .graph import components
from .registry import query
from .words import mix, word_hashes

U = np.uint64
WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
BLOCK = 256
#: A pair whose signatures agree in a smaller share is not compared: at a similarity of 0.8 the share has
#: a standard deviation of 0.037, so this is over five of them below.
LEAST_SHARE = 0.6


def shingles(words: np.ndarray, counts: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text number, 64-bit hash and weight, in order of both."""
    first = np.cumsum(counts) - counts
    size = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(counts)), size)
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
    h = np.zeros(len(at), U)
    last = first + counts - 1
    for k in range(n):
        place = at + k
        here = place <= last[owner]
        step = np.where(here, words[np.minimum(place, max(len(words) - 1, 0))] if len(words) else U(0), U(k + 1))
        h = mix(h * U(0x9E3779B97F4A7C15) + step)
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    start = np.flatnonzero(new)
    return owner[start], h[start], np.diff(np.append(start, len(h)))


def _unit(h: np.ndarray) -> np.ndarray:
    """A number in (0, 1) from the upper bits of a hash."""
    return ((h >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def signatures(owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """The element that arrives first at each register of each text; zeros for a text without elements.

    The k-th arrival of an element and its register come from a hash of the element and k, divided by the
    weight, so equal elements of two texts have the same process at different speeds. Arrivals are drawn up
    to a time at which nearly every register has one; texts with an empty register go on to twice that time.
    """
    best = np.full(texts * registers, np.inf)
    found = np.zeros(texts * registers, U)
    total = np.bincount(owner, weights, texts) if len(owner) else np.zeros(texts)
    limit = np.zeros(texts)
    np.divide(registers * (np.log(registers) + 2.0), total, out=limit, where=total > 0)
    pending = total > 0
    while pending.any():
        use = np.flatnonzero(pending[owner])
        own, x, w = owner[use], elements[use], weights[use].astype(np.float64)
        stop = limit[own]
        state = mix(x + U(0x632BE59BD9B4E019))
        time = -np.log(_unit(state)) / w
        while True:
            alive = np.flatnonzero(time <= stop)
            if not len(alive):
                break
            own, x, w, stop, state, time = own[alive], x[alive], w[alive], stop[alive], state[alive], time[alive]
            state = mix(state + U(0x9E3779B97F4A7C15))
            slot = own * registers + (state % U(registers)).astype(np.int64)
            np.minimum.at(best, slot, time)
            won = best[slot] == time
            found[slot[won]] = x[won]
            state = mix(state + U(0x9E3779B97F4A7C15))
            time = time - np.log(_unit(state)) / w
        worst = best.reshape(texts, registers).max(axis=1) if texts else np.zeros(0)
        pending &= ~np.isfinite(worst)
        limit[pending] *= 2
    return found.reshape(texts, registers)


def _bands(found: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of a signature; the band's number is part of it."""
    out = np.zeros((len(found), BANDS), U)
    for b in range(BANDS):
        h = np.full(len(found), U(b + 1))
        for k in range(ROWS):
            h = mix(h * U(0x9E3779B97F4A7C15) + found[:, b * ROWS + k])
        out[:, b] = h
    return out.view(np.int64)


def _prints(owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, texts: int) -> np.ndarray:
    """A 128-bit fingerprint of each text's weighted shingles."""
    out = np.zeros((texts, 2), U)
    for side, salt in enumerate((0xA0761D6478BD642F, 0xE7037ED1A0B428DB)):
        np.add.at(out[:, side], owner, mix((elements ^ U(salt)) + mix(weights.astype(U) * U(salt))))
    return out


def _shingled(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    owner, x, w = shingles(*word_hashes(*flat(batch.column("text"))))
    return owner, x, w, _prints(owner, x, w, batch.num_rows)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        n = batch.num_rows
        owner, x, w, prints = _shingled(batch)
        found = signatures(owner, x, w, n)
        small = (found & U(0xFFFF)).astype("<u2")
        keys = _bands(found)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("_hash"), pa.array(prints[:, 0].view(np.int64)), pa.array(prints[:, 1].view(np.int64)),
            pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(keys.ravel())),
            pa.array([row.tobytes() for row in small], pa.binary())], ["doc_id", "_hash", "p1", "p2", "bands", "signature"])


PRINT = ["p1", "p2"]


def _with_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps rows whose fingerprint is the wanted one and adds their shingles and weights."""
    for batch in pieces(batches):
        owner, x, w, prints = _shingled(batch)
        wanted = np.stack([batch.column(c).to_numpy().view(U) for c in PRINT], axis=1)
        good = np.flatnonzero((wanted == prints).all(axis=1))
        cut = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        rows = batch.take(pa.array(good))
        spans = [(cut[k], cut[k + 1]) for k in good]
        yield pa.RecordBatch.from_arrays(
            [*(rows.column(c) for c in ("node", "family", "blocks", "signature")),
             pa.array([x[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([w[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary())],
            ["node", "family", "blocks", "signature", "elements", "weights"])


def similarity(xa: np.ndarray, wa: np.ndarray, xb: np.ndarray, wb: np.ndarray) -> float:
    """Probability Jaccard similarity of two weighted sets, given as sorted elements and weights."""
    if not len(xa) or not len(xb):
        return float(len(xa) == len(xb))
    at = np.minimum(np.searchsorted(xb, xa), len(xb) - 1)
    common = xb[at] == xa
    shared = int(common.sum())
    if (wa == 1).all() and (wb == 1).all():
        return shared / (len(xa) + len(xb) - shared)
    if not shared:
        return 0.0
    pairs, counts = np.unique(np.stack([wa[common], wb[at[common]]], axis=1).astype(np.float64), axis=0, return_counts=True)
    only_a = float(wa[~common].sum())
    only_b = float(wb.sum() - wb[at[common]].sum())
    out = 0.0
    for (a, b), n in zip(pairs, counts):
        out += n / (float(counts @ np.maximum(pairs[:, 0] / a, pairs[:, 1] / b)) + only_a / a + only_b / b)
    return out


def _links(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, left, right), rows in grouped_rows(batches, ["family", "left", "right"]):
            rows = sorted({r["node"]: r for r in rows}.values(), key=lambda r: r["node"])
            sets = [(np.frombuffer(r["elements"], U), np.frombuffer(r["weights"], "<u4")) for r in rows]
            signs = np.array([np.frombuffer(r["signature"], "<u2") for r in rows])
            block = np.array([r["block"] for r in rows])
            root = list(range(len(rows)))

            def top(k: int) -> int:
                while root[k] != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            a, b, share = [], [], []
            for k in range(len(rows) - 1):
                other = np.arange(k + 1, len(rows))
                if left != right:  # pairs inside a block have a task of their own
                    other = other[block[other] != block[k]]
                agree = (signs[other] == signs[k]).mean(axis=1)
                near = np.flatnonzero(agree >= LEAST_SHARE)
                a.append(np.full(len(near), k))
                b.append(other[near])
                share.append(agree[near])
            found = []
            if a:
                a, b, share = map(np.concatenate, (a, b, share))
                for k in np.argsort(-share, kind="stable").tolist():
                    i, j = int(a[k]), int(b[k])
                    if (ti := top(i)) != (tj := top(j)) and similarity(*sets[i], *sets[j]) >= threshold:
                        root[max(ti, tj)] = min(ti, tj)
                        found.append((rows[i]["node"], rows[j]["node"]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])
    return run


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class), class_size, kept and class_key.

    Classes without ids, or with one repeated id, share a class_id; their class_key is their own.
    """
    return _classified(docs, threshold).drop("_hash")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that stay, one of each class, with all their columns, whatever their names.

    Of equal texts with one doc_id the row stays whose other columns come first as text.
    """
    return shielded(docs, lambda rows: _keep_one(rows, threshold))


def _keep_one(docs: DataFrame, threshold: float) -> DataFrame:
    stay = written(_classified(docs, threshold).where("kept").select(F.col("doc_id").alias("_id"), "_hash"), "stay")
    text = F.xxhash64(whole_text())
    rows = docs.join(stay.hint("merge"), F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (text == F.col("_hash")))
    others = F.to_json(F.struct(*[docs[c] for c in docs.columns if c != "text"], F.col("text").isNull()))
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy("_id", "_hash").orderBy(others)))
    return rows.where("_nth = 1").select(*[docs[c] for c in docs.columns])


def _classified(docs: DataFrame, threshold: float) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text"))
    sketched = written(arrow_map(docs.withColumn("_hash", F.xxhash64("text")), _sketch, "doc_id bigint, _hash bigint, p1 bigint, p2 bigint, bands array<bigint>, signature binary"), "sketches")
    nodes = sketched.groupBy(*PRINT).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    one = sketched.join(nodes.select("node", F.col("doc_id").alias("_first"), *PRINT), PRINT)
    one = one.where(F.col("doc_id").eqNullSafe(F.col("_first"))).dropDuplicates(["node"]).select("node", "bands", "signature")
    one = written(one, "representatives")

    # groups proposed by the bands: a link from each member to the smallest one
    members = one.select("node", F.explode("bands").alias("key")).repartition("key")
    heads = members.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("_last")).where("head < _last").select("key", "head")
    proposed = members.join(heads, "key").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    families = components(proposed)

    # blocks of a family, sized by its count, and the pairs of blocks
    sizes = families.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    placed = families.join(sizes, "label").join(nodes, "node").select("node", F.col("label").alias("family"), "blocks", "doc_id", *PRINT)
    placed = written(placed.join(one.select("node", "signature"), "node"), "families")
    # members grow with the data, so they are never broadcast
    texts = docs.withColumnRenamed("doc_id", "_id").join(placed.hint("merge"), F.col("_id").eqNullSafe(F.col("doc_id"))).drop("_id", "doc_id")
    rich = arrow_map(texts.select("text", "node", "family", "blocks", "signature", *PRINT), _with_shingles,
                     "node bigint, family bigint, blocks int, signature binary, elements binary, weights binary")
    rich = rich.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = rich.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("left", F.least("block", "_other")).withColumn("right", F.greatest("block", "_other")).drop("_other", "blocks")
    keys = ["family", "left", "right"]
    links = written(arrow_map(dealt.repartition(*keys).sortWithinPartitions(*keys), _links(threshold), "a bigint, b bigint"), "near_links")

    joined = components(links)
    named = nodes.join(joined, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sums = named.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"), F.min(F.struct(*PRINT)).alias("_least"))
    key = F.concat(*[F.lpad(F.lower(F.hex(F.col(f"_least.{p}"))), 16, "0") for p in PRINT])
    by_print = named.join(sums, "label").select(*PRINT, "class_id", "class_size", key.alias("class_key"))
    rows = sketched.select("doc_id", "_hash", *PRINT).join(by_print, PRINT)
    # of rows that share the smallest doc_id of a class, one stays
    ties = Window.partitionBy("class_key", "doc_id").orderBy(*PRINT, "_hash")
    kept = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.row_number().over(ties) == 1)
    return rows.select("doc_id", "class_id", "class_size", kept.alias("kept"), "class_key", "_hash")


@query("op4_prob_minhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
