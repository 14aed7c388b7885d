"""Op 2: interpolated modified Kneser-Ney bigram model.

Counting is done by Spark: tasks hash words, count the distinct pairs of their texts and send them, by the
hash of the first word, to buckets of about 16 MB of text each. A bucket merges its counts, keeps them as
sorted arrays in one file of the shared folder, and passes on how many different words stand before each word.
Pairs whose first word is so frequent that it would fill a bucket alone are spread by the second word too.
Scoring tasks map the files they need into memory and find hashes by binary search.

Words are runs of ``[^\\x20\\x09-\\x0D]`` in lower case (A-Z), then one end. A start mark is the context of the first
word. The model has order 2: of 27.1 million tokens (0.10 GB of documents) 22.6 million triples would be sent to be counted, 2.5 times
the input at 11 bytes each, and order 2 takes 2.9 times the input already. Discounts follow the counts of counts; where those are too few for the usual estimate (tiny corpora),
0.5, 1 and 1.5 are used. An empty training set gives every word the uniform share of the one unknown word.
Null texts are empty and have one token.
"""

from __future__ import annotations

import json
import mmap
import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import arrow_map, flat, fold, parts_for, pieces, table, text_bytes, whole_text, written
from .registry import query
from .words import mix, word_hashes

U = np.uint64
END, START = mix(np.array([0x454E44, 0x535441], U))
BUCKET_BYTES = 16 << 20
#: Pairs that a task holds before it counts and sends them.
HOLD = 1 << 21


# ---- files of the shared folder ----

def _store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _save(folder: str, name: str, arrays: list[np.ndarray]) -> str:
    """Write sorted arrays in one file under a name of its own; the result that is committed names it."""
    store, path = _store(f"{folder}/{name}-{uuid.uuid4().hex}.bin")
    with store.open_output_stream(path) as out:
        out.write(np.array([len(arrays), len(arrays[0])], np.int64).tobytes())
        for a in arrays:
            out.write(np.ascontiguousarray(a).astype(np.uint64).tobytes() if a.dtype == np.uint64 else a.astype("<u4").tobytes() + b"\0" * (-4 * len(a) % 8))
    return path.rsplit("/", 1)[1]


@lru_cache(4096)
def _mapped(folder: str, name: str, kinds: str) -> list[np.ndarray]:
    """The arrays of a file, mapped into memory; ``kinds`` has 8 or 4 for the bytes of each.

    A file of a remote folder is fetched to this worker's temporary folder and unlinked as soon as it is mapped.
    """
    store, path = _store(f"{folder}/{name}")
    if isinstance(store, fs.LocalFileSystem):
        file = open(path, "rb")
    else:
        file = tempfile.TemporaryFile()
        with store.open_input_stream(path) as source:
            while block := source.read(1 << 22):
                file.write(block)
        file.flush()
    with file:
        view = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    _, n = np.frombuffer(view, np.int64, 2)
    out, at = [], 16
    for kind in kinds:
        out.append(np.frombuffer(view, np.uint64 if kind == "8" else "<u4", n, at))
        at += 8 * n if kind == "8" else -(-4 * n // 8) * 8
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted hashes in a sorted array, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


# ---- counting ----

def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def pair_key(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(mix(before + U(0x9E3779B97F4A7C15)) ^ words)


def _pair_bucket(before: np.ndarray, words: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    place = mix(before)
    if len(hot):
        spread = np.isin(before, hot)
        place[spread] = pair_key(before[spread], words[spread])
    return _bucket(place, buckets)


def tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and ends of all texts in a row, the word before each, and the tokens of each text."""
    h, counts = word_hashes(*flat(batch.column("text")))
    ends = np.cumsum(counts)
    words = np.insert(h, ends, END)
    before = np.empty_like(words)
    before[1:] = words[:-1]
    starts = ends - counts + np.arange(len(counts))
    before[starts] = START
    return words, before, counts + 1


def _unique(*columns: np.ndarray, counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows in the order of the columns, and the sum of their counts."""
    order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0])
    columns = [c[order] for c in columns]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    sums = np.diff(np.append(at, len(order))) if counts is None else np.add.reduceat(counts[order], at) if len(at) else counts[:0]
    return [c[at] for c in columns], sums


PAYLOAD = "bucket int, kind string, payload binary"


def _pack(arrays: list[np.ndarray], counts: np.ndarray) -> bytes:
    """Sorted columns as bytes: the first one as distinct values and their runs, the counts as small as they go."""
    new = np.ones(len(counts), bool)
    new[1:] = arrays[0][1:] != arrays[0][:-1]
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(counts)))
    big = np.flatnonzero(counts > 254)
    head = np.array([len(counts), len(at), len(arrays), len(big)], "<i8")
    small = np.minimum(counts, 255).astype(np.uint8)
    return b"".join([head.tobytes(), arrays[0][at].tobytes(), runs.astype("<u4").tobytes(), *(a.tobytes() for a in arrays[1:]), small.tobytes(), counts[big].astype("<i8").tobytes()])


def _unpack(data: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    n, distinct, columns, big = np.frombuffer(data, "<i8", 4)
    at = 32
    first = np.frombuffer(data, U, distinct, at)
    at += 8 * distinct
    runs = np.frombuffer(data, "<u4", distinct, at)
    at += 4 * distinct
    out = [np.repeat(first, runs)]
    for _ in range(columns - 1):
        out.append(np.frombuffer(data, U, n, at))
        at += 8 * n
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
    at += n
    counts[counts == 255] = np.frombuffer(data, "<i8", big, at)
    return out, counts


def _emit(bucket: np.ndarray, columns: list[np.ndarray], counts: np.ndarray, kind: str) -> Iterator[tuple[int, str, bytes]]:
    """One payload for each bucket that has rows; rows are in order and stay so."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    for a, b in zip(at.tolist(), np.append(at[1:], len(bucket)).tolist()):
        rows = order[a:b]
        yield int(bucket[a]), kind, _pack([c[rows] for c in columns], counts[rows])


def _batch(rows: list[tuple[int, str, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows) if rows else ((), (), ()), kinds)], ["bucket", "kind", "payload"])


def _held(batches: Iterator[pa.RecordBatch], columns_of) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Distinct rows and their counts over as many batches as ``HOLD`` allows."""
    held: list[tuple[list[np.ndarray], np.ndarray]] = []
    for batch in pieces(batches):
        columns = columns_of(*tokens(batch)[:2])
        held.append(_unique(*columns))
        if sum(len(c) for _, c in held) > HOLD:
            yield _merged(held)
            held = []
    if held:
        yield _merged(held)


def _merged(parts: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    return _unique(*(np.concatenate(c) for c in zip(*(p[0] for p in parts))), counts=np.concatenate([p[1] for p in parts]))


def _by_bucket(rows: DataFrame, reduce, schema: str) -> DataFrame:
    """Hand all payloads of a bucket to ``reduce(bucket, {kind: [payload]})``, which yields batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, {}
        for batch in batches:
            for k, kind, data in zip(batch.column("bucket").to_pylist(), batch.column("kind").to_pylist(), batch.column("payload")):
                if held and k != last:
                    yield from reduce(last, held)
                    held = {}
                last = k
                held.setdefault(kind, []).append(data.as_py())
        if held:
            yield from reduce(last, held)
    return arrow_map(rows.repartition("bucket").sortWithinPartitions("bucket"), run, schema)


def _counts_of_counts(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


def discounts(n: list[int]) -> tuple[float, float, float]:
    """The three discounts of the modified estimate from how many counts are 1, 2, 3 and 4."""
    if min(n) == 0:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    found = tuple(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))
    return found if all(0 < d < k for k, d in enumerate(found, 1)) else (0.5, 1.0, 1.5)


def fit(docs: DataFrame) -> dict:
    """Count the texts of ``docs`` and store the model; returns its manifest, whose size follows the number of files."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "lm")
    _store(folder)[0].create_dir(_store(folder)[1], recursive=True)
    docs = docs.select(whole_text().alias("text"))
    buckets = parts_for(text_bytes(docs), BUCKET_BYTES)

    def count_words(batches):
        for (words,), counts in _held(batches, lambda w, _: (w,)):
            for row in _emit(_bucket(words, buckets), [words], counts, "words"):
                yield _batch([row])

    def merge_words(bucket, held):
        (words,), counts = _merged([_unpack(x) for x in held["words"]])
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array(["words"]), pa.array([_pack([words], counts)], pa.binary()),
                                          pa.array([int(counts.sum())], pa.int64()), pa.array([len(words)], pa.int64())],
                                         ["bucket", "kind", "payload", "total", "distinct"])

    word_rows = written(_by_bucket(arrow_map(docs, count_words, PAYLOAD), merge_words, PAYLOAD + ", total bigint, distinct bigint"), "lm_words")
    sums = word_rows.agg(F.sum("total").alias("n"), F.sum("distinct").alias("v")).first()
    total, distinct = int(sums["n"] or 0), int(sums["v"] or 0)

    # words that make up more than a bucket's share of all tokens: fewer than there are buckets
    def frequent(batches):
        for batch in batches:
            for data in batch.column("payload"):
                (words,), counts = _unpack(data.as_py())
                hot = words[counts * buckets > total]
                yield pa.RecordBatch.from_arrays([pa.array(hot.view(np.int64))], ["word"])
    hot = np.sort(np.array([r["word"] for r in arrow_map(word_rows.select("payload"), frequent, "word bigint").collect()] + ([START.view(np.int64)] if buckets > 1 else []), np.int64).view(U))

    def count_pairs(batches):
        for (before, words), counts in _held(batches, lambda w, b: (b, w)):
            for row in _emit(_pair_bucket(before, words, hot, buckets), [before, words], counts, "pairs"):
                yield _batch([row])

    def merge_pairs(bucket, held):
        (before, words), counts = _merged([_unpack(x) for x in held["pairs"]])
        keys = pair_key(before, words)
        order = np.argsort(keys)
        file = _save(folder, f"pairs-{bucket}", [keys[order], np.minimum(counts, 0xFFFFFFFF)[order].astype("<u4")])
        at = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        first = before[at]
        stats = np.stack([np.add.reduceat(x.astype(np.int64), at) for x in (counts, counts == 1, counts == 2, counts > 2)], axis=1)
        split = np.isin(first, hot)
        own, mine = first[~split], stats[~split]
        contexts = _save(folder, f"contexts-{bucket}", [own, *(mine[:, k].astype(U) for k in range(4))])
        note = json.dumps({"pairs": file, "contexts": contexts, "n": _counts_of_counts(counts), "distinct": len(counts),
                           "hot": [[int(h), *map(int, s)] for h, s in zip(first[split], stats[split])]})
        rows = [(bucket, "note", note.encode())]
        (after,), seen = _unique(words)
        rows += _emit(_bucket(after, buckets), [after], seen, "after")
        for row in rows:
            yield _batch([row])

    pair_rows = written(_by_bucket(arrow_map(docs, count_pairs, PAYLOAD), merge_pairs, PAYLOAD), "lm_pairs")

    def merge_after(bucket, held):
        (words,), counts = _merged([_unpack(x) for x in held["words"]])
        (after,), seen = _merged([_unpack(x) for x in held["after"]])
        assert len(words) == len(after)
        file = _save(folder, f"words-{bucket}", [words, counts.astype(U), seen.astype("<u4")])
        note = json.dumps({"words": file, "n": _counts_of_counts(seen), "more": int((seen > 2).sum()), "pairs": int(seen.sum())})
        yield _batch([(bucket, "note", note.encode())])

    lower = word_rows.select("bucket", "kind", "payload").union(pair_rows.where("kind = 'after'"))
    last = [(r["bucket"], json.loads(r["payload"])) for r in written(_by_bucket(lower, merge_after, PAYLOAD), "lm_after").collect()]
    notes = [(r["bucket"], json.loads(r["payload"])) for r in pair_rows.where("kind = 'note'").collect()]
    contexts: dict[int, list[int]] = {}
    for _, note in notes:
        for h, *stats in note["hot"]:
            contexts[h] = [x + y for x, y in zip(contexts.get(h, [0] * 4), stats)]

    def added(rows, size):
        return [sum(r["n"][k] for _, r in rows) for k in range(size)]
    return {"folder": folder, "buckets": buckets, "total": total, "distinct": distinct, "hot": contexts,
            "pairs": {k: r["pairs"] for k, r in notes}, "contexts": {k: r["contexts"] for k, r in notes}, "words": {k: r["words"] for k, r in last},
            "pair_n": added(notes, 4), "word_n": added(last, 4), "more": sum(r["more"] for _, r in last), "kinds": sum(r["pairs"] for _, r in last)}


# ---- scoring ----

class Model:
    """Log probabilities of words after words, from the mapped files of a manifest."""

    def __init__(self, m: dict):
        self.m = m
        self.hot = np.array(sorted(m["hot"]), U)
        self.hot_stats = np.array([m["hot"][int(h)] for h in self.hot], np.float64).reshape(-1, 4)
        self.pair_d = np.array([0.0, *discounts(m["pair_n"])])
        self.word_d = np.array([0.0, *discounts(m["word_n"])])
        kinds = m["kinds"]
        used = [m["word_n"][0], m["word_n"][1], m["more"]]
        # what the discounts leave for words in general, spread over all words and the unknown one
        self.floor = (float(self.word_d[1:] @ used) / kinds if kinds else 1.0) / (m["distinct"] + 1)

    def _each(self, files: dict[int, str], buckets: np.ndarray, keys: np.ndarray, kinds: str, size: int) -> np.ndarray:
        """The values stored for each key, zero where there is none."""
        out = np.zeros((size, len(keys)))
        order = np.lexsort((keys, buckets))  # in the order of the files, which the search then walks through
        sorted_buckets = buckets[order]
        at = np.flatnonzero(np.append(True, sorted_buckets[1:] != sorted_buckets[:-1])) if len(order) else []
        for a, b in zip(at, np.append(at[1:], len(order)) if len(order) else []):
            name = files.get(int(sorted_buckets[a]))
            if name is None:
                continue
            part = order[a:b]
            stored, *values = _mapped(self.m["folder"], name, kinds)
            place, there = _find(stored, keys[part])
            for k, v in enumerate(values):
                out[k, part] = np.where(there, v[place] if len(v) else 0, 0)
        return out

    def words(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each word occurs, and its probability whatever stands before it."""
        keys, which = np.unique(words, return_inverse=True)
        counts, kinds = self._each(self.m["words"], _bucket(keys, self.m["buckets"]), keys, "884", 2)
        lower = np.maximum(kinds - self.word_d[np.minimum(kinds, 3).astype(int)], 0) / max(self.m["kinds"], 1) + self.floor
        return counts[which], lower[which]

    def contexts(self, before: np.ndarray) -> np.ndarray:
        """Total, and how many words follow once, twice and more often, for each word before."""
        keys, which = np.unique(before, return_inverse=True)
        stats = self._each(self.m["contexts"], _bucket(mix(keys), self.m["buckets"]), keys, "88888", 4)
        if len(self.hot):
            place, there = _find(self.hot, keys)
            stats[:, there] = self.hot_stats[place[there]].T
        return stats[:, which]

    def log10(self, before: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each word and log10 of its probability after the word before it."""
        counts, lower = self.words(words)
        total, one, two, more = self.contexts(before)
        pairs, = self._each(self.m["pairs"], _pair_bucket(before, words, self.hot, self.m["buckets"]), pair_key(before, words), "84", 1)
        known = total > 0
        safe = np.where(known, total, 1)
        taken = np.maximum(pairs - self.pair_d[np.minimum(pairs, 3).astype(int)], 0) / safe
        left = (self.pair_d[1] * one + self.pair_d[2] * two + self.pair_d[3] * more) / safe
        return counts, np.log10(np.where(known, taken + left * lower, lower))


@lru_cache(1)
def _model(manifest: str) -> Model:
    m = json.loads(manifest)
    for name in ("pairs", "contexts", "words", "hot"):
        m[name] = {int(k): v for k, v in m[name].items()}
    return Model(m)


def score(docs: DataFrame, manifest: dict, extra: list[str]) -> DataFrame:
    """Base and model score of every text; ``extra`` names integer or boolean columns to keep."""
    data = docs.sparkSession.sparkContext.broadcast(json.dumps(manifest))  # names of files: bytes of text / 16 MB, and sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(data.value)
        n, v = model.m["total"], model.m["distinct"]
        for batch in pieces(batches):
            words, before, sizes = tokens(batch)
            counts, logs = model.log10(before, words)
            at = np.cumsum(sizes) - sizes
            base = np.log10((counts + 1) / (n + (v + 1)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in extra), pa.array(sizes), pa.array(np.add.reduceat((counts > 0).astype(np.int64), at)),
                 pa.array(np.full(len(sizes), n, np.int64)), pa.array(np.add.reduceat(base, at)), pa.array(np.add.reduceat(logs, at))],
                [*extra, "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    kinds = dict(docs.dtypes)
    return arrow_map(docs, run, ", ".join([*(f"{c} {kinds[c]}" for c in extra), "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"]))


@query("op2_kneser_ney")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = (fold("doc_id", 7) == 2).alias("held_out")
    manifest = fit(docs.where(fold("doc_id", 7) != 2))
    return score(docs.select(F.col("doc_id").cast("bigint"), held_out, whole_text().alias("text")), manifest, ["doc_id", "held_out"])
