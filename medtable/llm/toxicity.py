"""Op 7: toxicity of texts restored by a noisy-channel decoder.

Writers hide words by leetspeak, by spaces or signs between letters and by repeating letters. Each suspicious
token becomes a lattice: a sign may stand for a letter or for nothing, a run of a letter for one or two, a gap
for a gap or for nothing. The Viterbi path under a character trigram model of the whole corpus and fixed
channel costs replaces the token. The restored text is then scored by a list of words and word beginnings.

The list is learned from at most ``SAMPLE`` labelled rows (those of smallest hash; a documented bound): counts of
every feature come from Spark, and the features that best cover the toxic rows are chosen greedily.
Labels are the only other input; they are never part of a score. Null and empty texts score as texts without
any listed feature. Rows without a doc_id or label teach nothing; without toxic rows the list is empty.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, fold, pieces, table, whole_text, written
from .registry import query

THRESHOLD = 0.3
SAMPLE = 20_000
#: Most features that the choice looks at, those with most toxic rows first.
CANDIDATES = 4_000
SUPPORT, UNCOVERED, PRECISION = 4, 3, 0.9
PREFIXES = (3, 4, 5, 6)

# fixed values: letters that a sign may stand for
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "(": "c", "¢": "c"}
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœß"
SIZE = len(LETTERS) + 1  # 0 is the border of a word
#: A second letter in a row of a lower probability than exp(-RARE) sends its word through the decoder.
RARE = 4.5
#: Characters that are counted at once.
SLICE = 1 << 17
#: Decoded words that a worker keeps, and the longest of them; together they bound its memory.
KEPT_WORDS, KEPT_SIZE = 1 << 16, 48
LETTER_COST, DROP_COST, DIGIT_DROP_COST, SHORTER_COST, JOIN_COST = 0.7, 1.5, 5.0, 0.3, 0.2

_SIGNS = re.escape("".join(LEET))
_GAP = r"[ .\-_*~·]"
#: At least four single letters or signs with gaps between them.
_SPACED = re.compile(rf"(?<![^\W_])(?:[^\W_]|[{_SIGNS}])(?:{_GAP}{{1,3}}(?:[^\W_]|[{_SIGNS}])(?![^\W_])){{3,}}")
#: What no letter can hide behind, at both ends of a token.
_EDGE = re.compile(rf"^[^\w{_SIGNS}]+|(?:[^\w{_SIGNS}]|_)+$")
_ODD = re.compile(rf"(.)\1\1|[^\W\d_](?:[{_SIGNS}]|[.\-_*~·][^\W_](?:[.\-_*~·]|$))|[{_SIGNS}][^\W\d_]")
_LETTER = re.compile(r"[^\W\d_]")


# ---- character model ----

def _codes() -> np.ndarray:
    out = np.zeros(0x110000, np.int32)
    out[[ord(c) for c in LETTERS]] = np.arange(1, SIZE)
    return out


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """How often each three characters follow each other in the whole corpus; its size is that of the alphabet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, total = _codes(), np.zeros(SIZE ** 3, np.int64)
        for batch in pieces(batches, limit=1 << 20):
            text = "".join(["\n\n", "\n\n".join(batch.column("text").to_pylist()).lower(), "\n"])
            for a in range(0, len(text) - 2, SLICE):  # slices share two characters
                c = code[np.frombuffer(text[a:a + SLICE + 2].encode("utf-32-le"), np.uint32)]
                total += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["at", "n"])
    rows = arrow_map(docs.select(whole_text().alias("text")), run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(SIZE ** 3)
    for r in rows:
        out[r["at"]] = r["n"]
    return out.reshape(SIZE, SIZE, SIZE)


def language_model(counts: np.ndarray) -> np.ndarray:
    """-log P(c | a, b), interpolated with the shorter contexts."""
    one = (counts.sum((0, 1)) + 1) / (counts.sum() + SIZE)
    pairs = counts.sum(0)
    two = (pairs + 5 * one) / (pairs.sum(1, keepdims=True) + 5)
    return -np.log((counts + 5 * two) / (counts.sum(2, keepdims=True) + 5))


class Decoder:
    """Viterbi decoder of single tokens."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs.astype(np.float32).tolist()
        self.code = {c: k for k, c in enumerate(LETTERS, 1)}
        self.known = lru_cache(KEPT_WORDS)(self._word)

    def _options(self, char: str, run: int, edge: bool) -> list[tuple[str, float]]:
        """What a run of one character may stand for, with the cost of it."""
        if char == " ":
            return [("", JOIN_COST), (" ", 0.0)]
        if char in LEET:
            out = [(letter * k, LETTER_COST + (SHORTER_COST if k < run else 0)) for letter in LEET[char] for k in {1, min(run, 2)}]
            drop = DIGIT_DROP_COST if char.isdigit() else 0.2 if edge else DROP_COST
            return [*out, ("", drop)]
        if _LETTER.match(char):
            return [(char, SHORTER_COST if run > 1 else 0.0), *([(char * 2, SHORTER_COST if run > 2 else 0.0)] if run > 1 else [])]
        return [("", 0.2)] if not char.isdigit() else [("", DIGIT_DROP_COST)]

    def word(self, token: str) -> str:
        return self.known(token) if len(token) <= KEPT_SIZE else self._word(token)

    def _word(self, token: str) -> str:
        runs = [(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", token, re.S)]
        code, costs = self.code, self.costs
        # (two codes before) -> (cost, text as a chain of pieces)
        paths: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for k, (char, run) in enumerate(runs):
            step: dict[tuple[int, int], tuple[float, tuple]] = {}
            for piece, price in self._options(char, run, k in (0, len(runs) - 1)):
                for (a, b), (cost, chain) in paths.items():
                    cost += price
                    for c in piece:
                        n = code.get(c, 0)
                        cost += costs[a][b][n]
                        a, b = (0, 0) if c == " " else (b, n)
                    if (a, b) not in step or cost < step[a, b][0]:
                        step[a, b] = (cost, (chain, piece) if piece else chain)
            paths = step
        best = min(((cost + costs[a][b][0], chain) for (a, b), (cost, chain) in paths.items()), key=lambda x: x[0])[1]
        out = []
        while best:
            best, piece = best
            out.append(piece)
        return "".join(reversed(out))

    def _unlikely(self, token: str) -> bool:
        """Whether a letter stands twice in a row where the corpus hardly ever has it."""
        code, costs = self.code, self.costs
        for m in _DOUBLE.finditer(token):
            before, here = code.get(token[m.start() - 1], 0) if m.start() else 0, code.get(m[1], 0)
            if here and costs[before][here][here] > RARE:
                return True
        return False

    def words(self, text: str) -> set[str]:
        """The distinct words of the restored text."""
        text = text.lower()
        out: set[str] = set()
        if _SPACED.search(text):
            spaced = _SPACED.findall(text)
            text = _SPACED.sub(" ", text)
            for run in spaced:
                out.update(self.word(re.sub(rf"{_GAP}+", " ", run)).split(" "))
        for token in set(text.split()):
            doubled = _DOUBLE.search(token)
            if not doubled and token.isalpha():
                out.add(token)
                continue
            core = _EDGE.sub("", token)
            if _LETTER.search(core) and (_ODD.search(core) or doubled and self._unlikely(core)):
                out.update(self.word(core).split(" "))
            else:
                out.update(_PLAIN.findall(core))
        out.discard("")
        return out


_DOUBLE = re.compile(r"([^\W\d_])\1")
_PLAIN = re.compile(r"[^\W_]+")


def features(words: set[str]) -> set[str]:
    """Words, and their beginnings marked by a star."""
    out = set(words)
    for n in PREFIXES:
        out.update(w[:n] + "*" for w in words if len(w) > n)
    return out


# ---- learning ----

def choose(rows: list[list[str]], counts: dict[str, tuple[int, int]], clean: int) -> tuple[dict[str, float], float]:
    """Greedy cover of the toxic rows; the probability of each chosen feature, and of rows without any."""
    holders: dict[str, set[int]] = {}
    for k, names in enumerate(rows):
        for f in names:
            holders.setdefault(f, set()).add(k)
    left = set(range(len(rows)))
    chosen: dict[str, float] = {}
    while holders:
        best = max(holders, key=lambda f: (len(holders[f] & left), counts[f][0] / sum(counts[f]), -len(f), f))
        gain = holders.pop(best) & left
        if len(gain) < UNCOVERED:
            break
        a, b = counts[best]
        chosen[best] = (a + 0.5) / (a + b + 1)
        left -= gain
    return chosen, min((len(left) + 0.1) / (len(left) + clean + 1), THRESHOLD / 2)


def learn(docs: DataFrame, labels: DataFrame) -> dict:
    """The character model over all documents, and the list from a bounded sample of the labels."""
    spark = docs.sparkSession
    costs = language_model(trigram_counts(docs))
    rows = labels.where("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    sample = written(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE), "labels")
    data = spark.sparkContext.broadcast(costs)

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(data)
        for batch in pieces(batches):
            found = [sorted(features(decoder.words(t))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.string()))], ["toxic", "features"])
    # the sample has at most SAMPLE rows of two numbers
    texts = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")).join(F.broadcast(sample), "doc_id").select("text", "toxic")
    known = written(arrow_map(texts, restore, "toxic int, features array<string>"), "label_features")
    toxic = F.col("toxic").cast("bigint")
    sums = known.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(F.sum(toxic).alias("a"), F.sum(1 - toxic).alias("b"))
    best = sums.where((F.col("a") >= SUPPORT) & (F.col("a") >= PRECISION * (F.col("a") + F.col("b")))).orderBy(F.desc("a"), "feature").limit(CANDIDATES).collect()
    counts = {r["feature"]: (r["a"], r["b"]) for r in best}
    names = F.array(*[F.lit(f) for f in counts]) if counts else F.array().cast("array<string>")
    bad = [r["f"] for r in known.where("toxic = 1").select(F.array_intersect("features", names).alias("f")).collect()]
    chosen, rest = choose(bad, counts, known.where("toxic = 0").count())
    return {"costs": data, "chosen": chosen, "rest": rest}


_DECODERS: dict[int, Decoder] = {}


def _decoder(data) -> Decoder:
    """The decoder of this worker for a broadcast model; its table of decoded words serves all tasks."""
    costs = data.value
    key = zlib.crc32(costs.tobytes())
    if key not in _DECODERS:
        _DECODERS.clear()
        _DECODERS[key] = Decoder(costs)
    return _DECODERS[key]


def score(docs: DataFrame, model: dict, extra: list[str]) -> DataFrame:
    """Adds score and predicted to the named columns; the highest probability of a listed feature counts."""
    data, chosen, rest = model["costs"], model["chosen"], model["rest"]
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(data)
        words = {f: p for f, p in chosen.items() if not f.endswith("*")}
        starts = {f[:-1]: p for f, p in chosen.items() if f.endswith("*")}
        sizes = sorted({len(f) for f in starts})
        for batch in pieces(batches):
            out = []
            for text in batch.column("text").to_pylist():
                best = rest
                for w in decoder.words(text or ""):
                    best = max(best, words.get(w, 0.0))
                    for n in sizes:
                        if len(w) > n:
                            best = max(best, starts.get(w[:n], 0.0))
                out.append(best)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in extra), pa.array(out, pa.float64()), pa.array([int(s >= THRESHOLD) for s in out], pa.int32())],
                                             [*extra, "score", "predicted"])
    return arrow_map(docs, run, ", ".join([*(f"`{c}` {kinds[c]}" for c in extra), "score double, predicted int"]))


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """Learn from the labels outside the held-out fold."""
    return learn(docs, labels.where(fold("doc_id", 4) != 2))


@query("op7_noisy_channel")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    held_out = (fold("doc_id", 4) == 2).alias("held_out")
    return score(docs.select(F.col("doc_id").cast("bigint"), held_out, whole_text().alias("text")), model, ["doc_id", "held_out"])
