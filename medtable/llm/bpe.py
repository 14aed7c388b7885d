"""Op 3: byte-pair encoding and decoding with a pair occurrence index.

The words of a batch that are not known yet are laid out as one linked list of symbols. An index maps each
mergeable pair, by its rank, to all its positions. Active ranks are applied in ascending order; a merge
looks only at the pairs it touches and appends them to the lists of their ranks. Words are found with array
operations on code points, and the ids of known words are kept in a table of bounded size.

Null and empty texts have no ids. Special tokens written out in a text become their ids, as in the library.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from .common import arrow_map, pieces, table, whole_text
from .registry import query
from .words import mix

U = np.uint64
SPACE, LETTER, NUMBER, OTHER = range(4)
_BASE = U(0x9E3779B97F4A7C55)
_HIGH, _NFC = re.compile("[\u0300-\U0010ffff]"), normalizers.NFC()  # below, every text is in NFC


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(1)
def _later_points() -> str:
    """Code points that this Python's Unicode tables do not know yet; the library's may."""
    return "".join(c for c in map(chr, range(0x40000)) if unicodedata.category(c) == "Cn")


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point: space, letter, number or other."""
    groups = {"L": LETTER, "N": NUMBER, "Z": SPACE}
    out = np.full(0x110000, OTHER, np.uint8)
    out[:0x40000] = np.fromiter((groups.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x40000)), np.uint8, 0x40000)
    out[[*range(9, 14), 0x85]] = SPACE  # white space that has the category of control characters
    for kind, pattern in ((LETTER, r"[^\p{L}]+"), (NUMBER, r"[^\p{N}]+")):
        for part, _ in pre_tokenizers.Split(Regex(pattern), "removed").pre_tokenize_str(_later_points()):
            out[np.frombuffer(part.encode("utf-32-le"), np.uint32)] = kind
    return out


@lru_cache(1)
def _lower_cases() -> tuple[re.Pattern, dict[int, str]]:
    """Code points whose lower case Python does not know as the library does."""
    lower = normalizers.Lowercase().normalize_str("\n".join(_later_points())).split("\n")
    own = {ord(c): x for c, x in zip(_later_points(), lower, strict=True) if c.lower() != x} | {ord("Σ"): "σ"}
    return re.compile("[" + "".join(map(re.escape, map(chr, own))) + "]"), own


@lru_cache(1)
def _point_codes() -> np.ndarray:
    return mix(np.arange(1, 0x110001, dtype=U) * U(0x9E3779B97F4A7C15))


@lru_cache(1)
def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Tokens and merges of a tokenizer file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        self.tokens = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = token
        self.bytes = [t.encode() for t in self.tokens]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.made = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in pairs]
        keys = np.array([a << 20 | b for a, b, _ in self.made] + [1 << 62], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order
        makers: dict[int, int] = {}
        for rank, (_, _, new) in enumerate(self.made):
            makers[new] = rank  # the last rank that makes it
        #: Ranks whose result may be part of a pair of lower rank.
        self.careful = {makers[x] for r, (a, b, _) in enumerate(self.made) for x in (a, b) if makers.get(x, -1) > r}
        symbols = _byte_symbols()
        self.inner = np.array([self.ids[s] for s in symbols], np.int64)
        self.last = np.array([self.ids[s + end] for s in symbols], np.int64)
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in a row and their number in each word, by one pair occurrence index over all words."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b"".join(words), np.uint8)
    n = len(raw)
    heads = np.cumsum(sizes) - sizes
    tails = heads + sizes - 1
    sym = np.empty(n + 1, np.int64)
    sym[:n] = v.inner[raw]
    sym[tails] = v.last[raw[tails]]
    sym[n] = -1
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    after[tails] = n  # n stands for the end of a word, n + 1 - 1 for what is before its start
    before[heads] = n
    after[n] = before[n] = n
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def note(places: np.ndarray) -> None:
        """Add the pairs that start at these places to the lists of their ranks."""
        keys = sym[places] << 20 | sym[after[places]]
        at = np.searchsorted(v.pair_keys, keys)
        hit = v.pair_keys[at] == keys
        ranks, places = v.pair_ranks[at[hit]], places[hit]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = (np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist()
        for r, a, b in zip(ranks[[0, *cuts]].tolist(), [0, *cuts], [*cuts, len(ranks)]):
            if r in index:
                index[r].append(places[a:b])
            else:
                index[r] = [places[a:b]]
                heapq.heappush(active, r)

    note(np.flatnonzero(after[:n] < n))
    while active:
        rank = heapq.heappop(active)
        left, right, new = v.made[rank]
        lists = index.pop(rank)
        p = lists[0] if len(lists) == 1 else np.concatenate(lists)
        q = after[p]
        good = (sym[p] == left) & (sym[q] == right)  # else an earlier merge took one of the sides
        if not good.all():
            p = p[good]
        if not len(p):
            continue
        if left == right or rank in v.careful:
            p = np.unique(p)
        if rank in v.careful and len(p) > 1:
            # this merge may make a pair of lower rank, which then goes first: one place at a time
            index[rank] = [p[1:]]
            heapq.heappush(active, rank)
            p = p[:1]
        q = after[p]
        if left == right:  # in a run of equal symbols every other pair is merged, from the left
            linked = np.append(False, p[1:] == q[:-1])
            start = np.maximum.accumulate(np.where(linked, 0, np.arange(len(p))))
            p = p[(np.arange(len(p)) - start) % 2 == 0]
            q = after[p]
        nxt = after[q]
        sym[p] = new
        sym[q] = -1
        after[p] = nxt
        before[nxt] = p
        before[n] = n
        prv = before[p]
        touched = np.concatenate([p[nxt < n], prv[(prv < n) & (sym[prv] != new)]])
        if (same := (prv < n) & (sym[prv] == new)).any():
            touched = np.unique(np.concatenate([touched, prv[same]]))
        if len(touched):
            note(touched)
    alive = sym[:n] >= 0
    return sym[:n][alive], np.add.reduceat(alive.astype(np.int64), heads) if n else sizes


def _powers(n: int, kept: list[np.ndarray] = [np.ones(1, U)]) -> np.ndarray:  # noqa: B006
    if n > len(kept[0]):
        kept[0] = np.multiply.accumulate(np.concatenate([np.ones(1, U), np.full(max(255, 2 * n), _BASE)]))
    return kept[0]


def split_words(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of many texts, given as code points in a row.

    A word is a short form after an apostrophe, a run of letters, a single number or a run of others.
    """
    n = len(points)
    kind = _classes()[points]
    edge = np.empty(n, bool)
    edge[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge |= kind == NUMBER
    text_starts = offsets[:-1][offsets[:-1] < n]
    edge[text_starts] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], n)
    single = np.flatnonzero((points[starts] == 0x27) & (ends - starts == 1))
    single = single[single + 1 < len(starts)]
    if len(single):
        run = single + 1
        a = starts[run]
        ok = (kind[a] == LETTER) & ~np.isin(a, text_starts)
        single, run, a = single[ok], run[ok], a[ok]
        size = ends[run] - a
        one, two = points[a], points[np.minimum(a + 1, n - 1)]
        s, t, m, d, r, e, v_, l_ = map(ord, "stmdrevl")
        pair = (size >= 2) & (((one == r) & (two == e)) | ((one == v_) & (two == e)) | ((one == l_) & (two == l_)))
        taken = np.where((one == s) | (one == t) | (one == m) | (one == d), 1, np.where(pair, 2, 0))
        ends[single] += taken
        starts[run] += taken
    keep = (starts < ends) & (kind[np.minimum(starts, n - 1)] != SPACE) if n else np.zeros(0, bool)
    return starts[keep], ends[keep]


class Encoder:
    """Encodes batches of texts; keeps the ids of at most ``room`` words."""

    def __init__(self, path: str, room: int = 1 << 20):
        self.v = vocabulary(path)
        self.slots = room
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(self.slots, U)
        self.number = np.zeros(self.slots, np.int32)
        self.flat = np.zeros(1 << 20, np.uint16 if len(self.v.tokens) <= 1 << 16 else np.int32)
        self.used, self.words = 0, 0
        self.at = np.zeros(1 << 16, np.int64)

    def _grow(self, extra: int, words: int) -> None:
        while self.used + extra > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.words + words + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])

    def normal(self, text: str) -> str:
        """NFC, then every code point in lower case by itself."""
        if not text.isascii():
            if _HIGH.search(text):
                text = _NFC.normalize_str(text)
                pattern, own = _lower_cases()
                if pattern.search(text):
                    text = text.translate(own)
        return text.lower()

    @staticmethod
    def _hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sizes = ends - starts
        at = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(at, sizes)
        code = _point_codes()[points[place + np.repeat(starts, sizes)]]
        code *= _powers(int(sizes.max()))[place]
        return mix(np.add.reduceat(code, at) + sizes.astype(U)) | U(1)

    def _numbers(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of each word in the table of known words; adds those that are missing."""
        h = np.concatenate([self._hashes(points, starts[k:k + (1 << 17)], ends[k:k + (1 << 17)]) for k in range(0, len(starts), 1 << 17)])
        slot = (h >> U(20)).astype(np.int64) % self.slots
        out = self.number[slot]
        missing = np.flatnonzero(self.keys[slot] != h)
        if len(missing):
            keys, first, which = np.unique(h[missing], return_index=True, return_inverse=True)
            if self.words + len(keys) > 2 * self.slots:
                self._clear()
                return self._numbers(points, starts, ends)
            where = missing[first]
            whole = points.astype("<u4").tobytes()
            found = [whole[4 * a:4 * b].decode("utf-32-le").encode() for a, b in zip(starts[where].tolist(), ends[where].tolist())]
            ids, counts = encode_words(found, self.v)
            self._grow(len(ids), len(found))
            self.flat[self.used:self.used + len(ids)] = ids
            self.at[self.words + 1:self.words + 1 + len(found)] = self.used + np.cumsum(counts)
            new = np.arange(self.words, self.words + len(found), dtype=np.int32)
            self.used += len(ids)
            self.words += len(found)
            put, one = np.unique((keys >> U(20)).astype(np.int64) % self.slots, return_index=True)  # one word for each slot
            self.keys[put], self.number[put] = keys[one], new[one]
            out[missing] = new[which]
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and the offsets between the texts."""
        v = self.v
        parts, owner, special = [], [], []
        for k, text in enumerate(texts):
            if v.split is not None and "<" in text:
                for part in v.split.split(text):
                    owner.append(k)
                    special.append(v.special.get(part, -1))
                    parts.append("" if special[-1] >= 0 else self.normal(part))
            else:
                owner.append(k)
                special.append(-1)
                parts.append(self.normal(text))
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
        points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts, ends = split_words(points, offsets) if len(points) else (np.zeros(0, np.int64),) * 2
        numbers = self._numbers(points, starts, ends) if len(starts) else np.zeros(0, np.int32)
        if max(special, default=-1) >= 0:  # a special token stands as a word of its own
            marks = [k for k, s in enumerate(special) if s >= 0]
            self._grow(len(marks), len(marks))
            mine = []
            for k in marks:
                self.flat[self.used] = special[k]
                self.used += 1
                self.words += 1
                self.at[self.words] = self.used
                mine.append(self.words - 1)
            where = np.searchsorted(starts, offsets[marks])
            numbers, starts = np.insert(numbers, where, mine), np.insert(starts, where, offsets[marks])
            part_of = np.insert(np.searchsorted(offsets, np.delete(starts, where + np.arange(len(where))), "right") - 1, where, marks)
        else:
            part_of = np.searchsorted(offsets, starts, "right") - 1
        a = self.at[numbers]
        sizes = self.at[numbers + 1] - a
        owners = np.asarray(owner, np.int64)[part_of] if len(part_of) else np.zeros(0, np.int64)
        total = int(sizes.sum())
        ids = self.flat[np.repeat(a - np.cumsum(sizes) + sizes, sizes) + np.arange(total)] if total else self.flat[:0]
        per = np.bincount(owners, sizes, len(texts)).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
        return ids, np.concatenate([np.zeros(1, np.int64), np.cumsum(per)])


def decode(ids: np.ndarray, v: Vocabulary) -> bytes:
    """The tokens of the ids, with a space between them, in UTF-8."""
    return b" ".join(map(v.bytes.__getitem__, ids.tolist()))


#: Bytes of text that are encoded at once; code points and word places take some thirty times that.
ENCODE_BYTES = 2 << 20


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """The encoder of this worker; its table of known words serves all its tasks."""
    return Encoder(path)


def _codec(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in pieces(batches, limit=ENCODE_BYTES):
            texts = batch.column("text").to_pylist()
            ids, at = enc.encode(texts)
            wide = ids.astype("<u4")
            counts, hashes, decoded = [], [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                counts.append(b - a)
                hashes.append(hashlib.sha256(wide[a:b].tobytes()).hexdigest())
                decoded.append(hashlib.sha256(decode(ids[a:b], enc.v)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``ids`` of every document; null text is empty."""
    def run(batches):
        enc = encoder(path)
        for batch in pieces(batches, limit=ENCODE_BYTES):
            ids, at = enc.encode(batch.column("text").to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "ids"])
    return arrow_map(docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")), run, "doc_id bigint, ids array<int>")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Number of ids, digest of the ids and digest of the text decoded from them, for every document."""
    return arrow_map(docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")), _codec(path),
                     "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


@query("op3_bpe_codec")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), default_vocabulary())
