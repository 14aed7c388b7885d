"""Op 12 against plain counting of all phrases."""

import collections
import random
import re

import pytest

from medtable.llm import setm

SCHEMA = "text string, lang string, block int, words string, name bigint, n string, phrase string"


def frame(spark, rows):
    """Documents with extra columns whose names the operator uses inside."""
    return spark.createDataFrame([(t, g, 1, "x", 5, "y", "z") for t, g in rows], SCHEMA)


def plain(rows, least=setm.LEAST, longest=setm.LONGEST, top=setm.TOP):
    counts, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for a in range(len(words) - size + 1):
                    counts[lang, tuple(words[a:a + size])] += 1
    found = {k: v for k, v in counts.items() if len(k[1]) > 1 and v >= least}
    covered = set()
    for (lang, words), a in found.items():
        for size in range(2, len(words)):
            for b in range(len(words) - size + 1):
                part = (lang, words[b:b + size])
                if 100 * a >= 80 * found[part]:
                    covered.add(part)
    out = collections.defaultdict(list)
    for (lang, words), a in found.items():
        if (lang, words) not in covered:
            score, _, l, r = min((2_000_000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k, counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words)))
            out[lang].append((-score, -a, " ".join(words).encode(), l, r))
    return sorted((lang, k, p.decode(), -a, l, r, n[lang], -s) for lang, rest in out.items() for k, (s, a, p, l, r) in enumerate(sorted(rest)[:top], 1))


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def noise(seed, count):
    rng = random.Random(seed)
    words = ["a", "b", "É", "é", "x\xa0y", "\x85", "dd", "E", "e", "A"]
    return [("".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ", ", "\x0c", "!", "\x1c"]) for _ in range(rng.randrange(60))), rng.choice(["en", "en", "de", None, "und"])) for _ in range(count)]


@pytest.mark.parametrize("limit", [300, setm.BLOCK_BYTES])
def test_phrases(spark, limit):
    rows = noise(1, 1500) + [(None, "en"), ("", None), (" . ", "de"), ("one two three four " * 40, "en"), ("p q " * 3000, "fr"), ("one Two three four", "EN"), ("s t u\n" * 35, "es"), ("s t\n" * 8, "es")]
    want = plain(rows)
    assert len(want) > 50
    assert got(setm.collocations(frame(spark, rows).repartition(3), limit=limit)) == want


def test_ties_top_and_parameters(spark):
    rows = noise(2, 900) + [(f"k{k} l{k}. " * 31, "en") for k in range(40)]
    assert got(setm.collocations(frame(spark, rows), top=17)) == plain(rows, top=17)
    assert got(setm.collocations(frame(spark, rows), least=100, longest=2)) == plain(rows, least=100, longest=2)


def test_nothing_to_find(spark):
    assert got(setm.collocations(frame(spark, []))) == []
    assert got(setm.collocations(frame(spark, [(None, None), ("", "en"), ("a b c", "en")]))) == []


def test_one_long_text_and_one_long_piece(spark):
    rows = [("lorem ipsum dolor. " * 20_000, "en"), ("alpha beta " * 20_000, "en"), ("w" * 300_000, "de")]
    assert got(setm.collocations(frame(spark, rows), limit=5_000)) == plain(rows)


def test_cut_keeps_pieces_whole():
    for text in (b"", b".", b"aaa.bb.c", b"aaaaaaaaaaaa", b"a.aaaaaaaaaaaa.b", b"...."):
        parts = list(setm.cut(text, 4))
        assert b".".join(parts) == text
        assert all(len(p) <= 4 or b"." not in p for p in parts)


def test_check_sql_agrees(spark, sf):
    from tests.check import compare, connect

    error, rows = compare(setm.op12(spark, sf), connect(sf), setm.check_sql())
    assert error is None and rows > 20
