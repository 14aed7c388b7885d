"""Op 7: the Viterbi decoder against trying all paths."""

import collections
import itertools
import random
import re

import pytest

from medtable.llm import toxicity

WORDS = "the idiot and the dumbass whore said stupid things to all losers in a tall house of glass"


@pytest.fixture(scope="module")
def decoder(spark):
    docs = spark.createDataFrame([(WORDS,)] * 20, "text string")
    return toxicity.Decoder(toxicity.language_model(toxicity.trigram_counts(docs)))


def plain_cost(decoder, text):
    a = b = 0
    cost = 0.0
    for c in text:
        n = decoder.code.get(c, 0)
        cost += decoder.costs[a][b][n]
        a, b = (0, 0) if c == " " else (b, n)
    return cost + decoder.costs[a][b][0]


def all_paths(decoder, token):
    """The cost of every text that a token may stand for: channel costs and the language model's."""
    runs = [(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", token, re.S)]
    options = [decoder._options(c, n, k in (0, len(runs) - 1)) for k, (c, n) in enumerate(runs)]
    out = {}
    for choice in itertools.product(*options):
        text = "".join(piece for piece, _ in choice)
        cost = sum(price for _, price in choice) + plain_cost(decoder, text)
        out[text] = min(cost, out.get(text, cost))
    return out


def test_decoder_finds_the_cheapest_path(decoder):
    rnd = random.Random(6)
    tokens = ["1d10t", "5tup1d", "l o s e r", "iidiioott", "$tup!d", "wh0r€", "dumba$$", "a", "!!!", "8|0", "m.o-r", "ttthhhe", "g1a$$"]
    tokens += ["".join(rnd.choice("idotsale01345$!| .") for _ in range(rnd.randrange(1, 9))).strip() or "x" for _ in range(300)]
    for token in tokens:
        paths = all_paths(decoder, token)
        got = decoder._word(token)
        assert got in paths and paths[got] == pytest.approx(min(paths.values()), abs=1e-4), token


def test_long_tokens_are_decoded_but_not_kept(decoder):
    token = "1d10t" * 40
    before = decoder.known.cache_info().currsize
    assert decoder.word(token) == decoder._word(token) and decoder.known.cache_info().currsize == before


def test_trigram_counts_of_a_text_of_several_slices(spark):
    rnd = random.Random(1)
    text = "".join(rnd.choices("abcdeé .Σ1", k=3 * toxicity.SLICE + 17))
    got = toxicity.trigram_counts(spark.createDataFrame([(text,)], "text string"))
    code = {c: k for k, c in enumerate(toxicity.LETTERS, 1)}
    codes = [code.get(c, 0) for c in "\n\n" + text.lower() + "\n"]
    want = collections.Counter(zip(codes, codes[1:], codes[2:]))
    assert got.sum() == sum(want.values()) and all(got[k] == n for k, n in want.items())
