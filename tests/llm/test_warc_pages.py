"""Op 9: hostile pages in linear time, and record ids of pages that share an id."""

import random
import re
import time

import pytest

from medtable.llm import warc

HOSTILE = ["<div ", "<p a=\"", "<meta ", "<title>a", "<!--", "<![CDATA[", "<a href='", "<", "</", "<script>", "<p a='\"", "\"<a ", "<p \"'>", "<!", "<title", "<noscript><a ", "&amp", "\n ", "<a href=x "]


@pytest.mark.parametrize("part", HOSTILE)
def test_hostile_pages_take_linear_time(part):
    page = part * (1_000_000 // len(part))
    start = time.process_time()
    warc.Scanner(page).plain()
    assert time.process_time() - start < 5  # about one second where nothing else runs


def plain_end(page, at):
    """End of a tag by its definition: quoted parts are skipped whole."""
    m = re.compile(r"""(?:"[^"]*"|'[^']*'|[^"'>])*>""").match(page, at)
    return m.end() if m else -1


def test_tag_ends_equal_their_definition():
    rnd = random.Random(2)
    for _ in range(3000):
        page = "".join(rnd.choice(["<a", "<", ">", "'", '"', "x", " "]) for _ in range(rnd.randrange(30)))
        s = warc.Scanner("")
        s.page, s.last, s.ends, s.ahead = page, {c: page.rfind(c) for c in "\"'>"}, {}, (0, -1)
        for m in re.finditer("<a", page):
            assert s._tag_end(m.end()) == plain_end(page, m.end()), page


def test_scanner_fields():
    s = warc.Scanner("<!DOCTYPE html><html lang='de'><head><meta charset=utf-8><title>A &amp; B</title></head><body><p title='a > b'>x < y<br>z<a href=\"/q?a=1&amp;b=2\">l</a></p><!-- <title>no</title>")
    assert (s.lang, s.charset, s.title, s.links) == ("de", "utf-8", "A &amp; B", ["/q?a=1&b=2"])
    assert s.plain() == "x < y\nzl"


def test_pages_with_one_id_have_records_of_their_own(spark):
    rows = [(1, "u", "a"), (1, "u", "b"), (None, None, "c"), (None, None, "d"), (None, None, "d"), (2, "u", None), (2, "u", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' AS record_id", "'y' AS kind", "'z' AS headers")
    made = warc.derivatives(warc.responses(pages)).collect()
    assert len(made) == 14 and len({r.record_id for r in made}) == 10 and len({r.refers_to for r in made}) == 5
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0
