"""The training-data operators against plain versions on small tables."""

import collections
import hashlib
import html.parser
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from medtable.llm import ann, bpe, catalog, chat, exact, graph, lines, lm, near, packing, toxicity, warc, words

SCHEMA = "doc_id bigint, text string, lang string, print int, node string"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", 1, "x") for i, t in rows], SCHEMA)


def documents(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


ODD = [(1, None), (2, ""), (3, "  \n\n "), (4, "a"), (4, "a"), (None, "a b"), (None, None), (7, "x" * 50_000), (8, "w " * 30_000), (9, "Σ İ é < <|endoftext|> it's 'll 12")]


def test_word_hashes_cross_blocks(monkeypatch):
    monkeypatch.setattr(words, "BLOCK", 7)
    texts = ["", "Aa bb  ccccccccccccccccccc d", "\n", "x", "aa"]
    data = "".join(texts).encode()
    h, n = words.word_hashes(np.frombuffer(data, np.uint8), np.cumsum([0, *map(len, texts)]))
    assert n.tolist() == [len(t.split()) for t in texts]
    assert len(set(h.tolist())) == len({w.lower() for t in texts for w in t.split()})


def test_ids_equal_the_library(spark, sf):
    from tokenizers import Tokenizer

    path = bpe.default_vocabulary()
    tool = Tokenizer.from_file(path)
    rows = documents(spark, sf) + ODD
    got = collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(frame(spark, rows), path).collect())
    want = collections.Counter()
    for i, t in rows:
        ids = tool.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tool.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert got == want
    assert {r.doc_id: r.ids for r in bpe.encode_documents(frame(spark, [(5, "hello hello")]), path).collect()}[5] == tool.encode("hello hello").ids


def test_packing_is_whole_and_gapless(spark):
    from tokenizers import Tokenizer

    rows = ODD + [(100 + k, "word " * (k * 37 % 5000)) for k in range(120)]
    tool, got = Tokenizer.from_file(bpe.default_vocabulary()), packing.pack(frame(spark, rows), bpe.default_vocabulary()).collect()
    want = collections.Counter()
    for i, t in rows:
        ids = np.array([*tool.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.update((i, a, zlib.crc32(ids[a:a + 4096].tobytes()), len(ids)) for a in range(0, len(ids), 4096))
    assert collections.Counter((r.doc_id, r.start, r.ids_crc32, r.doc_tokens) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert sum(r.length for r in got) > 0.9 * 4096 * len(by)


def test_histogram_packs_every_piece_once():
    random.seed(3)
    for _ in range(50):
        sizes = [random.randint(1, 64) for _ in range(random.randint(1, 200))]
        patterns = packing.pack_histogram(collections.Counter(sizes), 64)
        assert collections.Counter(x for n, p in patterns for x in p for _ in range(n)) == collections.Counter(sizes)
        assert all(sum(p) <= 64 for _, p in patterns)


def _kept(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    return {k: (min(v)[3], len(v)) for k, v in groups.items()}


def test_exact_groups(spark, sf, monkeypatch):
    rows = documents(spark, sf) + ODD + [(20, "a  "), (21, "\ta"), (None, "a"), (22, "é"), (23, "é")]
    got, want = exact.deduplicate(frame(spark, rows)).collect(), _kept(rows)
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    assert all((r.keep_id, r.group_size) == by_sha[r.text_sha256] for r in got)
    assert collections.Counter(r.text_sha256 for r in got if r.kept) == collections.Counter(list(by_sha))
    data = np.frombuffer(bytes(range(256)) * 1000, np.uint8)
    whole = exact.fingerprint(data)
    assert whole == exact.combine(exact.fingerprint(data[:77_777]), exact.fingerprint(data[77_777:]), len(data) - 77_777)
    assert exact._short_prints(data[:300], np.array([0, 100, 100, 300]))[0].tolist() == [exact.fingerprint(data[a:b])[0] for a, b in ((0, 100), (100, 100), (100, 300))]


def test_collisions_are_told_apart(spark, monkeypatch):
    """With a useless fingerprint the comparison still finds the groups."""
    source = exact._prints

    def poor(chunked):
        run = source(chunked)

        def worse(batches):
            for b in run(batches):
                yield b.set_column(1, "print", __import__("pyarrow").array([0] * b.num_rows, "int64"))
        return worse
    monkeypatch.setattr(exact, "_prints", poor)
    rows = [(1, "ab"), (2, "ab"), (3, "ba"), (4, "bc"), (5, "b c"), (6, "zzz")]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact.deduplicate(frame(spark, rows)).collect()}
    assert got == {1: (1, 2, True), 2: (1, 2, False), 3: (3, 1, True), 4: (5, 2, False), 5: (5, 2, True), 6: (6, 1, True)}


def _shingles(t):
    w = (t or "").encode().lower().split()
    return collections.Counter([tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else [])


def _similar(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    return sum(1 / sum(max(a[y] / a[x], b[y] / b[x]) for y in set(a) | set(b)) for x in set(a) & set(b))


def test_near_classes(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 8)
    random.seed(5)
    vocabulary = [f"w{k}" for k in range(300)]
    base = [random.choices(vocabulary, k=random.randint(3, 120)) for _ in range(12)]
    rows = [(i, t) for i, t in ODD if i is not None and i < 7]
    for k in range(150):
        w = list(random.choice(base))
        for _ in range(random.choice([0, 0, 1, 1, 2, 6])):
            w[random.randrange(len(w))] = random.choice(vocabulary)
        rows.append((100 + k, " ".join(w * random.choice([1, 1, 2]))))
    sets = [_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k
    for a in range(len(rows)):
        for b in range(a):
            if top(a) != top(b) and (sets[a].keys() & sets[b].keys() or not sets[a] and not sets[b]) and _similar(sets[a], sets[b]) >= 0.8:
                root[top(a)] = top(b)
    smallest = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        smallest[top(k)].append(i)
    want = collections.Counter((rows[k][0], min(smallest[top(k)]), len(smallest[top(k)])) for k in range(len(rows)))
    got = near.classes(frame(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.class_id, r.class_size) for r in got) == want
    assert sum(r.kept for r in got) == len(smallest)
    stay = near.keep_one(frame(spark, rows))
    assert stay.columns == frame(spark, rows).columns and stay.count() == len(smallest)


def test_near_classes_without_own_ids(spark):
    """Unrelated texts with null ids, or with one id, are classes of their own and all stay."""
    texts = {k: " ".join(f"{k}{n}" for n in range(30)) for k in "abcdef"}
    rows = [(None, texts["a"]), (None, texts["a"] + " more"), (None, texts["b"]), (None, None), (None, ""), (5, texts["c"]), (5, texts["d"]), (5, texts["d"]), (6, texts["e"]), (None, texts["e"]),
            (7, texts["f"]), (7, texts["f"] + " more")]
    got = near.classes(frame(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.class_id, r.class_size) for r in got) == collections.Counter({(None, None, 2): 4, (None, None, 1): 1, (5, 5, 1): 1, (5, 5, 2): 2, (6, 6, 2): 1, (None, 6, 2): 1, (7, 7, 2): 2})
    by_key = collections.Counter(r.class_key for r in got)
    assert sorted(by_key.values()) == [1, 1, 2, 2, 2, 2, 2] and all(r.class_size == by_key[r.class_key] for r in got)
    assert collections.Counter(r.class_key for r in got if r.kept) == collections.Counter(list(by_key))
    stay = [(r.doc_id, (r.text or "").split(" more")[0]) for r in near.keep_one(frame(spark, rows)).collect()]
    assert sorted(stay, key=repr) == sorted([(None, texts["a"]), (None, texts["b"]), (None, ""), (5, texts["c"]), (5, texts["d"]), (6, texts["e"]), (7, texts["f"])], key=repr)


def test_signature_share_estimates_similarity():
    a, b = np.arange(1, 401, dtype=np.uint64) * np.uint64(7919), np.arange(81, 481, dtype=np.uint64) * np.uint64(7919)
    a, b = words.mix(a), words.mix(b)
    x = np.concatenate([a, b])
    owner = np.repeat([0, 1], 400)
    found = near.signatures(owner, x, np.ones(800, int), 2, 2000)
    assert abs((found[0] == found[1]).mean() - 320 / 480) < 0.04


def test_components(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, 101), (103, 102), (102, 100), (7, 7)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert len({got[k] for k in range(41)}) == 1 and len({got[k] for k in range(100, 104)}) == 1 and got[0] != got[100]


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
    return out


def test_line_edit_join(spark):
    random.seed(9)
    base = ["".join(random.choices("abcd é", k=random.randint(30, 70))).strip() for _ in range(8)]
    rows = [(1, None), (2, ""), (None, base[0]), (None, base[1] + "!")]
    for k in range(40):
        texts = []
        for _ in range(random.randint(1, 5)):
            s = list(random.choice(base))
            for _ in range(random.randint(0, 4)):
                at = random.randrange(len(s))
                random.choice([lambda: s.insert(at, "z"), lambda: s.pop(at), lambda: s.__setitem__(at, "q")])()
            texts.append("".join(s))
        rows.append((10 + k, "\n".join([*texts, " "])))
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for k, s in enumerate((t or "").split("\n")):
            if s.strip():
                place = (i is None, i or 0, k)
                first[s.strip()] = min(first.get(s.strip(), place), place)
    order = sorted(first, key=first.get)
    near_lines = {b for n, b in enumerate(order) for a in order[:n] if min(len(a), len(b)) >= 40 and first[a] != first[b] and _edits(a, b) <= 2}
    want = collections.defaultdict(lambda: [0, 0, 0, set()])
    for i, t in rows:
        for k, s in enumerate((t or "").split("\n")):
            mine, s = want[i], s.strip()
            if s:
                mine[0] += 1
                if s in near_lines:
                    mine[2] += 1
                    mine[3].add(k)
                elif first[s] != (i is None, i or 0, k):
                    mine[1] += 1
                    mine[3].add(k)
    got = {r.doc_id: [r.n_lines, r.n_exact, r.n_near, {int(x) for x in r.dropped.split(",") if x}] for r in lines.report(frame(spark, rows)).collect()}
    assert sum(v[2] for v in got.values()) > 10
    assert {k: v for k, v in got.items() if k is not None} == {k: v for k, v in want.items() if k is not None}
    cleaned = lines.clean(frame(spark, rows))
    assert cleaned.columns == frame(spark, rows).columns


def test_line_links_are_whole(spark, monkeypatch):
    """Classes and numbers of links equal those of all pairs, also where a key is hot and for lines under 40 code points."""
    monkeypatch.setattr(lines, "CELL", 4)
    random.seed(11)
    base = ["".join(random.choices("abcdefgh ", k=n)).strip("  ").ljust(n, "x") for n in (15, 20, 24, 30, 38, 39, 40, 41, 60, 60)]
    texts = set()
    for s in base:
        for _ in range(14):
            t = list(s)
            for _ in range(random.randint(0, 3)):
                at = random.randrange(len(t))
                random.choice([lambda: t.insert(at, "z"), lambda: t.pop(at), lambda: t.__setitem__(at, "q")])()
            texts.add("".join(t).strip())
    texts = sorted(texts)
    near_pairs = [(a, b) for n, b in enumerate(texts) for a in texts[:n] if _edits(a, b) <= (2 if min(len(a), len(b)) >= 40 else 1 if min(len(a), len(b)) >= 20 else 0)]
    assert any(min(map(len, p)) < 40 for p in near_pairs)
    links, root = collections.Counter(x for p in near_pairs for x in p), {x: x for x in texts}
    for a, b in near_pairs:
        old = root[b]
        root = {x: root[a] if r == old else r for x, r in root.items()}
    members = collections.defaultdict(set)
    for x in links:
        members[root[x]].add(x)
    got = [(texts[10 * r.doc_id + x.line_no], x.class_id, x.links) for r in lines.report(frame(spark, [(k, "\n".join(texts[10 * k:10 * k + 10])) for k in range(-(-len(texts) // 10))])).collect() for x in r.linked]
    assert {t: n for t, _, n in got} == dict(links) and len(got) == len(links)
    found = collections.defaultdict(set)
    for t, c, _ in got:
        found[c].add(t)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, members.values()))


def test_clean_keeps_rows_with_shared_ids_apart(spark):
    """Rows with a repeated or null id lose their own repeated lines only, and equal rows are repeats of each other."""
    rows = [(1, "first of all\ncommon\nown of one"), (2, "common\nown of two"), (2, "said once\nalso said\ncommon"), (None, "common\nnull a"), (None, "null b\nnull c\n\nown of one"), (None, "null b"), (3, "same\nrow"), (3, "same\nrow"), (None, None)]
    got = [(r.doc_id, r.text) for r in lines.clean(frame(spark, rows)).collect()]
    said = collections.Counter(x for _, t in got for x in (t or "").split("\n") if x)
    assert said == collections.Counter({x for _, t in rows for x in (t or "").split("\n") if x})
    assert collections.Counter(i for i, _ in got) == collections.Counter([1, 2, 2, None, None, None, 3]) or collections.Counter(i for i, _ in got) == collections.Counter([1, 2, 2, None, None, 3, None, None])
    assert (1, rows[0][1]) in got and (2, "own of two") in got and (3, "same\nrow") in got and (None, "null a") in got
    found = [(r.doc_id, r.n_lines, r.n_exact) for r in lines.report(frame(spark, rows)).collect()]
    assert len(found) == len(rows) and sum(n for _, n, _ in found) == 18 and sum(n for _, _, n in found) == 18 - len(said)


def test_tallies_lose_no_pair(spark):
    """Lines within two edits always pass, also where a count goes over 64."""
    base = ["e" * 64 + "tail", "e" * 63 + "tails of it", "the quick brown fox " * 8, "ä" * 50]
    pairs = [(x, y) for x in base for y in (x, x[1:], x + "et", x[:5] + "zz" + x[7:], "e" + x, x[:-2], "q" + x[1:-1] + "t")]
    df = spark.createDataFrame(pairs + [(base[0], base[2])], "a STRING, b STRING")
    near = lines.tallies_near(lines.tally(df.a), lines.tally(df.b), 2)
    got = df.select("a", "b", F.levenshtein("a", "b").alias("d"), near.alias("n")).collect()
    assert all(r.n for r in got if r.d <= 2) and not all(r.n for r in got)


def test_within_equals_the_distance(spark):
    random.seed(2)
    pairs = []
    for _ in range(300):
        a = "".join(random.choices("ab", k=random.randint(0, 9)))
        b = "".join(random.choices("ab", k=random.randint(0, 9)))
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string")
    for edits in (1, 2, 3):
        got = df.select("a", "b", lines.within(df.a, df.b, edits).alias("w")).collect()
        assert all(r.w == (_edits(r.a, r.b) <= edits) for r in got)


def _plain_model(train, rows):
    tokens = [["<s>", *(t or "").encode().lower().split(), "</s>"] for t in train]
    one = collections.Counter(w for t in tokens for w in t[1:])
    two = collections.Counter(p for t in tokens for p in zip(t, t[1:]))
    before, total, after = collections.Counter(b for _, b in two), collections.Counter(), collections.defaultdict(list)
    for (a, _), n in two.items():
        total[a] += n
        after[a].append(n)

    def counted(c):
        return [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
    d2, d1 = [0, *lm.discounts(counted(two))], [0, *lm.discounts(counted(before))]
    kinds, n, v = len(two), sum(one.values()), len(one)
    floor = sum(d1[min(x, 3)] for x in before.values()) / kinds / (v + 1)
    out = []
    for t in rows:
        tokens, base, score = ["<s>", *(t or "").encode().lower().split(), "</s>"], 0.0, 0.0
        for a, b in zip(tokens, tokens[1:]):
            low = max(before[b] - d1[min(before[b], 3)], 0) / kinds + floor
            if total[a]:
                left = sum(d2[min(x, 3)] for x in after[a]) / total[a]
                low = max(two[a, b] - d2[min(two[a, b], 3)], 0) / total[a] + left * low
            base += math.log10((one[b] + 1) / (n + v + 1))
            score += math.log10(low)
        out.append((len(tokens) - 1, sum(w in one for w in tokens[1:]), n, base, score))
    return out


def test_model_equals_plain_counts(spark, sf, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_BYTES", 100_000)
    rows = [(i, t) for i, t in documents(spark, sf) if i is not None] + [(10_000 + k, t) for k, (_, t) in enumerate(ODD)]
    train = [t for i, t in rows if i % 3]
    model = lm.fit(frame(spark, [r for r in rows if r[0] % 3]))
    assert model["buckets"] > 1 and model["hot"]
    got = {r.doc_id: r for r in lm.score(frame(spark, rows).select("doc_id", "text"), model, ["doc_id"]).collect()}
    for (i, _), (size, known, n, base, score) in zip(rows, _plain_model(train, [t for _, t in rows])):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (size, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_model_probabilities_sum_to_one(spark):
    rows = [(k, t) for k, t in enumerate(["a b a c", "a b", "c c c a", "b a d e f", "a b c d e"])]
    vocabulary = sorted({w for _, t in rows for w in t.split()})
    model = lm.fit(frame(spark, rows))
    probes = frame(spark, [(k, f"a {w}") for k, w in enumerate([*vocabulary, "unseen"])] + [(99, "a")]).select("doc_id", "text")
    scores = {r.doc_id: r.score for r in lm.score(probes, model, ["doc_id"]).collect()}
    assert all(math.isfinite(s) and s < 0 for s in scores.values())
    empty = lm.fit(frame(spark, []))
    assert lm.score(probes, empty, ["doc_id"]).count() == len(scores)


def test_nearest_recall_and_edges(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[700:1000] = x[3]  # a very common vector
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(5000, None), (5050, [0.0] * 16), (5100, [float("nan")] * 16), (5150, [None] * 16), (None, [1.0] * 16), (5200, [1.0, 2.0]), (0, x[0].tolist())]
    got = collections.defaultdict(list)
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    y = x.astype(np.float64)
    cosine = y @ y.T / np.outer(np.linalg.norm(y, axis=1), np.linalg.norm(y, axis=1))
    hits = 0
    for q in range(0, 1500, 50):
        want = [i for i in np.lexsort((np.arange(1500), -np.round(cosine[q], 12))) if i != q][:5]
        hits += len(set(want) & {i for i, _ in got[q]})
        assert all(s == pytest.approx(cosine[q, i], abs=1e-12) for i, s in got[q])
    assert hits >= 0.9 * 5 * 30 and len(got[0]) == 5 and 5200 not in got


class _Text(html.parser.HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in warc.HIDDEN
        if tag in warc.BLOCKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        self.skip -= tag in warc.HIDDEN
        if tag in warc.BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def test_records(spark, sf):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()] + [(None, None, None), (9000, "u", ""), (9000, "u", ""), (9001, "u", "<b>x < y<script>1")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    sources = warc.responses(df)
    made = warc.derivatives(sources).collect()
    assert len(made) == 2 * len(pages)
    ids = {r.record_id for r in sources.collect()}
    for r in made:
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        assert r.refers_to in ids and f"WARC-Refers-To: {r.refers_to}".encode() in head and r.source_digest.encode() in head
        assert f"Content-Length: {r.content_length}".encode() in head and warc.digest(block[:-4]) == r.block_digest
    for _, _, page in pages[:-4]:
        plain = _Text()
        plain.feed(page)
        text = "\n".join(x for x in (" ".join(s.split()) for s in "".join(plain.out).split("\n")) if x)
        assert "\n".join(" ".join(s.split()) for s in warc.plain_text(page).split("\n")) == text


def test_records_of_odd_pages():
    """Heads without an end tag, and comments that a script opens or a comment that holds one, lose no text and no links."""
    assert warc.plain_text("<html><head><title>t</title><body><p>all the text</p>") == "all the text"
    assert warc.plain_text("<head><meta charset=utf-8><title>a < b</title><link href=x><style>p{}</style><p>all</p> the text") == "all\nthe text"
    assert warc.plain_text("<head><title>t<body>all the text") == "all the text"
    assert warc.plain_text("<svg><title/><title>x</title></svg>one<svg><title>y</title></svg> two") == "one two"
    page = "<p>one</p><script>if (a) { document.write('<!--'); }</script><p>two <a href='/b'>three</a></p>"
    assert warc.plain_text(page) == "one\ntwo three" and warc._links(page) == ["/b"]
    page = "<p>one<!-- <script> <a href='/a'> --> two <a href='/b'>three</a></p><script><!-- <a href='/c'> --></script><noscript><a href='/d'></a></noscript><!-- four <a href='/e'>"
    assert warc.plain_text(page) == "one two three" and warc._links(page) == ["/b", "/d"]


def test_pairs(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "yo"), (1, 0, "user", "hi"), (1, 1, "assistant", "no"), (3, 0, None, None), (None, 0, "user", "x"), (4, 0, "user", "hi"), (5, 0, "user", "hi")]
    got = {r.conv_id: r for r in chat.format_pairs(chat.pairs_of(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))).collect()}
    assert set(got) == {0, 1, 3, 4, 5}
    assert got[0].prompt == "<|user|>\nhi<|end|>\n" and got[0].chosen_completion == "<|assistant|>\nyo<|end|>\n" and got[0].rejected_completion == "<|assistant|>\nno<|end|>\n"
    (span,) = got[0].chosen_spans
    assert got[0].chosen_completion[span.start:span.start + span.length] == "yo<|end|>\n"
    assert (got[1].rejected_completion, got[4].prefix_turns, got[4].chosen_completion) == ("", 1, "") and got[5].rejected == []


def test_decoder_restores_hidden_words(spark):
    known = [(k, "the idiot and the moron said stupid things to a loser in the trash") for k in range(30)]
    decoder = toxicity.Decoder(toxicity.language_model(toxicity.trigram_counts(frame(spark, known))))
    assert {"idiot", "moron", "stupid", "loser"} <= decoder.words("you 1d10t, m.o.r.o.n! stuuuupid L O S E R")
    assert decoder.words("") == set() and decoder.words("!!! ... $$$") == set()
    assert decoder.words("Plain words, as they are!!") == {"plain", "words", "as", "they", "are"}


def test_decoder_restores_ends_and_doubled_letters(spark):
    """Signs at the end of a word may be letters, and doubled letters that the corpus does not have are one."""
    known = [(k, "the idiot and the dumbass whore said stupid things to all losers and one loser in the tall grass of a good book") for k in range(30)]
    decoder = toxicity.Decoder(toxicity.language_model(toxicity.trigram_counts(frame(spark, known))))
    assert decoder.words("dumba$$, whor€. id1o+") == {"dumbass", "whore", "idiot"}
    assert decoder.words("iidiioott ssttuuppiidd,") == {"idiot", "stupid"}
    assert decoder.words("tall grass, good book! the losers!!") == {"tall", "grass", "good", "book", "the", "losers"}
    assert decoder.words("the loser! idiot?!") == {"the", "loser", "idiot"}


def test_toxicity_learns(spark):
    random.seed(4)
    rows, labels = [(None, None), (900, None), (901, "")], [(None, 1), (900, 0)]
    for k in range(400):
        bad = k % 5 == 0
        rows.append((k, " ".join(random.choices(["the", "and", "house", "river", "idea", "moment"], k=30) + ["idiot"] * bad)))
        labels.append((k, int(bad)))
    rows += [(1000, "the river 1d10t house"), (1001, "the i d i o t idea")]
    docs = frame(spark, rows)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(docs.select("doc_id", "text"), model, ["doc_id"]).collect()}
    assert all(got[k].predicted == (k % 5 == 0) for k in range(400)) and got[1000].predicted == got[1001].predicted == 1
    assert got[901].predicted == 0 and 0 <= got[901].score < 0.3


def test_empty_tables(spark):
    docs = frame(spark, [])
    path = bpe.default_vocabulary()
    for df in (bpe.digests(docs, path), packing.pack(docs, path), exact.deduplicate(docs), near.classes(docs), lines.report(docs), lines.clean(docs)):
        assert df.count() == 0
    assert ann.nearest(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert toxicity.score(docs.select("doc_id", "text"), model, ["doc_id"]).count() == 0


def test_check_sql(spark, sf):
    from tests.check import compare, connect

    con = connect(sf)
    if not con.execute("SELECT count(*) FROM duckdb_views() WHERE view_name = 'conversations'").fetchone()[0]:
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    for name, sql in catalog.ORACLES.items():
        assert compare(catalog.QUERIES[name](spark, sf), con, sql)[0] is None


def test_pipeline(spark, sf):
    import corpus_pipeline

    given = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, sf), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert {r.doc_id for r in docs.select("doc_id").collect()} <= set(given)
