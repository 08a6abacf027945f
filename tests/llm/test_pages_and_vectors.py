"""Top-k search, URL filters and HTML extraction against brute force, and their odd inputs."""

import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from casemill.llm import html_crf, queries, topk, url_filter

# ---------------------------------------------------------------- top-k


def brute_top(rows, asks, k):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(1024 * x) for x in v]

    vectors = [(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    out = []
    for q in sorted({i for i, _ in vectors if i in asks}):
        own = min(v for i, v in vectors if i == q)
        best = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in vectors if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


def test_top_k_matches_brute_force(spark, shared, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERIES", 8)
    pick = np.random.default_rng(1)
    rows = [(i, pick.normal(0, 0.2, 16).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # ties
    rows += [(7, rows[7][1]), (2000, None), (2001, [None] * 16), (2002, [float("nan")] * 16), (2003, [float("inf")] * 16), (None, rows[3][1]), (2004, [0.5] * 4), (2005, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("block", F.lit(1))
    asks = {i for i, _ in rows if i is not None and i % 20 == 0} | {7, 2002}
    got = topk.top_k(frame, frame.where(F.col("vec_id").isin(list(asks))), 10).collect()
    assert sorted(map(tuple, got)) == brute_top(rows, asks, 10)


def test_top_k_of_few(spark, shared):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(frame, frame.where("vec_id = 0")).collect()] == [(0, 1, 1, 1024 * 2048)]
    assert topk.top_k(frame.limit(0), frame.limit(0)).collect() == []


def test_segments_stop_early_only_on_proof():
    pick = np.random.default_rng(2)
    for _ in range(20):
        vectors = pick.integers(-500, 500, (200, 12))
        queries_ = pick.integers(-500, 500, (5, 12))
        got = topk.search_block(np.arange(5), queries_, np.arange(200), vectors, 3)
        for q in range(5):
            score = vectors @ queries_[q]
            want = sorted((-int(score[i]), i) for i in range(200) if i != q)[:3]
            assert sorted((-s, i) for a, i, s in got if a == q) == want


def test_large_components_are_exact(spark, shared, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERIES", 4)
    monkeypatch.setattr(topk, "TOGETHER", 2)
    pick = np.random.default_rng(5)
    rows = [(i, (pick.normal(0, 1, 8) * 100_000).tolist()) for i in range(100)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(frame, frame.where("vec_id % 3 = 0"), 10).collect()
    assert sorted(map(tuple, got)) == brute_top(rows, {i for i in range(0, 100, 3)}, 10)
    huge = spark.createDataFrame([(0, [1e17]), (1, [1e17]), (2, [-1e17]), (3, [1.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(huge, huge.where("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2**63 - 1), (0, 2, 3, 2**63 - 1), (0, 3, 2, -(2**63))]


def test_postings_without_weight_or_chance_are_not_read():
    pick = np.random.default_rng(6)
    vectors = pick.integers(-40, 40, (500, 32)) * (pick.random((500, 32)) < 0.2)
    vectors[:20, :4] += 3000
    queries_ = np.zeros((3, 32), dtype=np.int64)
    queries_[:, :4] = pick.integers(500, 900, (3, 4))
    work = {}
    got = topk.search_block(np.arange(1000, 1003), queries_, np.arange(500), vectors, 5, work)
    for q in range(3):
        want = sorted((-int(s), i) for i, s in enumerate(vectors @ queries_[q]))[:5]
        assert sorted((-s, i) for a, i, s in got if a == 1000 + q) == want
    assert work["read"] * 4 < work["saved"]


# ---------------------------------------------------------------- urls

URLS = [
    (1, "https://A.Example.COM/en/x?y#z", "a.example.com", "/en/x", "example.com/en/", "block"),
    (2, "http://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    (3, "http://x.net/fr/1#a", "x.net", "/fr/1", "net/fr/", "block"),
    (4, "http://net/es/", "net", "/es/", "net/es/", "block"),
    (5, "http://planet/es/", "planet", "/es/", None, None),
    (6, "http://example.com", "example.com", "", None, None),
    (7, "http://example.com?a://b/c", "example.com", "", None, None),
    (8, "no scheme", "", "", None, None),
    (9, None, "", "", None, None),
    (10, "", "", "", None, None),
    (11, "https://shop.example.com/de/", "shop.example.com", "/de/", "com/", "allow"),
    (11, "https://shop.example.com/de/", "shop.example.com", "/de/", "com/", "allow"),
    (None, "http://free-casino.example.org/EN/", "free-casino.example.org", "/EN/", None, "block"),
    (12, "http://" + "a" * 20_000 + "/" + "b" * 50_000, "a" * 20_000, "/" + "b" * 50_000, None, None),
]


def test_urls(spark, shared):
    frame = spark.createDataFrame([(r[0], r[1], None if r[0] == 3 else "<p>free casino words</p>") for r in URLS], "page_id long, url string, html string")
    out = url_filter.judge(frame.withColumn("host", F.lit(1)).withColumn("odds", F.lit(1)), queries.URL_RULES).collect()
    got = sorted(((r.page_id, r.host, r.path, r.rule) for r in out), key=str)
    assert got == sorted(((r[0], r[2], r[3], r[4]) for r in URLS), key=str)
    want = {r[0]: r[5] for r in URLS if r[5]}
    assert {r.page_id: r.verdict for r in out if r.page_id in want} == want
    assert {r.verdict for r in out} <= {"allow", "block"}
    assert url_filter.judge(frame.limit(0), queries.URL_RULES).collect() == []


def test_segmentation_is_the_best_split():
    model = {"free": -2.0, "bets": -3.0, "freeb": -9.0, "ets": -9.0, "be": -2.5, "ts": -2.6}
    assert url_filter.segment("freebets", model) == ["free", "bets"]
    pick, words = random.Random(3), {"a": -1.0, "ab": -1.5, "b": -2.0, "ba": -1.2, "abb": -2.2}

    def cost(parts):
        return sum(words.get(p, math.log(1e-9) - 2 * len(p)) for p in parts)

    def splits(text):
        return [[]] if not text else [[text[:n]] + rest for n in range(1, len(text) + 1) for rest in splits(text[n:])]

    for _ in range(30):
        text = "".join(pick.choice("abc") for _ in range(pick.randint(1, 8)))
        assert cost(url_filter.segment(text, words)) == pytest.approx(max(map(cost, splits(text))))
    assert url_filter.segment("", model) == []


_TAGS = re.compile(r"<(script|style)\b.*?</\1>|<[^>]*>", re.DOTALL)


def test_markup_is_removed_in_one_pass():
    pick = random.Random(8)
    for _ in range(3000):
        text = "".join(pick.choice(["<", ">", "<script", "</script>", "<style ", "</style>", "scripts", " ", "ab", "<p>", "</"]) for _ in range(pick.randint(0, 12)))
        assert url_filter.without_markup(text) == _TAGS.sub(" ", text), text
    began = time.perf_counter()
    for text in ("<" * 2_000_000, "<script " * 250_000, "<style>" * 250_000, "<script x>" * 250_000):
        url_filter.without_markup(text)
    assert time.perf_counter() - began < 20


def test_verdicts_match_a_plain_bayes(spark, shared):
    """Tokens, odds and verdicts of all pages from whole word counts, without buckets of Spark."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html")
    pages = pages.unionByName(spark.createDataFrame([(-1, None, "casino"), (-2, "x://a", None), (-3, "x://", "")], pages.schema))
    rows = pages.collect()
    got = {r.page_id: r for r in url_filter.judge(pages.withColumn("TOKENS", F.lit(1)).withColumn("At", F.lit(2)), queries.URL_RULES).collect()}
    counts = Counter()
    for r in rows:
        counts.update(re.findall("(?<![a-z])[a-z]{2,24}(?![a-z])", _TAGS.sub(" ", (r.html or "").lower())))
    model = {w: math.log(n / sum(counts.values())) for w, n in counts.items()}

    def words(run):
        return [f"#{len(run)}"] if run[0].isdigit() else url_filter.segment(run, model)

    tokens = {i: [f"{p}:{w}" for p, t in (("h", r.host), ("p", r.path.lower())) for run in re.findall("[a-z]+|[0-9]+", t) for w in words(run)] for i, r in got.items()}
    assert {i: r.tokens for i, r in got.items()} == tokens and len(got) == len(rows)
    bucket = lambda t: xxhash.xxh64_intdigest(t.encode(), seed=42) % url_filter.BUCKETS
    ruled = {i: r.verdict for i, r in got.items() if r.rule}
    taught = {c: Counter(bucket(t) for i, v in ruled.items() if v == c for t in tokens[i]) for c in ("allow", "block")}
    taught["block"].update({bucket("h:" + s): url_filter.SEED_PAGES for s in url_filter.SEEDS})
    size = {c: sum(n.values()) + url_filter.BUCKETS for c, n in taught.items()}
    prior = math.log((1 + list(ruled.values()).count("block")) / (1 + list(ruled.values()).count("allow")))
    for i, r in got.items():
        odds = prior + sum(
            math.log((taught["block"][b] + 1) / size["block"]) - math.log((taught["allow"][b] + 1) / size["allow"]) for b in map(bucket, tokens[i])
        )
        assert r.odds == pytest.approx(odds)
        assert r.rule or r.verdict == ("block" if odds > 0 else "allow")
        assert r.At == 2


# ---------------------------------------------------------------- pages


@pytest.fixture(scope="module")
def model(spark):
    return html_crf.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"), "page_id", "html")


def test_extraction_of_held_out_pages(spark, shared, model):
    import html
    import re

    def article(page):
        inner = re.search("<article>(.*?)(</article>|$)", page, re.S)[1]
        inner = re.sub("<[^>]*>", "", re.sub("</?(?:p|h1|br)[^>]*>", " ", inner))
        return " ".join(html.unescape(inner).split())

    seen = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html")
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").join(seen, "html", "left_anti")
    rows = html_crf.extract(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"), model=model).collect()
    texts = {r.page_id: article(r.html) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    assert pages.count() > 0 and {r.page_id: r.text for r in rows} == texts


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<p>Fish &amp; chips,\n  caf&eacute; &#x41;<b>bold</b>ly.<br>New line of words here.<p>Next one ends.", "Fish & chips, café Aboldly. New line of words here. Next one ends."),
        ("<div class=menu><a href=x>Home</a></div><div id=content><p>A long paragraph, with many words to be read, ends.</p></div><div class='user comments'><p>I like this a lot, thanks for all.</p></div><form><label>Your name</label></form>", "A long paragraph, with many words to be read, ends."),
        ("<article><header>By me</header><p>Main words go here, all of them are good.</p><aside>Related items</aside><script>var a = '<p>no</p>';</script><style>p{}</style></article>", "Main words go here, all of them are good."),
    ],
)
def test_extraction_of_odd_pages(model, page, text):
    assert html_crf.main_text(page, model) == text


def test_viterbi_finds_the_best_labels():
    pick = np.random.default_rng(6)
    for _ in range(30):
        n = int(pick.integers(1, 7))
        model = html_crf.Model({str(i): i for i in range(n)}, pick.normal(size=(n, 2)), pick.normal(size=(2, 2)))

        def value(labels, model=model, n=n):
            return sum(model.weights[i, y] for i, y in enumerate(labels)) + sum(model.moves[a, b] for a, b in zip(labels, labels[1:]))

        every = [[(k >> i) & 1 for i in range(n)] for k in range(2**n)]
        assert value(model.decode([[str(i)] for i in range(n)])) == pytest.approx(max(map(value, every)))


def test_pages_without_a_teacher(spark, shared):
    frame = spark.createDataFrame([(1, "<p>words</p>", "mine"), (1, "<p>words</p>", "mine"), (None, None, "mine")], "page_id long, html string, text string")
    assert [r.text for r in html_crf.extract(frame).collect()] == ["", "", ""]
    assert html_crf.extract(frame.limit(0)).collect() == []


def test_no_markup_stops_the_parser():
    words = lambda html: [text for text, _, _ in html_crf.leaf_blocks(html)]
    assert words("<p>a<![foo[x]]> b<p>c<![ ") == ["a b", "c"] and words("<![1[x><p>d") == ["d"]
    assert words("<p>Let <math><mi>x</mi></math> be <noscript>real</noscript> <svg><text>here</text></svg><script>no</script>") == ["Let x be real here"]
    pick = random.Random(8)
    parts = ["<", ">", "<!", "<![", "]]>", "<!--", "-->", "</", "<p", "&#x", "&amp", ";", "<script>", "<div class=a>", "text ", "<?x", "=", '"', "<!doctype"]
    for _ in range(3000):
        html_crf.leaf_blocks("".join(pick.choices(parts, k=pick.randint(1, 12))))


def test_deep_pages_take_linear_time():
    deep = "".join(f"<div class=c{n}>t{n}" for n in range(40_000)) + "".join("</x></td><td>" for _ in range(40_000))
    began = time.perf_counter()
    blocks = html_crf.leaf_blocks(deep)
    features = html_crf._features(blocks[:5])
    assert len(blocks) == 40_000 and time.perf_counter() - began < 20 and "name=c0" in features[1]


def test_one_article_among_many_pages_teaches(spark, shared):
    article = "<html><body><nav><a href=x>Home</a></nav><article><p>" + "A long sentence of the story stands here. " * 5 + "</p></article></body></html>"
    pages = spark.range(20_000).select(
        F.col("id").alias("page_id"),
        F.when(F.col("id") == 77, F.lit(article)).otherwise(F.lit("<div><ul><li><a href=x>x</a></ul></div>")).alias("html"),
        F.lit("mine").alias("TEXT"),
    )
    out = html_crf.extract(pages)
    assert out.columns == ["page_id", "text"]
    found = {r.page_id: r.text for r in out.where("text <> ''").collect()}
    assert found[77].startswith("A long sentence of the story") and "Home" not in found[77]
