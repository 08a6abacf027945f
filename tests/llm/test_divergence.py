"""Packed term counts and source divergences against brute force, and odd inputs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from casemill.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def odd_texts(n):
    pick = random.Random(6)
    pieces = list("aAbZ  .7_\x00\x7f[`@{") + ["é", "É", "日本", "\U0001f600", " the ", "abcdefgh", "abcdefghi", "q" * 16, "Q" * 17, "x" * 40, " "]
    return ["".join(pick.choices(pieces, k=pick.choice([0, 1, 4, 40]))) for _ in range(n)] + ["", "é" * 30, "word " * 400, "z" * 5000, "a"]


def test_radix_order_sorts():
    pick = np.random.default_rng(1)
    words = [pick.integers(0, 2**63, 3000, dtype=np.uint64) >> np.uint64(s) for s in (0, 40, 62)]
    order = divergence.radix_order(words)
    want = sorted(range(3000), key=lambda i: tuple(int(w[i]) for w in reversed(words)))
    assert [tuple(int(w[i]) for w in words) for i in order] == [tuple(int(w[i]) for w in words) for i in want]
    assert divergence.radix_order([np.zeros(0, dtype=np.uint64)]).tolist() == []


def test_block_counts_of_any_text_in_blocks_of_any_size():
    texts = odd_texts(200)
    group = np.array([i % 3 for i in range(len(texts))])
    n, docs = Counter(), Counter()
    for g, text in zip(group, texts):
        n.update((t, g) for t in terms(text))
        docs.update((t, g) for t in set(terms(text)))
    parts = [t.encode() for t in texts]
    offsets, data = np.cumsum([0, *map(len, parts)]), np.frombuffer(b"".join(parts), dtype=np.uint8)
    for block in (1, 13, 300, 2**22):
        got_n, got_docs = Counter(), Counter()
        for found, where, times, texts_with in divergence.block_counts(data, offsets, group, block):
            for term, g, a, b in zip(found, where, times, texts_with):
                got_n[term.decode(), g] += int(a)
                got_docs[term.decode(), g] += int(b)
        assert (got_n, got_docs) == (n, docs), block


def brute(rows, least, top):
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        n[lang, source].update(terms(text))
        docs[lang].update(set(terms(text)))
    out = []
    p = lambda c, total, v: 1 + 10**9 * (c + 5) // (total + 5 * v)
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in docs[lang].items() if d >= least]
        own = [s for g, s in groups if g == lang]
        total = {s: sum(n[lang, s][t] for t in kept) for s in own}
        whole = sum(total.values())
        for s in own:
            ps = {t: p(n[lang, s][t], total[s], len(kept)) for t in kept}
            pairs = [(o, sum(abs(ps[t] - p(n[lang, o][t], total[o], len(kept))) for t in kept)) for o in own if o != s]
            more = [(t, ps[t] - p(sum(n[lang, o][t] for o in own), whole, len(kept))) for t in kept if n[lang, s][t]]
            for part, items, most in (("pair", pairs, len(own)), ("term", [m for m in more if m[1] > 0], top)):
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(items[:most], 1)]
    return sorted(out)


def test_divergence_matches_brute_force(spark, shared):
    pick = random.Random(7)
    texts = odd_texts(30) + [" ".join(f"w{chr(97 + pick.randint(0, 20))}é" for _ in range(60)) for _ in range(20)]
    rows = [(pick.choice(texts), pick.choice(["en", "en", "de", None, ""]), pick.choice(["hot", "hot", "ä", "b", None, "\U0001f600"])) for _ in range(300)]
    rows += [(None, "en", "no text"), ("", "xx", "one"), ("7 8", "xx", "two"), ("rare", "yy", "only"), *[("Same Text", "en", "hot")] * 40]
    table = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("Term", F.lit(1)).withColumn("value", F.lit("x"))
    want = brute(rows, 6, 5)
    for cells, per_block in ((2**16, 256), (16, 2)):
        out = divergence.source_divergence(table, least_docs=6, top=5, block=64, cells=cells, rows=per_block)
        assert out.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
        assert sorted(map(tuple, out.collect())) == want


def test_divergence_of_nothing_and_of_nulls(spark, shared):
    empty = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.source_divergence(empty).collect() == []
    nulls = spark.createDataFrame([(None, None, None), ("x", None, "b")], empty.schema)
    assert sorted(map(tuple, divergence.source_divergence(nulls).collect())) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]


def test_probabilities_are_exact_beyond_64_bits(spark):
    big = 10**12 + 7
    row = spark.range(1).select(divergence.probability(F.lit(big), F.lit(3 * big), F.lit(11)).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 5) // (3 * big + 55)
