"""The pipeline's near stage against every pair compared."""

import random
import re
from itertools import combinations

import numpy as np
from test_dedup import FOLD

import corpus_pipeline
from casemill.llm import shingle_dedup

NEAR = dict(corpus_pipeline.STAGES)["near"]


def brute_shingles(text, words=5):
    found = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(FOLD))
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))}


def brute_stays(rows):
    """The smallest id of every component of pairs at 0.8 or more."""
    sets = {i: brute_shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 5 * len(x & y) >= 4 * len(x | y):
            a, b = top(a), top(b)
            root[max(a, b)] = min(a, b)
    return sorted(i for i in root if top(i) == i)


def test_near_stage_finds_every_pair_at_four_fifths(spark, docs):
    pick = random.Random(5)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rows += [(10**6, None), (10**6 + 1, ""), (10**6 + 2, " \t\n"), (10**6 + 3, "one two"), (10**6 + 4, "ONE  two"), (10**6 + 5, "w " * 20_000)]
    for family in range(40):  # copies with some words replaced, around the bound
        words = [f"w{pick.randrange(3000)}" for _ in range(pick.randint(5, 120))]
        for copy in range(12):
            own = list(words)
            for _ in range(pick.randint(0, 1 + len(words) // 30)):
                own[pick.randrange(len(own))] = f"x{pick.randrange(30)}"
            rows.append((2 * 10**6 + family * 100 + copy, " ".join(own)))
    out = NEAR(spark, docs(*rows, node=1, root=2), "")
    assert out.columns[-2:] == ["node", "root"]
    assert sorted(r.doc_id for r in out.collect()) == brute_stays(rows)


def test_bound_is_met_exactly(spark, docs):
    base = [f"a{i}" for i in range(22)]  # 18 shingles; the second has these of its 22, the third of its 24
    out = NEAR(spark, docs((1, " ".join(base)), (2, " ".join([*base, *"bcde"])), (3, " ".join(["q", *base, *"vwxyz"]))), "")
    assert [round(18 / n, 2) for n in (22, 24)] == [0.82, 0.75]
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_null_and_repeated_ids_do_not_save_copies(spark, docs):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (None, text + " x"), (None, "alone and far from all"), (5, "other words stand here now"), (5, text + " y"), (4, text + " z")]
    out = NEAR(spark, docs(*rows), "").collect()
    assert sorted((str(r.doc_id), r.text[:5]) for r in out) == [("4", "w0 w1"), ("5", "other"), ("None", "alone")]
    assert shingle_dedup.one_of_each(docs()).collect() == []


def test_sketches_let_every_alike_pair_pass():
    pick = random.Random(9)
    sizes = [1, 2, 5, 40, 900, 3000]
    for _ in range(300):
        pool = [f"w{i}" for i in range(pick.choice(sizes) + 4)]
        one = shingle_dedup.shingles(" ".join(pool))
        other = shingle_dedup.shingles(" ".join([*pool[: len(pool) - pick.randint(0, len(pool) // 9 + 1)], *[f"x{i}" for i in range(pick.randint(0, len(pool) // 9))]]))
        if shingle_dedup.alike(one, other):
            assert shingle_dedup.may_be_alike(shingle_dedup.sketch(one), shingle_dedup.sketch(other), len(one), len(other))
    far = [shingle_dedup.shingles(" ".join(f"{name}{i}" for i in range(5000))) for name in "ab"]
    assert not shingle_dedup.may_be_alike(shingle_dedup.sketch(far[0]), shingle_dedup.sketch(far[1]), *map(len, far))


def test_simhash_links_what_it_connects_and_the_check_decides(spark, docs):
    words = [f"w{i}" for i in range(400)]
    sets = [shingle_dedup.shingles(" ".join(words)), shingle_dedup.shingles(" ".join([*words, "end"]))]
    prints = [shingle_dedup.majority(s) for s in sets]
    assert bin((prints[0] ^ prints[1]) & (2**64 - 1)).count("1") <= 4
    bits = [sum((int(h) >> b) & 1 for h in sets[0]) * 2 > len(sets[0]) for b in range(64)]
    assert prints[0] & (2**64 - 1) == sum(1 << b for b in range(64) if bits[b])
    use = spark.createDataFrame([(7, prints[0]), (3, prints[1]), (9, ~prints[0])], "node long, fp long")
    assert [tuple(r) for r in shingle_dedup._simhash_pairs(use).collect()] == [(7, 3)]


def test_a_passage_brings_a_pair_together_once(spark):
    marks = [(s, n, n) for s in range(50) for n in (3, 8, 11)] + [(70, 3, 3), (70, 8, 8)] + [(80, 3, 3), (80, 9, 3)] + [(90, 8, 8), (90, 11, 11)]
    rooted = spark.createDataFrame(marks, "shingle long, node long, root long")
    left = sorted(tuple(r) for r in shingle_dedup._one_by_one(rooted).collect())
    assert left == [(0, 3, 3), (0, 8, 8), (0, 11, 11), (70, 3, 3), (70, 8, 8), (90, 8, 8), (90, 11, 11)]


def test_long_unlike_texts_with_a_common_passage_do_not_meet(spark, docs, monkeypatch):
    seen, links, nothing = [], shingle_dedup._links, np.array([], dtype=np.int64)
    monkeypatch.setattr(shingle_dedup, "_frequent", lambda *_: (nothing.view(np.uint64), nothing))  # as if the sample missed the passage
    monkeypatch.setattr(shingle_dedup, "_links", lambda pairs, *rest: seen.append(pairs.count()) or links(pairs, *rest))
    common = " ".join(f"c{i}" for i in range(40))
    texts = [" ".join([*(f"d{d}w{i}" for i in range(4000)), common]) for d in range(8)]
    rows = [*enumerate(texts), (20, texts[0] + " end"), (21, " ".join(["start", *texts[1].split()[:3700], common]))]
    out = NEAR(spark, docs(*rows), "")
    assert sorted(r.doc_id for r in out.collect()) == [0, 1, 2, 3, 4, 5, 6, 7]
    assert seen[1] == 0  # 43 pairs by 1,024 parities alone


def test_rows_that_repeat_id_and_text_stay_once(spark, docs):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(4, text, "b"), (4, text, "a"), (4, text, "a"), (6, text + " x"), (None, "alone"), (None, "alone"), (7, "one two three four five six")]
    out = NEAR(spark, docs(*rows), "").collect()
    assert sorted((str(r.doc_id), r.text[:5], r.source) for r in out) == [("4", "w0 w1", "a"), ("7", "one t", "src0"), ("None", "alone", "src0")]
