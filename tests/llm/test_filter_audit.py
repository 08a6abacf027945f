"""The byte pass and the audit of filter orders against brute force, and odd inputs."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from casemill.llm import filter_audit
from casemill.llm.filter_audit import Transducer, WordTable

WORD = re.compile("[^\x20\x09-\x0d]+")


def counts(text):
    words = WORD.findall(text)
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall("[#$%&*|]", text))]


def run(texts, block):
    parts = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, parts)])
    return Transducer(block).run(np.frombuffer(b"".join(parts), dtype=np.uint8), offsets).T.tolist()


def odd_texts(n=300):
    pick = random.Random(4)
    letters = list("aabB  \t\n\x0b\x1f#|%") + ["é", "日本", "\U0001f600", " ", "the ", "A" * 9]
    texts = ["".join(pick.choices(letters, k=pick.choice([0, 1, 3, 30, 200]))) for _ in range(n)]
    return texts + ["", " ", "x", "", "word " * 700, "z" * 900, "z" * 900 + " " + "z" * 900, " " * 500, ""]


def test_counts_of_any_text_in_blocks_of_any_size():
    texts = odd_texts()
    want = [counts(t) for t in texts]
    for block in (1, 7, 64, 2**20):
        assert run(texts, block) == want, block
    assert run([], 64) == [] and run(["", ""], 64) == [[0] * 5] * 2


def test_equal_hashes_are_verified_by_bytes():
    data = np.frombuffer(b"ab cd ab cde", dtype=np.uint8)
    start, size = np.array([0, 3, 6, 9]), np.array([2, 2, 2, 3])
    table = WordTable(data, room=2)
    same = np.full(4, 5, dtype=np.uint64)
    assert table.insert(start, size, np.array([0, 0, 0, 0]), same).tolist() == [True, True, False, True]
    assert table.insert(start, size, np.array([0, 0, 1, 0]), same).tolist() == [False, False, True, False]


def brute(docs, labels):
    """Rows by (part, order, step) from filters applied one after the other."""
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    fails = []
    for i, text, lang in docs:
        words, distinct, capitals, points, symbols = counts(text or "")
        bad = {"A": words < 100, "B": 100 * distinct < 80 * words, "C": 100 * capitals > 10 * points, "D": symbols > 0}
        bad["E"] = i is not None and least[text or ""] < i
        fails.append((lang or "", i, {f for f in bad if bad[f]}))
    out, shapley = {}, Counter()
    for part in {f[0] for f in fails}:
        own = [f for f in fails if f[0] == part]
        for order in permutations("ABCDE"):
            left = list(own)
            for step, name in enumerate(order, 1):
                lost = [f for f in left if name in f[2]]
                gone = [f for f in own if f not in left]
                left = [f for f in left if name not in f[2]]
                redundant = sum(name in f[2] for f in own) - len(lost)
                assert redundant <= len(gone)
                only = sum(f[2] == {name} for f in own)
                shapley[part, name] += len(lost)
                out[part, "".join(order), step] = [
                    len(left), len(lost), redundant, only, sum(f[1] in good for f in lost), sum(f[1] in toxic for f in lost)
                ]
    return {(part, order, step): (*row, shapley[part, order[step - 1]]) for (part, order, step), row in out.items()}


def test_audit_matches_filters_applied_in_every_order(spark, shared):
    pick = random.Random(5)
    texts = odd_texts(40) + [" ".join(f"w{pick.randint(0, 400)}" for _ in range(120)) for _ in range(12)] + [None, None]
    docs = [(i if i % 17 else None, pick.choice(texts[-20:]) if i % 3 else pick.choice(texts), pick.choice(["en", "de", None, ""])) for i in range(160)]
    docs += [docs[5], docs[5], (5000, "hot text", "en"), *[(6000 + i, "hot text", "de") for i in range(60)]]
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 1, None])) for i in range(0, 160, 2)] + [(None, 1, 1), (4, 1, 1), (4, 0, 0), (99999, 1, 1)]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("Part", F.lit("mine")).withColumn("failed", F.lit(1))
    out = filter_audit.audit(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in out.collect()}
    assert got == brute(docs, labels) and len(got) == out.count()


def test_audit_of_nothing(spark, shared):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).collect() == []
    one = spark.createDataFrame([(None, None, None)], docs.schema)
    rows = filter_audit.audit(one, labels).collect()
    assert len(rows) == 600 and {r.removed for r in rows if r.filter_order == "ABCDE"} == {0, 1}
