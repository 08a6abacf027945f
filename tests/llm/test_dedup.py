"""Exact, passage and near duplicates against brute force, and their odd inputs."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from casemill.llm import exact_dedup, simhash, suffix_dedup
from casemill.llm.common import LOWER, UPPER, connected

FOLD = str.maketrans(UPPER, LOWER)
ODD = [(1, None), (2, ""), (3, "Straße ÄÖ"), (3, "Straße ÄÖ"), (4, "straße ÄÖ"), (5, "STRASSE äö"), (None, "x"), (9, "X"), (6, "w " * 30_000)]


# ---------------------------------------------------------------- exact


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_groups_match_brute_force(docs, sample, keep):
    rows = [(r.doc_id, r.text) for r in sample.collect()] + [(i and i + 10**6, t) for i, t in ODD]
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(FOLD), []).append(i)
    best = min if keep == "smallest" else max
    want = []
    for i, t in rows:
        folded = (t or "").translate(FOLD)
        ids = groups[folded]
        stays = best((x for x in ids if x is not None), default=None)
        want.append((i, stays, len(ids), i == stays, hashlib.sha256(folded.encode()).hexdigest()))
    got = exact_dedup.exact_groups(docs(*rows), keep=keep).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_colliding_hashes_do_not_merge_texts(docs):
    rows = [(i, f"text {i % 5}") for i in range(20)]
    out = exact_dedup.exact_groups(docs(*rows), hash_of=lambda c: F.substring(F.md5(c), 1, 0)).collect()
    assert {(r.keep_id, r.group_size) for r in out} == {(i, 4) for i in range(5)}


def test_exact_keeps_columns_that_clash(docs):
    out = exact_dedup.without_copies(docs((1, "a"), (2, "A"), (2, "A"), kept="mine", keep_id="mine", row="mine", hash="mine"), keep="largest")
    assert [(r.doc_id, r.kept, r.keep_id, r.row, r.hash) for r in out.collect()] == [(2, "mine", "mine", "mine", "mine")]
    assert exact_dedup.exact_groups(docs()).collect() == []


# ---------------------------------------------------------------- passages


def brute_removed(rows, length):
    first, out = {}, []
    for i, text in sorted(((-(2**63) if i is None else i), (t or "").encode()) for i, t in rows):
        gone = np.zeros(len(text), dtype=bool)
        for at in range(len(text) - length + 1):
            if first.setdefault(text[at : at + length], i) < i:
                gone[at : at + length] = True
        turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out.append((None if i == -(2**63) else i, len(text), turns.reshape(-1, 2).tolist(), np.frombuffer(text, np.uint8)[~gone].tobytes()))
    return sorted(out, key=str)


def removed(frame, **options):
    rows = suffix_dedup.remove_repeats(frame, **options).collect()
    return sorted(((r.doc_id, r.n_bytes, [[s["start"], s["end"]] for s in r.spans], bytes(r.kept)) for r in rows), key=str)


def test_passages_match_brute_force(docs, sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    assert removed(sample) == brute_removed(rows, 50)


def test_null_ids_are_spread_over_batches(docs):
    pick = random.Random(4)
    words = lambda n: "".join(pick.choice("abcdefgh ") for _ in range(n))
    shared = [words(70) for _ in range(5)]
    rows = [(None, words(60) + pick.choice(shared) + words(60)) for _ in range(300)]
    rows += [(i, words(60) + pick.choice(shared) + words(60)) for i in range(100)] + [(7, rows[0][1]), (None, rows[0][1]), (None, None)]
    assert removed(docs(*rows)) == brute_removed(rows, 50)


def test_passages_of_few_letters_match_brute_force(docs):
    pick = random.Random(5)
    rows = [(i, "".join(pick.choice("ab") for _ in range(pick.randint(0, 90)))) for i in range(40)] + [(50, "a" * 300), (51, "ab" * 200), (52, "a" * 60)]
    assert removed(docs(*rows), length=20, gram=6) == brute_removed(rows, 20)


def test_passages_of_odd_rows(docs):
    line = "é" * 30 + "one passage that is long enough to be found again"
    rows = [(None, line), (1, line), (1, line), (2, None), (3, ""), (4, "x" * 49), (5, "x" * 49), (7, "\U0001f600" * 40 + line)]
    assert removed(docs(*rows, batch="mine", spans=1)) == brute_removed(rows, 50)
    assert removed(docs()) == []


def test_edges_of_a_common_passage_are_dealt_out(docs, monkeypatch):
    pick = np.random.default_rng(9)
    passage = bytes(pick.integers(97, 123, 200).astype(np.uint8))
    own = lambda: bytes(pick.integers(97, 123, 150).astype(np.uint8))
    texts = [own() + passage + own() for _ in range(400)]
    lows, ids = suffix_dedup._anchors_of(texts, 50, 16), np.arange(400)
    keys, often = suffix_dedup._distinct(lows)
    keys = keys[often]
    asked = suffix_dedup.asked_windows(ids, texts, lows, keys, np.ones(len(keys), dtype=bool), 64, 0, 50)
    held = [len(x[2]) // 16 for x in asked if x[2] is not None]
    assert sum(held) > 10_000 and max(held) < 2 * sum(held) / 64
    rows = [(i, t.decode()) for i, t in enumerate(texts)] + [(None, passage.decode()), (7, passage.decode() + "x" * 60), (7, "y" + passage.decode())]
    monkeypatch.setattr(suffix_dedup, "CROWD", 2)
    assert removed(docs(*rows)) == brute_removed(rows, 50)


def test_family_levels_stay_logarithmic():
    family, pick = suffix_dedup.Family(), np.random.default_rng(3)
    batches = [np.unique(pick.integers(0, 5000, 200).astype(np.uint64)) for _ in range(64)]
    for keys in batches:
        family.insert(keys)
    count = {}
    for keys in batches:
        for k in keys.tolist():
            count[k] = count.get(k, 0) + 1
    assert len(family.levels) <= 8
    for keys in batches:
        assert family.shared(keys).tolist() == [count[k] > 1 for k in keys.tolist()]


# ---------------------------------------------------------------- near


def brute_print(text):
    words = [w for w in __import__("re").findall("[^\x20\x09-\x0d]+", (text or "").translate(FOLD))]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, reach=4):
    ids = list(prints)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if (prints[a] ^ prints[b]).bit_count() <= reach:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_near_groups_match_brute_force(docs, sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    rows += [(10**6, None), (10**6 + 1, ""), (10**6 + 2, " \t\n"), (10**6 + 3, "one two"), (10**6 + 4, "ONE two"), (10**6 + 5, "w " * 20_000)]
    prints = {i: brute_print(t) for i, t in rows}
    whole = brute_components(prints)
    out = simhash.near_groups(docs(*rows, fp=1, row=2)).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in out} == {i: (f"{prints[i]:016x}", whole[i]) for i in prints}
    assert simhash.near_groups(docs()).collect() == []
    stays = simhash.one_of_each(docs(*rows, fp=1, stay=2))
    assert sorted(r.doc_id for r in stays.collect()) == sorted(set(whole.values()))


def test_null_and_repeated_ids_do_not_save_near_copies(docs):
    one, two = "a b c d e f g", "nothing like the first text at all"
    rows = [(None, one), (None, "alone and far from all the others"), (None, "far"), (5, two), (5, one.upper()), (4, one)]
    out = simhash.one_of_each(docs(*rows)).collect()
    assert sorted((str(r.doc_id), r.text[:3]) for r in out) == [("4", "a b"), ("5", "not"), ("None", "alo"), ("None", "far")]


def test_links_of_dense_balls_are_whole(spark, shared, monkeypatch):
    pick = random.Random(11)
    centre = pick.getrandbits(64)
    values = {centre ^ sum(1 << b for b in pick.sample(range(64), pick.randint(0, 5))) for _ in range(600)}
    values |= {pick.getrandbits(64) for _ in range(1500)}
    monkeypatch.setattr(simhash, "PIECE", 20_000)
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    frame = spark.createDataFrame([s[0] for s in signed], "long").toDF("fp").withColumn("least", F.col("fp"))
    got = {r.node: r.root for r in connected(simhash.links(frame)).collect()}
    whole = brute_components({s[0]: s[0] % 2**64 for s in signed})
    assert {n: whole[n] for n in got} == got
    assert all(whole[n] == n for n in whole if n not in got)


def test_components_of_a_long_path(spark, shared):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1002, 1001), (7, 7)]
    out = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(201)} | {1000: 1000, 1001: 1000, 1002: 1000}
