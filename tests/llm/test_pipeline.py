"""The pipeline, stage by stage on its own input, against brute force."""

import hashlib
from collections import Counter

import public_tokenizers
import tiktoken
from test_dedup import FOLD
from test_near_stage import brute_stays
from test_text_and_tokens import brute_mix, words

import corpus_pipeline
from casemill.llm import bpe, queries
from casemill.llm.common import stored

SF = "/root/testdata/sf0.001"


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_every_stage_matches_brute_force(spark, shared):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, names = docs.columns, [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact", "near", "mixing", "tokens"]
    stage = dict(corpus_pipeline.STAGES)

    scored = queries.op1_quality(spark, SF).collect()
    good = stored(stage["quality"](spark, docs, SF))
    assert good.columns == columns and ids(good.collect()) == sorted(r.doc_id for r in scored if r.predicted == 1)

    single = stored(stage["exact"](spark, good, SF))
    largest = {}
    for r in good.collect():
        key = (r.text or "").translate(FOLD)
        largest[key] = max(largest.get(key, r.doc_id), r.doc_id)
    assert single.columns == columns and ids(single.collect()) == sorted(largest.values())

    apart = stored(stage["near"](spark, single, SF))
    stays = brute_stays([(r.doc_id, r.text) for r in single.collect()])
    assert apart.columns == columns and ids(apart.collect()) == stays

    mixed = stored(stage["mixing"](spark, apart, SF))
    rows = apart.collect()
    sizes, target = brute_mix([(r.doc_id, r.text, r.source) for r in rows])
    turns, start = Counter(), Counter()
    for r in sorted(rows, key=lambda r: hashlib.md5(str(r.doc_id).encode()).hexdigest()):
        size = words(r.text)
        taken = sum(size > 0 and start[r.source] + e * sizes[r.source] < int(target[r.source] + 0.5) for e in range(3))
        if taken:
            turns[r.doc_id] = taken
        start[r.source] += size
    assert mixed.columns == columns and Counter(r.doc_id for r in mixed.collect()) == turns

    out = stage["tokens"](spark, mixed, SF).collect()
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in mixed.collect():
        tokens = plain.encode_ordinary(r.text or "")
        digest = lambda b: hashlib.sha256(b).hexdigest()
        want.append((r.doc_id, len(tokens), digest(" ".join(map(str, tokens)).encode()), digest((r.text or "").encode())))
    assert sorted(map(tuple, out)) == sorted(want)


def test_stages_of_nothing(spark, shared):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name
