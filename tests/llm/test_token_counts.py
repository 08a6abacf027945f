"""Token counts against the library itself, and odd inputs."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casemill.llm import queries, token_counts

PATH = public_tokenizers.path(queries.MERGES)


@pytest.fixture(scope="module")
def merges():
    return token_counts.read_merges(PATH)


def library(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [len(e.ids) for e in tokenizer.encode_batch(list(texts), add_special_tokens=False)]


def test_counts_like_the_library(merges):
    pick = random.Random(3)
    letters = [chr(p) for p in [*range(0x250), 0x558, 0x58B, 0x2003, 0x200B, 0x2028, 0x3000, 0x4E00, 0x10940, 0x1F600]]
    letters += ["<|endoftext|>"] * 20 + ["<|endof"] * 5 + list("    \n\n\t''sretvmlld") * 5
    texts = ["".join(pick.choices(letters, k=pick.randint(0, 40))) for _ in range(4000)]
    texts += ["a" * 5000, "ab" * 7000, " " * 3000 + "x", "<|endoftext|>" * 9, "\r\n \n\n x", "don't I'LL we'll", "é" * 4000]
    counter = token_counts.Counter(merges)
    assert [counter.text(t) for t in texts] == library(texts)
    forgetful = token_counts.Counter(merges, kept_words=3)
    assert [forgetful.text(t) for t in texts[:500]] == library(texts[:500])


def test_every_code_point_is_split_like_the_library(merges):
    counter = token_counts.Counter(merges)
    texts = ["".join(f"a{c}1{c} {c}{c} x" for c in map(chr, range(low, low + 64)) if not 0xD800 <= ord(c) < 0xE000) for low in [*range(0, 0x30000, 64), *range(0xE0000, 0xE0200, 64)]]
    assert [counter.text(t) for t in texts] == library(texts)


def test_every_document(spark, shared):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = queries.op11_token_counts(spark, sf)
    assert out.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    rows = {r.doc_id: tuple(r)[1:] for r in out.collect()}
    want = {i: (len(t.encode()), n, n > 1024) for (i, t), n in zip(docs.items(), library(docs.values()))}
    assert rows == want


def test_nulls_repeats_and_clashing_columns(spark, docs, merges):
    rows = [(1, None), (1, None), (None, ""), (2, "same text"), (3, "same text"), (4, "word " * 30000)]
    out = token_counts.count_tokens(docs(*rows, N_Tokens="mine", row="r", _t=1), merges, limit=2)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "_t", "n_bytes", "n_tokens", "over_limit"]
    got = sorted(((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit, r.row) for r in out.collect()))
    n = library(["word " * 30000])[0]
    assert got == [(0, 0, 0, False, "r"), (1, 0, 0, False, "r"), (1, 0, 0, False, "r"), (2, 9, 2, False, "r"), (3, 9, 2, False, "r"), (4, 150000, n, True, "r")]
    assert token_counts.count_tokens(docs(*rows).where(F.lit(False)), merges).count() == 0


def test_other_kinds_are_refused():
    with pytest.raises(ValueError):
        token_counts.read_merges(public_tokenizers.path("word_bpe_49k.json"))
