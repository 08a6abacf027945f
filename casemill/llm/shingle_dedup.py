"""Near duplicates by SimHash over word shingles, links checked by Jaccard similarity; prefix filtering adds what SimHash misses."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm import simhash
from casemill.llm.common import LOWER, UPPER, connected, most_frequent, packed, scratch, stored, unpacked

WORDS = 5
#: Linked are sets whose similarity is at least FOUR / FIVE; whole numbers keep the comparison exact.
FOUR, FIVE = 4, 5
#: Frequent shingles are learnt from about this many documents, and at most ROOM are remembered. Both only order work.
SAMPLE, ROOM = 8192, 2**16
#: Bits of the parities, a multiple of 64. With fewer than a few per shingle, sets that share nothing pass as well.
PARITIES = 1024
#: Sets of more than PARITIES shingles have these too, where nodes meet one by one: fewer say nothing of sets twice their number.
MORE_PARITIES = 8192
#: The orders by which shingles choose whom all their documents meet first.
TURNS = 8
_WORD = re.compile("[^\x20\x09-\x0d]+")
_FOLD = str.maketrans(UPPER, LOWER)
_ODD = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- one document


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles; fewer words are one shingle, no words the hash zero."""
    found = _WORD.findall((text or "").translate(_FOLD))
    if not found:
        return np.zeros(1, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    each = np.fromiter((digest(w) for w in found), dtype=np.uint64, count=len(found))
    take = min(words, len(found))
    count = len(found) - take + 1
    out = np.full(count, take, dtype=np.uint64)
    for k in range(take):
        out = (out ^ each[k : k + count]) * _ODD
        out ^= out >> np.uint64(29)
    return np.unique(out)


def prefix(hashes: np.ndarray, known: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The rarest shingles of a set, so many that two sets similar enough must share one of theirs.

    Shared are at least FOUR / FIVE of the larger set, so a shared shingle is among the first n - ceil(n FOUR / FIVE) + 1 of
    any order that all sets follow. Rarest by the sample comes first, then by hash.
    """
    n = len(hashes)
    rank = np.zeros(n, dtype=np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        rank = np.where(known[at] == hashes, ranks[at], 0)
    return hashes[np.argsort(rank, kind="stable")[: n - -(-n * FOUR // FIVE) + 1]]


def parities(hashes: np.ndarray, count: int = PARITIES) -> np.ndarray:
    """``count`` bits: how many of the set fall to each, odd or even. Two sets differ in at least as many shingles as bits."""
    odd = np.bincount((hashes % np.uint64(count)).astype(np.int64), minlength=count) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def majority(hashes: np.ndarray) -> int:
    """The SimHash of a set: the bits that more than half of its hashes have, as a signed number."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def sketch(hashes: np.ndarray) -> bytes:
    """Parities of a set in at least as many bits as it has shingles, a power of two, so that long sets tell apart too."""
    bits = 1 << max(PARITIES.bit_length() - 1, min(20, (len(hashes) - 1).bit_length()))
    return np.packbits((np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def may_be_alike(a: bytes, b: bytes, n: int, m: int) -> bool:
    """What the sketches of sets of n and m shingles allow. The longer sketch is folded: half the bits, halves added up."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return (FIVE + FOUR) * int(np.bitwise_count(x ^ y).sum()) <= (FIVE - FOUR) * (n + m)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    if FIVE * min(len(a), len(b)) < FOUR * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return FIVE * both >= FOUR * (len(a) + len(b) - both)


# ---------------------------------------------------------------- the job


def _key(text_col: str) -> Column:
    return F.md5(F.coalesce(F.col(text_col), F.lit("")))


def _frequent(docs: DataFrame, text_col: str, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted shingles, counts) of shingles that repeat in a bounded sample of the documents."""

    def every(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t, words) for t in batch["text"]] or [shingles(None)[:0]]
            yield pd.DataFrame({"shingle": np.concatenate(sets).view(np.int64)})

    share = min(2**30, 2**30 * SAMPLE // max(1, docs.count()))
    some = docs.where(F.pmod(F.xxhash64(text_col, F.lit(5)), F.lit(2**30)) < share).select(F.col(text_col).alias("text"))
    counts = some.mapInPandas(every, "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    top = most_frequent(stored(counts), ROOM).toPandas()
    known, ranks = top["shingle"].to_numpy(dtype=np.int64).view(np.uint64), top["n"].to_numpy(dtype=np.int64)
    order = np.argsort(known)
    return known[order], ranks[order]


def _links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Those of the distinct pairs (a, b) whose sets are alike, written out.

    Sets are made from the texts again, only for nodes that are in a pair, and sent only for pairs that their sketches,
    a fiftieth of the size, allow.
    """

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t, words) for t in batch["text"]]
            more = {"n": np.array([len(h) for h in sets], dtype=np.int64), "sketch": [sketch(h) for h in sets], "hashes": [h.tobytes() for h in sets]}
            yield batch[["node"]].assign(**more)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ok = [alike(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)) for x, y in zip(batch["x"], batch["y"])]
            yield batch.loc[ok, ["a", "b"]]

    def hope(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ok = [may_be_alike(x, y, n, m) for x, y, n, m in zip(batch["x"], batch["y"], batch["n"], batch["m"])]
            yield batch.loc[ok, ["a", "b"]]

    def both(pairs: DataFrame, sets: DataFrame, value: str) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col(value).alias("x"), "n")
        right = sets.select(F.col("node").alias("b"), F.col(value).alias("y"), F.col("n").alias("m"))
        return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y", "n", "m")

    with scratch() as keep:
        pairs = stored(pairs)
        met = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "_key"), "node")
        one_text = texts.join(met, "_key").select("node", "text").dropDuplicates(["node"])
        sets = stored(one_text.mapInPandas(again, "node long, n long, sketch binary, hashes binary"))
        hoped = stored(both(pairs, sets, "sketch").mapInPandas(hope, "a long, b long"))
        return keep(both(hoped, sets, "hashes").mapInPandas(judge, "a long, b long"))


def _simhash_pairs(use: DataFrame) -> DataFrame:
    """(node, b): every node beside the smallest node that SimHash connects it with, in fingerprints of few differing bits."""
    prints = stored(use.select("fp").distinct())
    parts = connected(simhash.links(prints)).select(F.col("node").alias("fp"), "root")
    rooted = use.select("node", "fp").join(parts, "fp", "left").select("node", F.coalesce("root", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("node").alias("b"))
    return rooted.join(low, "root").where("node != b").select("node", "b")


def _one_by_one(rooted: DataFrame) -> DataFrame:
    """Of the rows (shingle, node, root) those of shingles whose nodes differ in root; of shingles with the same nodes only one.

    A passage's shingles have the same nodes, and one of them finds all the pairs. Sets of nodes are told apart by number, ends
    and the sum of 64-bit hashes.
    """
    same = [F.count("*").alias("nodes"), F.min("node").alias("low"), F.max("node").alias("high"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum")]
    sets = rooted.groupBy("shingle").agg(F.min("root").alias("r"), F.max("root").alias("s"), *same).where("r < s")
    one = sets.groupBy("nodes", "low", "high", "sum").agg(F.min("shingle").alias("shingle"))
    return rooted.join(one.select("shingle"), "shingle")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(_id, _key, root): the id, the hash of the text and the component of every row.

    Texts are A-Z folded; rows are linked if their sets of shingles have a Jaccard similarity of at least FOUR / FIVE,
    and components are what links connect. Texts without words are linked with each other only. Equal sets are one
    node, by 64 bits of hash. An empty table gives an empty result; other columns are not read.

    First SimHash: every node meets the smallest node its fingerprint is connected with, and an exact check decides.
    Fingerprints of alike sets may differ in more bits than SimHash links, so the rest is found by prefixes: two sets
    alike share a shingle of theirs, so all pairs are found where nodes meet by a prefix shingle. A large family is not
    compared pair by pair: every node meets the first and the last node of its shingle, in one of TURNS orders, and only
    nodes that all these links leave apart meet one by one, once for all shingles that have the same nodes.
    """
    known, ranks = _frequent(docs, text_col, words)
    kind = docs.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t, words) for t in batch["text"]]
            more = {
                "node": np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], dtype=np.uint64).view(np.int64),
                "fp": np.array([majority(s) for s in sets], dtype=np.int64),
                "n": np.array([len(s) for s in sets], dtype=np.int64),
                "bits": [parities(s) for s in sets],
                "more": [parities(s, MORE_PARITIES) if len(s) > PARITIES else None for s in sets],
                "prefix": [prefix(s, known, ranks).view(np.int64) for s in sets],
            }
            yield batch[["_id", "_key"]].assign(**more)

    texts = docs.select(F.col(id_col).alias("_id"), _key(text_col).alias("_key"), F.col(text_col).alias("text"))
    rows = stored(texts.mapInPandas(read, f"_id {kind}, _key string, node long, fp long, n long, bits array<long>, more array<long>, prefix array<long>"))
    nodes = rows.groupBy("node").agg(F.min("_key").alias("_key"), *[F.first(c).alias(c) for c in ("fp", "n", "bits", "more")])
    marks = rows.select("node", F.explode("prefix").alias("shingle"))
    met = marks.groupBy("shingle").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    marks = stored(marks.join(met.select("shingle"), "shingle").distinct())

    use = stored(marks.select("node").distinct().join(nodes, "node"))
    whole = texts.select("_key", "text")

    def may(x: str, y: str) -> Column:
        """What sizes and parities allow: similar sets differ in at most a ninth of what they hold together."""
        n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
        apart = sum((F.bit_count(F.col(f"{x}.bits")[k].bitwiseXOR(F.col(f"{y}.bits")[k])) for k in range(PARITIES // 64)), F.lit(0))
        near = F.lit(FIVE + FOUR) * apart <= F.lit(FIVE - FOUR) * (n + m)
        return (F.lit(FIVE) * F.least(n, m) >= F.lit(FOUR) * F.greatest(n, m)) & near

    def may_long(x: str, y: str) -> Column:
        """The same by MORE_PARITIES, for two sets that have them."""
        bits = F.zip_with(f"{x}.more", f"{y}.more", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
        apart = F.aggregate(bits, F.lit(0), lambda s, k: s + k)
        return F.coalesce(F.lit(FIVE + FOUR) * apart <= F.lit(FIVE - FOUR) * (F.col(f"{x}.n") + F.col(f"{y}.n")), F.lit(True))

    traits = use.select("node", "n", "bits")
    turn = F.xxhash64("node", F.pmod("shingle", F.lit(TURNS)))
    ends = marks.groupBy("shingle").agg(F.min_by("node", turn).alias("low"), F.max_by("node", turn).alias("high"))
    pairs = marks.join(ends, "shingle").select("node", F.explode(F.array("low", "high")).alias("b")).where("node != b")
    pairs = _simhash_pairs(use).unionByName(pairs)
    pairs = pairs.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    pairs = pairs.join(traits.alias("one"), F.col("a") == F.col("one.node")).join(traits.alias("two"), F.col("b") == F.col("two.node"))
    edges = _links(pairs.where(may("one", "two")).select("a", "b"), use, whole, words)
    parts = connected(edges)

    rooted = stored(marks.join(parts, "node", "left").select("shingle", "node", F.coalesce("root", "node").alias("root")))
    rooted = stored(_one_by_one(rooted).join(use.select("node", "n", "bits", "more"), "node"))
    one, two = rooted.alias("one"), rooted.alias("two")
    differ = (F.col("one.shingle") == F.col("two.shingle")) & (F.col("one.root") < F.col("two.root")) & may("one", "two") & may_long("one", "two")
    pairs = one.join(two, differ).select(F.col("one.node").alias("a"), F.col("two.node").alias("b")).distinct()
    late = _links(pairs, use, whole, words)
    if not late.isEmpty():
        parts = connected(parts.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(late))
    return rows.join(parts, "node", "left").select("_id", "_key", F.coalesce("root", "node").alias("root"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that stay, one for every component: the one with its smallest id, then text hash; null ids last.

    Of rows that repeat both the id and the text of the one that stays only one stays, the first by its columns as JSON.
    """
    with scratch() as keep:
        classes = near_classes(docs, id_col, text_col, words).groupBy("root", "_id", "_key").agg(F.count("*").alias("copies"))
        best = classes.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_key", "copies")).alias("best"))
        stays = keep(best.select(F.col("best._id").alias("stay"), F.col("best._key").alias("stay_key"), F.col("best.copies").alias("copies")))
    rows = packed(docs, id=F.col(id_col), key=_key(text_col))
    chosen = lambda some: rows.join(some, F.col("id").eqNullSafe(F.col("stay")) & (F.col("key") == F.col("stay_key")), "left_semi")
    out, several = chosen(stays.where("copies = 1")).select("row"), stays.where("copies > 1")
    if not several.isEmpty():
        out = out.unionByName(chosen(several).groupBy("id", "key").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row"))
    return unpacked(out)
