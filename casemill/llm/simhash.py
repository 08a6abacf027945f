"""SimHash near duplicates: 64-bit fingerprints, linked within a Hamming distance found by vantage-point trees."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import LOWER, UPPER, connected, packed, stored, unpacked

WORDS = 4
BITS = 4
SEED = 42
#: The routing tree: its vantage points come from this many fingerprints at most, and it has this many shards at least.
SAMPLE, SHARDS, SHARD_ROWS = 8192, 128, 20_000
#: A shard with more possible comparisons than this is cut by members into pieces, each with all the queries.
PIECE = 10**10
LEAF = 96
_WORD = re.compile("[^\x20\x09-\x0d]+")
_FOLD = str.maketrans(UPPER, LOWER)


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Majority of the bits of the shingles' XXH64, repeats included; no words give zero."""
    found = _WORD.findall((text or "").translate(_FOLD))
    if not found:
        return 0
    lengths = np.fromiter((len(w.encode()) for w in found), dtype=np.int64, count=len(found))
    ends = (np.cumsum(lengths + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    whole = memoryview(" ".join(found).encode())
    take = min(words, len(found))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(whole[a:b], SEED) for a, b in zip(starts, ends[take - 1 :])), dtype=np.uint64, count=len(found) - take + 1
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * ones > len(hashes)).tolist())


def fingerprints(text: Column, words: int = WORDS) -> Column:
    @F.pandas_udf("long")
    def of(batch: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in batch], dtype=np.uint64).view(np.int64))

    return of(text)


# ---------------------------------------------------------------- vantage-point trees


def _far(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def plant(sample: np.ndarray, depth: int) -> list[tuple[int, int]]:
    """The routing tree over a sample: (vantage point, median distance) of every inner node in heap order."""
    nodes = [(0, 0)] * (2**depth - 1)
    parts = {0: sample}
    for at in range(len(nodes)):
        part = parts.pop(at)
        point = part[0] if len(part) else np.uint64(0)
        away = _far(part, point)
        cut = int(np.median(away)) if len(part) else 32
        nodes[at] = (int(point), cut)
        parts[2 * at + 1], parts[2 * at + 2] = part[away <= cut], part[away > cut]
    return nodes


def descend(prints: np.ndarray, nodes: list[tuple[int, int]], reach: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, indices): the shards that a fingerprint's ball of radius ``reach`` touches; reach 0 gives its home."""
    todo = [(0, np.arange(len(prints)))]
    while todo:
        at, rows = todo.pop()
        if not len(rows):
            continue
        if at >= len(nodes):
            yield at - len(nodes), rows
            continue
        point, cut = nodes[at]
        away = _far(prints[rows], np.uint64(point))
        todo += [(2 * at + 1, rows[away <= cut + reach]), (2 * at + 2, rows[away > cut - reach])]


def pairs_within(members: np.ndarray, queries: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (query, member) fingerprints at most ``reach`` apart, by a local vantage-point tree over the members.

    A node splits its members at the median distance to a vantage point and sends a query to a side only if the
    triangle inequality leaves a member of that side within reach. A node that cannot be split is compared in blocks.
    """
    todo = [(members, queries)]
    while todo:
        own, asked = todo.pop()
        if not len(own) or not len(asked):
            continue
        if len(own) > LEAF:
            point = own[0]
            away = _far(own, point)
            cut = int(np.median(away))
            near = away <= cut
            if 0 < near.sum() < len(own):
                out = _far(asked, point)
                todo += [(own[near], asked[out <= cut + reach]), (own[~near], asked[out > cut - reach])]
                continue
        for a in range(0, len(own), 512):
            part = own[a : a + 512]
            step = max(1, 2_000_000 // len(part))
            for b in range(0, len(asked), step):
                q, m = np.nonzero(np.bitwise_count(asked[b : b + step, None] ^ part[None, :]) <= reach)
                if len(q):
                    yield asked[b + q], part[m]


def star_edges(members: np.ndarray, queries: np.ndarray, reach: int) -> pd.DataFrame:
    """The links of one shard, reduced at once to one edge per fingerprint and tree: (a, smallest linked b)."""
    nodes = np.unique(np.concatenate([members, queries]))
    parent = np.arange(len(nodes))

    def roots(x: np.ndarray) -> np.ndarray:
        at = x
        while True:
            up = parent[at]
            if np.array_equal(up, at):
                parent[x] = at
                return at
            at = up

    for q, m in pairs_within(members, queries, reach):
        other = q != m
        a, b = np.searchsorted(nodes, q[other]), np.searchsorted(nodes, m[other])
        while True:
            ra, rb = roots(a), roots(b)
            differ = ra != rb
            if not differ.any():
                break
            np.minimum.at(parent, np.maximum(ra, rb)[differ], np.minimum(ra, rb)[differ])
            a, b = a[differ], b[differ]
    root = roots(np.arange(len(nodes)))
    moved = root != np.arange(len(nodes))
    return pd.DataFrame({"a": nodes[moved].view(np.int64), "b": nodes[root[moved]].view(np.int64)})


def links(prints: DataFrame, reach: int = BITS) -> DataFrame:
    """(a, b): edges between distinct fingerprints (column fp, long) that connect exactly what links within ``reach`` do.

    The routing tree is planted over a bounded sample; only its vantage points travel with the tasks. A fingerprint
    is a member of one shard and a query in every shard its ball touches, so pairs that straddle a boundary are found
    in the member's shard. Rows travel packed, one row per batch and shard; a shard that holds far more than its part,
    such as one dense ball, is cut into pieces by members.
    """
    rows = prints.count()
    depth = max(SHARDS, -(-rows // SHARD_ROWS)).bit_length() - 1
    sample = prints.orderBy(F.xxhash64(F.col("fp"), F.lit(1)), "fp").limit(SAMPLE).toPandas()["fp"]
    nodes = plant(sample.to_numpy(dtype=np.int64).view(np.uint64), depth)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            home = dict(descend(own, nodes, 0))
            packed = [(shard, own[home[shard]].tobytes() if shard in home else b"", own[at].tobytes()) for shard, at in descend(own, nodes, reach)]
            yield pd.DataFrame(packed, columns=["shard", "members", "queries"])

    def compare(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        members = np.frombuffer(b"".join(shard["members"]), dtype=np.uint64)
        queries = np.frombuffer(b"".join(shard["queries"]), dtype=np.uint64)
        return star_edges(members, queries, reach)

    routed = stored(prints.select("fp").mapInPandas(route, "shard int, members binary, queries binary"))
    work = (F.sum(F.length("members") / 8) * F.sum(F.length("queries") / 8) / F.lit(float(PIECE))).alias("work")
    pieces = routed.groupBy("shard").agg(work).select("shard", F.ceil(F.greatest(F.lit(1.0), "work")).cast("int").alias("pieces"))
    cut = routed.join(pieces, "shard").withColumn("piece", F.explode(F.sequence(F.lit(1), "pieces")))
    mine = F.pmod(F.xxhash64("queries"), F.col("pieces")) + 1 == F.col("piece")
    cut = cut.withColumn("members", F.when(mine, F.col("members")).otherwise(F.lit(b"")))
    return cut.select("shard", "piece", "members", "queries").groupBy("shard", "piece").applyInPandas(compare, "a long, b long")


# ---------------------------------------------------------------- documents


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, reach: int = BITS) -> DataFrame:
    """One row per input row: its id, fingerprint (16 hex digits) and component_id.

    Texts are A-Z folded and cut into words; a text of fewer words than a shingle is one shingle; empty, null and
    blank texts have fingerprint zero and are linked like any other. component_id is the smallest id reachable over
    links of at most ``reach`` differing bits; null ids are ignored unless a component has no other, then it is null.
    An empty table gives an empty result; other columns are not read.

    Equal fingerprints are one node, so a group of copies costs one row however large it is. What joins back is the
    table of fingerprints that are linked; the others only need the smallest id of their own fingerprint.
    """
    out = _classes(docs, id_col, text_col, words, reach)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return out.select(F.col("_id").alias(id_col), hexed, "component_id")


def _classes(docs: DataFrame, id_col: str, text_col: str, words: int, reach: int) -> DataFrame:
    """(_id, fp, root, component_id) of every row; root tells components apart that have null ids only."""
    printed = docs.withColumn("_fp", fingerprints(F.col(text_col), words))
    ids = stored(printed.select(F.col(id_col).alias("_id"), F.col("_fp").alias("fp")))
    nodes = stored(ids.groupBy("fp").agg(F.min("_id").alias("least")))
    parts = connected(links(nodes, reach))
    joined = nodes.join(parts, nodes["fp"] == parts["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    joined = stored(joined)
    lowest = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = joined.join(lowest, "root").select("fp", "root", "component_id")
    return ids.join(classes, "fp").select("_id", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, reach: int = BITS) -> DataFrame:
    """The rows of ``docs`` that stay: of every component the one with its smallest id, then fingerprint; null ids last.

    Rows that repeat both the id and the fingerprint of the one that stays stay with it.
    """
    classes = _classes(docs, id_col, text_col, words, reach)
    best = classes.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "fp")).alias("best"))
    stays = best.select(F.col("best._id").alias("stay"), F.col("best.fp").alias("stay_fp")).distinct()
    rows = packed(docs, id=F.col(id_col), fp=fingerprints(F.col(text_col), words))
    rows = rows.join(stays, F.col("id").eqNullSafe(F.col("stay")) & (F.col("fp") == F.col("stay_fp")), "left_semi")
    return unpacked(rows)
