"""Exact top-k by inner product over an impact-ordered index, processed score at a time.

A block of vectors is indexed by posting segments: per component and quantised impact, the vectors that have it.
Queries take the segments by descending impact into accumulators. What a vector may still gain or lose is bounded by the norms of the query
and of the vector's unprocessed rest, so a query stops when all but a few vectors are proven out; those few are
scored exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
#: Width of an impact step, vectors in a block, queries in a block and blocks of queries that meet a block of vectors together.
STEP, BLOCK, QUERIES, TOGETHER = 32, 4096, 512, 64
#: A query stops once this many times k vectors may still be members.
ENOUGH = 4


def quantised(vector: Column) -> Column:
    """floor(SCALE * x) of every component as long; null if the vector, or a component, is null or not finite."""
    whole = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False)))
    return F.when(whole, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)))


class Postings:
    """A block's index: for every component and quantised impact the vectors that have it.

    Segments of one power of two of impact form a stride; strides are processed by descending impact. A posting is
    (vector, signed impact), so components without impact in a stride cost nothing in it.
    """

    def __init__(self, vectors: np.ndarray):
        impact = np.rint(vectors / STEP)
        size = np.abs(impact)
        rest = vectors.astype(np.float64)
        self.strides: list[tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray]] = []
        self.total = 0
        for bit in range(int(size.max(initial=0)).bit_length() - 1, -1, -1):
            component, vector = np.nonzero(((size >= 2**bit) & (size < 2 ** (bit + 1))).T)
            value = impact[vector, component] * STEP
            rest[vector, component] -= value
            first = np.flatnonzero(np.concatenate([[True], component[1:] != component[:-1]])) if len(component) else component
            lists = [(int(component[x]), vector[x:y], value[x:y]) for x, y in zip(first, np.append(first[1:], len(component)))]
            self.total += len(component)
            # the norm of what is not processed yet bounds what a vector may still gain or lose
            self.strides.append((lists, np.sqrt((rest * rest).sum(axis=1))))


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, work: dict | None = None
) -> list[tuple[int, int, int]]:
    """(query id, vector id, score): the k best of the block for every query, or all, ties to smaller ids.

    ``work`` gets the postings added to accumulators and those saved by proofs or by components without weight.
    """
    out, read = [], 0
    index = Postings(vectors)
    own = query_ids[:, None] == ids[None, :]
    norms, whole = (np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) for x in (queries, vectors))
    wide = norms * whole.max(initial=0) * 1.001 >= 2.0**63

    def finish(row: int, members: np.ndarray) -> None:
        at = np.flatnonzero(members)
        if wide[row]:  # a sum may leave the range of a long
            sums = vectors[at].astype(object) @ queries[row].astype(object)
            score = np.array([max(-(2**63), min(2**63 - 1, int(x))) for x in sums], dtype=np.int64)
        else:
            score = vectors[at] @ queries[row]
        best = np.lexsort((ids[at], ~score))[:k]
        out.extend((int(query_ids[row]), int(ids[at[b]]), int(score[b])) for b in best)

    for row in np.flatnonzero(wide):  # scores held at the ends of a long tie there, so bounds prove nothing
        finish(row, ~own[row])
    open_ = np.flatnonzero(~wide)
    sums = np.zeros((len(vectors), len(open_)))
    possible = ~own[open_]
    for lists, rest in index.strides:
        weights = queries[open_].astype(np.float64)
        for component, members, values in lists:
            weight = weights[:, component]
            asked = np.flatnonzero(weight)
            if len(asked) == len(weight):
                sums[members] += values[:, None] * weight[None, :]
            elif len(asked):
                sums[np.ix_(members, asked)] += values[:, None] * weight[None, asked]
            read += len(members) * len(asked)
        # the last term covers rounding, which is relative to the sizes of both vectors
        slack = norms[open_, None] * (rest * (1 + 1e-9) + whole * 1e-9)[None, :] + 1
        possible = _possible(sums.T, slack, own[open_], k)
        done = possible.sum(axis=1) <= ENOUGH * k
        for row, members in zip(open_[done], possible[done]):
            finish(row, members)
        open_, sums, possible = open_[~done], sums[:, ~done], possible[~done]
        if not len(open_):
            break
    for row, members in zip(open_, possible):
        finish(row, members)
    if work is not None:
        work["read"], work["saved"] = read, index.total * len(queries) - read
    return out


def _possible(sums: np.ndarray, slack: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Vectors whose upper bound reaches the k-th best lower bound; no other can be a member."""
    low = np.where(own, -np.inf, sums - slack)
    n = low.shape[1]
    least = np.partition(low, n - k, axis=1)[:, n - k] if n > k else np.full(len(low), -np.inf)
    return (sums + slack >= least[:, None]) & ~own


def _packed(rows: DataFrame, blocks: int, salt: int) -> DataFrame:
    """(block, ids, width, data): vectors dealt into blocks by hash, every block one row of packed longs."""

    def pack(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        width = int(block["v"].map(len).max())
        data = np.zeros((len(block), width), dtype=np.int64)
        for at, v in enumerate(block["v"]):
            data[at, : len(v)] = v
        ids = block["id"].to_numpy(dtype=np.int64)
        return pd.DataFrame({"block": [key[0]], "ids": [ids.tobytes()], "width": [width], "data": [data.tobytes()]})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "v", F.lit(salt)), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInPandas(pack, "block int, ids binary, width int, data binary")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): for every query its ``k`` best vectors but its own, ties to smaller ids.

    Vectors that are null or hold null or non-finite components, and null ids, take no part; an empty vector scores 0
    and a shorter one counts as ended by zeros. A query whose id repeats asks once, with the first of its vectors; rows
    that repeat a vector's id are candidates of their own. Fewer than k candidates give them all; an empty table gives
    an empty result; other columns are not read.

    Scores are exact in 64 bits; components and scores beyond that are held at the ends of a long, where they tie.

    Blocks of queries go to every block of vectors, TOGETHER of them to a task's group at a time. So a task holds bounded
    blocks of both, queries are sent once per block of vectors and vectors once per TOGETHER blocks of queries. Every
    block returns k rows per query.
    """
    pick = lambda d: d.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col)).alias("v")).where("v is not null and id is not null")
    rows, asked = pick(vectors), pick(queries).groupBy("id").agg(F.min("v").alias("v"))
    blocks = -(-rows.count() // BLOCK) or 1
    asks = -(-asked.count() // QUERIES) or 1
    turns = -(-asks // TOGETHER)
    left = _packed(asked, asks, 1).select(
        F.floor(F.col("block") / TOGETHER).cast("int").alias("turn"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "ids", "width", "data"
    )
    right = _packed(rows, blocks, 2).withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))

    def read(row, width: int) -> np.ndarray:
        own = np.frombuffer(row.data, dtype=np.int64).reshape(-1, row.width) if row.width else np.zeros((len(row.ids) // 8, 0), dtype=np.int64)
        return np.pad(own, ((0, 0), (0, width - row.width)))

    def search(asks: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = []
        for members in block.itertuples():
            for row in asks.itertuples():
                width = max(row.width, members.width)
                q_ids, ids = np.frombuffer(row.ids, dtype=np.int64), np.frombuffer(members.ids, dtype=np.int64)
                found += search_block(q_ids, read(row, width), ids, read(members, width), k)
        return pd.DataFrame(found, columns=["query_id", "id", "score"]).astype("int64")

    found = left.groupBy("turn", "block").cogroup(right.groupBy("turn", "block")).applyInPandas(search, "query_id long, id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
