"""Exact duplicates: rows grouped by a 128-bit content hash, bytes compared inside each group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import folded, packed, stored, text_or_empty, unpacked

NEW = ("keep_id", "group_size", "kept", "text_sha256")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", hash_of=F.md5) -> DataFrame:
    """One row per input row: the columns of ``docs`` plus keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after A-Z folding; null is the empty text. ``keep`` names the row that stays,
    the smallest or the largest id of the group; null ids lose against any other. Rows that repeat the staying id
    with the same text are all kept, and every row counts in group_size. An empty table gives an empty result;
    extra columns pass through, those named like a new one are replaced.

    Plan: the group key is (128-bit hash, text), so the aggregate itself compares bytes, and its map-side half
    leaves one row per text and task however many copies there are. What joins back is narrow: hash, digest, id
    and size. One side of that join is unique, so a group with a third of all rows is split by the skew join.
    Two texts with one 128-bit hash stay two groups, told apart by SHA-256; should that collide as well the job
    fails rather than merge them.
    """
    return unpacked(_grouped(docs, id_col, text_col, keep, hash_of), NEW)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, one for each group: rows that repeat the staying id with its text stay once."""
    kept = _grouped(docs, id_col, text_col, keep, F.md5).where("kept")
    return unpacked(kept.dropDuplicates(["keep_id", "text_sha256"]))


def _grouped(docs: DataFrame, id_col: str, text_col: str, keep: str, hash_of) -> DataFrame:
    best = {"smallest": F.min, "largest": F.max}[keep]
    folds = {"folds": folded(text_or_empty(text_col)), "id": F.col(id_col)}
    texts = docs.select(*[c.alias(n) for n, c in folds.items()]).withColumn("hash", hash_of("folds"))
    texts = texts.groupBy("hash", "folds").agg(best("id").alias("keep_id"), F.count("*").alias("group_size"))
    texts = texts.select("hash", F.sha2("folds", 256).alias("digest"), "keep_id", "group_size")
    collided = F.raise_error(F.concat(F.lit("two texts share both digests: "), F.col("digest"))).cast("bigint")
    groups = (
        texts.groupBy("hash", "digest")
        .agg(F.count("*").alias("texts"), F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"))
        .select("hash", "digest", "keep_id", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(collided).alias("group_size"))
    )
    rows = packed(docs, **folds).select("row", "id", hash_of("folds").alias("hash"), F.sha2("folds", 256).alias("digest"))
    # written out, so that both sides of the join are plain exchanges, which the skew join can split
    return rows.join(stored(groups), ["hash", "digest"]).select(
        "row", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256")
    )
