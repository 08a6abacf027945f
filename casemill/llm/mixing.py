"""Mixing sources to target weights along a time-varying curriculum.

Every source has a share of all tokens and a weight schedule over training time. Integrating the schedule gives the
source's cumulative demand; inverting it at a document's cumulative token offset gives the document's position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.common import packed, stored, unpacked, word_count
from casemill.operators.metrics import ranked_by

#: Weights by the source's rank, repeating, and the schedule's multiplier at the start and at the end of training.
WEIGHTS = (1.0, 2.0, 3.0)
SCHEDULE = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
EPOCHS = 3


def source_targets(sizes: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, rank, weight, target) from rows (source, size).

    Sources are ranked by code point, null last. They share the sum of all sizes by weight; a target stops at
    ``epochs`` times its source's size and the excess goes to the others by weight, again and again until none is
    above. Each turn is one aggregate over the table of sources that returns one row.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").cast("double").alias("source_size"))
    ranked = ranked_by(sources, [], [F.col("source").asc_nulls_last()], "rank")
    which = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = stored(ranked.withColumn("weight", which).withColumn("cap", F.col("source_size") * epochs))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0.0
    level = 0.0
    while total:
        over = F.col("weight") * F.lit(level) >= F.col("cap")
        held, free = ranked.agg(F.sum(F.when(over, F.col("cap")).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
        following = (total - held) / free if free else level
        if following <= level:
            break
        level = following
    return ranked.select("source", "source_size", "rank", "weight", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def _position(share: Column, first: Column, last: Column) -> Column:
    """Training time at which a source has used ``share`` of its demand, its rate going linearly from first to last.

    The rate's integral over [0, t] is first*t + (last-first)*t*t/2, over its value at 1; this is its inverse.
    """
    whole = (first + last) / 2
    slope = last - first
    root = F.sqrt(F.greatest(F.lit(0.0), first * first + slope * 2 * share * whole))
    return F.when(slope == 0, share).otherwise((root - first) / slope)


def curriculum(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, schedule=SCHEDULE, epochs: int = EPOCHS, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: its id and source, the columns in ``carry``, size, source_size, target, taken, positions.

    ``size`` is the text's number of words, null and empty texts 0. A source's documents stand in a fixed shuffled
    order (MD5 of the id, then id, then size); epoch after epoch they are laid end to end and the mix takes the
    words below the source's target, so taken words of a source are its target to within a word per document at the
    cut. ``taken`` counts repeats and never exceeds ``epochs`` times the size. ``positions`` has a training time in
    [0, 1] for each epoch in which the document starts inside the target, by the inverted demand of its source.
    Rows that repeat an id are documents of their own. An empty table gives an empty result.

    Plan: a source may hold any part of the rows, so its prefix sums go by buckets: order within about sqrt(rows)
    ranges of the hash a source, then range totals. Both windows and the join share one partitioning by (source, bucket).
    """
    narrow = docs.select(
        F.col(id_col).alias("_id"),
        F.col(source_col).alias("_source"),
        word_count(F.col(text_col)).alias("_size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("_order"),
        F.struct(F.lit(0), *carry).alias("_carry"),
    )
    narrow = stored(narrow)
    count = narrow.count()
    buckets = max(1, int(count**0.5))
    narrow = narrow.withColumn("_bucket", F.floor(F.conv(F.substring("_order", 1, 8), 16, 10).cast("bigint") * buckets / 2**32))
    targets = source_targets(narrow.select(F.col("_source").alias("source"), F.col("_size").alias("size")), weights, epochs)
    steps = [F.array(F.lit(float(a)), F.lit(float(b))) for a, b in schedule]
    targets = targets.withColumn("rates", F.element_at(F.array(*steps), ((F.col("rank") - 1) % len(schedule) + 1).cast("int")))
    totals = narrow.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_sum"))
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_source", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    offsets = offsets.join(targets, offsets["_source"].eqNullSafe(targets["source"])).drop("source")
    offsets = offsets.select(F.col("_source").alias("_s"), F.col("_bucket").alias("_b"), "_offset", "source_size", "target", "rates")
    inside = Window.partitionBy("_source", "_bucket").orderBy("_order", "_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    placed = narrow.withColumn("_start", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    placed = placed.join(offsets, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    start = F.col("_offset") + F.col("_start")
    part = lambda e: F.greatest(
        F.lit(0).cast("bigint"), F.least(F.col("_size"), F.round(F.col("target")).cast("bigint") - (start + F.col("source_size").cast("bigint") * e))
    )
    taken = sum((part(e) for e in range(1, epochs)), part(0))
    moments = [
        F.when(
            part(e) > 0,
            _position((start + F.col("source_size") * e) / F.nullif(F.col("target"), F.lit(0.0)), F.col("rates")[0], F.col("rates")[1]),
        )
        for e in range(epochs)
    ]
    return placed.select(
        F.col("_id").alias(id_col),
        F.col("_source").alias(source_col),
        *[F.col("_carry")[c].alias(c) for c in carry],
        F.col("_size").alias("size"),
        F.col("source_size").cast("bigint").alias("source_size"),
        "target",
        taken.alias("taken"),
        F.array_compact(F.array(*moments)).alias("positions"),
        "_order",
    )


def in_training_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents range-sorted by their first position; those not taken come last, in hash order, so no range is one value."""
    first = F.coalesce(F.get("positions", F.lit(0)), F.lit(2.0))
    return mixed.orderBy(first, "_order", id_col)


def laid_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` in training order, each once for every epoch in which the mix starts it, whole.

    The rows travel with their prefix sums, so rows that repeat an id, or all columns, have turns of their own.
    """
    rows = packed(docs, id=F.col(id_col), text=F.col(text_col), source=F.col(source_col))
    mixed = curriculum(rows, "id", "text", "source", carry=("row",), **options)
    placed = mixed.select("row", "id", "_order", F.explode("positions").alias("position"))
    return unpacked(placed.orderBy("position", "_order", "id"))
