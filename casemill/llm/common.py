"""What the operators share: tables, word rules, written intermediate tables and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.session import ensure_checkpoint_dir

#: A word is a run of anything but the six ASCII white-space characters; letters folded are A-Z only.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def folded(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Pure ASCII takes the byte path of ``lower``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def packed(docs: DataFrame, **more: Column) -> DataFrame:
    """Every row as one struct ``row`` beside the columns ``more``, so that names of the input clash with nothing."""
    return docs.select(F.struct("*").alias("row"), *[c.alias(name) for name, c in more.items()])


def unpacked(rows: DataFrame, new: tuple[str, ...] = ()) -> DataFrame:
    """The packed rows' own columns and those in ``new``, which replace own ones of the same name."""
    own = [f.name for f in rows.schema["row"].dataType.fields if f.name.lower() not in {n.lower() for n in new}]
    return rows.select(*[F.col("row")[c].alias(c) for c in own], *new)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to a new folder below spark.checkpoint.dir and read it back.

    Cuts the lineage like a checkpoint does, in columns: later reads take only what they need, and a lost
    executor costs one read. The folder stays until the checkpoint folder is cleaned, or the ``scratch`` it is in ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    for folders in _SCRATCH.get()[-1:]:
        folders.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Folders written in the scratch blocks that are open, innermost last.
_SCRATCH: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A block whose stored tables are deleted when it ends, but for those stored with the function it gives.

    What is needed afterwards must be stored with that function: it belongs to the block around this one, if any.
    """
    outer = _SCRATCH.get()
    folders: list[str] = []
    token = _SCRATCH.set((*outer, folders))
    sessions: list[SparkSession] = []

    def keep(df: DataFrame) -> DataFrame:
        inner = _SCRATCH.set(outer)
        try:
            sessions.append(df.sparkSession)
            return stored(df)
        finally:
            _SCRATCH.reset(inner)

    try:
        yield keep
    finally:
        _SCRATCH.reset(token)
        spark = sessions[0] if sessions else SparkSession.getActiveSession()
        for folder in folders if spark is not None else ():
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def most_frequent(counts: DataFrame, room: int, steps: int = 1) -> DataFrame:
    """The rows of ``counts`` whose n reaches the least level that lets at most ``room`` rows through.

    Levels are powers of two, each parted into ``steps``. Ties of one level go together, so this needs no order over
    all rows: one aggregate of 64 rows a step decides.
    """
    level = F.floor(F.log2("n") * F.lit(steps)).cast("int")
    bins = counts.groupBy(level.alias("bin")).agg(F.count("*").alias("rows")).collect()
    least = 0
    for row in sorted(bins, key=lambda r: -r["bin"]):
        if row["rows"] > room:
            least = row["bin"] + 1
            break
        room -= row["rows"]
    return counts.where(level >= least)


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable from every node that has an edge. ``edges``: a, b, of any order type.

    Alternates the large-star and small-star steps. Each round turns the edges at every node to the smallest
    neighbour; the minimum per node is a map-side aggregate and the joins have one unique side, so a node with a
    third of all edges is split by the skew join instead of being gathered. The edge table is written out after
    each round. Stops when a round changes nothing.
    """
    ordered = lambda e: (
        e.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    now = stored(ordered(edges))
    mark = None
    for _ in range(rounds):
        # large star: every larger neighbour of a node goes to the node's smallest neighbour (itself included)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = ordered(both.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        # small star: the smaller neighbours of a node, and the node, go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        now = stored(ordered(small))
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
