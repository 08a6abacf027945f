"""Structured Streaming front ends over the same operators."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from casemill import fixed, schemas
from casemill.functions.scalars import cell_key
from casemill.operators.curate import curate, index_rows
from casemill.operators.metrics import merge_coverage
from casemill.operators.neighbors import choose_pivots, nearest_distance, nearest_pivot, norm, reached_pivots, vector_width
from casemill.session import checkpointed
from casemill.sources import artifacts, lines

# ------------------------------------------------------------------ ingest


def stream_artifact(spark: SparkSession, root: str, kind: str, schema: T.StructType | None = None, split: int = lines.SPLIT) -> DataFrame:
    """A stream of one kind of log: the rows of new files, and the lines added to files that were read before.

    Files are those ``read_artifact`` finds. A line still being written waits until it is whole, blank lines are
    skipped and a malformed line fails the stream.
    """
    schema = schema or schemas.ARTIFACTS[kind]
    raw = lines.stream_lines(spark, root, kind, split).where(F.trim("raw") != "")
    row = F.from_json("raw", schema, {"mode": "FAILFAST"})
    folder = lambda pattern: F.nullif(F.regexp_extract("file", pattern, 1), F.lit(""))
    run = F.coalesce(folder(r"/run_id=([^/]+)/[^/]+$"), folder(rf"/([^/]+)/{kind}\.jsonl(?:/[^/]+)?$"))
    rows = raw.select(row.alias("row"), run.alias("run")).select("row.*", "run")
    if "run_id" in schema.names:  # the folder names it where the lines don't
        rows = rows.withColumn("run_id", F.coalesce("run_id", "run"))
    return rows.drop("run")


# ------------------------------------------------------------------ node status

def _lookup(table: dict[str, str], key: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in table.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def node_marks(events: DataFrame, *keep: str) -> DataFrame:
    """(run_id, ord, columns to keep, node, mark, starts): what each event says about a node of its run's board.

    ``events`` has run_id, ord and either a progress event (stage, stage_event) or a result (role,
    verdict, provider). ``mark`` is the status the event leaves; ``starts`` tells a start apart, because
    a start also displaces whatever else was running.
    """
    stage, event = F.col("stage"), F.col("stage_event")
    begun = event.isin("start", "select", "revise")
    started = F.when((stage == "generation") & (event == "revise"), F.lit("revise_from_adversary")).otherwise(
        _lookup(fixed.STAGE_NODES, stage)
    )
    done = _lookup(fixed.ROLE_NODES, F.col("role"))
    verdict = F.when(F.col("verdict") == "accept", F.lit("accept")).otherwise(F.lit("reject"))
    status = F.when(
        (F.coalesce("provider", F.lit("local")) == "local") & (verdict == "accept"), F.lit("local")
    ).otherwise(verdict)
    note = lambda node, mark, starts: F.struct(node.alias("node"), mark.alias("mark"), F.lit(starts).alias("starts"))
    skipped = F.array(*[note(F.lit(n), F.lit("skipped"), False) for n in fixed.SKIPPED_WHEN_GENERATION_FIRST])
    marks = (
        F.when((stage == "run") & (event == "start_from_generation"), skipped)
        .when(F.col("verdict").isNotNull() & done.isNotNull(), F.array(note(done, status, False)))
        .when(begun & started.isNotNull(), F.array(note(started, F.lit("running"), True)))
    )
    return events.select("run_id", "ord", *keep, F.explode(marks).alias("m")).select("run_id", "ord", *keep, "m.*")


def _displaced(node: str) -> str:
    return "local" if node in fixed.LOCAL_NODES else "pending"


def _parallel(a: str, b: str) -> bool:
    return a in fixed.PARALLEL_NODES and b in fixed.PARALLEL_NODES


def node_status(events: DataFrame) -> DataFrame:
    """(run_id, node, status) of a whole log.

    A node's status is its own latest mark, except that a running node is displaced by any later start of
    another node (the two gates run side by side). That only needs each node's latest mark and latest
    start, so one aggregate per run with map-side partials decides everything; no ordering pass.
    """
    marks = node_marks(events)
    at = F.struct("ord", "mark")
    aggs = []
    for n in fixed.BOARD_NODES:
        own = F.col("node") == n
        aggs.append(F.max(F.when(own, at)).alias(f"m_{n}"))
        aggs.append(F.max(F.when(own & F.col("starts"), F.col("ord"))).alias(f"s_{n}"))
    boards = marks.groupBy("run_id").agg(*aggs)
    rows = []
    for n in fixed.BOARD_NODES:
        rivals = [F.coalesce(F.col(f"s_{o}"), F.lit(-1)) for o in fixed.BOARD_NODES if o != n and not _parallel(o, n)]
        mark = F.col(f"m_{n}")
        moved = (mark["mark"] == "running") & (F.greatest(*rivals) > mark["ord"])
        status = F.when(mark.isNull(), F.lit("pending")).when(moved, F.lit(_displaced(n))).otherwise(mark["mark"])
        rows.append(F.struct(F.lit(n).alias("node"), status.alias("status")))
    return boards.select("run_id", F.explode(F.array(*rows)).alias("r")).select("run_id", "r.*")


class _Boards(StatefulProcessor):
    """One board per run: the latest mark and the latest start of each node, until a timer ends the run."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        node = T.StructType([T.StructField("ord", T.LongType()), T.StructField("mark", T.StringType()), T.StructField("start", T.LongType())])
        self.nodes = handle.getMapState("nodes", "node string", node)
        self.ends = handle.getValueState("ends", "at long")

    def _rows(self, run: str, expired: bool) -> pd.DataFrame:
        held = {key[0]: value for key, value in self.nodes.iterator()}
        statuses = []
        for node in fixed.BOARD_NODES:
            ord_, mark, _ = held.get(node, (None, "pending", None))
            rivals = [start for other, (_, _, start) in held.items() if other != node and not _parallel(other, node)]
            moved = mark == "running" and max(rivals, default=-1) > ord_
            statuses.append(_displaced(node) if moved else mark)
        return pd.DataFrame({"run_id": run, "node": fixed.BOARD_NODES, "status": statuses, "expired": expired})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        latest: dict[str, tuple] = {}
        last = self.ends.get()[0] if self.ends.exists() else None
        seen = 0
        for batch in rows:
            seen = max(seen, int(batch["at_ms"].max()))
            for node, ord_, mark, starts in batch[["node", "ord", "mark", "starts"]].itertuples(index=False):
                if node not in latest:
                    known = self.nodes.containsKey((node,))
                    latest[node] = tuple(self.nodes.getValue((node,))) if known else (-1, "", -1)
                held, old, start = latest[node]
                latest[node] = (*((ord_, mark) if (ord_, mark) > (held, old) else (held, old)), max(start, ord_) if starts else start)
        for node, (ord_, mark, start) in latest.items():
            self.nodes.updateValue((node,), (int(ord_), mark, int(start)))
        ends = seen + self.idle_ms
        if last is None or ends > last:
            if last is not None:
                self.handle.deleteTimer(last)
            self.handle.registerTimer(ends)
            self.ends.update((ends,))
        yield self._rows(key[0], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._rows(key[0], True)
        self.nodes.clear()
        self.ends.clear()

    def close(self) -> None:
        pass


def stream_boards(events: DataFrame, time_col: str, idle: str = "1 hour", late: str = "0 seconds") -> DataFrame:
    """(run_id, node, status, expired): ``stream_node_status`` with a state that ends.

    State is keyed by run: a few numbers per node. Once the watermark, which trails the newest event time by ``late``,
    has passed a run's last event by ``idle``, its board is reported once more as expired and leaves the state store.
    Events that come later start the run's board anew. Needs the RocksDB state store, as keyed timers do.
    """
    flat = node_marks(events.withWatermark(time_col, late), time_col).withColumn("at_ms", F.unix_millis(time_col))
    return flat.groupBy("run_id").transformWithStateInPandas(
        statefulProcessor=_Boards(_milliseconds(idle)),
        outputStructType="run_id string, node string, status string, expired boolean",
        outputMode="update",
        timeMode="eventTime",
    )


def _milliseconds(duration: str) -> int:
    return int(pd.Timedelta(duration) / pd.Timedelta("1ms"))


def stream_node_status(events: DataFrame) -> DataFrame:
    """The board of every run a micro-batch touches (update mode).

    The same aggregate as the batch form: state is one row of a few dozen numbers per run, merged in any
    order, with no Python worker and no per-run event list.
    """
    return node_status(events)


# ------------------------------------------------------------------ counters and dedup


def stream_counters(stages: DataFrame) -> DataFrame:
    """(run_id, metric, key, n): committed, dropped, routes, and coverage when a cell is present."""
    committed = (F.col("role") == "curate_committed_sample") & (F.col("route_code") == "accept")
    dropped = (F.col("verdict") == "reject") & (
        F.col("role").isin("audit_design", "curate_committed_sample") | F.startswith("route_code", F.lit("drop_"))
    )
    entry = lambda when, metric, key: F.when(
        F.coalesce(when, F.lit(False)), F.struct(F.lit(metric).alias("metric"), key.alias("key"))
    )
    entries = [
        entry(F.lit(True), "route", F.coalesce("route_code", F.lit("None"))),
        entry(committed, "committed", F.lit("")),
        entry(dropped, "dropped", F.lit("")),
    ]
    if "cell" in stages.columns:
        entries.append(entry(committed, "coverage", cell_key(F.col("cell"))))
    rows = stages.select("run_id", F.explode(F.array_compact(F.array(*entries))).alias("e"))
    return rows.groupBy("run_id", F.col("e.metric").alias("metric"), F.col("e.key").alias("key")).agg(F.count("*").alias("n"))


def stream_dedup(designs: DataFrame, time_col: str = "ts", watermark: str = "1 hour") -> DataFrame:
    """First design per content hash. The watermark bounds the remembered hashes; later rows are dropped."""
    return designs.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(["content_hash"])


# ------------------------------------------------------------------ curation


def _pivots(rows: DataFrame, root: str, domain_id: str) -> np.ndarray:
    """The pivots of a domain's index: chosen from the first batch that has vectors, then for good, so that groups stay."""
    spark = rows.sparkSession
    kept = artifacts.index_pivots(spark, root, domain_id)
    if kept is None:
        live = rows.where(norm(F.col("vector")) > 0)
        chosen, _ = choose_pivots(live, vector_width(live))
        if not len(chosen):
            return chosen
        artifacts.write_index_pivots(spark, chosen.tolist(), root, domain_id)
        kept = chosen.tolist()
    return np.array(kept)


def curate_batch(batch: DataFrame, batch_id: int, root: str, domain_id: str, threshold: float) -> None:
    """Curate one micro-batch against everything earlier batches accepted.

    The stored index is partitioned by the nearest pivot of a vector. A batch reads the partitions its vectors reach
    within the threshold, which decide, and for the distances of what it accepts those that could hold something nearer
    than the nearest found. The rest is pruned before it is opened, and results are those of the whole index.

    Every write of a batch lands in folders named after its id and replaces them, and the index and
    ledger it reads are those of earlier batches, so replaying a batch changes nothing. Pivots that a batch
    chose before it failed are kept.
    """
    spark = batch.sparkSession
    kinds = {"id": "string", "ord": "bigint", "vector": "array<double>"}
    rows = checkpointed(batch.select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()]))
    pivots = _pivots(rows, f"{root}/pivots", domain_id)
    # vectors stored outside any batch ("open") count for every batch
    index = artifacts.read_index(spark, f"{root}/index", domain_id).where(F.coalesce(F.expr("try_cast(batch AS bigint)") < batch_id, F.lit(True)))
    group = lambda numbers: index.where(F.col("pivot").isin(numbers)).select("embedding_ref", "candidate_id", "vector")
    near = [-1, *reached_pivots(rows.withColumn("within", F.lit(math.acos(1.0 - threshold))), pivots)]
    curated = checkpointed(curate(rows, group(near), threshold))
    taken = curated.where(F.col("verdict") == "accept").select("id", "ord", "vector", "nn_distance")
    reach = F.coalesce(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 1.0 - F.col("nn_distance")))), F.lit(math.pi))
    more = sorted(set(reached_pivots(taken.withColumn("within", reach), pivots)) - set(near))
    if more:
        members = group(more).select(F.concat(F.lit("stored:"), "candidate_id").alias("id"), F.lit(-1).cast("bigint").alias("ord"), "vector")
        other = nearest_distance(taken, members).select("id", F.col("nn_distance").alias("other"))
        least = F.least("nn_distance", "other").alias("nn_distance")
        columns = [least if c == "nn_distance" else c for c in curated.columns]
        curated = checkpointed(curated.join(other, "id", "left").select(*columns))
    fresh = index_rows(curated, f"batch-{batch_id}").withColumn("pivot", nearest_pivot(F.col("vector"), pivots))
    artifacts.append_index(fresh, f"{root}/index", domain_id, batch=str(batch_id))
    verdicts = curated.drop("vector")
    verdicts.write.mode("overwrite").parquet(f"{root}/verdicts/batch={batch_id}")
    commits = batch.join(curated.where(F.col("verdict") == "accept").select("id"), "id", "left_semi").select("cell")
    snapshot = artifacts.coverage_snapshot(spark, f"{root}/coverage", domain_id, before=batch_id)
    artifacts.write_coverage(merge_coverage(snapshot, commits), f"{root}/coverage", domain_id, version=batch_id)


def stream_curate(cands: DataFrame, root: str, domain_id: str, threshold: float = fixed.NOVELTY_THRESHOLD):
    """A stream writer that curates each micro-batch of (id, ord, vector, cell); the caller sets trigger
    and checkpoint location and starts it."""
    return cands.writeStream.foreachBatch(lambda df, n: curate_batch(df, n, root, domain_id, threshold))
