"""Registered queries over logs that are written, grow and are followed."""

import os
import threading
import uuid

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from casemill.plans import adapters as A
from casemill.plans.sql import STAGES
from casemill.session import ensure_checkpoint_dir
from casemill.sources import artifacts
from casemill.sources.lines import file_system
from casemill.streaming import streams

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


def _place(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def _drain(stream, base, mode="append"):
    """Run a stream over everything that is there now; rows are written with the batch that brought them."""

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{base}/state")
    writer.foreachBatch(write).start().awaitTermination()


def _grown(lines, root, kind, upto=None):
    """Write (ord, line) as log files, one per task: the lines up to ``upto`` and half of the next, or all of them.

    Written again with more lines, a file holds what it held and goes on: it has grown.
    """

    def write(batches):
        system, inside = file_system(f"{root}/run-{TaskContext.get().partitionId()}/{kind}.jsonl")
        system.create_dir(os.path.dirname(inside))
        n = 0
        with system.open_output_stream(inside) as out:
            torn = False
            for batch in batches:
                for ord_, line in zip(batch["ord"], batch["line"]):
                    data = line.encode() + b"\n"
                    if upto is None or ord_ <= upto:
                        out.write(data)
                        n += 1
                    elif not torn:
                        out.write(data[: len(data) // 2])
                        torn = True
        yield pd.DataFrame({"n": [n]})

    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lines.select("ord", "line").repartition(parts, "ord").sortWithinPartitions("ord")
    return dealt.mapInPandas(write, "n long").agg(F.sum("n")).first()[0]


# ------------------------------------------------------------------ following logs


@query(
    "tailed_records",
    f"""WITH {STAGES}, c AS (SELECT (min(ord) + max(ord)) // 2 AS cut FROM stages)
    SELECT artifact_id, run_id, role, verdict, latency_ms, error, CAST(ord > cut AS INTEGER) AS batch FROM stages, c""",
)
def tailed_records(spark, sf):
    """A log followed while it grows: half of its lines, the last one torn, are drained first, what was added afterwards."""
    records = A.stage_records(spark, sf)
    ends = records.agg(F.min("ord").alias("low"), F.max("ord").alias("high")).first()
    lines = records.select("ord", F.to_json(F.struct(*[c for c in records.columns if c != "ord"])).alias("line"))
    root, base = _place(spark, "log"), _place(spark, "tail")
    for upto in ((ends["low"] + ends["high"]) // 2 if ends["low"] is not None else None, None):
        _grown(lines, root, "stage_records", upto)
        _drain(streams.stream_artifact(spark, root, "stage_records"), base)
    out = spark.read.parquet(f"{base}/out")
    return out.select("artifact_id", "run_id", "role", "verdict", "latency_ms", "error", F.col("batch").cast("int").alias("batch"))


@query(
    "lenient_events",
    "SELECT event_id, event_type, true AS numbered_in_order FROM events WHERE event_id % 7 <> 0",
)
def lenient_events(spark, sf):
    """A log with broken lines, read in small splits: numbers rise with the order in which lines were written."""
    e = A.table(spark, sf, "events")
    body = F.to_json(F.struct("event_id", "event_type"))
    lines = e.select(F.col("event_id").alias("ord"), F.when(F.col("event_id") % 7 != 0, body).otherwise(F.concat(F.lit("{oops "), body)).alias("line"))
    root = _place(spark, "log")
    _grown(lines, root, "events")
    read = artifacts.read_events_lenient(spark, root, split=2**14)
    get = lambda key, kind: F.variant_get("event", f"$.{key}", kind)
    rows = read.select("file", "line_no", get("event_id", "long").alias("event_id"), get("event_type", "string").alias("event_type"))
    # the writer dealt events to files by hash and sorted them, broken ones too: their numbers follow from the table
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.pmod(F.hash("event_id"), F.lit(parts))
    wanted = e.select(F.col("event_id").alias("id"), F.row_number().over(Window.partitionBy(place).orderBy("event_id")).alias("want"))
    checked = rows.join(wanted, F.col("event_id") == F.col("id"))
    return checked.select("event_id", "event_type", (F.col("line_no") == F.col("want")).alias("numbered_in_order"))


_ENDED = """e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
  m AS (SELECT 'run-' || user_id AS run_id, event_id AS ord, epoch_ms(ts) AS ms, event_type IN ('view', 'signup') AS starts,
    CASE k % 6 WHEN 0 THEN 'generate' WHEN 1 THEN 'validate_det' WHEN 2 THEN 'quality_gate' WHEN 3 THEN 'rubric_gate' WHEN 4 THEN 'adversary' ELSE 'curate' END AS node,
    CASE WHEN event_type IN ('view', 'signup') THEN 'running' WHEN k % 4 = 0 THEN 'reject' WHEN k % 5 = 0 THEN 'local' ELSE 'accept' END AS mark FROM e),
  cut AS (SELECT (min(event_id) + max(event_id)) // 2 AS cut FROM events),
  early AS (SELECT m.* FROM m, cut WHERE ord <= cut),
  gone AS (SELECT run_id FROM early GROUP BY run_id HAVING max(ms) + 43200000 < (SELECT max(ms) FROM early)),
  later AS (SELECT m.* FROM m, cut WHERE ord > cut OR run_id NOT IN (SELECT run_id FROM gone)),
  over AS (SELECT run_id FROM later GROUP BY run_id HAVING max(ms) + 43200000 < (SELECT max(ms) FROM m)),
  b AS (SELECT 0 AS drain, early.* FROM early JOIN gone USING (run_id) UNION ALL SELECT 1, later.* FROM later JOIN over USING (run_id)),
  runs AS (SELECT DISTINCT drain, run_id FROM b),
  nodes(node) AS (VALUES ('design'), ('validate_design_batch_det'), ('select_next_design'), ('audit_design'), ('generate'), ('validate_det'), ('adversary'),
    ('revise_from_adversary'), ('quality_gate'), ('rubric_gate'), ('join_gates'), ('curate')),
  last AS (SELECT drain, run_id, node, max(ord) AS ord, arg_max(mark, ord) AS mark FROM b GROUP BY ALL)
  SELECT r.drain, r.run_id, n.node, CASE WHEN l.mark IS NULL THEN 'pending' WHEN l.mark = 'running' AND EXISTS (SELECT 1 FROM b m
      WHERE m.drain = r.drain AND m.run_id = r.run_id AND m.starts AND m.ord > l.ord AND m.node <> n.node
        AND NOT (m.node IN ('quality_gate', 'rubric_gate') AND n.node IN ('quality_gate', 'rubric_gate')))
    THEN CASE WHEN n.node IN ('validate_design_batch_det', 'validate_det', 'curate') THEN 'local' ELSE 'pending' END ELSE l.mark END AS status,
    CAST(1 AS BIGINT) AS times
  FROM runs r CROSS JOIN nodes n LEFT JOIN last l ON l.drain = r.drain AND l.run_id = r.run_id AND l.node = n.node"""


@query("expired_boards", f"WITH {_ENDED}")
def expired_boards(spark, sf):
    """Boards of runs that ended, reported once each: half of the events is drained first, the rest afterwards.

    A run that ended in between starts anew with its later events.
    """
    e = A.table(spark, sf, "events")
    ends = e.agg(F.min("event_id").alias("low"), F.max("event_id").alias("high")).first()
    cut = ((ends["low"] or 0) + (ends["high"] or 0)) // 2
    source, base, last = _place(spark, "events"), _place(spark, "boards"), -1
    settings = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
    before = {name: spark.conf.get(name, None) for name in settings}
    out = None
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        for drain, half in enumerate((e.where(F.col("event_id") <= cut), e.where(F.col("event_id") > cut))):
            half.repartition(1).write.mode("append").parquet(source)
            stream = spark.readStream.schema(e.schema).parquet(source)
            _drain(streams.stream_boards(A.board_events_from(stream, F.col("ts").cast("timestamp").alias("ts")), "ts", "12 hours"), base, "update")
            boards = spark.read.parquet(f"{base}/out").where(F.col("expired") & (F.col("batch") > last))
            seen = spark.read.parquet(f"{base}/out").agg(F.max("batch")).first()[0]
            part = boards.withColumn("drain", F.lit(drain)).where(F.col("batch") <= seen)
            out, last = part if out is None else out.unionByName(part), seen
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return out.groupBy("drain", "run_id", "node", "status").agg(F.count("*").alias("times"))


# ------------------------------------------------------------------ guarded writes


@query(
    "guarded_runs",
    f"""WITH {STAGES} SELECT run_id, count(*) AS rows, CAST(sum(latency_ms) AS BIGINT) AS latency_ms, CAST(1 AS BIGINT) AS writers, CAST(1 AS BIGINT) AS refused
    FROM stages GROUP BY run_id""",
)
def guarded_runs(spark, sf):
    """Every run written by two racing writers, then replayed by the winner: one write is kept, whole."""
    records = A.stage_records(spark, sf).select("run_id", "artifact_id", "latency_ms")
    path, refused = _place(spark, "runs"), []

    def write(run, writer):
        rows = records.where(F.col("run_id") == run).withColumn("writer", F.lit(writer))
        try:
            artifacts.write_run(rows, path, run, token=f"{run}-{writer}")
            artifacts.write_run(rows.limit(0), path, run, token=f"{run}-{writer}")  # a replay changes nothing
        except artifacts.RunExists:
            refused.append(run)

    for run in [r["run_id"] for r in records.select("run_id").distinct().collect()]:
        pair = [threading.Thread(target=write, args=(run, n)) for n in (1, 2)]
        for thread in pair:
            thread.start()
        for thread in pair:
            thread.join()
    lost = spark.createDataFrame([(r,) for r in refused], "run_id string").groupBy("run_id").agg(F.count("*").alias("refused"))
    rows = artifacts.read_run(spark, path, schema="artifact_id string, latency_ms long, writer int")
    kept = rows.groupBy("run_id").agg(F.count("*").alias("rows"), F.sum("latency_ms").alias("latency_ms"), F.countDistinct("writer").alias("writers"))
    return kept.join(lost, "run_id").select("run_id", "rows", "latency_ms", "writers", "refused")
