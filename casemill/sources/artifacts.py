"""Artifact logs: JSON-lines folders per run, read with fixed schemas and appended by kind."""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill import schemas
from casemill.functions.scalars import field, is_json_object, is_json_string
from casemill.sources import lines


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything on the file system the path names."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def artifact_path(root: str, kind: str, run_id: str | None = None) -> str:
    """Where one kind of log lives: a file or a folder of part files, by run."""
    return f"{root}/{run_id if run_id is not None else '*'}/{kind}.jsonl"


def _with_schema(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _tagged(spark: SparkSession, root: str, kind: str, run_id: str | None, schema: T.StructType) -> DataFrame:
    """Rows of one kind of log with the run they were found under as ``_run_id``, from both places a log may be in.

    ``<root>/<run>/<kind>.jsonl`` is what other tools write, ``<root>/<kind>/run_id=<run>/`` what ``append_artifact``
    grows. Blank lines are skipped and a malformed line fails the read.
    """
    rows = _with_schema(spark, T.StructType([*schema.fields, T.StructField("_run_id", T.StringType())]))
    path = artifact_path(root, kind, run_id)
    if path_exists(spark, path):
        folder = F.regexp_extract(F.col("_metadata.file_path"), rf"([^/]+)/{kind}\.jsonl(?:/[^/]+)?$", 1)
        found = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
        rows = rows.unionByName(found.select("*", folder.alias("_run_id")))
    appended = read_appended(spark, root, kind, schema)
    if run_id is not None:
        appended = appended.where(F.col("run_id") == run_id)
    return rows.unionByName(appended.select(*schema.names, F.col("run_id").alias("_run_id")))


def read_artifact(
    spark: SparkSession, root: str, kind: str, run_id: str | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """One kind of run log, wherever it was written. A missing path is an empty table."""
    return _tagged(spark, root, kind, run_id, schema or schemas.ARTIFACTS[kind]).drop("_run_id")


def scan_runs(
    spark: SparkSession, logs_root: str, run_id: str | None = None, all_runs: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(stage records, stage events) of the selected runs, each row tagged with its folder's ``_run_id``.

    A run without a stage log contributes nothing, not even its events. Without a run id and without
    ``all_runs`` no run is selected.
    """
    records, events = (_tagged(spark, logs_root, kind, run_id, schemas.ARTIFACTS[kind]) for kind in ("stage_records", "stage_events"))
    if run_id is None and not all_runs:
        return records.limit(0), events.limit(0)
    # run ids with a stage log: one narrow aggregated row per run
    return records, events.join(records.select("_run_id").distinct(), "_run_id", "left_semi").select(
        *schemas.STAGE_EVENTS.names, "_run_id"
    )


def read_events_lenient(spark: SparkSession, path: str, split: int = lines.SPLIT) -> DataFrame:
    """(file, line_no, event): every line that is a JSON value, with its 1-based line number.

    Lines that are not JSON are dropped but count. Files are read in splits by byte ranges; every split brings the number
    of its first line from one count of the lines of the splits before, so no file has to fit a row or a task and no
    line is joined, sorted or shuffled.
    """
    numbered = lines.read_lines(spark, path, split, lines.line_numbers(spark, path, split))
    parsed = numbered.select("file", F.col("line_no").cast("int").alias("line_no"), F.try_parse_json("raw").alias("event"))
    return parsed.where(F.col("event").isNotNull())


def _trial_number(path: Column) -> Column:
    return F.regexp_extract(path, r"/trial_(\d+)/", 1).cast("int")


def read_trials(spark: SparkSession, run_dir: str) -> DataFrame:
    """Trials of an experiment run: summary, mapped grade and agent result joined per ``trial_N``."""

    def doc(name: str, alias: str) -> DataFrame:
        path = f"{run_dir}/trials/trial_*/{name}"
        if not path_exists(spark, path):
            return spark.createDataFrame([], "trial int, raw string").select(
                "trial", F.try_parse_json("raw").alias(alias)
            )
        raw = spark.read.text(path, wholetext=True)
        return raw.select(
            _trial_number(F.col("_metadata.file_path")).alias("trial"), F.parse_json("value").alias(alias)
        )

    joined = (
        doc("summary.json", "summary")
        .join(doc("grader/mapped_output.json", "mapped"), "trial")
        .join(doc("agent/result.json", "result"), "trial")
    )
    response = field(F.col("result"), "$.response")
    body = (
        F.when(is_json_string(response), F.try_variant_get(F.col("result"), "$.response", "string"))
        .when(is_json_object(response), response.cast("string"))
        .otherwise(F.col("result").cast("string"))
    )
    rate = F.variant_get("mapped", "$.payload.pass_rate", "string")
    return joined.select(
        "trial",
        F.variant_get("summary", "$.ids.task_id", "string").alias("case_id"),
        F.variant_get("summary", "$.ids.variant_id", "string").alias("variant"),
        F.variant_get("summary", "$.agent.exit_status", "string").alias("exit_status"),
        F.coalesce(rate.try_cast("double") != 0, rate.try_cast("boolean"), F.lit(False)).alias("passed"),
        F.variant_get("mapped", "$.payload.score", "double").alias("score"),
        body.alias("response"),
        F.try_variant_get("result", "$.error.message", "string").alias("error"),
    )


# ------------------------------------------------------------------------------- sinks


def append_artifact(df: DataFrame, root: str, kind: str) -> None:
    """Append rows of one kind of log, foldered by run.

    Rows go to ``<root>/<kind>/run_id=<run>/``, where ``read_artifact`` and ``scan_runs`` find them; a reader
    prunes by run and concurrent writers add files without touching each other's.
    """
    schema = schemas.ARTIFACTS[kind]
    cols = [F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    rows = df.select(*cols) if "run_id" in schema.names else df.select(
        *cols, F.col("run_id") if "run_id" in df.columns else F.lit("none").alias("run_id")
    )
    rows.write.mode("append").partitionBy("run_id").json(f"{root}/{kind}")


def read_appended(spark: SparkSession, root: str, kind: str, schema: T.StructType | None = None) -> DataFrame:
    """The table ``append_artifact`` grows, always with its ``run_id``; empty when nothing was written yet."""
    schema = schema or schemas.ARTIFACTS[kind]
    if "run_id" not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])
    if not path_exists(spark, f"{root}/{kind}/run_id=*"):
        return _with_schema(spark, schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(f"{root}/{kind}").select(*schema.names)


class RunExists(ValueError):
    """The run already has artifacts and overwriting was not asked for, or another writer was first."""


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file appear whole under a name nobody has, or tell that somebody has it."""
    system, target = _hadoop(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_draft-{uuid.uuid4().hex}")
    out = system.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if system.getUri().getScheme() == "file":  # a rename replaces there; a link does not
            os.link(draft.toUri().getPath(), target.toUri().getPath())
            return True
        plain = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        plain[0] = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename").NONE
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
        context.rename(draft, target, plain)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    finally:
        system.delete(draft, False)


def manifests(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """(run_id, version, folder, token): every published write of the runs below ``path``."""
    spec = f"{path}/_manifests/run_id={'*' if run_id is None else run_id}/version=*.json"
    schema = "run_id string, version int, folder string, token string"
    return spark.read.schema(schema).json(spec) if path_exists(spark, spec) else spark.createDataFrame([], schema)


def write_run(df: DataFrame, path: str, run_id: str, overwrite: bool = False, token: str | None = None) -> None:
    """Write one run's rows, all or nothing. An existing run is refused, or with ``overwrite`` replaced alone.

    The rows are written under a name of their own. Publishing is one manifest file, numbered by version, that must
    not exist: of writers that race for a run exactly one publishes, the others get RunExists and leave nothing. A write
    repeated with the ``token`` of a published one changes nothing. ``read_run`` takes what manifests name, so it
    never sees a part of a write. What a version replaced stays for its readers until ``drop_superseded``.
    """
    spark = df.sparkSession
    token = token or uuid.uuid4().hex
    known = manifests(spark, path, run_id).collect()
    if any(m["token"] == token for m in known):
        return
    if known and not overwrite:
        raise RunExists(f"run id already has artifacts: {run_id}")
    version, folder = 1 + max((m["version"] for m in known), default=0), f"run_id={run_id}/write={uuid.uuid4().hex}"
    df.drop("run_id").write.parquet(f"{path}/{folder}")
    text = json.dumps({"run_id": run_id, "version": version, "folder": folder, "token": token}) + "\n"
    system, place = _hadoop(spark, f"{path}/_manifests/run_id={run_id}")
    system.mkdirs(place)
    if not _publish(spark, f"{path}/_manifests/run_id={run_id}/version={version:08d}.json", text):
        system.delete(_hadoop(spark, f"{path}/{folder}")[1], True)
        raise RunExists(f"another writer published run id first: {run_id}")


def read_run(spark: SparkSession, path: str, run_id: str | None = None, schema: T.StructType | str | None = None) -> DataFrame:
    """Published rows of one run or of all, each run's newest version, with its ``run_id``. No run: an empty table of ``schema``."""
    newest = manifests(spark, path, run_id).groupBy("run_id").agg(F.max_by("folder", "version").alias("folder")).collect()
    if not newest:
        return spark.createDataFrame([], schema or "run_id string").withColumn("run_id", F.lit(None).cast("string"))
    reader = spark.read if schema is None else spark.read.schema(schema)
    found = reader.option("basePath", path).parquet(*[f"{path}/{m['folder']}" for m in newest])
    return found.drop("write").withColumn("run_id", F.col("run_id").cast("string"))


def drop_superseded(spark: SparkSession, path: str) -> int:
    """Delete the folders of writes that a newer version replaced; returns how many there were."""
    old = manifests(spark, path).withColumn("newest", F.max("version").over(Window.partitionBy("run_id"))).where("version < newest").collect()
    gone = 0
    for row in old:
        system, folder = _hadoop(spark, f"{path}/{row['folder']}")
        gone += bool(system.exists(folder) and system.delete(folder, True))
    return gone


def append_index(df: DataFrame, root: str, domain_id: str, batch: str | None = None) -> None:
    """Append accepted vectors (embedding_ref, candidate_id, vector) to a domain's index.

    With a ``batch`` name the write replaces that batch's own folder, so repeating a batch after a
    lost task or a restarted stream cannot add its vectors twice. Rows are partitioned by ``pivot``, the
    group of a vector; -1, also where the column is missing, is no group and must always be read.
    """
    pivot = F.col("pivot") if "pivot" in df.columns else F.lit(-1)
    rows = df.select("embedding_ref", "candidate_id", F.col("vector").cast("array<double>").alias("vector"), pivot.cast("int").alias("pivot"))
    base = f"{root}/domain_id={domain_id}"
    if batch is None:
        rows.write.mode("append").partitionBy("pivot").parquet(f"{base}/batch=open")
    else:
        rows.write.mode("overwrite").partitionBy("pivot").parquet(f"{base}/batch={batch}")


def read_index(spark: SparkSession, root: str, domain_id: str) -> DataFrame:
    path = f"{root}/domain_id={domain_id}"
    schema = "embedding_ref string, candidate_id string, vector array<double>, batch string, pivot int"
    if not path_exists(spark, f"{path}/batch=*/pivot=*"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def index_pivots(spark: SparkSession, root: str, domain_id: str) -> list[list[float]] | None:
    """The vectors that group a domain's index, of which there is a bounded number; None before they are chosen."""
    path = f"{root}/domain_id={domain_id}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return None
    rows = spark.read.schema("pivot int, vector array<double>").parquet(path).orderBy("pivot").collect()
    return [r["vector"] for r in rows]


def write_index_pivots(spark: SparkSession, pivots: list[list[float]], root: str, domain_id: str) -> None:
    rows = spark.createDataFrame(list(enumerate(pivots)), "pivot int, vector array<double>")
    rows.write.mode("overwrite").parquet(f"{root}/domain_id={domain_id}")


def coverage_snapshot(spark: SparkSession, root: str, domain_id: str, before: int | None = None) -> DataFrame:
    """(cell_key, n) of a domain's newest ledger version (older than ``before``); empty when none exists."""
    versions = f"{root}/domain_id={domain_id}/version=*"
    if not path_exists(spark, versions):
        return spark.createDataFrame([], "cell_key string, n bigint")
    table = spark.read.schema("cell_key string, n bigint, version bigint").parquet(f"{root}/domain_id={domain_id}")
    if before is not None:
        table = table.where(F.col("version") < before)
    newest = table.agg(F.max("version")).first()[0]
    if newest is None:
        return spark.createDataFrame([], "cell_key string, n bigint")
    return table.where(F.col("version") == newest).select("cell_key", "n")


def write_coverage(counts: DataFrame, root: str, domain_id: str, version: int) -> None:
    """Write a new version of the ledger beside the old one, so it never reads what it overwrites."""
    counts.select("cell_key", "n").write.mode("overwrite").parquet(
        f"{root}/domain_id={domain_id}/version={version}"
    )
