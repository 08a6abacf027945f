"""Session helpers: a tuned local session for tests, and shared-folder checkpoints."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, partitions: int = 8, name: str = "casemill") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CASEMILL_DRIVER_MEMORY", "12g"))
        .config("spark.casemill.spread", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder iterative jobs cut their lineage into.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that setting always wins.
    Only a local master may fall back to a temporary folder, because there every task runs on
    the same machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="casemill-checkpoint-")
    sc.setCheckpointDir(named)
    return named


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder so lost executors cost one read, not a replay."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, per_core: int = 1) -> DataFrame:
    """Deal an input whose rows cost far more than their bytes into as many partitions as ``spark.casemill.spread`` says.

    Unset, an input that is read in fewer tasks than ``per_core`` times the cores is dealt into that many, since a file
    of a few MB may hold a million rows; inputs of more splits need no shuffle.
    """
    spark = df.sparkSession
    parts = spark.conf.get("spark.casemill.spread", None)
    if parts:
        return df.repartition(int(parts))
    wanted = per_core * spark.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df
