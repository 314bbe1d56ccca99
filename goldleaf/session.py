"""Session helpers: a local session for tests and benchmarks, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cpus: int | str = 8, app_name: str = "goldleaf") -> SparkSession:
    """A single-JVM session. On a cluster the caller brings its own session instead."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
    if not SparkConf().contains(CHECKPOINT_SETTING):
        # one machine: its own temporary folder is shared by all its tasks
        builder = builder.config(CHECKPOINT_SETTING, tempfile.mkdtemp(prefix="goldleaf-"))
    return (
        builder.config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # small local inputs: let eight threads share what a cluster would call one partition
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        # keep the generated code of a whole refresh, instead of compiling it for each run
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    On a cluster the setting is required: a machine-local folder would be lost with its machine. A
    single-JVM session without it gets one temporary folder for as long as the process lives.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="goldleaf-")
    return _local_folders[context.applicationId]


def importable_in_tasks(spark: SparkSession, root: str) -> None:
    """Let Python workers find the packages below ``root``, wherever the driver was started.

    For sessions on one machine, or clusters where the path is the same on all; elsewhere ship the
    package with the job.
    """
    environment = spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def run_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/goldleaf/{label}-{uuid.uuid4().hex}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Let iterative jobs cut their lineage in the shared folder, unless that is set up already."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
