"""Session set-up and the folder shared by all executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "tickloom", memory: str = "16g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    n = "8" if cores == "*" else str(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", n)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in a local session where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^-]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        app = spark.sparkContext.applicationId
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="tickloom-")
        folder = _local_dirs[app]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and cut its lineage; survives executor loss."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: later passes read only the columns they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
