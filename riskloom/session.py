"""Session set-up and the shared folder for tables written between two steps of one job."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
#: Paths written inside each open ``intermediates`` block, the innermost last.
_open_blocks: list[list[str]] = []


def build_session(app_name: str = "riskloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators expect; the cluster's own settings win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Feature frames have hundreds of columns; stages stay compiled up to this width.
        "spark.sql.codegen.maxFields": "2000",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a local session may do without one."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app_id = spark.sparkContext.applicationId
    if app_id not in _local_roots:
        _local_roots[app_id] = tempfile.mkdtemp(prefix="riskloom-")
        atexit.register(shutil.rmtree, _local_roots[app_id], ignore_errors=True)
    return _local_roots[app_id]


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage and fixes partition-dependent values (slice numbers, row sequence), so
    that two later branches of a plan, or a task re-run after a lost executor, see the same rows.
    """
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), "riskloom", uuid.uuid4().hex)
    if _open_blocks:
        _open_blocks[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Remove a table that ``written`` has returned, once no other frame will read it."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)).getParent()
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, the tables that operators wrote to the shared folder inside it.

    Frames made in the block read those tables, so write the result before the block ends. Tables are
    removed through the file system Spark writes them with, also when the block fails, and tables written
    before the block stay. Blocks may be nested; threads of one driver share the innermost block.
    """
    paths: list[str] = []
    _open_blocks.append(paths)
    try:
        yield
    finally:
        _open_blocks[:] = [b for b in _open_blocks if b is not paths]
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def slice_count(spark: SparkSession) -> int:
    """Number of range slices for a global order: the session's shuffle width."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
