"""Session construction and the shared scratch folder."""

from __future__ import annotations

import atexit
import gc
import re
import shutil
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# Partition number of monotonically_increasing_id: its bits from this one up (Spark API).
PARTITION_SHIFT = 33
#: Folders made inside `scratch_scope`, to be deleted at its end.
_scopes: list[list[str]] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and benchmarks; on a cluster use the session spark-submit provides.

    Unless `conf` names one, it gets a scratch folder that is deleted when Python ends.
    """
    if CHECKPOINT_CONF not in conf:
        conf[CHECKPOINT_CONF] = tempfile.mkdtemp(prefix="opinara-")
        atexit.register(shutil.rmtree, conf[CHECKPOINT_CONF], ignore_errors=True)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("opinara")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder named by `spark.checkpoint.dir`.

    Only a local-mode session may fall back to a temporary folder of this machine: there the
    driver and the tasks share one file system. The folder is remembered in the session.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="opinara-")
        spark.conf.set(CHECKPOINT_CONF, root)
    path = f"{root.rstrip('/')}/opinara/{name}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediates written inside when the result has been written."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder as Parquet and return a scan of it.

    This runs a job. It cuts the lineage, so a lost executor costs a re-read of one file
    instead of a replay of everything upstream.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of frames that are gone.

    It does so when the driver collects its garbage, which may be long after. A frame that Python
    lets go in the first round is found in the second.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)
