"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_scratch: dict[str, str] = {}


# Settings of every session.
COMMON = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # no stack capture per expression
}
# On a cluster: start with many shuffle partitions and let adaptive execution merge them to a size that
# fits a task's memory, read large splits, and split a skewed join even where that costs a shuffle.
CLUSTER = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(app: str = "riskmart", cores: int | str | None = "*", shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A local session on ``cores`` threads, or with ``cores=None`` one on the cluster of spark-submit.

    Further settings are given with ``__`` for the dots: ``spark__driver__memory="8g"``.
    """
    settings = dict(COMMON)
    builder = SparkSession.builder.appName(app)
    if cores is None:
        settings |= CLUSTER
    else:
        builder = builder.master(f"local[{cores}]")
        settings["spark.ui.enabled"] = "false"
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings |= {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a temporary folder, with a warning, that goes when Python
    ends. On a cluster the driver's disk is not the executors' disk, so a missing setting is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    app_id = spark.sparkContext.applicationId
    if base:
        return f"{base.rstrip('/')}/riskmart-{app_id}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if app_id not in _local_scratch:
        _local_scratch[app_id] = tempfile.mkdtemp(prefix="run-")
        warnings.warn(f"spark.checkpoint.dir is not set; intermediate tables go to {_local_scratch[app_id]}", stacklevel=2)
        atexit.register(shutil.rmtree, _local_scratch[app_id], ignore_errors=True)
    return f"{_local_scratch[app_id]}/riskmart-{app_id}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared scratch area and read it back.

    The written files fix the rows, so later jobs over the result agree with each other and survive
    the loss of executors; the plan starts again at a column-pruned parquet scan.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all that the application staged. Results built on staged tables must have been written or read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """A join side that is broadcast only after its rows were counted; a larger one is left to the optimizer.

    The side is written first, so it is computed once for the count and the join.
    """
    side = stage(df, "side")
    return F.broadcast(side) if side.count() <= max_rows else side
