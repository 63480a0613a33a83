"""Session helpers: the settings every job relies on, and the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators depend on. Time zone pinned to UTC (timestamps are
# naive wall-clock values); AQE on for runtime re-planning and skew splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # no Python stack trace per column expression: plans here have thousands
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # wide projections beyond what HotSpot compiles run as split functions instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Local runs only: the driver is the executor, so it gets the memory.
LOCAL_CONF = {"spark.driver.memory": "8g"}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName("stratus")
    conf = dict(BASE_CONF)
    if master.startswith("local"):
        conf.update(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session. Where nothing is configured, a local session (tests)
    gets a private folder; any other session must name one, as executors on
    other machines do not see this machine's folders.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="stratus-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/stratus/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def set_within(spark: SparkSession, name: str, value: str):
    """A setting of the session that holds for what is run inside."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def split_methods(spark: SparkSession):
    """Plans run inside have their wide projections as functions that HotSpot
    compiles, also in a session that was not made by :func:`get_session`."""
    name = "spark.sql.codegen.hugeMethodLimit"
    return set_within(spark, name, BASE_CONF[name])


def drop_shuffles(spark: SparkSession):
    """What is written inside leaves no shuffle files: Spark drops them when the
    write ends, not when the driver happens to collect its garbage."""
    return set_within(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def cut_lineage(df, name: str = "stage"):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    continue from the written table.

    Used after wide, expression-heavy stages (validation): later joins plan
    against a plain scan, and a lost executor does not recompute the stage.
    (A written table rather than ``checkpoint()``, which would carry over
    and recompute the constraints of the large projections.) Its shuffles go, as
    nothing reads them once the table stands.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    with split_methods(spark), drop_shuffles(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
