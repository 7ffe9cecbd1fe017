"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings that hold for a laptop and for a large cluster alike. AQE sizes the
# shuffle partitions down from a generous initial number, so the number itself need not
# follow the data; the advisory size keeps every reduce task inside executor memory.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python call site of every column expression doubles the planning time.
    "spark.sql.dataFrameQueryContext.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def cluster_conf(total_cores: int) -> dict[str, str]:
    """Settings for spark-submit on a cluster with that many executor cores.

    Three shuffle partitions for each core to begin with: grouping by a unique key leaves the
    whole table to shuffle, and AQE can join small partitions but cannot split such ones.
    """
    return {**RECOMMENDED_CONF, "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores))}


def local_session(
    cores: int | str = "*", app: str = "wattlake", memory: str = "8g", **conf: str
) -> SparkSession:
    """A session for tests and the bench; on a cluster spark-submit brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for tables and stream checkpoints.

    It lies under the shared ``spark.checkpoint.dir`` of the cluster, where every executor
    can read what a lost one has written. Only a local session without that setting gets a
    folder of its own machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/wattlake/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"wattlake-{purpose}-")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each job inside go when the job ends, not with the driver's garbage.

    For jobs that write or collect their result: nothing reads their shuffles again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def bound_arrow_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Lower the rows of an Arrow batch: a task holds a batch of whole texts several times, in the
    executor's JVM and in its Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
