"""Session settings and the shared working folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on at scale: runtime re-planning, hot-key splitting in joins and in
# rebalanced writes, broadcast of sides measured below 64 MB, and Arrow batches bounded by bytes so
# image payloads cannot fill a worker.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app: str = "sightline", cores: str = "*", partitions: int = 8, memory: str = "8g", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in {**SCALE_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder that every executor can reach.

    It lies under the folder named by ``spark.checkpoint.dir``. Only a local session, where all
    tasks share one machine, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="sightline-")
    return f"{base.rstrip('/')}/sightline/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table once in the shared folder and read it back.

    Results that several steps use are computed once and survive lost executors, and the planner
    knows the size of what was written: a small lookup is then broadcast, a large one is not.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that `materialize` wrote and nothing reads any more.

    The driver's garbage is collected too, as Spark removes the shuffle files of finished queries only then.
    """
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()


def spread(table: DataFrame) -> DataFrame:
    """Rows of a stored table over all task slots, for hooks that cost far more than moving a row.

    A scan of at least as many tasks as there are slots is left as it is.
    """
    slots = table.sparkSession.sparkContext.defaultParallelism
    return table if table.rdd.getNumPartitions() >= slots else table.repartition(slots)
