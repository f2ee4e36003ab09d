"""File streams through the batch operators.

Every job reads new files of a folder, keeps its progress in a checkpoint folder, and can be stopped
and started again. Outputs are written per micro-batch under the batch number, so a repeated batch
replaces its own files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sightline.functions import paths
from sightline.operators import metrics
from sightline.operators.hooks import Encoder, embed_batches


def read_folder(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _start(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def stream_embed(rows: DataFrame, factory: Callable[[], Encoder], out: str, checkpoint: str, batch_size: int = 64, drop: tuple[str, ...] = ()) -> StreamingQuery:
    """Embed new rows; good rows and failures land in ``status=ok`` and ``status=failed`` of one write."""
    embedded = embed_batches(rows, factory, batch_size, drop=drop)
    status = F.when(F.col("error").isNull(), "ok").otherwise("failed")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy("status").parquet(f"{out}/batch={number}")

    return _start(embedded.withColumn("status", status), checkpoint, write)


def stream_predictions(rows: DataFrame, predict: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Predict on new rows and append the results as soon as their batch is done."""
    writer = predict(rows).writeStream.format("parquet").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)


def stream_progress(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Running counts of processed and failed paths."""
    failed = paths.object_id_positional(F.col("image_path")).isNull()
    counts = rows.groupBy(F.when(failed, "failed").otherwise("processed").alias("status")).agg(
        F.count(F.lit(1)).alias("n")
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/state/batch={number}")

    return _start(counts, checkpoint, write, mode="complete")


def stream_metrics(records: DataFrame, out: str, checkpoint: str, fallback: bool = False) -> StreamingQuery:
    """Running per-class sums of the records so far; ``finish_metrics`` turns them into ratios."""
    sums = records.groupBy("classifier_gt").agg(*metrics.outcome_sums(fallback))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/state/batch={number}")

    return _start(sums, checkpoint, write, mode="complete")


def latest_state(spark: SparkSession, out: str) -> DataFrame:
    """The running state as the newest micro-batch wrote it; older ones stay until they are removed."""
    states = spark.read.parquet(f"{out}/state")
    newest = states.agg(F.max("batch").alias("b")).scalar()
    return states.filter(F.col("batch") == newest).drop("batch")


def finish_metrics(sums: DataFrame) -> DataFrame:
    """Hybrid metrics of the sums; the per-class average is only possible once they are in a table."""
    return sums.agg(*metrics.hybrid_columns())
