"""Queries that run the streaming jobs over the given tables until nothing is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.catalog import fixtures as fx
from sightline.catalog.evaluation import HYBRID_RATES, hybrid_sql, rounded
from sightline.catalog.registry import register
from sightline.catalog.scoring import HYBRID, document_images, predicted_documents
from sightline.catalog.views import POSITIONAL_ID
from sightline.session import shared_dir
from sightline.streaming import jobs

FILES_PER_BATCH = 2  # input files per micro-batch


def as_stream(spark, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows as a stream over files, and a folder for outputs."""
    base = shared_dir(spark, name)
    df.write.parquet(f"{base}/in")  # as many files as the scan has tasks
    return jobs.read_folder(spark, f"{base}/in", df.schema, files_per_batch=FILES_PER_BATCH), base


def finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


@register("stream_embed", "SELECT doc_id, " + ", ".join(f"v[{i + 1}] AS e{i}" for i in range(16)) + " FROM fx_letters")
def stream_embed(spark, d):
    texts = fx.table(spark, d, "documents").select("doc_id", "text")
    rows, base = as_stream(spark, texts, "stream_embed")
    finish(jobs.stream_embed(rows, fx.letter_encoder, f"{base}/out", f"{base}/checkpoint", drop=("text",)))
    back = spark.read.parquet(f"{base}/out").filter("status = 'ok'")
    return back.select("doc_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(16)])


@register(
    "stream_progress",
    f"SELECT CASE WHEN {POSITIONAL_ID} IS NULL THEN 'failed' ELSE 'processed' END AS status, count(*) AS n FROM fx_manifest GROUP BY 1",
)
def stream_progress(spark, d):
    rows, base = as_stream(spark, fx.manifest(spark, d), "stream_progress")
    finish(jobs.stream_progress(rows, f"{base}/out", f"{base}/checkpoint"))
    return jobs.latest_state(spark, f"{base}/out")


@register("stream_metrics", f"SELECT {hybrid_sql('loose_hit')} FROM fx_flags")
def stream_metrics(spark, d):
    rows, base = as_stream(spark, fx.predictions(spark, d), "stream_metrics")
    finish(jobs.stream_metrics(rows, f"{base}/out", f"{base}/checkpoint", fallback=True))
    return rounded(jobs.finish_metrics(jobs.latest_state(spark, f"{base}/out")), HYBRID_RATES)


@register("stream_predictions", f"SELECT {', '.join(HYBRID)} FROM fx_hybrid")
def stream_predictions(spark, d):
    """The file sink's log names the files of finished batches, so a repeated batch adds nothing twice."""
    rows, base = as_stream(spark, document_images(spark, d), "stream_predictions")
    predict = lambda stream: predicted_documents(spark, d, stream)
    finish(jobs.stream_predictions(rows, predict, f"{base}/out", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/out").filter("error IS NULL").select(*HYBRID)
