"""Hybrid evaluation: predictions joined to both truths, and their report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.functions import outcomes, paths
from sightline.operators.labels import dual_truth_join
from sightline.operators.metrics import metrics_report
from sightline.schemas import PREDICTION_FIELDS
from sightline.session import materialize
from sightline.sources.tables import read_predictions


def prediction_records(predicted: DataFrame, zero_shot_labels: DataFrame, head_labels: DataFrame, synonyms: DataFrame, fallback: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, failures) of predicted rows (image_path, the prediction columns, error).

    The predictions are written first, so their hooks run once for both results.
    """
    predicted = materialize(predicted, "predicted")
    path = F.col("image_path")
    checked = predicted.withColumn("error", F.coalesce("error", paths.path_error(path)))
    failures = checked.filter("error IS NOT NULL").select(F.col("image_path").alias("image"), "error")
    named = checked.filter("error IS NULL").withColumn("object_id", paths.object_id_positional(path))
    truth = dual_truth_join(named, zero_shot_labels, head_labels, synonyms)
    records = truth.withColumn("image", paths.image_basename(path)).withColumn(
        "hybrid_correct", outcomes.hybrid_correct(fallback)
    )
    return records.select(*PREDICTION_FIELDS), failures


def evaluate(predicted: DataFrame, zero_shot_labels: DataFrame, head_labels: DataFrame, synonyms: DataFrame, encoder: DataFrame, fallback: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, failures, report) of one evaluation; the fallback is on, as in an evaluation job."""
    records, failures = prediction_records(predicted, zero_shot_labels, head_labels, synonyms, fallback)
    return records, failures, metrics_report(records, encoder, failures, fallback)


def recompute_report(spark: SparkSession, path: str, encoder: DataFrame | None = None, fallback: bool = False) -> DataFrame:
    """Report from saved predictions; flags are computed anew, the stored one is not used."""
    return metrics_report(read_predictions(spark, path), encoder, None, fallback)
