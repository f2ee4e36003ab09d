"""Choosing and placing detector boxes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions.boxes import DEFAULT_EXPANSION, expand_bbox
from sightline.schemas import BOX_COLUMNS


def best_detection(boxes: DataFrame, keys: Sequence[str], ties: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """The box of highest confidence per image; equal confidences go to the smallest ``ties``, then coordinates.

    One aggregate with a map-side step: each task sends one box per image, however many an image
    has. A NaN confidence ranks last.
    """
    confidence = F.when(~F.isnan("confidence"), F.col("confidence"))
    rank = F.struct(confidence.alias("c"), *[(-F.col(t)).alias(f"t{i}") for i, t in enumerate([*ties, "xmin", "ymin", "xmax", "ymax"])])
    columns = [*ties, *BOX_COLUMNS, *keep]
    best = boxes.groupBy(*keys).agg(F.max_by(F.struct(*columns), rank).alias("best"))
    return best.select(*keys, *[F.col(f"best.{c}").alias(c) for c in columns])


def expanded_boxes(boxes: DataFrame, expansion: float = DEFAULT_EXPANSION) -> DataFrame:
    """Add ``bbox``: the padded, truncated and clamped box."""
    return boxes.withColumn(
        "bbox",
        expand_bbox(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax", "img_w", "img_h")], expansion),
    )


def pair_detections(images: DataFrame, best: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every image with its best box or none, and the flag ``yolo_detected``."""
    paired = images.join(best.withColumn("__hit", F.lit(True)), list(keys), "left")
    return paired.withColumn("yolo_detected", F.col("__hit").isNotNull()).drop("__hit")
