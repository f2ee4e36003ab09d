"""Embedding extraction: paths to labelled embedding records and failures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions import paths
from sightline.operators.hooks import BATCH_SIZE, Detector, Encoder, embed_batches, failure_split
from sightline.operators.labels import label_lookup_default, limit_images
from sightline.session import materialize
from sightline.sources.tables import read_manifest_images


def extract_embeddings(
    rows: DataFrame,
    labels: DataFrame,
    factory: Callable[[], Encoder],
    payload: tuple[str, ...] = (),
    batch_size: int = BATCH_SIZE,
    normalize: bool = False,
    detector_factory: Callable[[], Detector] | None = None,
) -> DataFrame:
    """(image_path, batch_id, image, objectID, label, embedding, error) for rows with ``image_path``.

    With a detector, the crop of the best box is embedded, as in prediction; the rows need ``img_w`` and ``img_h``. A
    path without an object ID, or a row whose ``read_error`` is set, skips both models. The payload is dropped in the
    stage that reads it; only embeddings meet the label join.
    """
    path = F.col("image_path")
    read_error = F.col("read_error") if "read_error" in rows.columns else F.lit(None).cast("string")
    named = rows.withColumn("path_error", F.coalesce(paths.path_error(path), read_error))
    usable = named.filter("path_error IS NULL")
    good = embed_batches(usable, factory, batch_size, normalize, (*payload, "path_error"), detector_factory)
    bad = named.filter("path_error IS NOT NULL").select("image_path", F.col("path_error").alias("error"))
    results = good.select("image_path", "embedding", "error").unionByName(bad, allowMissingColumns=True)
    with_id = results.withColumn("objectID", paths.object_id_positional(path))
    labelled = label_lookup_default(with_id, labels, key="objectID", out="label")
    return labelled.select(
        "image_path",
        paths.batch_id(path).alias("batch_id"),
        paths.image_basename(path).alias("image"),
        "objectID",
        "label",
        "embedding",
        "error",
    )


def run_extraction(rows: DataFrame, labels: DataFrame, factory: Callable[[], Encoder], payload: tuple[str, ...] = (), **options) -> tuple[DataFrame, DataFrame]:
    """(records, failures), with the encoder run once: both read the written results."""
    return failure_split(materialize(extract_embeddings(rows, labels, factory, payload, **options), "extracted"))


def run_manifest(
    manifest: DataFrame,
    labels: DataFrame,
    factory: Callable[[], Encoder],
    detector_factory: Callable[[], Detector] | None = None,
    max_images: int = -1,
    opener: Callable[[str], bytes] | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """(records, failures) of the first ``max_images`` images of a manifest (pos, image_path, uri).

    Only those images are opened, each once, in the task that detects, crops and embeds it; an image that cannot be
    read is a failure like any other. ``prepare`` may derive what the models need from ``content``, such as the image
    size; it must not shuffle.
    """
    images = read_manifest_images(limit_images(manifest, max_images), opener=opener)
    kept = {"pos", "prefix", "image_path", "uri"}
    rows = prepare(images)
    payload = tuple(c for c in rows.columns if c not in kept)
    return run_extraction(rows, labels, factory, payload, detector_factory=detector_factory, **options)
