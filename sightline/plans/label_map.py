"""Ground-truth label maps for the two vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sightline.operators.labels import distinct_object_ids, resolve_labels

# The ID column of the database by split.
ID_COLUMNS = {"train": "trainingID", "test": "testingID"}


def build_label_map(manifest: DataFrame, database: DataFrame | None, overrides: DataFrame | None = None, ground_truth: str = "classifier") -> DataFrame:
    """(object_id, label, mapped) for every ID of the manifest.

    The head's truth takes curated overrides before the database, the zero-shot truth the database only.
    """
    if ground_truth not in ("classifier", "mobileclip"):
        raise ValueError(f"unknown ground truth: {ground_truth}")
    ids = distinct_object_ids(manifest)
    return resolve_labels(ids, overrides if ground_truth == "classifier" else None, database)
