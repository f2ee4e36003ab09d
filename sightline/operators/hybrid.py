"""Detector, zero-shot classifier and head in one pass over the images."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.functions.boxes import DEFAULT_EXPANSION
from sightline.functions.text import normalize_label
from sightline.operators import numeric
from sightline.operators.head import Head, forward, pack, unpack
from sightline.operators.hooks import BATCH_SIZE, Detector, Encoder, cropped, isolate, rebatch
from sightline.operators.labels import synonym_join
from sightline.operators.zeroshot import Bank, best_categories
from sightline.session import materialize

INDICES = ["top1_idx", "top2_idx", "class_idx"]
RESULT = T.StructType(
    [
        *[T.StructField(c, T.LongType()) for c in INDICES],
        T.StructField("yolo_detected", T.BooleanType()),
        T.StructField("mobileclip_ms", T.DoubleType()),
        T.StructField("classifier_ms", T.DoubleType()),
        T.StructField("pipeline_ms", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)


def hybrid_indices(
    df: DataFrame,
    detector_factory: Callable[[], Detector],
    encoder_factory: Callable[[], Encoder],
    bank: Bank,
    head: Head,
    keep: Sequence[str],
    width: str = "img_w",
    height: str = "img_h",
    batch_size: int = BATCH_SIZE,
    expansion: float = DEFAULT_EXPANSION,
) -> DataFrame:
    """Columns ``keep`` plus the indices of the two best categories and of the head's class, the detection flag,
    timings and error. The second index is NULL if the bank has one category only.

    The encoder sees its batch with the crop region of each row. One Python stage, no shuffle; timings are batch time
    per row. Equal scores (to nine places) go to the smaller index.
    """
    params, slices = df.sparkSession.sparkContext.broadcast(pack(head)), bank.slices
    schema = T.StructType([df.schema[k] for k in keep] + RESULT.fields)
    names, vector_width = list(keep), bank.width

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        layers, detector, encoder, erf = unpack(params.value), detector_factory(), encoder_factory(), numeric.Erf()

        def embed(part: pd.DataFrame) -> list:
            vectors, has_norm = numeric.unit_rows(np.asarray(encoder(part), dtype=np.float64))
            if not has_norm.all():
                raise ValueError("zero vector has no direction")
            return list(vectors)

        for batch in rebatch(frames, batch_size):
            start = time.perf_counter()
            crops, detected, errors = cropped(detector, batch, width, height, expansion)
            encoded = time.perf_counter()
            read = [i for i, e in enumerate(errors) if e is None]
            vectors, embed_errors = isolate(embed, crops) if read else ([], [])
            for i, failure in zip(read, embed_errors):
                errors[i] = failure
            good = np.array([e is None for e in errors], dtype=bool)
            unit = np.array([v for v in vectors if v is not None]).reshape(-1, vector_width)
            top, _ = best_categories(unit, slices, 2)
            matched = time.perf_counter()
            guess, _ = numeric.stable_top_k(forward(layers, unit, erf), 1)
            done = time.perf_counter()

            out = batch[names].copy()
            for name, values in (
                ("top1_idx", top[:, 0]),
                ("top2_idx", top[:, 1] if top.shape[1] > 1 else None),
                ("class_idx", guess[:, 0]),
                ("yolo_detected", detected[good]),
                ("mobileclip_ms", (matched - encoded) * 1000 / len(batch)),
                ("classifier_ms", (done - matched) * 1000 / len(batch)),
                ("pipeline_ms", (done - start) * 1000 / len(batch)),
            ):
                column = np.full(len(batch), None, dtype=object)
                column[good] = values
                out[name] = column
            out["error"] = pd.Series(errors, index=out.index, dtype=object)
            yield out

    return df.mapInPandas(run, schema)


def canonical_categories(categories: DataFrame, synonyms: DataFrame | None) -> DataFrame:
    """(category_idx, name): the category's dataset label where it has one, else its own name, in canonical form."""
    if synonyms is None:
        return categories.select("category_idx", normalize_label(F.col("category")).alias("name"))
    return synonym_join(categories, synonyms, "category", "name").select("category_idx", "name")


def hybrid_predict(
    df: DataFrame,
    detector_factory: Callable[[], Detector],
    encoder_factory: Callable[[], Encoder],
    bank: Bank,
    categories: DataFrame,
    head: Head,
    classes: DataFrame,
    keep: Sequence[str],
    synonyms: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Columns ``keep`` plus the two best categories, the head's class, the detection flag, timings and error.

    ``categories`` (category_idx, category) names the bank's categories, ``synonyms`` (category, canonical) maps them
    to dataset labels, ``classes`` (label_idx, label) names the head's classes. The model stage returns indices; the
    names come by joins with those tables, which are written first, so that the planner knows their size.
    """
    found = hybrid_indices(df, detector_factory, encoder_factory, bank, head, keep, **options)
    names = materialize(canonical_categories(categories, synonyms), "category_names")
    labels = materialize(classes.select("label_idx", "label"), "class_names")
    for index, out, table, key, value in (
        ("top1_idx", "mobileclip_top1", names, "category_idx", "name"),
        ("top2_idx", "mobileclip_top2", names, "category_idx", "name"),
        ("class_idx", "classifier_pred", labels, "label_idx", "label"),
    ):
        named = table.select(F.col(key).cast("long").alias(f"__{index}"), F.col(value).alias(out))
        found = found.join(named, F.col(index) == F.col(f"__{index}"), "left").drop(f"__{index}")
    order = ["mobileclip_top1", "mobileclip_top2", "classifier_pred", *[f.name for f in RESULT if f.name not in INDICES]]
    return found.select(*keep, *order)
