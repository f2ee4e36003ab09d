"""Applying user-supplied models to rows in batches, with failures kept apart per row.

A hook is given as a factory, called once per task; the model itself is the caller's. Rows flow
through unchanged plus result columns and ``error``; a batch that fails is retried in halves, so one
bad row costs only itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.functions.boxes import DEFAULT_EXPANSION
from sightline.operators import numeric

BATCH_SIZE = 64
CROP = ["crop_xmin", "crop_ymin", "crop_xmax", "crop_ymax"]

Encoder = Callable[[pd.DataFrame], np.ndarray]
Detector = Callable[[pd.DataFrame], list]


def rebatch(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Cut a stream of frames into frames of ``size`` rows; only the last may be shorter."""
    held: list[pd.DataFrame] = []
    rows = 0
    for frame in frames:
        while len(frame):
            part = frame.iloc[: size - rows]
            frame = frame.iloc[len(part):]
            held.append(part)
            rows += len(part)
            if rows == size:
                yield pd.concat(held, ignore_index=True)
                held, rows = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def isolate(call: Callable[[pd.DataFrame], list], batch: pd.DataFrame) -> tuple[list, list]:
    """Results and error texts, one of each per row; a failing batch is halved down to its bad rows."""
    try:
        results = list(call(batch))
        if len(results) != len(batch):
            raise ValueError(f"hook returned {len(results)} results for {len(batch)} rows")
        return results, [None] * len(batch)
    except Exception as failure:
        if len(batch) == 1:
            return [None], [repr(failure)]
        half = len(batch) // 2
        left = isolate(call, batch.iloc[:half].reset_index(drop=True))
        right = isolate(call, batch.iloc[half:].reset_index(drop=True))
        return left[0] + right[0], left[1] + right[1]


def cropped(detector: Detector, batch: pd.DataFrame, width: str, height: str, expansion: float) -> tuple[pd.DataFrame, np.ndarray, list]:
    """The readable rows with the region of their best box (CROP), a flag per row whether there was one, and errors.

    A row without boxes keeps the whole image as its region.
    """

    def locate(part: pd.DataFrame) -> list:
        found = [np.asarray(b, dtype=float).reshape(-1, 5) for b in detector(part)]
        size = [part[c].to_numpy(dtype=float) for c in (width, height)]
        return list(zip(*numeric.best_boxes(found, *size, expansion)))

    located, errors = isolate(locate, batch)
    good = np.array([e is None for e in errors], dtype=bool)
    region = np.array([r for r, _ in (x for x in located if x is not None)], dtype=np.int32).reshape(-1, 4)
    detected = np.array([x is not None and bool(x[1]) for x in located], dtype=bool)
    rows = batch[good].reset_index(drop=True)
    return pd.concat([rows, pd.DataFrame(region, columns=CROP)], axis=1), detected, errors


def embed_batches(
    df: DataFrame,
    factory: Callable[[], Encoder],
    batch_size: int = BATCH_SIZE,
    normalize: bool = False,
    drop: tuple[str, ...] = (),
    detector_factory: Callable[[], Detector] | None = None,
    width: str = "img_w",
    height: str = "img_h",
    expansion: float = DEFAULT_EXPANSION,
) -> DataFrame:
    """Add ``embedding`` and ``error``; the encoder sees frames of ``batch_size`` rows.

    With a detector, the encoder sees each batch with the crop region of every row, and a row that
    the detector cannot read is a failed row. ``normalize`` scales to unit length; a zero vector is
    then a failed row. Stored training embeddings are usually left as they are. ``drop`` names
    payload columns not to carry on.
    """
    kept = [f for f in df.schema.fields if f.name not in drop]
    schema = T.StructType(
        [*kept, T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("error", T.StringType())]
    )
    names = [f.name for f in kept]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = factory()
        detector = detector_factory and detector_factory()

        def call(part: pd.DataFrame) -> list:
            vectors = np.asarray(encoder(part), dtype=np.float32)
            if normalize:
                norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
                if (norms == 0).any():
                    raise ValueError("zero vector has no direction")
                vectors = (vectors / norms[:, None]).astype(np.float32)
            return list(vectors)

        for batch in rebatch(frames, batch_size):
            if detector is None:
                results, errors = isolate(call, batch)
            else:
                crops, _, errors = cropped(detector, batch, width, height, expansion)
                good = [i for i, e in enumerate(errors) if e is None]
                results = [None] * len(batch)
                for i, result, error in zip(good, *(isolate(call, crops) if good else ([], []))):
                    results[i], errors[i] = result, error
            out = batch[names].copy()
            out["embedding"] = pd.Series(results, index=out.index, dtype=object)
            out["error"] = pd.Series(errors, index=out.index, dtype=object)
            yield out

    return df.mapInPandas(run, schema)


def detect_batches(df: DataFrame, factory: Callable[[], Detector], keys: list[str], batch_size: int = BATCH_SIZE) -> DataFrame:
    """One row per detected box (keys, box_id, xmin, ymin, xmax, ymax, confidence, error).

    The detector returns one array of [boxes, 5] per row. An image without boxes gives no row; a
    failed image gives one row with ``error``.
    """
    box = ["xmin", "ymin", "xmax", "ymax", "confidence"]
    schema = T.StructType(
        [df.schema[k] for k in keys]
        + [T.StructField("box_id", T.IntegerType())]
        + [T.StructField(c, T.DoubleType()) for c in box]
        + [T.StructField("error", T.StringType())]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detector = factory()
        for batch in rebatch(frames, batch_size):
            results, errors = isolate(detector, batch)
            found = [np.empty((0, 5)) if r is None else np.asarray(r, dtype=float).reshape(-1, 5) for r in results]
            sizes = np.array([1 if e else len(f) for f, e in zip(found, errors)])
            source = np.repeat(np.arange(len(batch)), sizes)
            out = batch[keys].iloc[source].reset_index(drop=True)
            values = np.concatenate(
                [np.full((1, 5), np.nan) if e else f for f, e in zip(found, errors)] or [np.empty((0, 5))]
            )
            starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            out["box_id"] = (np.arange(len(out)) - starts[source]).astype(np.int32)
            out[box] = values
            out["error"] = pd.Series([errors[i] for i in source], index=out.index, dtype=object)
            yield out

    return df.mapInPandas(run, schema)


def failure_split(df: DataFrame, image: str = "image_path", error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows, failures as image and error)."""
    good = df.filter(F.col(error).isNull()).drop(error)
    failed = df.filter(F.col(error).isNotNull()).select(F.col(image).alias("image"), F.col(error).alias("error"))
    return good, failed
