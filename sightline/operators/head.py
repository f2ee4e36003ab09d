"""The classification head: scoring a trained network and fitting one on embeddings."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.operators import numeric

# Widths of the two hidden layers and the layer-norm epsilon.
HIDDEN = (256, 128)
NORM_EPS = 1e-5


@dataclass
class Head:
    """Weights of Linear-LayerNorm-GELU twice and a final Linear; matrices are [inputs, outputs]."""

    weights: list[np.ndarray]
    biases: list[np.ndarray]
    gains: list[np.ndarray]
    shifts: list[np.ndarray]

    @property
    def width(self) -> int:
        return self.weights[0].shape[0]

    @property
    def classes(self) -> int:
        return self.weights[-1].shape[1]


def pack(head: Head) -> list[np.ndarray]:
    """All arrays in one plain list, for broadcasts and optimisers."""
    return [*head.weights, *head.biases, *head.gains, *head.shifts]


def unpack(params: Sequence[np.ndarray]) -> Head:
    layers = (len(params) + 2) // 4
    parts = np.cumsum([0, layers, layers, layers - 1, layers - 1])
    return Head(*[list(params[a:b]) for a, b in zip(parts, parts[1:])])


def random_head(width: int, classes: int, seed: int, hidden: tuple[int, ...] = HIDDEN) -> Head:
    """A head with uniform random weights of the usual 1/sqrt(inputs) range."""
    rng = np.random.default_rng(seed)
    sizes = [width, *hidden, classes]
    bounds = [1 / np.sqrt(n) for n in sizes[:-1]]
    return Head(
        weights=[rng.uniform(-b, b, (m, n)) for b, m, n in zip(bounds, sizes, sizes[1:])],
        biases=[rng.uniform(-b, b, n) for b, n in zip(bounds, sizes[1:])],
        gains=[np.ones(n) for n in hidden],
        shifts=[np.zeros(n) for n in hidden],
    )


def forward(head: Head, x: np.ndarray, erf: numeric.Erf) -> np.ndarray:
    """Logits of a batch; dropout plays no part when scoring."""
    for weight, bias, gain, shift in zip(head.weights, head.biases, head.gains, head.shifts):
        x = x @ weight + bias
        x = x - x.mean(axis=1, keepdims=True)
        x = x / np.sqrt((x * x).mean(axis=1, keepdims=True) + NORM_EPS) * gain + shift
        x = x * 0.5 * (1 + erf(x / np.sqrt(2)))
    return x @ head.weights[-1] + head.biases[-1]


def score_head(df: DataFrame, head: Head, vector: str = "embedding", out: str = "logits", normalize: bool = True) -> DataFrame:
    """Add the logits of each embedding, on unit-length inputs unless ``normalize`` is off.

    NULL for a vector of another width, and for the zero vector when normalising.
    """
    shared = df.sparkSession.sparkContext.broadcast(pack(head))

    @F.arrow_udf("array<double>")
    def logits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held, erf = unpack(shared.value), numeric.Erf()
        for batch in batches:
            matrix, usable = numeric.to_matrix(batch, held.width)
            if normalize:
                matrix, has_norm = numeric.unit_rows(matrix)
                usable = usable & has_norm
            yield numeric.to_lists(forward(held, matrix, erf), usable, pa.float64())

    return df.withColumn(out, logits(F.col(vector)))


def train_linear_head(df: DataFrame, weights: DataFrame, max_iter: int = 100, reg: float = 1e-4, vector: str = "embedding", label: str = "label_idx") -> LogisticRegressionModel:
    """Class-weighted multinomial regression on the training rows; gradients are summed by tree."""
    weighted = df.join(weights.select(F.col(label), "weight"), label)
    features = weighted.select(
        array_to_vector(F.col(vector).cast("array<double>")).alias("features"),
        F.col(label).cast("double").alias("label"),
        "weight",
    )
    estimator = LogisticRegression(
        family="multinomial", weightCol="weight", maxIter=max_iter, regParam=reg, aggregationDepth=3
    )
    return estimator.fit(features)


def linear_head(model: LogisticRegressionModel) -> Head:
    """A fitted linear model as a head without hidden layers, so that one stage scores both kinds."""
    return Head([model.coefficientMatrix.toArray().T.copy()], [model.interceptVector.toArray().copy()], [], [])


def score_linear_head(df: DataFrame, model: LogisticRegressionModel, vector: str = "embedding", out: str = "logits") -> DataFrame:
    vectors = df.withColumn("__features", array_to_vector(F.col(vector).cast("array<double>")))
    scored = model.setFeaturesCol("__features").setRawPredictionCol("__raw").setProbabilityCol("").setPredictionCol("")
    return scored.transform(vectors).withColumn(out, vector_to_array("__raw")).drop("__features", "__raw")
