"""Vector arithmetic on array columns, in double precision and inside the JVM."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    A lambda body is run once per element, so anything that does not depend on the element must be
    bound outside it; otherwise normalising a vector costs the square of its length.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def total(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(as_double(vector), F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(vector: Column) -> Column:
    """Unit vector, NULL for the zero vector."""
    return bind(
        l2_norm(vector),
        lambda norm: F.when(norm > 0, F.transform(as_double(vector), lambda x: x / norm)),
    )


def dot(left: Column, right: Column) -> Column:
    return total(F.zip_with(as_double(left), as_double(right), lambda a, b: a * b))


def scale_logits(similarity: Column, logit_scale: float | None) -> Column:
    """Similarity times ``exp(logit_scale)``; unchanged when there is no scale."""
    return similarity if logit_scale is None else similarity * F.lit(math.exp(logit_scale))


def softmax(logits: Column) -> Column:
    powers = bind(F.array_max(logits), lambda top: F.transform(as_double(logits), lambda x: F.exp(x - top)))
    return bind(
        powers, lambda ps: bind(total(ps), lambda norm: F.transform(ps, lambda p: p / norm))
    )


def log_softmax(logits: Column) -> Column:
    shifted = bind(F.array_max(logits), lambda top: F.transform(as_double(logits), lambda x: x - top))
    return bind(
        shifted,
        lambda xs: bind(
            F.log(F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + F.exp(x))),
            lambda norm: F.transform(xs, lambda x: x - norm),
        ),
    )


def argmax(logits: Column) -> Column:
    """Zero-based index of the first largest element."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def top_k(scores: Column, k: int) -> Column:
    """The k best (score, index) pairs; equal scores (to nine places) go by index."""
    pairs = F.transform(
        scores,
        lambda score, i: F.struct((-F.round(score, 9)).alias("key"), i.alias("idx"), score.alias("score")),
    )
    best = F.slice(F.array_sort(pairs), 1, k)
    return F.transform(best, lambda p: F.struct(p["idx"].alias("idx"), p["score"].alias("score")))
