"""Correctness rules of a prediction record as column expressions.

Two predictions compare as Python values do: two missing labels are equal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline.functions.text import normalize_label


def top1_correct() -> Column:
    return F.col("mobileclip_top1").eqNullSafe(F.col("mobileclip_gt"))


def mobileclip_correct(fallback: bool = False) -> Column:
    """Top-1 or top-2 equals truth A; with ``fallback`` also the normalised truth B."""
    top1, top2 = F.col("mobileclip_top1"), F.col("mobileclip_top2")
    strict = top1_correct() | top2.eqNullSafe(F.col("mobileclip_gt"))
    if not fallback:
        return strict
    coarse = normalize_label(F.col("classifier_gt"))
    return strict | top1.eqNullSafe(coarse) | top2.eqNullSafe(coarse)


def classifier_correct() -> Column:
    return F.col("classifier_pred").eqNullSafe(F.col("classifier_gt"))


def hybrid_correct(fallback: bool = False) -> Column:
    return mobileclip_correct(fallback) | classifier_correct()


def correct_source(fallback: bool = False) -> Column:
    """Which side was right: both, mobileclip_only, classifier_only or neither."""
    zero_shot, head = mobileclip_correct(fallback), classifier_correct()
    return (
        F.when(zero_shot & head, "both")
        .when(zero_shot, "mobileclip_only")
        .when(head, "classifier_only")
        .otherwise("neither")
    )


def hybrid_candidates() -> Column:
    return F.array("mobileclip_top1", "mobileclip_top2", "classifier_pred")


def parse_flag(text: Column) -> Column:
    """'true' in any case is true, other text false, empty or missing NULL."""
    return F.when(F.coalesce(text, F.lit("")) != "", F.lower(text) == "true")


def parse_timing(text: Column) -> Column:
    """Empty or missing text is NULL; text that is no number is an error."""
    return F.nullif(text, F.lit("")).cast("double")
