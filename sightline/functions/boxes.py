"""Bounding-box geometry as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_EXPANSION = 0.2


def expand_bbox(
    xmin: Column, ymin: Column, xmax: Column, ymax: Column, width: Column, height: Column,
    expansion: float = DEFAULT_EXPANSION,
) -> Column:
    """Pad a box on each side by a share of its size, truncate to whole pixels, clamp to the image.

    Coordinates beyond the range of whole numbers are clamped too; a box with a NaN or infinite one is NULL.
    """
    whole = lambda c: F.greatest(F.least(c.cast("double"), F.lit(2147483647.0)), F.lit(-2147483648.0)).cast("int")
    finite = F.lit(True)
    for side in (xmin, ymin, xmax, ymax):
        finite = finite & (F.abs(side.cast("double")) < F.lit(float("inf")))
    pad_x = (xmax - xmin) * F.lit(float(expansion))
    pad_y = (ymax - ymin) * F.lit(float(expansion))
    box = F.struct(
        F.greatest(F.lit(0), whole(xmin - pad_x)).alias("xmin"),
        F.greatest(F.lit(0), whole(ymin - pad_y)).alias("ymin"),
        F.least(width.cast("int"), whole(xmax + pad_x)).alias("xmax"),
        F.least(height.cast("int"), whole(ymax + pad_y)).alias("ymax"),
    )
    return F.when(finite, box)


def crop_region(bbox: Column, width: Column, height: Column) -> Column:
    """The box, or the whole image where nothing was detected."""
    whole = F.struct(
        F.lit(0).alias("xmin"),
        F.lit(0).alias("ymin"),
        width.cast("int").alias("xmax"),
        height.cast("int").alias("ymax"),
    )
    return F.coalesce(bbox, whole)
