"""Exact quantiles by counting, for groups of any size.

Spark's ``percentile`` holds every distinct value of a group in one task. Here values are first
counted in fine cells whose order follows the value order; the cells that hold the wanted ranks are
found on the counts alone. A chosen cell that holds many rows is cut again, between its lowest and
its highest value, until it is small or holds one value only. The values in the last few cells are
ranked one by one. The few chosen cells are written, so each further pass over the data is a filter
and no shuffle of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.session import materialize

CELLS_PER_UNIT = 20_000  # cells per factor e of the value
SMALL = 10_000  # rows of a cell whose values one task ranks
PARTS = 4_096  # parts of a cell that holds more; a double is used up after a few cuts
ORIGIN = 1e6  # values below one part in a million share the cells around zero


def value_cell(value: Column) -> Column:
    """Cell number that never falls as the value rises (log1p is monotone)."""
    return (F.signum(value) * F.floor(F.least(F.log1p(F.abs(value) * ORIGIN), F.lit(800.0)) * CELLS_PER_UNIT)).cast("bigint")


def summarize(df: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Per group: n, mean, lowest, highest and the named quantiles with linear interpolation; NaN is no value."""
    data = df.select(*keys, F.col(value).cast("double").alias("v")).filter("v IS NOT NULL AND NOT isnan(v)")
    data = data.withColumn("cell", value_cell(F.col("v")))
    cells = data.groupBy(*keys, "cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    group = Window.partitionBy(*keys)
    before = group.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.select(
        *keys,
        "cell",
        "n",
        F.col("lo").alias("least"),
        F.col("hi").alias("most"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        F.sum("n").over(group).alias("rows"),
        F.sum("s").over(group).alias("s"),
        F.min("lo").over(group).alias("lo"),
        F.max("hi").over(group).alias("hi"),
    )

    def rank(share: float) -> Column:
        return (F.col("rows") - 1) * F.lit(float(share))

    def holds(at: Column) -> Column:
        return (at >= F.col("first")) & (at < F.col("first") + F.col("n"))

    totals = ["rows", "s", "lo", "hi"]

    def wanted(counted: DataFrame) -> DataFrame:
        """The cells that hold a rank, of (keys, cell, first, n, least, most, totals)."""
        held = F.lit(False)
        for share in quantiles.values():
            held = held | holds(F.floor(rank(share))) | holds(F.ceil(rank(share)))
        return counted.filter(held).select(*keys, "cell", "first", "n", "least", "most", *totals)

    def inside(cells: DataFrame) -> DataFrame:
        """The values in the given cells, with the cells' columns."""
        return data.join(cells, [*keys, "cell"]).filter(F.col("v").between(F.col("least"), F.col("most")))

    chosen = materialize(wanted(placed), "quantile_cells")
    crowded = (F.col("n") > SMALL) & (F.col("least") < F.col("most"))
    while not chosen.filter(crowded).isEmpty():
        share = (F.col("v") - F.col("least")) / (F.col("most") - F.col("least"))
        part = F.least(F.floor(share * PARTS), F.lit(PARTS - 1))
        parts = inside(chosen.filter(crowded)).groupBy(*keys, "cell", "least", "first", *totals, part.alias("part"))
        parts = parts.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        lower = Window.partitionBy(*keys, "cell", "least").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("first", F.col("first") + F.coalesce(F.sum("n").over(lower), F.lit(0)))
        finer = parts.select(*keys, "cell", "first", "n", F.col("low").alias("least"), F.col("high").alias("most"), *totals)
        chosen = materialize(chosen.filter(~crowded).unionByName(wanted(finer)), "quantile_cells")

    values = (
        inside(chosen)
        .groupBy(*keys, "cell", "least", "v")
        .agg(F.count(F.lit(1)).alias("n"), F.first("first").alias("cell_first"), *[F.first(c).alias(c) for c in totals])
    )
    lower = Window.partitionBy(*keys, "cell", "least").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = values.withColumn("first", F.col("cell_first") + F.coalesce(F.sum("n").over(lower), F.lit(0)))

    picks = []
    for name, share in quantiles.items():
        picks.append(F.max(F.when(holds(F.floor(rank(share))), F.col("v"))).alias(f"{name}__lo"))
        picks.append(F.max(F.when(holds(F.ceil(rank(share))), F.col("v"))).alias(f"{name}__hi"))
    one = ranked.groupBy(*keys).agg(*[F.first(c).alias(c) for c in totals], *picks)

    def interpolate(name: str, share: float) -> Column:
        low, high = F.col(f"{name}__lo"), F.col(f"{name}__hi")
        return low + (high - low) * (rank(share) - F.floor(rank(share)))

    return one.select(
        *keys,
        F.col("rows").alias("n"),
        (F.col("s") / F.col("rows")).alias("mean"),
        F.col("lo").alias("lowest"),
        F.col("hi").alias("highest"),
        *[interpolate(name, share).alias(name) for name, share in quantiles.items()],
    )


def latency_summary(df: DataFrame, keys: Sequence[str] = (), ms: str = "ms") -> DataFrame:
    """Mean, median, min, max, p95 and images per second, per group."""
    out = summarize(df, keys, ms, {"median": 0.5, "p95": 0.95})
    mean = F.col("mean")
    return out.select(
        *keys,
        mean.alias("average_latency_ms"),
        F.col("median").alias("median_latency_ms"),
        F.col("lowest").alias("min_latency_ms"),
        F.col("highest").alias("max_latency_ms"),
        F.col("p95").alias("p95_latency_ms"),
        F.when(mean == 0, F.lit(float("inf"))).otherwise(F.lit(1000.0) / mean).alias("throughput_images_per_sec"),
    )


def per_image_latency(images: DataFrame, batches: DataFrame, batch: str, ms: str, out: str = "latency_ms") -> DataFrame:
    """Each image's share of its batch time; batch sizes are counted before the join."""
    sizes = images.groupBy(batch).agg(F.count(F.lit(1)).alias("__size"))
    share = batches.join(sizes, batch).select(batch, (F.col(ms) / F.col("__size")).alias(out))
    return images.join(share, batch)
