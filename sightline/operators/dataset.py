"""Turning labelled embeddings into a training set."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.schemas import UNKNOWN
from sightline.session import materialize

VAL_SIZE = 0.1
SEED = 42
HASH_DIGITS = 3  # leading hex digits of the row hash: 4,096 cells per class


def concat_samples(*sources: DataFrame) -> DataFrame:
    """All samples of several embedding tables."""
    out = sources[0]
    for source in sources[1:]:
        out = out.unionByName(source)
    return out


def drop_unknown(df: DataFrame, label: str = "label") -> DataFrame:
    return df.filter(~F.col(label).eqNullSafe(F.lit(UNKNOWN)))


def fit_label_encoder(df: DataFrame, label: str = "label") -> DataFrame:
    """Sorted distinct labels as dense indices from 0; the window sees one row per class."""
    classes = df.select(F.col(label).alias("label")).distinct()
    return classes.select((F.row_number().over(Window.orderBy("label")) - 1).alias("label_idx"), "label")


def embedding_stats(df: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.size(vector)).alias("min_dim"),
        F.max(F.size(vector)).alias("max_dim"),
        F.count_distinct(label).alias("classes"),
    )


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights n / (classes * count), as single-precision values."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()
    weight = F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n"))
    return counts.select(label, "n", weight.cast("float").cast("double").alias("weight"))


def split_quotas(counts: DataFrame, label: str, val_size: float = VAL_SIZE) -> DataFrame:
    """Validation rows per class from (label, n): largest remainder, equal remainders by label.

    The validation share is rounded up over all rows. Classes of one row, or a split with fewer
    rows than classes on either side, are errors.
    """
    everything = Window.partitionBy()
    sized = counts.select(
        label,
        "n",
        F.sum("n").over(everything).alias("rows"),
        F.count(F.lit(1)).over(everything).alias("classes"),
        F.min("n").over(everything).alias("smallest"),
    ).withColumn("val_rows", F.ceil(F.col("rows") * F.lit(float(val_size))))
    wide = "decimal(18,0)"
    share = F.col("n").cast(wide) * F.col("val_rows").cast(wide)
    base = sized.withColumn("remainder", share % F.col("rows").cast(wide)).withColumn(
        "base", F.floor((share - F.col("remainder")) / F.col("rows").cast(wide)).cast("bigint")
    )
    rank = F.row_number().over(Window.orderBy(F.col("remainder").desc(), label))
    ranked = base.select("*", rank.alias("place"), F.sum("base").over(everything).alias("given"))
    quota = F.col("base") + F.when(F.col("place") <= F.col("val_rows") - F.col("given"), 1).otherwise(0)
    problem = F.when(F.col("smallest") < 2, "a class has fewer than 2 rows").when(
        F.least("val_rows", F.col("rows") - F.col("val_rows")) < F.col("classes"),
        "a side of the split has fewer rows than classes",
    )
    return ranked.select(
        label, "n", F.when(problem.isNotNull(), F.raise_error(problem).cast("bigint")).otherwise(quota).alias("quota")
    )


def split_thresholds(df: DataFrame, label: str, key: str, val_size: float = VAL_SIZE, seed: int = SEED) -> DataFrame:
    """Per class the (hash, key) of the last validation row.

    Rows are ranked by a seeded hash. Instead of sorting a class, its rows are counted by leading
    hash digits; only the one cell that holds the quota's edge is ranked row by row, so a class with
    a third of all rows costs a sort of 1/4,096 of it. The three small tables on the way are
    written, so the planner knows that neither pass over the data needs a shuffle of it.
    """
    hashed = df.select(label, key, F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))).alias("h"))
    hashed = hashed.withColumn("cell", F.substring("h", 1, HASH_DIGITS))
    cells = materialize(hashed.groupBy(label, "cell").agg(F.count(F.lit(1)).alias("n")), "split_cells")
    counts = cells.groupBy(label).agg(F.sum("n").alias("n"))
    quotas = split_quotas(counts, label, val_size).select(label, "quota")
    running = Window.partitionBy(label).orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = (
        cells.withColumn("upto", F.sum("n").over(running))
        .join(quotas, label)
        .filter((F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("n") < F.col("quota")))
        .select(label, "cell", (F.col("quota") - F.col("upto") + F.col("n")).alias("take"))
    )
    rank = F.row_number().over(Window.partitionBy(label, "cell").orderBy("h", key))
    in_edge = hashed.join(materialize(edge, "split_edges"), [label, "cell"]).withColumn("place", rank)
    last = in_edge.filter("place = take").select(label, F.col("h").alias("last_h"), F.col(key).alias("last_key"))
    return materialize(last, "split_thresholds")


def stratified_split(df: DataFrame, label: str = "label", key: str = "vec_id", val_size: float = VAL_SIZE, seed: int = SEED) -> DataFrame:
    """Add ``split`` (train or val): exact class quotas, members chosen by seeded hash.

    The rows themselves are only compared with a table of one threshold per class.
    """
    last = split_thresholds(df, label, key, val_size, seed)
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    joined = df.join(last.withColumnRenamed(label, "__label"), F.col(label) == F.col("__label"), "left")
    is_val = (hashed < F.col("last_h")) | ((hashed == F.col("last_h")) & (F.col(key) <= F.col("last_key")))
    return joined.withColumn("split", F.when(is_val, "val").otherwise("train")).drop("__label", "last_h", "last_key")
