"""Loss, accuracy and early-stopping rules of head training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.functions.vectors import dot, log_softmax

LABEL_SMOOTHING = 0.1
PATIENCE = 10


def weight_vector(weights: DataFrame, label: str = "label_idx") -> Column:
    """Class weights in index order as one array, read as a scalar subquery (one row per class)."""
    pairs = weights.agg(F.array_sort(F.collect_list(F.struct(F.col(label), F.col("weight")))).alias("p"))
    return pairs.select(F.transform("p", lambda p: p["weight"]).alias("w")).scalar()


def weighted_ce_loss(df: DataFrame, weights: Column, batch: str, logits: str = "logits", target: str = "label_idx", smoothing: float = LABEL_SMOOTHING) -> DataFrame:
    """Class-weighted cross-entropy with label smoothing, one value per batch."""
    logp = log_softmax(F.col(logits))
    rows = df.select(batch, target, logp.alias("logp"), weights.alias("w"))
    weight = F.get("w", F.col(target))
    terms = rows.select(
        batch,
        weight.alias("w"),
        (-weight * F.get("logp", F.col(target))).alias("nll"),
        (-dot(F.col("w"), F.col("logp"))).alias("smooth"),
        F.size("logp").alias("classes"),
    )
    eps = F.lit(float(smoothing))
    value = ((1 - eps) * F.sum("nll") + eps / F.max("classes") * F.sum("smooth")) / F.sum("w")
    return terms.groupBy(batch).agg(value.alias("loss"))


def epoch_loss(batch_losses: DataFrame) -> DataFrame:
    """Mean of the batch values, so a short last batch counts as much as a full one."""
    return batch_losses.agg(F.avg("loss").alias("loss"), F.count(F.lit(1)).alias("batches"))


def epoch_accuracy(df: DataFrame, keys: Sequence[str], truth: str, pred: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count_if(F.col(truth) == F.col(pred)).alias("correct"),
        F.count(F.lit(1)).alias("total"),
        F.avg(F.when(F.col(truth) == F.col(pred), 1.0).otherwise(0.0)).alias("accuracy"),
    )


def early_stopping(history: DataFrame, run: str = "run_id", epoch: str = "epoch", score: str = "val_accuracy", patience: int = PATIENCE) -> DataFrame:
    """Best epoch and the epoch at which each run stops.

    The score must rise strictly above the best so far, which starts at 0; a run that never does has
    best epoch 0. A NaN score is no improvement. One window partition holds one run's epochs.
    """
    value = F.when(~F.isnan(score), F.col(score))
    order = Window.partitionBy(run).orderBy(epoch)
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    best_before = F.greatest(F.lit(0.0), F.coalesce(F.max(value).over(past), F.lit(0.0)))
    steps = history.select(
        run, epoch, value.alias("v"), (F.coalesce(value, F.lit(0.0)) > best_before).alias("improved"),
        F.greatest(F.lit(0.0), F.coalesce(F.max(value).over(upto), F.lit(0.0))).alias("best"),
    )
    last = F.coalesce(F.max(F.when(F.col("improved"), F.col(epoch))).over(upto), F.lit(0))
    steps = steps.withColumn("last", last).withColumn("stop", F.col(epoch) - F.col("last") >= patience)
    first_stop = F.min(F.when(F.col("stop"), F.struct(F.col(epoch).alias("e"), F.col("last"), F.col("best"))))
    end = F.max(F.struct(F.col(epoch).alias("e"), F.col("last"), F.col("best")))
    return (
        steps.groupBy(run)
        .agg(F.coalesce(first_stop, end).alias("at"), F.bool_or("stop").alias("stopped_early"))
        .select(
            run,
            F.col("at.last").alias("best_epoch"),
            F.col("at.best").alias("best_val_accuracy"),
            F.col("at.e").alias("last_epoch"),
            "stopped_early",
        )
    )
