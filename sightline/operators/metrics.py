"""Accuracy reports over prediction records.

Records are summed once per (truth B, prediction) pair; everything else works on those sums, whose
number is bounded by the square of the class list. All averages are 0 for empty input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.functions import outcomes
from sightline.schemas import SOURCES
from sightline.session import materialize


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


def ratio0(part: Column, whole: Column) -> Column:
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def mark_outcomes(df: DataFrame, fallback: bool = False) -> DataFrame:
    """Add every correctness flag and the outcome of each record."""
    return df.withColumns(
        {
            "top1_correct": outcomes.top1_correct(),
            "mobileclip_correct": outcomes.mobileclip_correct(fallback),
            "classifier_correct": outcomes.classifier_correct(),
            "hybrid_correct": outcomes.hybrid_correct(fallback),
            "correct_source": outcomes.correct_source(fallback),
        }
    )


def outcome_sums(fallback: bool) -> list[Column]:
    source = outcomes.correct_source(fallback)
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(outcomes.top1_correct()).alias("top1"),
        F.count_if(outcomes.mobileclip_correct(fallback)).alias("top2"),
        F.count_if(outcomes.hybrid_correct(fallback)).alias("hits"),
        *[F.count_if(source == name).alias(name) for name in SOURCES],
        F.sum("mobileclip_ms").alias("mc_ms"),
        F.count("mobileclip_ms").alias("mc_n"),
        F.sum("pipeline_ms").alias("pl_ms"),
        F.count("pipeline_ms").alias("pl_n"),
        F.count_if(F.col("yolo_detected")).alias("det"),
        F.count("yolo_detected").alias("det_n"),
    ]


SUMMED = ["n", "top1", "top2", "hits", *SOURCES, "mc_ms", "mc_n", "pl_ms", "pl_n", "det", "det_n"]


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))


def mobileclip_columns() -> list[Column]:
    return [
        ratio0(_total("top1"), _total("n")).alias("top1_accuracy"),
        ratio0(_total("top2"), _total("n")).alias("top2_accuracy"),
        _total("n").alias("num_images"),
        ratio(F.sum("mc_ms"), _total("mc_n")).alias("average_inference_ms"),
    ]


def hybrid_columns() -> list[Column]:
    """Over rows that each hold the sums of one truth-B class."""
    return [
        ratio0(_total("hits"), _total("n")).alias("hybrid_accuracy"),
        F.coalesce(F.avg(ratio(F.col("hits"), F.col("n"))), F.lit(0.0)).alias("hybrid_balanced_accuracy"),
        _total("n").alias("num_images"),
        *[_total(name).alias(name) for name in SOURCES],
        ratio(F.sum("pl_ms"), _total("pl_n")).alias("average_pipeline_ms"),
        ratio(_total("det"), _total("det_n")).alias("yolo_detection_rate"),
    ]


def mobileclip_metrics(df: DataFrame, fallback: bool = False) -> DataFrame:
    """Top-1 and top-2 accuracy, rows, and mean time over rows that have one."""
    return df.agg(*outcome_sums(fallback)).agg(*mobileclip_columns())


def hybrid_metrics(df: DataFrame, fallback: bool = False) -> DataFrame:
    """Hybrid and balanced accuracy, outcome counts, mean pipeline time, detection rate."""
    return df.groupBy("classifier_gt").agg(*outcome_sums(fallback)).agg(*hybrid_columns())


def sums_by_fallback(df: DataFrame, *keys: str) -> DataFrame:
    """Outcome sums without and with the fallback from one scan: two rows per key, told apart by ``fallback``."""
    sums = [F.struct(F.lit(flag).alias("fallback"), *outcome_sums(flag)) for flag in (False, True)]
    return df.groupBy(*keys).agg(F.array(*sums).alias("sums")).select(*keys, F.inline("sums"))


def mobileclip_metrics_by_fallback(df: DataFrame) -> DataFrame:
    return sums_by_fallback(df).groupBy("fallback").agg(*mobileclip_columns())


def hybrid_metrics_by_fallback(df: DataFrame) -> DataFrame:
    """One row per setting, none without records."""
    return sums_by_fallback(df, "classifier_gt").groupBy("fallback").agg(*hybrid_columns())


def hybrid_class_counts(df: DataFrame, fallback: bool = False) -> DataFrame:
    """Rows and hits per truth-B class."""
    return df.groupBy("classifier_gt").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(outcomes.hybrid_correct(fallback)).alias("hits")
    )


def hybrid_balanced_accuracy(df: DataFrame, fallback: bool = False) -> DataFrame:
    per_class = hybrid_class_counts(df, fallback)
    return per_class.agg(
        F.coalesce(F.avg(F.col("hits") / F.col("n")), F.lit(0.0)).alias("hybrid_balanced_accuracy"),
        F.count(F.lit(1)).alias("classes"),
    )


def source_breakdown(df: DataFrame, fallback: bool = False) -> DataFrame:
    """One row per outcome, zeros kept."""
    source = outcomes.correct_source(fallback)
    counts = df.agg(*[F.count_if(source == name).alias(name) for name in SOURCES])
    return counts.unpivot([], SOURCES, "correct_source", "n")


def fallback_delta(df: DataFrame) -> DataFrame:
    """Per truth-B class: zero-shot and hybrid hits without and with the fallback, and rows that change."""
    strict, loose = outcomes.mobileclip_correct(False), outcomes.mobileclip_correct(True)
    return df.groupBy("classifier_gt").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(strict).alias("strict_hits"),
        F.count_if(loose).alias("fallback_hits"),
        F.count_if(loose & ~strict).alias("recovered"),
        F.count_if(outcomes.hybrid_correct(False)).alias("strict_hybrid_hits"),
        F.count_if(outcomes.hybrid_correct(True)).alias("fallback_hybrid_hits"),
    )


# --- classification metrics -------------------------------------------------------------------


def confusion_counts(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """The only pass over the data: rows per (truth, prediction)."""
    return df.groupBy(F.col(truth).alias("y"), F.col(pred).alias("y_pred")).agg(F.count(F.lit(1)).alias("n"))


def class_universe(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Classes seen as truth or as prediction."""
    pairs = confusion_counts(df, truth, pred)
    return pairs.select(F.explode(F.array("y", "y_pred")).alias("label")).distinct()


def class_sums(counts: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Per class: support, predicted, hits. ``classes`` (label) adds classes never seen, as zeros."""
    zero = F.lit(0).cast("bigint")
    as_truth = F.struct(
        F.col("y").alias("label"),
        F.col("n").alias("support"),
        zero.alias("predicted"),
        F.when(F.col("y").eqNullSafe(F.col("y_pred")), F.col("n")).otherwise(zero).alias("hits"),
    )
    as_pred = F.struct(
        F.col("y_pred").alias("label"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("hits")
    )
    rows = counts.select(F.inline(F.array(as_truth, as_pred)))
    if classes is not None:
        rows = rows.unionByName(
            classes.select("label", zero.alias("support"), zero.alias("predicted"), zero.alias("hits"))
        )
    return rows.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])


def _precision() -> Column:
    return ratio0(F.col("hits"), F.col("predicted"))


def _recall() -> Column:
    return ratio0(F.col("hits"), F.col("support"))


def _f1() -> Column:
    return ratio0(2 * F.col("hits"), F.col("support") + F.col("predicted"))


def _weighted(value: Column) -> Column:
    return ratio0(F.sum(value * F.col("support")), F.sum("support"))


def _classification_columns() -> list[Column]:
    """Three class lists meet here: macro averages run over classes seen on either side, balanced
    accuracy over classes in the truth only; a report over a fixed list counts unseen classes as 0."""
    seen = (F.col("support") > 0) | (F.col("predicted") > 0)
    return [
        ratio0(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.coalesce(F.avg(ratio(F.col("hits"), F.col("support"))), F.lit(0.0)).alias("balanced_accuracy"),
        F.avg(F.when(seen, _precision())).alias("macro_precision"),
        _weighted(_precision()).alias("weighted_precision"),
        F.avg(F.when(seen, _recall())).alias("macro_recall"),
        _weighted(_recall()).alias("weighted_recall"),
        F.avg(F.when(seen, _f1())).alias("macro_f1"),
        _weighted(_f1()).alias("weighted_f1"),
        F.coalesce(F.sum("support"), F.lit(0)).alias("num_samples"),
    ]


def classification_metrics(counts: DataFrame) -> DataFrame:
    return class_sums(counts).agg(*_classification_columns())


def _per_class() -> Column:
    return F.struct(
        F.col("label").cast("string").alias("label"),
        _precision().alias("precision"),
        _recall().alias("recall"),
        _f1().alias("f1_score"),
        F.col("support").alias("support"),
    )


def _summary_rows() -> tuple[Column, Column, Column]:
    accuracy = ratio0(F.sum("hits"), F.sum("support"))
    support = F.sum("support")

    def row(name: str, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1_score"),
            support.alias("support"),
        )

    return (
        row("accuracy", accuracy, accuracy, accuracy),
        row("macro avg", F.avg(_precision()), F.avg(_recall()), F.avg(_f1())),
        row("weighted avg", _weighted(_precision()), _weighted(_recall()), _weighted(_f1())),
    )


def classification_report(counts: DataFrame, classes: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class of the full list, then the three summary rows.

    The accuracy row repeats the accuracy in all three columns.
    """
    sums = class_sums(counts, classes)
    listed = sums.agg(F.concat(F.collect_list(_per_class()), F.array(*_summary_rows())).alias("rows"))
    return listed.select(F.inline("rows"))


def confusion_rows(counts: DataFrame, encoder: DataFrame) -> DataFrame:
    """Dense matrix, one row per class of the encoder: (label_idx, label, counts by predicted index)."""
    coded = (
        counts.join(encoder.select(F.col("label").alias("y"), F.col("label_idx").alias("yi")), "y")
        .join(encoder.select(F.col("label").alias("y_pred"), F.col("label_idx").alias("pi")), "y_pred")
        .groupBy("yi")
        .agg(F.map_from_entries(F.collect_list(F.struct("pi", "n"))).alias("cells"))
    )
    sized = encoder.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy()).cast("int"))
    joined = sized.join(coded, F.col("label_idx") == F.col("yi"), "left")
    return joined.select("label_idx", "label", _dense(F.col("cells"), F.col("size")).alias("counts"))


def _dense(cells: Column, size: Column) -> Column:
    """Counts of all class indices from a map that holds only those above zero."""
    zero = F.lit(0).cast("bigint")
    return F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.coalesce(F.try_element_at(cells, i), zero))


def confusion_matrix(counts: DataFrame, encoder: DataFrame) -> DataFrame:
    """The dense matrix in long form (true_idx, pred_idx, n), zeros included."""
    rows = confusion_rows(counts, encoder)
    return rows.select(F.col("label_idx").alias("true_idx"), F.posexplode("counts").alias("pred_idx", "n"))


# --- whole report -----------------------------------------------------------------------------


def metrics_report(df: DataFrame, encoder: DataFrame | None = None, failures: DataFrame | None = None, fallback: bool = False) -> DataFrame:
    """The whole report as one row of nested sections, from one pass over the records.

    Records whose truth B is outside ``encoder`` count in the zero-shot and hybrid sections only; a
    prediction outside it is an error. Without an encoder there is no classifier section. No records
    at all gives an ``error`` text instead of sections.
    """
    pairs = df.groupBy("classifier_gt", "classifier_pred").agg(*outcome_sums(fallback))
    zero = F.lit(0).cast("bigint")
    if encoder is None:
        coded = pairs.withColumn("yi", F.lit(None).cast("int")).withColumn("pi", F.lit(None).cast("int"))
    else:
        truth = encoder.select(F.col("label").alias("__t"), F.col("label_idx").alias("yi"))
        guess = encoder.select(F.col("label").alias("__p"), F.col("label_idx").alias("pi"))
        coded = pairs.join(truth, F.col("classifier_gt") == F.col("__t"), "left").join(
            guess, F.col("classifier_pred") == F.col("__p"), "left"
        )
        unknown = F.col("yi").isNotNull() & F.col("pi").isNull()
        problem = F.concat(F.lit("prediction outside the label encoder: "), F.col("classifier_pred"))
        coded = coded.withColumn("pi", F.when(unknown, F.raise_error(problem).cast("int")).otherwise(F.col("pi")))

    known = F.col("yi").isNotNull()
    hit = known & (F.col("yi") == F.col("pi"))
    as_truth = F.struct(
        F.col("classifier_gt").alias("label"),
        F.col("yi").alias("idx"),
        *[F.col(c) for c in SUMMED],
        F.when(known, F.col("n")).otherwise(zero).alias("support"),
        zero.alias("predicted"),
        F.when(hit, F.col("n")).otherwise(zero).alias("correct"),
        F.when(known, F.struct(F.col("pi").alias("pi"), F.col("n").alias("n"))).alias("cell"),
    )
    nothing = [F.lit(None).cast(t).alias(c) for c, t in pairs.dtypes if c in SUMMED]
    no_cell = F.lit(None).cast("struct<pi:int,n:bigint>").alias("cell")
    as_pred = F.struct(
        F.when(known, F.col("classifier_pred")).alias("label"),
        F.when(known, F.col("pi")).alias("idx"),
        *nothing,
        zero.alias("support"),
        F.when(known, F.col("n")).otherwise(zero).alias("predicted"),
        zero.alias("correct"),
        no_cell,
    )
    rows = coded.select(F.inline(F.array(as_truth, as_pred)))
    if encoder is not None:
        rows = rows.unionByName(
            encoder.select(
                "label", F.col("label_idx").cast("int").alias("idx"), *nothing,
                zero.alias("support"), zero.alias("predicted"), zero.alias("correct"), no_cell,
            )
        )
    by_class = rows.groupBy("label", "idx").agg(
        *[F.sum(c).alias(c) for c in SUMMED],
        F.sum("support").alias("support"),
        F.sum("predicted").alias("predicted"),
        F.sum("correct").alias("hits_known"),
        F.map_from_entries(F.collect_list("cell")).alias("cells"),
    )
    # The classifier formulas read (label, support, predicted, hits); "hits" of the hybrid section is
    # renamed apart, and only encoder classes enter the classifier section.
    in_list = F.col("idx").isNotNull()
    staged = by_class.select(
        F.struct("label", "idx", *SUMMED).alias("h"),
        "cells",
        F.when(in_list, F.struct("label", "idx", "support", "predicted", F.col("hits_known").alias("hits"))).alias("c"),
    )
    final = staged.select("h.*", "c", "cells").agg(
        F.struct(*mobileclip_columns()).alias("mobileclip"),
        F.struct(*hybrid_columns()).alias("hybrid"),
        F.collect_list(F.when(F.col("c").isNotNull(), F.struct("c", "cells"))).alias("classes"),
    )
    report = final.withColumn("num_images", F.col("hybrid.num_images"))
    if encoder is not None:
        report = _classifier_section(report)
    sections = ["mobileclip", "hybrid"] + (["classifier"] if encoder is not None else [])
    empty = F.col("num_images") == 0
    failed = F.lit(0).cast("bigint") if failures is None else failures.agg(F.count(F.lit(1)).alias("n")).scalar()
    return report.select(
        F.when(empty, "no images processed successfully").alias("error"),
        *[F.when(~empty, F.col(s)).alias(s) for s in sections],
        failed.alias("num_failures"),
    )


def _classifier_section(report: DataFrame) -> DataFrame:
    """Add ``classifier`` from the one-row list of class sums (bounded by the class list)."""
    ordered = F.array_sort("classes", lambda a, b: a["c"]["idx"] - b["c"]["idx"])
    report = report.withColumn("classes", ordered)
    matrix = F.transform("classes", lambda row: _dense(row["cells"], F.size("classes")))
    spread = report.withColumn("confusion_matrix", matrix).select(
        "mobileclip", "hybrid", "num_images", "confusion_matrix", F.explode_outer("classes").alias("k")
    )
    classes = spread.select("mobileclip", "hybrid", "num_images", "confusion_matrix", "k.c.*")
    keep = ["mobileclip", "hybrid", "num_images", "confusion_matrix"]
    accuracy, macro, weighted = _summary_rows()
    return classes.agg(
        *[F.first(c).alias(c) for c in keep],
        F.struct(*_classification_columns()).alias("scores"),
        F.array_sort(F.collect_list(F.struct("idx", _per_class().alias("row")))).alias("listed"),
        accuracy.alias("acc"),
        macro.alias("macro"),
        weighted.alias("weighted"),
    ).select(
        "mobileclip",
        "hybrid",
        "num_images",
        F.struct(
            "scores.*",
            "confusion_matrix",
            F.concat(F.transform("listed", lambda x: x["row"]), F.array("acc", "macro", "weighted")).alias("per_category"),
        ).alias("classifier"),
    )


def _long(df: DataFrame, section: str, *keys: str) -> DataFrame:
    """(section, label, predicted, metric, value): one row per column of ``df`` that is no key."""
    entries = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in df.columns if c not in keys]
    named = [(F.col(c) if c in keys else F.lit(None)).cast("string").alias(c) for c in ("label", "predicted")]
    return df.select(F.lit(section).alias("section"), *named, F.inline(F.array(*entries)))


def report_table(df: DataFrame, encoder: DataFrame | None = None, failures: DataFrame | None = None, fallback: bool = False) -> DataFrame:
    """The figures of `metrics_report` as one long table (section, label, predicted, metric, value).

    No row grows with the class list: ``per_category`` has rows per class and for the three averages,
    ``confusion_matrix`` a row per cell above zero. The records are read once; their sums per (truth,
    prediction) are written, and every section is made of them. Without an encoder the three sections
    of the head are left out, without records all but ``run``. A prediction outside the encoder for a
    truth inside it is an error.
    """
    pairs = materialize(df.groupBy("classifier_gt", "classifier_pred").agg(*outcome_sums(fallback)), "report_pairs")
    per_truth = pairs.groupBy("classifier_gt").agg(*[F.sum(c).alias(c) for c in SUMMED])
    sections = [_long(pairs.agg(*mobileclip_columns()), "mobileclip"), _long(per_truth.agg(*hybrid_columns()), "hybrid")]
    if encoder is not None:
        truth = encoder.select(F.col("label").alias("y"))
        guess = encoder.select(F.col("label").alias("__known"))
        counts = pairs.select(F.col("classifier_gt").alias("y"), F.col("classifier_pred").alias("y_pred"), "n").join(truth, "y", "left_semi")
        problem = F.concat(F.lit("prediction outside the label encoder: "), F.coalesce("y_pred", F.lit("NULL")))
        checked = F.when(F.col("__known").isNull(), F.raise_error(problem).cast("string")).otherwise(F.col("y_pred"))
        counts = counts.join(guess, F.col("y_pred") == F.col("__known"), "left").select("y", checked.alias("y_pred"), "n")
        sums = class_sums(counts, encoder)
        sections += [
            _long(sums.agg(*_classification_columns()), "classifier"),
            _long(sums.select(_per_class().alias("c")).select("c.*"), "per_category", "label"),
            _long(sums.agg(F.array(*_summary_rows()).alias("rows")).select(F.inline("rows")), "per_category", "label"),
            _long(counts.select(F.col("y").alias("label"), F.col("y_pred").alias("predicted"), "n"), "confusion_matrix", "label", "predicted"),
        ]
    table = sections[0]
    for section in sections[1:]:
        table = table.unionByName(section)
    images = F.coalesce(pairs.agg(F.sum("n").alias("n")).scalar(), F.lit(0))
    failed = F.lit(0).cast("bigint") if failures is None else failures.agg(F.count(F.lit(1)).alias("n")).scalar()
    run = df.sparkSession.range(1).select(images.alias("num_images"), failed.alias("num_failures"))
    return table.filter(images > 0).unionByName(_long(run, "run"))
