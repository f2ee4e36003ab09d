"""Queries on outcomes, metrics and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.catalog import fixtures as fx
from sightline.catalog.registry import r6, register
from sightline.functions import outcomes
from sightline.operators import labels, metrics, quantiles, training
from sightline.plans.evaluation import recompute_report
from sightline.schemas import SOURCES
from sightline.session import materialize, shared_dir
from sightline.sources import sinks
from sightline.sources.tables import parse_prediction_types


@register("hybrid_candidates", "SELECT image, array_to_string([mobileclip_top1, mobileclip_top2, classifier_pred], '|') AS candidates FROM fx_predictions")
def hybrid_candidates(spark, d):
    return fx.predictions(spark, d).select("image", F.array_join(outcomes.hybrid_candidates(), "|").alias("candidates"))


@register("mobileclip_correct", "SELECT image, strict_hit AS strict, loose_hit AS with_fallback FROM fx_flags")
def mobileclip_correct(spark, d):
    return fx.predictions(spark, d).select(
        "image",
        outcomes.mobileclip_correct(False).alias("strict"),
        outcomes.mobileclip_correct(True).alias("with_fallback"),
    )


@register("classifier_correct", "SELECT image, head_hit AS classifier_correct FROM fx_flags")
def classifier_correct(spark, d):
    return fx.predictions(spark, d).select("image", outcomes.classifier_correct().alias("classifier_correct"))


@register("hybrid_correct", "SELECT image, strict_hit OR head_hit AS strict, loose_hit OR head_hit AS with_fallback FROM fx_flags")
def hybrid_correct(spark, d):
    return fx.predictions(spark, d).select(
        "image", outcomes.hybrid_correct(False).alias("strict"), outcomes.hybrid_correct(True).alias("with_fallback")
    )


SOURCE = "CASE WHEN {hit} AND head_hit THEN 'both' WHEN {hit} THEN 'mobileclip_only' WHEN head_hit THEN 'classifier_only' ELSE 'neither' END"


@register(
    "correct_source",
    f"SELECT image, {SOURCE.format(hit='strict_hit')} AS strict, {SOURCE.format(hit='loose_hit')} AS with_fallback FROM fx_flags",
)
def correct_source(spark, d):
    return fx.predictions(spark, d).select(
        "image", outcomes.correct_source(False).alias("strict"), outcomes.correct_source(True).alias("with_fallback")
    )


def as_text(df):
    """Prediction records as a CSV file holds them."""
    flag = F.when(F.col("yolo_detected").isNull(), "").when(F.col("yolo_detected"), "True").otherwise("false")
    timings = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("mobileclip_ms", "classifier_ms", "pipeline_ms")]
    return df.withColumn("yolo_detected", flag).select(
        "image", "object_id", "classifier_gt", "classifier_pred", "yolo_detected", *timings
    )


@register(
    "parse_prediction_types",
    "SELECT image, object_id, classifier_gt, classifier_pred, yolo_detected, mobileclip_ms, round(classifier_ms, 6) AS classifier_ms, round(pipeline_ms, 6) AS pipeline_ms FROM fx_predictions",
)
def parse_prediction_types_query(spark, d):
    typed = parse_prediction_types(as_text(fx.predictions(spark, d)))
    kept = typed.select("image", "object_id", "classifier_gt", "classifier_pred", "yolo_detected", "mobileclip_ms", "classifier_ms", "pipeline_ms")
    return rounded(kept, ["classifier_ms", "pipeline_ms"])


MOBILECLIP = """round(avg(CASE WHEN top1_correct THEN 1.0::DOUBLE ELSE 0 END), 6) AS top1_accuracy, round(avg(CASE WHEN {hit} THEN 1.0::DOUBLE ELSE 0 END), 6) AS top2_accuracy,
  count(*) AS num_images, round(avg(mobileclip_ms), 6) AS average_inference_ms"""


@register(
    "mobileclip_metrics",
    f"SELECT false AS fallback, {MOBILECLIP.format(hit='strict_hit')} FROM fx_flags UNION ALL SELECT true, {MOBILECLIP.format(hit='loose_hit')} FROM fx_flags",
)
def mobileclip_metrics(spark, d):
    return rounded(metrics.mobileclip_metrics_by_fallback(fx.predictions(spark, d)), ["top1_accuracy", "top2_accuracy", "average_inference_ms"])


def hybrid_sql(hit: str, prefix: str = "") -> str:
    source = SOURCE.format(hit=hit)
    counts = ", ".join(f"count(*) FILTER (WHERE {source} = '{name}') AS \"{name}\"" for name in SOURCES)
    balanced = f"(SELECT avg(a) FROM (SELECT avg(CASE WHEN {hit} OR head_hit THEN 1.0::DOUBLE ELSE 0 END) AS a FROM fx_flags GROUP BY classifier_gt) q)"
    return f"""round(avg(CASE WHEN {hit} OR head_hit THEN 1.0::DOUBLE ELSE 0 END), 6) AS hybrid_accuracy, round({balanced}, 6) AS hybrid_balanced_accuracy,
  count(*) AS num_images, {counts}, round(avg(pipeline_ms), 6) AS average_pipeline_ms,
  round(avg(CASE WHEN yolo_detected THEN 1.0::DOUBLE WHEN yolo_detected IS NOT NULL THEN 0 END), 6) AS yolo_detection_rate"""


HYBRID_RATES = ["hybrid_accuracy", "hybrid_balanced_accuracy", "average_pipeline_ms", "yolo_detection_rate"]


def rounded(df, names):
    return df.withColumns({name: r6(name) for name in names})


@register(
    "hybrid_metrics",
    f"SELECT false AS fallback, {hybrid_sql('strict_hit')} FROM fx_flags UNION ALL SELECT true, {hybrid_sql('loose_hit')} FROM fx_flags",
)
def hybrid_metrics(spark, d):
    return rounded(metrics.hybrid_metrics_by_fallback(fx.predictions(spark, d)), HYBRID_RATES)


@register(
    "hybrid_balanced_accuracy",
    "SELECT round(avg(a), 6) AS hybrid_balanced_accuracy, count(*) AS classes FROM (SELECT avg(CASE WHEN strict_hit OR head_hit THEN 1.0::DOUBLE ELSE 0 END) AS a FROM fx_flags GROUP BY classifier_gt) t",
)
def hybrid_balanced_accuracy(spark, d):
    return rounded(metrics.hybrid_balanced_accuracy(fx.predictions(spark, d)), ["hybrid_balanced_accuracy"])


@register(
    "source_breakdown",
    f"""SELECT s AS correct_source, count(f.image) AS n FROM (SELECT unnest(['both', 'mobileclip_only', 'classifier_only', 'neither']) AS s) a
LEFT JOIN (SELECT image, {SOURCE.format(hit='strict_hit')} AS source FROM fx_flags) f ON f.source = a.s GROUP BY s""",
)
def source_breakdown(spark, d):
    return metrics.source_breakdown(fx.predictions(spark, d))


@register(
    "fallback_delta",
    """SELECT classifier_gt, count(*) AS n, count(*) FILTER (WHERE strict_hit) AS strict_hits, count(*) FILTER (WHERE loose_hit) AS fallback_hits,
  count(*) FILTER (WHERE loose_hit AND NOT strict_hit) AS recovered, count(*) FILTER (WHERE strict_hit OR head_hit) AS strict_hybrid_hits,
  count(*) FILTER (WHERE loose_hit OR head_hit) AS fallback_hybrid_hits FROM fx_flags GROUP BY classifier_gt""",
)
def fallback_delta(spark, d):
    return metrics.fallback_delta(fx.predictions(spark, d))


@register(
    "encode_labels_join",
    """SELECT image, t.label_idx AS y, p.label_idx AS y_pred FROM fx_predictions LEFT JOIN fx_encoder t ON t.label = classifier_gt
LEFT JOIN fx_encoder p ON p.label = classifier_pred""",
)
def encode_labels_join(spark, d):
    encoder = materialize(fx.type_encoder(spark, d), "encoder")
    truth = labels.encode_labels(fx.predictions(spark, d), encoder, "classifier_gt", "y")
    return labels.encode_labels(truth, encoder, "classifier_pred", "y_pred").select("image", "y", "y_pred")


@register("known_class_filter", "SELECT image, classifier_gt FROM fx_predictions WHERE classifier_gt IN (SELECT label FROM fx_encoder)")
def known_class_filter(spark, d):
    encoder = materialize(fx.type_encoder(spark, d), "encoder")
    return labels.known_class_filter(fx.predictions(spark, d), encoder).select("image", "classifier_gt")


@register("skipped_unknown", "SELECT count(*) AS skipped FROM fx_predictions WHERE classifier_gt NOT IN (SELECT label FROM fx_encoder)")
def skipped_unknown(spark, d):
    return labels.skipped_unknown(fx.predictions(spark, d), fx.type_encoder(spark, d))


@register("class_universe", "SELECT classifier_gt AS label FROM fx_predictions UNION SELECT classifier_pred FROM fx_predictions")
def class_universe(spark, d):
    return metrics.class_universe(fx.predictions(spark, d), "classifier_gt", "classifier_pred")


def known_counts(spark, d):
    """Confusion counts of the records whose truth is in the encoder; the filter works on the counts."""
    counts = metrics.confusion_counts(fx.predictions(spark, d), "classifier_gt", "classifier_pred")
    return labels.known_class_filter(counts, fx.type_encoder(spark, d), "y")


@register(
    "confusion_matrix",
    """SELECT t.label_idx AS true_idx, p.label_idx AS pred_idx, coalesce(n, 0) AS n FROM fx_encoder t CROSS JOIN fx_encoder p
LEFT JOIN fx_pairs ON y = t.label AND y_pred = p.label""",
)
def confusion_matrix(spark, d):
    return metrics.confusion_matrix(known_counts(spark, d), fx.type_encoder(spark, d))


CLASS_SCORES = """round(sum(hits) / sum(support), 6) AS accuracy, round(avg(r) FILTER (WHERE support > 0), 6) AS balanced_accuracy,
  round(avg(p) FILTER (WHERE support + predicted > 0), 6) AS macro_precision, round(sum(p * support) / sum(support), 6) AS weighted_precision,
  round(avg(r) FILTER (WHERE support + predicted > 0), 6) AS macro_recall, round(sum(r * support) / sum(support), 6) AS weighted_recall,
  round(avg(f) FILTER (WHERE support + predicted > 0), 6) AS macro_f1, round(sum(f * support) / sum(support), 6) AS weighted_f1, CAST(sum(support) AS BIGINT) AS num_samples"""
SCORE_NAMES = [
    "accuracy", "balanced_accuracy", "macro_precision", "weighted_precision", "macro_recall", "weighted_recall", "macro_f1", "weighted_f1",
]


@register("classification_metrics", f"SELECT {CLASS_SCORES} FROM fx_rates")
def classification_metrics(spark, d):
    return rounded(metrics.classification_metrics(known_counts(spark, d)), SCORE_NAMES)


REPORT_ROWS = """SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1_score, support FROM fx_rates
UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM fx_rates
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM fx_rates
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM fx_rates"""


@register("classification_report", REPORT_ROWS)
def classification_report(spark, d):
    report = metrics.classification_report(known_counts(spark, d), fx.type_encoder(spark, d))
    return rounded(report, ["precision", "recall", "f1_score"])


def flat_report(report):
    """A report's numbers as plain columns."""
    return rounded(
        report.select(
            "mobileclip.top1_accuracy", "mobileclip.top2_accuracy", "mobileclip.average_inference_ms",
            "hybrid.*", "num_failures", *[f"classifier.{name}" for name in SCORE_NAMES], "classifier.num_samples",
            F.array_join(F.transform("classifier.confusion_matrix", lambda row: F.array_join(row, ",")), ";").alias("matrix"),
        ),
        ["top1_accuracy", "top2_accuracy", "average_inference_ms", *HYBRID_RATES, *SCORE_NAMES],
    )


def report_sql(hit: str, failures: str) -> str:
    mobileclip = MOBILECLIP.format(hit=hit).replace("count(*) AS num_images, ", "")
    matrix = """(SELECT string_agg(line, ';' ORDER BY label_idx) FROM (SELECT t.label_idx, string_agg(CAST(coalesce(n, 0) AS VARCHAR), ',' ORDER BY p.label_idx) AS line
  FROM fx_encoder t CROSS JOIN fx_encoder p LEFT JOIN fx_pairs ON y = t.label AND y_pred = p.label GROUP BY t.label_idx) m) AS matrix"""
    return f"""SELECT a.*, c.*, {failures} AS num_failures, {matrix} FROM (SELECT {mobileclip}, {hybrid_sql(hit)} FROM fx_flags) a, (SELECT {CLASS_SCORES} FROM fx_rates) c"""


@register("metrics_report", report_sql("strict_hit", "(SELECT count(*) FROM fx_manifest WHERE image_path LIKE '%malformed%')"))
def metrics_report(spark, d):
    failures = fx.manifest(spark, d).filter(F.contains("image_path", F.lit("malformed")))
    return flat_report(metrics.metrics_report(fx.predictions(spark, d), fx.type_encoder(spark, d), failures))


def long_sql(section: str, names: list[str], sql: str, label: str = "NULL::VARCHAR", predicted: str = "NULL::VARCHAR") -> str:
    """The named columns of a statement as rows of the long report."""
    listed, values = ", ".join(f"'{n}'" for n in names), ", ".join(f'"{n}"::DOUBLE' for n in names)
    return f"SELECT '{section}' AS section, {label} AS label, {predicted} AS predicted, unnest([{listed}]) AS metric, round(unnest([{values}]), 6) AS value FROM ({sql}) t"


REPORT_TABLE = " UNION ALL ".join(
    [
        long_sql("mobileclip", ["top1_accuracy", "top2_accuracy", "num_images", "average_inference_ms"], f"SELECT {MOBILECLIP.format(hit='strict_hit')} FROM fx_flags"),
        long_sql("hybrid", ["num_images", *SOURCES, *HYBRID_RATES], f"SELECT {hybrid_sql('strict_hit')} FROM fx_flags"),
        long_sql("classifier", [*SCORE_NAMES, "num_samples"], f"SELECT {CLASS_SCORES} FROM fx_rates"),
        long_sql("per_category", ["precision", "recall", "f1_score", "support"], REPORT_ROWS, "label"),
        long_sql("confusion_matrix", ["n"], "SELECT * FROM fx_pairs", "y", "y_pred"),
        long_sql("run", ["num_images", "num_failures"], "SELECT (SELECT count(*) FROM fx_predictions) AS num_images, (SELECT count(*) FROM fx_manifest WHERE image_path LIKE '%malformed%') AS num_failures"),
    ]
)


@register("report_table", REPORT_TABLE)
def report_table(spark, d):
    failures = fx.manifest(spark, d).filter(F.contains("image_path", F.lit("malformed")))
    return rounded(metrics.report_table(fx.predictions(spark, d), fx.type_encoder(spark, d), failures), ["value"])


def saved_predictions(spark, d, fallback=False):
    """The prediction records, written by the sink; returns the folder."""
    path = shared_dir(spark, "predictions")
    records = fx.predictions(spark, d).withColumn("hybrid_correct", outcomes.hybrid_correct(fallback))
    sinks.write_predictions(records, path)
    return path


@register("recompute_report", report_sql("loose_hit", "0::BIGINT"))
def recompute_report_query(spark, d):
    """Saved without the fallback, recomputed with it."""
    path = saved_predictions(spark, d, fallback=False)
    return flat_report(recompute_report(spark, path, fx.type_encoder(spark, d), fallback=True))


@register(
    "latency_summary",
    """SELECT stage, round(avg(ms), 6) AS average_latency_ms, round(quantile_cont(ms, 0.5), 6) AS median_latency_ms, min(ms) AS min_latency_ms, max(ms) AS max_latency_ms,
  round(quantile_cont(ms, 0.95), 6) AS p95_latency_ms, round(1000 / avg(ms), 6) AS throughput_images_per_sec FROM fx_latency GROUP BY stage""",
)
def latency_summary(spark, d):
    summary = quantiles.latency_summary(fx.latency(spark, d), ["stage"])
    return rounded(summary, ["average_latency_ms", "median_latency_ms", "p95_latency_ms", "throughput_images_per_sec"])


@register(
    "per_image_latency",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(o_totalprice / count(*) OVER (PARTITION BY l_orderkey), 6) AS latency_ms
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)
def per_image_latency(spark, d):
    images = fx.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    batches = fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("ms"))
    return rounded(quantiles.per_image_latency(images, batches, "l_orderkey", "ms"), ["latency_ms"])


@register(
    "epoch_accuracy",
    """SELECT run_id, epoch, count(*) FILTER (WHERE y = y_pred) AS correct, count(*) AS total, round(avg(CASE WHEN y = y_pred THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy
FROM fx_scored GROUP BY run_id, epoch""",
)
def epoch_accuracy(spark, d):
    scored = training.epoch_accuracy(fx.scored_events(spark, d), ["run_id", "epoch"], "y", "y_pred")
    return rounded(scored, ["accuracy"])


@register(
    "early_stopping",
    """SELECT run_id, CAST(last AS INTEGER) AS best_epoch, round(best, 6) AS best_val_accuracy, epoch AS last_epoch, ever AS stopped_early FROM
(SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY CASE WHEN epoch - last >= 10 THEN 0 ELSE 1 END, CASE WHEN epoch - last >= 10 THEN epoch ELSE -epoch END) AS pick,
  bool_or(epoch - last >= 10) OVER (PARTITION BY run_id) AS ever FROM
 (SELECT *, coalesce(max(CASE WHEN val_accuracy > before THEN epoch END) OVER (PARTITION BY run_id ORDER BY epoch), 0) AS last, greatest(before, val_accuracy) AS best FROM
  (SELECT *, greatest(0, coalesce(max(val_accuracy) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS before FROM fx_history) a) b) c
WHERE pick = 1""",
)
def early_stopping(spark, d):
    return rounded(training.early_stopping(fx.history(spark, d)), ["best_val_accuracy"])
