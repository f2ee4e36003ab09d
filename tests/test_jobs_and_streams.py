import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.operators import metrics
from sightline.plans.evaluation import evaluate, recompute_report
from sightline.schemas import PREDICTION_FIELDS
from sightline.session import materialize, shared_dir
from sightline.sources import sinks
from sightline.streaming import jobs

PREDICTED = (
    "image_path string, mobileclip_top1 string, mobileclip_top2 string, classifier_pred string, yolo_detected boolean, "
    "mobileclip_ms double, classifier_ms double, pipeline_ms double, error string"
)


@pytest.fixture
def evaluated(frame):
    rows = [
        ("B/B_A1_IM1.png", "bolts", "x", "Fastener", True, 1.0, 2.0, 3.0, None),
        ("B/B_A2_IM2.png", "fastener", "x", "Other", False, 1.0, 2.0, 5.0, None),
        ("B/B_A9_IM3.png", "x", "y", "Other", True, 1.0, 2.0, 4.0, None),
        ("B/bad.png", "x", "y", "Other", True, 1.0, 2.0, 4.0, None),
        ("B/B_A1_IM4.png", None, None, None, None, None, None, None, "unreadable"),
    ]
    return evaluate(
        frame(rows, PREDICTED),
        frame([("A1", "Bolt"), ("A2", "Nut")], "object_id string, label string"),
        frame([("A1", "Fastener"), ("A2", "Fastener")], "object_id string, label string"),
        frame([("bolt", "bolts")], "category string, canonical string"),
        frame([(0, "Fastener"), (1, "Other")], "label_idx int, label string"),
    )


def test_evaluation(evaluated):
    records, failures, report = evaluated
    assert records.columns == PREDICTION_FIELDS
    got = {r.image: (r.object_id, r.mobileclip_gt, r.classifier_gt, r.hybrid_correct) for r in records.collect()}
    assert got == {
        "B_A1_IM1.png": ("A1", "bolts", "Fastener", True),
        "B_A2_IM2.png": ("A2", "nut", "Fastener", True),  # only through the fallback
        "B_A9_IM3.png": ("A9", "unknown", "UNKNOWN", False),
    }
    assert {r.image: r.error for r in failures.collect()} == {
        "B/bad.png": "Unexpected filename format: B/bad.png", "B/B_A1_IM4.png": "unreadable",
    }
    row = report.first()
    assert (row.num_failures, row.hybrid.num_images, row.classifier.num_samples) == (2, 3, 2)
    assert row.hybrid.hybrid_accuracy == pytest.approx(2 / 3) and row.classifier.accuracy == 0.5


def test_recompute_ignores_the_stored_flag(evaluated, frame, spark, tmp_path):
    records, _, report = evaluated
    encoder = frame([(0, "Fastener"), (1, "Other")], "label_idx int, label string")
    sinks.write_predictions(records, str(tmp_path / "p"))
    loose = recompute_report(spark, str(tmp_path / "p"), encoder, fallback=True).first()
    strict = recompute_report(spark, str(tmp_path / "p"), encoder, fallback=False).first()
    assert loose.hybrid == report.first().hybrid
    assert strict.hybrid.hybrid_accuracy == pytest.approx(1 / 3)
    assert strict.mobileclip.top1_accuracy == loose.mobileclip.top1_accuracy
    assert (strict.hybrid.mobileclip_only, loose.hybrid.mobileclip_only) == (0, 1)


def test_shared_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = shared_dir(spark, "x")
    assert "/sightline/x-" in path and path != shared_dir(spark, "x")
    if base:
        assert path.startswith(base)
    assert materialize(spark.range(5), "five").count() == 5


# --- streams ------------------------------------------------------------------------------------


def add_files(spark, path, start, stop, files=2):
    names = spark.range(start, stop).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("image_path"))
    names.repartition(files).write.mode("append").parquet(path)


def test_stream_embed_resumes_and_keeps_failures(spark, tmp_path):
    def one_encoder():
        def encode(part):
            if (part["image_path"] == "p13").any():
                raise ValueError("bad row")
            return np.array([[float(len(p)), 1.0] for p in part["image_path"]])

        return encode

    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    add_files(spark, source, 0, 10)

    def run():
        rows = jobs.read_folder(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
        jobs.stream_embed(rows, one_encoder, out, checkpoint).awaitTermination()

    run()
    run()  # nothing new: nothing happens
    assert spark.read.parquet(out).count() == 10
    add_files(spark, source, 10, 20)
    run()
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 20 and {r.image_path for r in rows} == {f"p{i}" for i in range(20)}
    assert [(r.image_path, r.error) for r in rows if r.status == "failed"] == [("p13", "ValueError('bad row')")]


def test_stream_progress_equals_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("B/B_1_IM1.png",)] * 7 + [("B/bad.png",)] * 3, "image_path string").repartition(4).write.parquet(source)
    rows = jobs.read_folder(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    jobs.stream_progress(rows, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert {r.status: r.n for r in jobs.latest_state(spark, str(tmp_path / "out")).collect()} == {"processed": 7, "failed": 3}


def test_stream_metrics_equal_batch(spark, tmp_path):
    from test_metrics import SCHEMA, random_rows

    source = str(tmp_path / "in")
    records = spark.createDataFrame(random_rows(200), SCHEMA)
    records.repartition(3).write.parquet(source)
    rows = jobs.read_folder(spark, source, records.schema, files_per_batch=1)
    jobs.stream_metrics(rows, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    streamed = jobs.finish_metrics(jobs.latest_state(spark, str(tmp_path / "out"))).first()
    assert streamed.asDict() == pytest.approx(metrics.hybrid_metrics(records).first().asDict())


def test_stream_predictions_equal_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    add_files(spark, source, 0, 12, files=3)
    predict = lambda df: df.withColumn("mobileclip_top1", F.upper("image_path"))
    rows = jobs.read_folder(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    jobs.stream_predictions(rows, predict, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    batch = {tuple(r) for r in predict(spark.read.parquet(source)).collect()}
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == batch
