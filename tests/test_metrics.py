import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sightline.functions import outcomes
from sightline.operators import metrics

SCHEMA = (
    "mobileclip_gt string, mobileclip_top1 string, mobileclip_top2 string, classifier_gt string, classifier_pred string, "
    "yolo_detected boolean, mobileclip_ms double, pipeline_ms double"
)


def records(frame, rows):
    return frame([(*r[:5], *(r[5:] or (None, None, None))) for r in rows], SCHEMA)


BOTH = ("Screw", "Screw", "Bolt", "Fastener", "Fastener")
SECOND = ("Screw", "Bolt", "Screw", "Fastener", "Fastener")
ZERO_SHOT = ("Screw", "Screw", "Bolt", "Fastener", "Nut")
HEAD = ("Screw", "Bolt", "Nut", "Fastener", "Fastener")
NEITHER = ("Screw", "Bolt", "Bolt", "Fastener", "Nut")


@pytest.mark.parametrize(
    "row, source",
    [(BOTH, "both"), (SECOND, "both"), (ZERO_SHOT, "mobileclip_only"), (HEAD, "classifier_only"), (NEITHER, "neither")],
)
def test_or_rule_and_sources(frame, row, source):
    out = records(frame, [row]).select(outcomes.hybrid_correct().alias("h"), outcomes.correct_source().alias("s")).first()
    assert (out.h, out.s) == (source != "neither", source)


@pytest.mark.parametrize(
    "row, strict, loose",
    [
        (("bullet casings", "bullet", "shell", "bullet", "bullet"), False, True),
        (("manufactured wood", "wood", "metal", "wood", "wood"), False, True),
        (("tire chunks", "rubber chunks", "plastic", "tire chunks", "tire chunks"), False, False),
        (("Bullet Casings", "bullet", "shell", "Bullet_Casings", "x"), False, False),
        (("Bullet Casings", "bullet", "shell", " Bullet", "x"), False, True),
        (("a", "x", "bullet casings", "Bullet_Casings", "x"), False, True),
        (("a", None, "b", "c", "d"), False, False),
        ((None, None, "b", "c", "d"), True, True),
        (("a", "none", "b", None, "d"), False, True),
    ],
)
def test_fallback(frame, row, strict, loose):
    out = records(frame, [row]).select(
        outcomes.mobileclip_correct().alias("s"), outcomes.mobileclip_correct(True).alias("l")
    ).first()
    assert (out.s, out.l) == (strict, loose)


def test_missing_labels_are_equal(frame):
    row = records(frame, [("a", "b", "c", None, None)]).select(outcomes.classifier_correct().alias("c")).first()
    assert row.c is True


def test_top1_top2(frame):
    row = metrics.mobileclip_metrics(records(frame, [BOTH, SECOND, HEAD])).first()
    assert (row.top1_accuracy, row.top2_accuracy, row.num_images) == (pytest.approx(1 / 3), pytest.approx(2 / 3), 3)
    assert row.average_inference_ms is None


def test_hybrid_and_balanced_accuracy(frame):
    df = records(
        frame,
        [
            (*BOTH, True, 1.0, 10.0),
            ("Screw", "Bolt", "Nut", "Fastener", "Nut", False, None, 20.0),
            ("Nail", "Nail", "Bolt", "Fastener", "Fastener", None, 3.0, None),
            ("Wire", "Wire", "Bolt", "Wire", "Wire", True, 2.0, None),
        ],
    )
    row = metrics.hybrid_metrics(df).first()
    assert row.hybrid_accuracy == pytest.approx(3 / 4)
    assert row.hybrid_balanced_accuracy == pytest.approx((2 / 3 + 1) / 2)
    assert (row.neither, row.both, row.mobileclip_only, row.classifier_only) == (1, 3, 0, 0)
    assert row.average_pipeline_ms == 15.0 and row.yolo_detection_rate == pytest.approx(2 / 3)
    assert metrics.mobileclip_metrics(df).first().average_inference_ms == 2.0
    assert metrics.hybrid_balanced_accuracy(df).first().hybrid_balanced_accuracy == pytest.approx((2 / 3 + 1) / 2)


def test_empty_input(frame):
    empty = records(frame, [])
    zero_shot, hybrid = metrics.mobileclip_metrics(empty).first(), metrics.hybrid_metrics(empty).first()
    assert (zero_shot.top1_accuracy, zero_shot.top2_accuracy, zero_shot.num_images) == (0.0, 0.0, 0)
    assert (hybrid.hybrid_accuracy, hybrid.hybrid_balanced_accuracy, hybrid.neither) == (0.0, 0.0, 0)
    assert hybrid.average_pipeline_ms is None and hybrid.yolo_detection_rate is None
    report = metrics.metrics_report(empty, frame([(0, "a")], "label_idx int, label string")).first()
    assert report.error == "no images processed successfully" and report.hybrid is None and report.num_failures == 0


def random_rows(n=400, seed=3):
    rng = random.Random(seed)
    fine, coarse = ["a", "b", "c", "d"], ["A", "B", "C", "only_truth", "UNKNOWN"]
    rows = []
    for _ in range(n):
        truth = rng.choice(coarse)
        rows.append(
            (
                rng.choice(fine), rng.choice(fine), rng.choice(fine), truth, rng.choice(["A", "B", "C", "only_pred"]),
                rng.choice([True, False, None]), rng.choice([None, 1.0, 2.0]), rng.choice([None, 5.0, 7.0]),
            )
        )
    return rows


ENCODER = ["A", "B", "C", "only_pred", "only_truth", "unseen"]


def loop_metrics(pairs, classes):
    """Plain-loop precision, recall, F1 and support of each class."""
    truth, pred, hit = Counter(t for t, _ in pairs), Counter(p for _, p in pairs), Counter(t for t, p in pairs if t == p)
    out = {}
    for c in classes:
        p = hit[c] / pred[c] if pred[c] else 0.0
        r = hit[c] / truth[c] if truth[c] else 0.0
        out[c] = (p, r, 2 * p * r / (p + r) if p + r else 0.0, truth[c])
    return out


def test_three_class_lists(frame):
    """A class seen only as prediction, one seen only as truth, and one never seen."""
    rows = random_rows()
    known = [(r[3], r[4]) for r in rows if r[3] in ENCODER]
    df = records(frame, rows).filter(F.col("classifier_gt") != "UNKNOWN")
    encoder = frame(list(enumerate(ENCODER)), "label_idx int, label string")
    counts = metrics.confusion_counts(df, "classifier_gt", "classifier_pred")
    seen = sorted({c for pair in known for c in pair})
    by_class = loop_metrics(known, seen)
    in_truth = [c for c in seen if by_class[c][3]]
    n = len(known)

    row = metrics.classification_metrics(counts).first()
    assert row.num_samples == n
    assert row.accuracy == pytest.approx(sum(t == p for t, p in known) / n)
    assert row.balanced_accuracy == pytest.approx(sum(by_class[c][1] for c in in_truth) / len(in_truth))
    for i, name in enumerate(["precision", "recall", "f1"]):
        assert row[f"macro_{name}"] == pytest.approx(sum(v[i] for v in by_class.values()) / len(seen))
        assert row[f"weighted_{name}"] == pytest.approx(sum(v[i] * v[3] for v in by_class.values()) / n)
    assert row.macro_recall != pytest.approx(row.balanced_accuracy)

    full = loop_metrics(known, ENCODER)
    report = {r.label: r for r in metrics.classification_report(counts, encoder).collect()}
    for c in ENCODER:
        assert tuple(report[c])[1:] == pytest.approx(full[c])
    assert report["macro avg"].recall == pytest.approx(sum(v[1] for v in full.values()) / len(ENCODER))
    assert report["weighted avg"].precision == pytest.approx(row.weighted_precision)
    assert report["accuracy"].f1_score == pytest.approx(row.accuracy)

    cells = {(r.true_idx, r.pred_idx): r.n for r in metrics.confusion_matrix(counts, encoder).collect()}
    assert len(cells) == len(ENCODER) ** 2
    want = Counter((ENCODER.index(t), ENCODER.index(p)) for t, p in known)
    assert {k: v for k, v in cells.items() if v} == dict(want)


@pytest.mark.parametrize("fallback", [False, True])
def test_report_equals_its_parts(frame, fallback):
    rows = random_rows(seed=8)
    df = records(frame, rows)
    encoder = frame(list(enumerate(ENCODER)), "label_idx int, label string")
    failures = frame([("x", "e"), ("y", "e")], "image string, error string")
    report = metrics.metrics_report(df, encoder, failures, fallback).first()
    assert report.error is None and report.num_failures == 2
    assert report.mobileclip.asDict() == pytest.approx(metrics.mobileclip_metrics(df, fallback).first().asDict())
    assert report.hybrid.asDict() == pytest.approx(metrics.hybrid_metrics(df, fallback).first().asDict())
    counts = metrics.confusion_counts(df.filter("classifier_gt <> 'UNKNOWN'"), "classifier_gt", "classifier_pred")
    section = report.classifier.asDict()
    matrix, per_category = section.pop("confusion_matrix"), section.pop("per_category")
    assert section == pytest.approx(metrics.classification_metrics(counts).first().asDict())
    rows_by_class = {r.label: tuple(r)[1:] for r in metrics.classification_report(counts, encoder).collect()}
    assert [r.label for r in per_category] == [*ENCODER, "accuracy", "macro avg", "weighted avg"]
    for r in per_category:
        assert tuple(r)[1:] == pytest.approx(rows_by_class[r.label])
    want = Counter((ENCODER.index(r[3]), ENCODER.index(r[4])) for r in rows if r[3] in ENCODER)
    assert matrix == [[want[(i, j)] for j in range(len(ENCODER))] for i in range(len(ENCODER))]


def test_report_sections(frame):
    df = records(frame, [BOTH])
    assert "classifier" not in metrics.metrics_report(df).columns
    report = metrics.metrics_report(df, frame([(0, "Fastener")], "label_idx int, label string")).first()
    assert report.classifier.accuracy == 1.0 and report.classifier.confusion_matrix == [[1]]


def test_prediction_outside_the_encoder_is_an_error(frame):
    encoder = frame([(0, "Fastener")], "label_idx int, label string")
    with pytest.raises(Exception, match="prediction outside the label encoder: Nut"):
        metrics.metrics_report(records(frame, [NEITHER]), encoder).collect()


def test_report_reads_the_records_once(frame, spark, tmp_path):
    records(frame, random_rows()).write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    plan = metrics.metrics_report(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_hot_class_is_summed_before_the_shuffle(frame):
    plan = metrics.hybrid_metrics(records(frame, [BOTH]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Window" not in plan


def test_fallback_delta(frame):
    df = records(frame, [("bullet casings", "bullet", "shell", "bullet", "x"), ("a", "a", "b", "bullet", "x"), ("a", "b", "c", "k", "k")])
    out = {r.classifier_gt: tuple(r)[1:] for r in metrics.fallback_delta(df).collect()}
    assert out == {"bullet": (2, 1, 2, 1, 1, 2), "k": (1, 0, 0, 0, 1, 1)}


def test_source_breakdown_keeps_zeros(frame):
    out = {r.correct_source: r.n for r in metrics.source_breakdown(records(frame, [BOTH, HEAD, HEAD])).collect()}
    assert out == {"both": 1, "mobileclip_only": 0, "classifier_only": 2, "neither": 0}


def test_class_universe(frame):
    df = records(frame, [BOTH, NEITHER])
    assert {r.label for r in metrics.class_universe(df, "classifier_gt", "classifier_pred").collect()} == {"Fastener", "Nut"}


def test_balanced_accuracy_by_loop(frame):
    rows = random_rows(seed=5)
    hits = defaultdict(list)
    for r in rows:
        hits[r[3]].append(r[0] in (r[1], r[2]) or r[3] == r[4])
    want = sum(sum(v) / len(v) for v in hits.values()) / len(hits)
    assert metrics.hybrid_balanced_accuracy(records(frame, rows)).first().hybrid_balanced_accuracy == pytest.approx(want)


@pytest.mark.parametrize("fallback", [False, True])
def test_long_report_equals_the_nested_one(frame, fallback):
    df = records(frame, random_rows(seed=11))
    encoder = frame(list(enumerate(ENCODER)), "label_idx int, label string")
    failures = frame([("x", "e")], "image string, error string")
    nested = metrics.metrics_report(df, encoder, failures, fallback).first()
    got = {tuple(r)[:4]: r.value for r in metrics.report_table(df, encoder, failures, fallback).collect()}
    want = {("run", None, None, "num_images"): nested.hybrid.num_images, ("run", None, None, "num_failures"): 1}
    section = nested.classifier.asDict()
    matrix, per_category = section.pop("confusion_matrix"), section.pop("per_category")
    for name, figures in (("mobileclip", nested.mobileclip.asDict()), ("hybrid", nested.hybrid.asDict()), ("classifier", section)):
        want |= {(name, None, None, metric): value for metric, value in figures.items()}
    for row in per_category:
        want |= {("per_category", row.label, None, m): row[m] for m in ("precision", "recall", "f1_score", "support")}
    cells = {(ENCODER[i], ENCODER[j]): n for i, line in enumerate(matrix) for j, n in enumerate(line) if n}
    want |= {("confusion_matrix", y, p, "n"): n for (y, p), n in cells.items()}
    assert got == pytest.approx(want)


def test_long_report_without_records_or_encoder(frame):
    encoder = frame([(0, "Fastener")], "label_idx int, label string")
    empty = metrics.report_table(records(frame, [BOTH]).limit(0), encoder).collect()
    assert sorted(tuple(r) for r in empty) == [("run", None, None, "num_failures", 0.0), ("run", None, None, "num_images", 0.0)]
    assert {r.section for r in metrics.report_table(records(frame, [BOTH])).collect()} == {"mobileclip", "hybrid", "run"}
    with pytest.raises(Exception, match="prediction outside the label encoder: Nut"):
        metrics.report_table(records(frame, [NEITHER]), encoder).collect()


def test_both_settings_from_one_scan(frame, spark, tmp_path):
    records(frame, random_rows(seed=12)).write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    for both, one in ((metrics.mobileclip_metrics_by_fallback, metrics.mobileclip_metrics), (metrics.hybrid_metrics_by_fallback, metrics.hybrid_metrics)):
        out = both(stored)
        assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
        got = {r.fallback: r.asDict() for r in out.collect()}
        for flag in (False, True):
            assert got[flag] == pytest.approx({"fallback": flag, **one(stored, flag).first().asDict()})
