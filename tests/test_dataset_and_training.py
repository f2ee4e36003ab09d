import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.operators import dataset, quantiles, training
from sightline.plans.preparation import prepare


def labelled(frame, counts):
    rows = [(f"{label}{i}", label) for label, n in counts.items() for i in range(n)]
    random.Random(1).shuffle(rows)
    return frame(rows, "key string, label string")


def expected_split(counts, val_size=0.1, seed=42):
    """Largest-remainder quotas and the smallest hashes of each class, by plain loops."""
    total = sum(counts.values())
    val = math.ceil(total * val_size)
    base = {c: n * val // total for c, n in counts.items()}
    rest = sorted(counts, key=lambda c: (-(counts[c] * val % total), c))
    for c in rest[: val - sum(base.values())]:
        base[c] += 1
    chosen = set()
    for c, n in counts.items():
        keys = sorted((hashlib.md5(f"{seed}:{c}{i}".encode()).hexdigest(), f"{c}{i}") for i in range(n))
        chosen |= {k for _, k in keys[: base[c]]}
    return chosen


@pytest.mark.parametrize(
    "counts, val_size",
    [
        ({c: 20 for c in "abcde"}, 0.1),
        ({"hot": 2000, "b": 31, "c": 7, "d": 2}, 0.1),
        ({"a": 3, "b": 3, "c": 5}, 0.5),
    ],
)
def test_split_is_exact(frame, counts, val_size):
    df = labelled(frame, counts)
    out = dataset.stratified_split(df, "label", "key", val_size).collect()
    assert len(out) == sum(counts.values())
    assert {r.key for r in out if r.split == "val"} == expected_split(counts, val_size)


def test_ninety_ten(frame):
    out = dataset.stratified_split(labelled(frame, {c: 20 for c in "abcde"}), "label", "key").collect()
    assert Counter(r.split for r in out) == {"train": 90, "val": 10}
    assert Counter(r.label for r in out if r.split == "val") == {c: 2 for c in "abcde"}


def test_split_passes_over_the_data_do_not_shuffle_it(frame, spark, tmp_path):
    labelled(frame, {"hot": 500, "b": 50}).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    plan = dataset.stratified_split(df, "label", "key")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize(
    "counts, message",
    [({"a": 30, "b": 1}, "fewer than 2 rows"), ({c: 2 for c in "abcd"}, "fewer rows than classes")],
)
def test_split_errors(frame, counts, message):
    with pytest.raises(Exception, match=message):
        dataset.stratified_split(labelled(frame, counts), "label", "key").collect()


def test_encoder_and_weights(frame):
    df = labelled(frame, {"b": 6, "a": 3, "UNKNOWN": 1})
    assert {r.label: r.label_idx for r in dataset.fit_label_encoder(df).collect()} == {"UNKNOWN": 0, "a": 1, "b": 2}
    weights = {r.label: r.weight for r in dataset.class_weights(df).collect()}
    assert weights == {c: float(np.float32(10 / (3 * n))) for c, n in {"b": 6, "a": 3, "UNKNOWN": 1}.items()}
    assert dataset.drop_unknown(df).count() == 9


def test_prepare(frame):
    df = labelled(frame, {"b": 40, "a": 20, "UNKNOWN": 20}).withColumn("embedding", F.array(F.lit(1.0)))
    samples, weights, encoder = prepare(df, "key")
    assert {r.label: r.label_idx for r in encoder.collect()} == {"UNKNOWN": 0, "a": 1, "b": 2}
    assert Counter((r.split, r.label_idx) for r in samples.collect()) == {
        ("train", 0): 18, ("train", 1): 18, ("train", 2): 36, ("val", 0): 2, ("val", 1): 2, ("val", 2): 4,
    }
    assert {r.label_idx: r.n for r in weights.collect()} == {0: 18, 1: 18, 2: 36}
    assert prepare(df, "key", drop_unknown=True)[2].count() == 2


def test_embedding_stats(frame):
    df = frame([("a", [1.0, 2.0]), ("b", [1.0, 2.0, 3.0]), ("a", [0.0, 0.0])], "label string, embedding array<float>")
    assert tuple(dataset.embedding_stats(df).first()) == (3, 2, 3, 2)


# --- early stopping -----------------------------------------------------------------------------


def loop_early_stopping(scores, patience):
    best, best_epoch, waited, epoch = 0.0, 0, 0, 0
    for epoch, score in enumerate(scores, 1):
        if score > best:
            best, best_epoch, waited = score, epoch, 0
        else:
            waited += 1
        if waited >= patience:
            return best_epoch, best, epoch, True
    return best_epoch, best, epoch, False


@pytest.mark.parametrize("patience", [1, 3, 10])
def test_early_stopping_equals_the_loop(frame, patience):
    rng = random.Random(patience)
    runs = {f"r{i}": [round(rng.random(), 2) for _ in range(rng.randint(1, 30))] for i in range(20)}
    runs["zero"] = [0.0] * 12
    runs["rising"] = [i / 30 for i in range(1, 25)]
    runs["equal"] = [0.5] * 12
    runs["nan"] = [0.2, math.nan, 0.3, math.nan]
    rows = [(run, e, s) for run, scores in runs.items() for e, s in enumerate(scores, 1)]
    out = training.early_stopping(frame(rows, "run_id string, epoch int, val_accuracy double"), patience=patience)
    got = {r.run_id: tuple(r)[1:] for r in out.collect()}
    assert got == {run: loop_early_stopping(scores, patience) for run, scores in runs.items()}


# --- loss ---------------------------------------------------------------------------------------


def loop_loss(rows, weights, eps):
    classes = len(weights)
    top = bottom = 0.0
    for y, logits in rows:
        logp = np.array(logits) - np.log(np.exp(logits).sum())
        top += (1 - eps) * weights[y] * -logp[y] + eps / classes * sum(-weights[c] * logp[c] for c in range(classes))
        bottom += weights[y]
    return top / bottom


def test_loss_per_batch_and_epoch(frame):
    rng = np.random.default_rng(2)
    rows = [(i // 8, int(rng.integers(4)), rng.normal(size=4).tolist()) for i in range(20)]
    weights = [0.5, 2.0, 1.0, 0.25]
    table = frame([(c, w) for c, w in enumerate(weights)], "label_idx int, weight double")
    df = frame(rows, "batch int, label_idx int, logits array<double>")
    losses = training.weighted_ce_loss(df, training.weight_vector(table), "batch")
    want = {b: loop_loss([(y, x) for bb, y, x in rows if bb == b], weights, 0.1) for b in range(3)}
    assert {r.batch: r.loss for r in losses.collect()} == pytest.approx(want)
    epoch = training.epoch_loss(losses).first()
    assert epoch.loss == pytest.approx(sum(want.values()) / 3) and epoch.batches == 3


def test_epoch_accuracy(frame):
    df = frame([(1, 0, 0), (1, 1, 0), (2, 1, 1)], "epoch int, y int, p int")
    assert {r.epoch: tuple(r)[1:] for r in training.epoch_accuracy(df, ["epoch"], "y", "p").collect()} == {1: (1, 2, 0.5), 2: (1, 1, 1.0)}


# --- quantiles ----------------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["spread", "hot", "same", "narrow", "signed", "one"])
def test_exact_quantiles(frame, kind):
    rng = np.random.default_rng(4)
    values = {
        "spread": rng.lognormal(2, 2, 997),
        "hot": np.concatenate([np.full(400, 7.25), rng.exponential(5, 600)]),
        "same": np.full(50, 3.5),
        "narrow": 1000 + rng.random(500) * 1e-7,
        "signed": np.concatenate([rng.normal(0, 1, 300), [0.0, -0.0, -1e9, 1e-12]]),
        "one": np.array([42.0]),
    }[kind]
    shares = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}
    df = frame([("g", float(v)) for v in values] + [("g", None), ("other", 1.0)], "k string, ms double")
    row = quantiles.summarize(df, ["k"], "ms", shares).filter("k = 'g'").first()
    assert row.n == len(values) and row["mean"] == pytest.approx(values.mean())
    for name, share in shares.items():
        assert row[name] == pytest.approx(np.quantile(values, share), rel=1e-12, abs=1e-12)


def test_cells_follow_the_values(frame):
    values = sorted([-1e12, -5.0, -1e-3, -1e-9, 0.0, 1e-9, 1e-6, 0.5, 0.50001, 3.0, 1e6, 1e300])
    out = frame([(v,) for v in values], "v double").select("v", quantiles.value_cell(F.col("v")).alias("c")).orderBy("v").collect()
    cells = [r.c for r in out]
    assert cells == sorted(cells)


def test_latency_summary(frame):
    df = frame([(float(v),) for v in (1, 2, 3, 10)], "ms double")
    row = quantiles.latency_summary(df).first()
    assert row.asDict() == pytest.approx(
        {
            "average_latency_ms": 4.0, "median_latency_ms": 2.5, "min_latency_ms": 1.0, "max_latency_ms": 10.0,
            "p95_latency_ms": 8.95, "throughput_images_per_sec": 250.0,
        }
    )
    assert quantiles.latency_summary(frame([(0.0,)], "ms double")).first().throughput_images_per_sec == math.inf


def test_per_image_latency(frame):
    images = frame([(1, "a"), (1, "b"), (2, "c")], "batch int, image string")
    out = quantiles.per_image_latency(images, frame([(1, 10.0), (2, 4.0)], "batch int, ms double"), "batch", "ms")
    assert {r.image: r.latency_ms for r in out.collect()} == {"a": 5.0, "b": 5.0, "c": 4.0}
