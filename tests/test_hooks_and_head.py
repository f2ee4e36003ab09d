import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.functions import vectors
from sightline.operators import head, hooks, hybrid, zeroshot
from sightline.plans.embedding import extract_embeddings, run_extraction, run_manifest
from sightline.sources import sinks, tables


def size_encoder(width=4):
    """Encoder whose vectors tell the size of the batch it was given."""

    def factory():
        def encode(part):
            if (part["image_path"].str.contains("boom")).any():
                raise RuntimeError("boom")
            return np.full((len(part), width), float(len(part)), dtype=np.float32)

        return encode

    return factory


def test_batches_are_full_except_the_last(frame):
    df = frame([(f"p{i}",) for i in range(5)], "image_path string").coalesce(1)
    out = hooks.embed_batches(df, size_encoder(512), batch_size=2).collect()
    assert sorted(r.embedding[0] for r in out) == [1.0, 2.0, 2.0, 2.0, 2.0]
    assert all(len(r.embedding) == 512 and r.error is None for r in out)


def test_batches_run_across_arrow_batches(frame, spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        df = frame([(f"p{i}",) for i in range(10)], "image_path string").coalesce(1)
        sizes = sorted(r.embedding[0] for r in hooks.embed_batches(df, size_encoder(), batch_size=4).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sizes == [2.0] * 2 + [4.0] * 8


def test_one_call_when_the_batch_is_never_full(frame):
    df = frame([(f"p{i}",) for i in range(3)], "image_path string").coalesce(1)
    assert {r.embedding[0] for r in hooks.embed_batches(df, size_encoder(), batch_size=10).collect()} == {3.0}


def test_a_bad_row_costs_only_itself(frame):
    df = frame([("a",), ("boom",), ("c",)], "image_path string").coalesce(1)
    good, failed = hooks.failure_split(hooks.embed_batches(df, size_encoder()))
    assert {r.image_path for r in good.collect()} == {"a", "c"}
    assert [tuple(r) for r in failed.collect()] == [("boom", "RuntimeError('boom')")]


def test_wrong_result_count_is_a_failure(frame):
    short = lambda: (lambda part: np.ones((1, 2)) if len(part) > 1 else np.ones((0, 2)))
    out = hooks.embed_batches(frame([("a",), ("b",)], "image_path string").coalesce(1), short).collect()
    assert all(r.embedding is None and "returned 0 results" in r.error for r in out)


def test_normalize_and_payload(frame):
    two = lambda: (lambda part: np.array([[3.0, 4.0] if p != "zero" else [0.0, 0.0] for p in part["image_path"]]))
    df = frame([("a", "x"), ("zero", "y")], "image_path string, payload string").coalesce(1)
    out = hooks.embed_batches(df, two, normalize=True, drop=("payload",))
    assert out.columns == ["image_path", "embedding", "error"]
    rows = {r.image_path: r for r in out.collect()}
    assert rows["a"].embedding == pytest.approx([0.6, 0.8]) and "zero vector" in rows["zero"].error
    raw = hooks.embed_batches(df, two).filter("image_path = 'a'").first()
    assert raw.embedding == [3.0, 4.0]


def test_detector_rows(frame):
    def factory():
        def detect(part):
            out = []
            for n in part["n"]:
                if n < 0:
                    raise ValueError("unreadable")
                out.append(np.arange(n * 5, dtype=float).reshape(n, 5))
            return out

        return detect

    df = frame([(1, 2), (2, 0), (3, -1), (4, 1)], "id int, n int").coalesce(1)
    rows = {(r.id, r.box_id): (r.xmin, r.confidence, r.error) for r in hooks.detect_batches(df, factory, ["id"]).collect()}
    assert set(rows) == {(1, 0), (1, 1), (3, 0), (4, 0)}
    assert rows[(1, 1)] == (5.0, 9.0, None) and "unreadable" in rows[(3, 0)][2]


def test_extraction(frame):
    images = ["N7/N7_cap-3_IM12.png", "N7/lid.png", "Q/Q_pin_IM0.png", "Q/Q_boom_IM1.png", "Q/Q_who_IM2.png"]
    df = frame([(p, "bytes") for p in images], "image_path string, content string")
    known = frame([("cap-3", "Cap"), ("pin", None)], "object_id string, label string")
    records, failures = run_extraction(df, known, size_encoder(), payload=("content",))
    got = {r.image: (r.batch_id, r.objectID, r.label) for r in records.collect()}
    assert got == {"N7_cap-3_IM12.png": ("N7", "cap-3", "Cap"), "Q_pin_IM0.png": ("Q", "pin", None), "Q_who_IM2.png": ("Q", "who", "UNKNOWN")}
    assert {r.image: r.error for r in failures.collect()} == {
        "N7/lid.png": "Unexpected filename format: N7/lid.png",
        "Q/Q_boom_IM1.png": "RuntimeError('boom')",
    }
    assert "content" not in extract_embeddings(df, known, size_encoder(), payload=("content",)).columns


def crop_models():
    """A detector that knows boxed rows, and an encoder whose vector is the crop."""

    def detector():
        def detect(part):
            if (part["name"] == "bad").any():
                raise IOError("unreadable")
            boxes = {"boxed": [[50, 50, 100, 100, 0.9], [0, 0, 1, 1, 0.1]], "endless": [[0, 0, np.inf, 1, 0.5]]}
            return [np.array(boxes.get(n, [])) for n in part["name"]]

        return detect

    def encoder():
        def encode(part):
            if (part["name"] == "odd").any():
                raise ValueError("odd")
            return part[hooks.CROP].to_numpy(dtype=float) + [1, 0, 0, 0]

        return encode

    return detector, encoder


def test_the_crop_is_embedded(frame):
    detector, encoder = crop_models()
    df = frame([(n, 200, 150) for n in ("boxed", "plain", "bad", "odd", "endless")], "name string, img_w int, img_h int").coalesce(1)
    out = {r.name: r for r in hooks.embed_batches(df, encoder, drop=("img_w", "img_h"), detector_factory=detector).collect()}
    assert out["boxed"].embedding == [41, 40, 110, 110] and out["plain"].embedding == [1, 0, 200, 150]
    for name, error in (("bad", "unreadable"), ("odd", "odd"), ("endless", "not finite")):
        assert out[name].embedding is None and error in out[name].error
    assert hooks.embed_batches(df.limit(0), encoder, detector_factory=detector).count() == 0


def test_manifest_images_and_whole_run(frame, tmp_path):
    detector, encoder = crop_models()
    names = ["boxed", "plain", "odd", "bad"]
    rows = [(i, f"B/B_{n}_IM{i}.png", n.encode() * 3) for i, n in enumerate(names, 1)]
    written = sinks.write_images(frame(rows, "pos long, image_path string, content binary"), str(tmp_path / "files"))
    uris = {r.image_path: r.uri for r in written.collect()}
    listed = [(i, p, uris[p]) for i, p, _ in rows] + [(5, "B/B_gone_IM5.png", str(tmp_path / "gone")), (6, "B/nothing.png", None), (7, "B/B_plain_IM7.png", f"file://{uris[rows[1][1]]}")]
    manifest = frame(listed, "pos long, image_path string, uri string")
    for size in (1, 1 << 20):
        read = {r.pos: r for r in tables.read_manifest_images(manifest, task_bytes=size, batch_bytes=size).collect()}
        assert [bytes(read[i].content) for i in (1, 2, 7)] == [b"boxed" * 3, b"plain" * 3, b"plain" * 3]
        assert read[1].length == 15 and read[5].content is None and read[5].read_error == f"image not found: {tmp_path}/gone"
        assert read[6].read_error.startswith("image not readable")
    assert tables.read_manifest_images(manifest.limit(0)).count() == 0

    decode = lambda images: images.select("pos", "image_path", "read_error", F.substring(F.decode("content", "UTF-8"), 1, F.length("content") / 3).alias("name"), F.lit(200).alias("img_w"), F.lit(150).alias("img_h"))
    known = frame([("boxed", "Box")], "object_id string, label string")
    records, failures = run_manifest(manifest, known, encoder, detector, prepare=decode)
    assert {(r.image, r.label, tuple(r.embedding)) for r in records.collect()} == {
        ("B_boxed_IM1.png", "Box", (41, 40, 110, 110)), ("B_plain_IM2.png", "UNKNOWN", (1, 0, 200, 150)), ("B_plain_IM7.png", "UNKNOWN", (1, 0, 200, 150)),
    }
    errors = {r.image: r.error for r in failures.collect()}
    assert len(errors) == 4 and "not found" in errors["B/B_gone_IM5.png"] and "filename" in errors["B/nothing.png"] and "odd" in errors["B/B_odd_IM3.png"]
    records, failures = run_manifest(manifest, known, encoder, detector, max_images=2, prepare=decode)
    assert records.count() == 2 and failures.count() == 0
    assert tables.read_manifest_images(manifest, opener=lambda uri: str(uri).encode()).filter("length > 0").count() == 7


# --- head ---------------------------------------------------------------------------------------


def loop_forward(net, x):
    for w, b, g, s in zip(net.weights, net.biases, net.gains, net.shifts):
        x = [sum(x[i] * w[i][j] for i in range(len(x))) + b[j] for j in range(len(b))]
        mean = sum(x) / len(x)
        var = sum((v - mean) ** 2 for v in x) / len(x)
        x = [(v - mean) / math.sqrt(var + 1e-5) * g[j] + s[j] for j, v in enumerate(x)]
        x = [v * 0.5 * (1 + math.erf(v / math.sqrt(2))) for v in x]
    w, b = net.weights[-1], net.biases[-1]
    return [sum(x[i] * w[i][j] for i in range(len(x))) + b[j] for j in range(len(b))]


@pytest.mark.parametrize("normalize", [True, False])
def test_head_equals_a_plain_loop(frame, normalize):
    net = head.random_head(6, 5, seed=1, hidden=(8, 7))
    net.gains[0] += 0.3
    net.shifts[1] -= 0.2
    rng = np.random.default_rng(0)
    vectors_in = rng.normal(size=(9, 6)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors_in)] + [(20, [0.0] * 6), (21, [1.0] * 5), (22, None)]
    out = {r.id: r.logits for r in head.score_head(frame(rows, "id int, embedding array<float>"), net, normalize=normalize).collect()}
    for i, v in enumerate(vectors_in.astype(float)):
        x = v / np.sqrt((v * v).sum()) if normalize else v
        assert out[i] == pytest.approx(loop_forward(net, list(x)), abs=1e-9)
    assert (out[20] is None) == normalize and out[21] is None and out[22] is None


def test_head_shape_and_probabilities(frame):
    df = frame([(i, [float(i + j + 1) for j in range(512)]) for i in range(4)], "id int, embedding array<float>")
    scored = head.score_head(df, head.random_head(512, 10, seed=3))
    for r in scored.select("logits", vectors.softmax(F.col("logits")).alias("p"), vectors.argmax(F.col("logits")).alias("a")).collect():
        assert len(r.logits) == 10 and sum(r.p) == pytest.approx(1, abs=1e-5) and min(r.p) >= 0
        assert np.argmax(r.p) == np.argmax(r.logits) == r.a


def test_linear_head_learns_weighted_classes(frame):
    rng = np.random.default_rng(7)
    centers = np.eye(3) * 4
    rows = [(int(c), (centers[c] + rng.normal(size=3) * 0.3).tolist()) for c in [0] * 60 + [1] * 20 + [2] * 5]
    df = frame(rows, "label_idx int, embedding array<float>")
    weights = frame([(0, 0.5), (1, 1.5), (2, 6.0)], "label_idx int, weight double")
    model = head.train_linear_head(df, weights, max_iter=20)
    scored = head.score_linear_head(df, model).select("label_idx", vectors.argmax(F.col("logits")).alias("a"))
    assert scored.filter("label_idx = a").count() == len(rows)


# --- whole pass ---------------------------------------------------------------------------------


def test_stored_heads_score_alike(frame, tmp_path):
    rng = np.random.default_rng(3)
    net = head.random_head(5, 3, seed=2, hidden=(7, 6))
    encoder = frame([(0, "b"), (1, "a"), (2, None)], "label_idx int, label string")
    sinks.write_head(net, encoder, str(tmp_path / "deep"))
    again, classes = tables.read_head(encoder.sparkSession, str(tmp_path / "deep"))
    assert all(np.array_equal(x, y) for x, y in zip(head.pack(net), head.pack(again), strict=True))
    assert sorted(map(tuple, classes.collect()), key=lambda r: r[0]) == [(0, "b"), (1, "a"), (2, None)]
    rows = frame([(int(c), (np.eye(3)[c] * 4 + rng.normal(size=3) * 0.3).tolist()) for c in [0, 1, 2] * 30], "label_idx int, embedding array<float>")
    model = head.train_linear_head(rows, frame([(i, 1.0) for i in range(3)], "label_idx int, weight double"), max_iter=20)
    sinks.write_head(head.linear_head(model), encoder, str(tmp_path / "linear"))
    stored, _ = tables.read_head(encoder.sparkSession, str(tmp_path / "linear"))
    for r in head.score_head(head.score_linear_head(rows, model), stored, out="again", normalize=False).collect():
        assert r.again == pytest.approx(r.logits, abs=1e-9)


@pytest.mark.parametrize("slice_bytes", [1 << 20, 40])
def test_hybrid_predict(frame, slice_bytes):
    # categories 1, 4 and 7: the indices between have no prompts
    bank = zeroshot.load_bank(frame([(1, 0, [1.0, 0.0, 0.0, 0.0]), (4, 0, [0.0, 1.0, 0.0, 0.0]), (7, 0, [0.0, 0.0, 1.0, 0.0])], "category_idx int, template_idx int, vec array<float>"), slice_bytes)
    categories = frame([(1, "Xenon_Lamp"), (4, "yoke"), (7, "zip")], "category_idx int, category string")
    synonyms = frame([("xenon lamp", "Light_Bulb")], "category string, canonical string")
    classes = frame([(0, "A"), (1, "B")], "label_idx int, label string")
    net = head.random_head(4, 2, seed=5, hidden=(6, 5))
    detector, encoder = crop_models()
    df = frame([(n, 200, 150) for n in ("boxed", "plain", "bad", "odd", "endless")], "name string, img_w int, img_h int").coalesce(1)
    out = {r.name: r for r in hybrid.hybrid_predict(df, detector, encoder, bank, categories, net, classes, keep=["name"], synonyms=synonyms).collect()}
    assert (out["boxed"].mobileclip_top1, out["boxed"].mobileclip_top2, out["boxed"].yolo_detected) == ("zip", "light bulb", True)
    assert (out["plain"].mobileclip_top1, out["plain"].mobileclip_top2, out["plain"].yolo_detected) == ("zip", "light bulb", False)
    for name, crop in (("boxed", [41, 40, 110, 110]), ("plain", [1, 0, 200, 150])):
        unit = np.array(crop) / np.linalg.norm(crop)
        assert out[name].classifier_pred == "AB"[int(np.argmax(loop_forward(net, list(unit))))]
        assert out[name].error is None and out[name].pipeline_ms >= out[name].classifier_ms >= 0
    assert "unreadable" in out["bad"].error and "odd" in out["odd"].error and "not finite" in out["endless"].error
    assert out["bad"].mobileclip_top1 is None and out["odd"].pipeline_ms is None
    plain = hybrid.hybrid_predict(df, detector, encoder, bank, categories, net, classes, keep=["name"])
    assert plain.filter("name = 'plain'").first().mobileclip_top2 == "xenon lamp"
    one = zeroshot.load_bank(frame([(3, 0, [1.0, 0.0, 0.0, 0.0])], "category_idx int, template_idx int, vec array<float>"))
    only = hybrid.hybrid_predict(df, detector, encoder, one, frame([(3, "q")], "category_idx int, category string"), net, classes, keep=["name"]).filter("name = 'plain'").first()
    assert (only.mobileclip_top1, only.mobileclip_top2) == ("q", None)
