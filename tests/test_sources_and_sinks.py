import json

import pytest
from pyspark.sql import functions as F

from conftest import pairs
from sightline.schemas import PREDICTION_FIELDS, PREDICTION_RECORD
from sightline.sources import documents, sinks, tables


def put(tmp_path, name, content):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("indent", [None, 2])
def test_manifest(spark, tmp_path, indent):
    path = put(tmp_path, "m.json", json.dumps([{"prefix": "s3://b/"}, "B/B_1_IM1.png", "B/é,\"q\".png"], indent=indent))
    rows = documents.read_manifest(spark, path).orderBy("pos").collect()
    assert [tuple(r) for r in rows] == [
        (1, "s3://b/", "B/B_1_IM1.png", "s3://b/B/B_1_IM1.png"),
        (2, "s3://b/", 'B/é,"q".png', 's3://b/B/é,"q".png'),
    ]


def test_manifest_lines_keep_file_order(spark, tmp_path):
    for part in range(3):
        lines = [json.dumps({"prefix": "s3://b/", "image_path": f"{part}/{i:03}"}) for i in range(40)]
        put(tmp_path, f"lines/part-{part}.json", "\n".join(lines))
    rows = documents.read_manifest_lines(spark, str(tmp_path / "lines")).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(1, 121))
    for part in range(3):
        block = [r.image_path for r in rows if r.image_path.startswith(f"{part}/")]
        assert block == sorted(block)
    assert rows[0].uri == "s3://b/" + rows[0].image_path


@pytest.mark.parametrize(
    "text",
    ['{"A1": "Screw"}', ' \n[{"object_id": "A1", "name": "Screw"}]', '{"A1": "First", "A1": "Screw"}',
     '[{"object_id": "A1", "name": "x"}, {"object_id": "A1", "name": "Screw"}]'],
)
def test_label_map_shapes_and_repeats(spark, tmp_path, text):
    assert pairs(documents.read_label_map(spark, put(tmp_path, "l.json", text)), "object_id", "label") == {"A1": "Screw"}


def test_overrides_keep_null_labels(spark, tmp_path):
    path = put(tmp_path, "o.json", '{"A1": null, "A2": "Bolt", "A3": "x", "A3": null}')
    assert pairs(documents.read_override_map(spark, path), "object_id", "label") == {"A1": None, "A2": "Bolt", "A3": None}


def test_csv_database(spark, tmp_path):
    text = 'extra,trainingID,name\n1, A1-B ," Light ""Bulb"", big"\n2,A2-B,old\n3,\tA2-B,new \n4,A3-B,"two\nlines"\n5,A4-B,\n'
    got = pairs(documents.read_id_name_csv(spark, put(tmp_path, "d.csv", text), "trainingID"), "object_id", "label")
    assert got == {"A1-B": 'Light "Bulb", big', "A2-B": "new", "A3-B": "two\nlines", "A4-B": ""}


def test_synonyms(spark, tmp_path):
    path = put(tmp_path, "s.json", {"category_to_objects": {"Bolt": ["Bolts", "x"], "light_bulb": ["A"], " Light Bulb": [" Bulbs_Big"]}})
    assert pairs(documents.read_synonyms(spark, path), "category", "canonical") == {"bolt": "bolts", "light bulb": "bulbs big"}
    empty = put(tmp_path, "e.json", {"category_to_objects": {"Bolt": []}})
    with pytest.raises(Exception, match="no labels for category Bolt"):
        documents.read_synonyms(spark, empty).collect()


def test_prompts(spark, tmp_path):
    path = put(tmp_path, "p.json", {"categories": ["Bolt", "Nut"], "templates": ["a {}", "the {}", "{}"]})
    categories, templates = documents.read_prompts(spark, path)
    assert pairs(categories, "category_idx", "category") == {0: "Bolt", 1: "Nut"}
    assert pairs(templates, "template_idx", "template") == {0: "a {}", 1: "the {}", 2: "{}"}
    assert documents.read_prompt_pairs(spark, path).count() == 6
    categories, templates = documents.read_prompts(spark)
    assert (categories.count(), templates.count(), documents.read_prompt_pairs(spark).count()) == (82, 8, 656)
    assert categories.first().category == "Allen key"


def test_label_encoder(spark, tmp_path):
    good = put(tmp_path, "e.json", {str(i): f"c{i}" for i in range(12)})
    assert pairs(documents.read_label_encoder(spark, good), "label_idx", "label") == {i: f"c{i}" for i in range(12)}
    with pytest.raises(Exception, match="not 0..C-1"):
        documents.read_label_encoder(spark, put(tmp_path, "g.json", {"0": "a", "2": "b"})).collect()


def test_embedding_files(spark, tmp_path):
    record = lambda i: {"image": f"{i}.png", "objectID": "o", "label": "L", "embedding": [i, 0.5]}
    put(tmp_path, "in/a/B1_embeddings.json", json.dumps([record(1), record(2)], indent=4))
    put(tmp_path, "in/B2_embeddings.json", record(3))
    put(tmp_path, "in/failures.json", [{"image": "x", "error": "e"}])
    rows = tables.read_embeddings(spark, str(tmp_path / "in")).orderBy("image").collect()
    assert [(r.image, r.embedding) for r in rows] == [("1.png", [1.0, 0.5]), ("2.png", [2.0, 0.5]), ("3.png", [3.0, 0.5])]


def test_embeddings_round_trip(frame, spark, tmp_path):
    rows = [(f"{i}.png", "o", None if i == 3 else "L", [float(i), 0.25], "hot" if i % 5 else f"b{i}") for i in range(40)]
    df = frame(rows, "image string, objectID string, label string, embedding array<float>, batch_id string")
    sinks.write_embeddings(df, str(tmp_path / "out"))
    back = tables.read_embeddings(spark, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in back.select("image", "embedding").collect()) == sorted((r[0], r[3]) for r in rows)
    assert {p.name for p in (tmp_path / "out").glob("batch_id=*")} == {f"batch_id={r[4]}" for r in rows}
    assert back.filter("label IS NULL").count() == 1


def prediction(**changes):
    base = dict.fromkeys(PREDICTION_FIELDS)
    base.update(image="i.png", object_id="o", mobileclip_gt="a", mobileclip_top1="a", mobileclip_top2="b", classifier_gt="A", classifier_pred="A")
    return {**base, **changes}


def test_predictions_round_trip(frame, spark, tmp_path):
    rows = [
        prediction(yolo_detected=True, mobileclip_ms=1.5, hybrid_correct=True),
        prediction(image='q"uo,te.png', yolo_detected=False, pipeline_ms=2.0, hybrid_correct=False),
        prediction(image="n.png", classifier_gt=""),
    ]
    sinks.write_predictions(spark.createDataFrame(rows, PREDICTION_RECORD), str(tmp_path / "p"))
    text = "".join(p.read_text() for p in (tmp_path / "p").glob("*.csv"))
    assert text.startswith(",".join(PREDICTION_FIELDS)) and "True" in text and "False" in text
    back = {r.image: r.asDict() for r in tables.read_predictions(spark, str(tmp_path / "p")).collect()}
    assert back == {r["image"]: r for r in rows}


def test_reference_style_predictions_file(spark, tmp_path):
    lines = [",".join(PREDICTION_FIELDS), "i.png,o,a,a,b,A,A,True,1.5,,3,True", "j.png,o,a,a,b,,A,,,0.5,,"]
    rows = tables.read_predictions(spark, put(tmp_path, "predictions.csv", "\n".join(lines))).orderBy("image").collect()
    assert (rows[0].yolo_detected, rows[0].mobileclip_ms, rows[0].classifier_ms, rows[0].hybrid_correct) == (True, 1.5, None, True)
    assert (rows[1].classifier_gt, rows[1].yolo_detected, rows[1].classifier_ms, rows[1].hybrid_correct) == ("", None, 0.5, None)


def test_prediction_columns_go_by_name(spark, tmp_path):
    text = "classifier_pred,image,mobileclip_ms\nA,i.png,2.5\n,j.png,\n"
    rows = tables.read_predictions(spark, put(tmp_path, "p.csv", text)).orderBy("image").collect()
    assert [(r.image, r.classifier_pred, r.mobileclip_ms, r.hybrid_correct) for r in rows] == [("i.png", "A", 2.5, None), ("j.png", "", None, None)]
    assert rows[0].__fields__ == PREDICTION_FIELDS
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.read_predictions(spark, put(tmp_path, "bad.csv", "image,mobileclip_ms\ni,fast\n")).collect()


def test_label_map_sinks(frame, spark, tmp_path):
    df = frame([("B", "x"), ("A", None), ("C", "z")], "object_id string, label string")
    sinks.write_label_map(df, str(tmp_path / "lines"))
    assert pairs(documents.read_label_lines(spark, str(tmp_path / "lines")), "object_id", "label") == {"A": None, "B": "x", "C": "z"}
    with pytest.raises(FileNotFoundError):
        tables.read_embeddings(spark, str(tmp_path / "lines"), "*.none")


def test_last_file_by_name_wins_whatever_its_size(spark, tmp_path):
    for name, label, rows in (("a", "old", 3), ("b", "new", 500), ("c", "newest", 50)):
        put(tmp_path, f"ids/{name}.csv", "id,name\n" + "".join(f"x{name}{i},n\n" for i in range(rows)) + f"1,{label}\n")
        put(tmp_path, f"lines/{name}.json", "".join(json.dumps({"prefix": "p/", "image_path": f"{name}{i}"}) + "\n" for i in range(rows)))
    assert pairs(documents.read_id_name_csv(spark, str(tmp_path / "ids"), "id"), "object_id", "label")["1"] == "newest"
    rows = sorted((r.pos, r.image_path) for r in documents.read_manifest_lines(spark, str(tmp_path / "lines")).collect())
    assert rows == [(i + 1, f"{n}{k}") for i, (n, k) in enumerate((n, k) for n, c in (("a", 3), ("b", 500), ("c", 50)) for k in range(c))]


def test_failures_only_when_there_are_any(frame, spark, tmp_path):
    schema = "image string, error string"
    assert sinks.write_failures(frame([], schema), str(tmp_path / "none")) is False and not (tmp_path / "none").exists()
    assert sinks.write_failures(frame([("i", "e")], schema), str(tmp_path / "some")) is True
    assert [tuple(r) for r in spark.read.schema(schema).json(str(tmp_path / "some")).collect()] == [("i", "e")]


def test_prepared_round_trip(frame, spark, tmp_path):
    samples = frame([([1.0, 2.0], 0, "train"), ([3.0, 4.0], 1, "val"), ([5.0, 6.0], 1, "train")], "embedding array<float>, label_idx int, split string")
    weights = frame([(0, 1.0), (1, 1.0)], "label_idx int, weight double")
    encoder = frame([(i, f"class {i}") for i in range(12)], "label_idx int, label string")
    path = str(tmp_path / "prep")
    sinks.write_prepared(samples, weights, encoder, path)
    train, val, back = tables.read_prepared(spark, path)
    assert sorted(r.embedding[0] for r in train.collect()) == [1.0, 5.0] and [r.label_idx for r in val.collect()] == [1]
    assert back.count() == 2
    names = documents.read_label_encoder(spark, f"{path}/label_encoder")
    assert pairs(names, "label_idx", "label") == {i: f"class {i}" for i in range(12)}
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_prompt_bank_check(frame, spark, tmp_path):
    schema = "category_idx int, category string, template_idx int, template string, vec array<float>"
    rows = [(c, f"c{c}", t, f"t{t}", [1.0, 0.0]) for c in range(2) for t in range(2)]
    sinks.write_prompt_bank(frame(rows, schema), str(tmp_path / "ok"))
    assert tables.read_prompt_bank(spark, str(tmp_path / "ok")).count() == 4
    for i, bad in enumerate([rows[:3], rows + rows[:1], rows[:3] + [(1, "c1", 1, "t1", [1.0])]]):
        sinks.write_prompt_bank(frame(bad, schema), str(tmp_path / f"bad{i}"))
        with pytest.raises(ValueError):
            tables.read_prompt_bank(spark, str(tmp_path / f"bad{i}"))


def test_images(frame, spark, tmp_path):
    for name in ("B1/B1_x_IM1.png", "B1/B1_y_IM2.png", "B1/notes.txt"):
        put(tmp_path, f"img/{name}", name)
    images = tables.read_images(spark, str(tmp_path / "img"))
    assert {bytes(r.content).decode() for r in images.collect()} == {"B1/B1_x_IM1.png", "B1/B1_y_IM2.png"}
    listing = images.select("uri", "length")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in listing
    base = f"file:{tmp_path}/img/"
    manifest = frame([(base + n, n) for n in ("B1/B1_x_IM1.png", "B1/gone.png")], "uri string, image_path string")
    results = images.select("uri", F.lit(None).cast("string").alias("error"))
    out = pairs(tables.match_manifest(manifest, results), "image_path", "error")
    assert out == {"B1/B1_x_IM1.png": None, "B1/gone.png": f"image not found: {base}B1/gone.png"}


def test_report_leaves_out_missing_values(frame, tmp_path):
    df = frame([((0.5, None), None, 3)], "mobileclip struct<top1_accuracy:double, average_inference_ms:double>, error string, num_failures bigint")
    sinks.write_report(df, str(tmp_path / "r"))
    text = "".join(p.read_text() for p in (tmp_path / "r").glob("*.json"))
    assert json.loads(text) == {"mobileclip": {"top1_accuracy": 0.5}, "num_failures": 3}


def test_training_outputs(frame, spark, tmp_path):
    history = frame([(1, 0.9, 0.5, 0.8, 0.6)], "epoch int, train_loss double, train_accuracy double, val_loss double, val_accuracy double")
    one = frame([(0.5,)], "accuracy double")
    sinks.write_training_outputs(history, one, one, str(tmp_path / "t"))
    assert {p.name for p in (tmp_path / "t").iterdir()} == {"training_history", "metrics", "classification_report"}
    assert spark.read.json(str(tmp_path / "t/training_history")).first().val_accuracy == 0.6
