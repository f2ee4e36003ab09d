import pytest
from pyspark.sql import functions as F

from sightline.functions import outcomes, paths, text
from sightline.operators import labels


@pytest.mark.parametrize(
    "path, strict, positional",
    [
        ("FRS1/FRS1_5081-B_IM0001.png", "5081-B", "5081-B"),
        ("FRS/FRS_a_b_IM1.png", "a_b", "a"),
        ("F_1/F_1_9_IM1.png", "9", "1"),
        ("FRS1/FRS2_7-B_IM1.png", None, "7-B"),
        ("FRS1/malformed.png", None, None),
        ("FRS1/FRS1_7-B_IM.png", None, "7-B"),
        ("FRS1/FRS1_7-B_IM1", None, "7-B"),
        ("deep/er/FRS1_7-B_IM1.png", None, "7-B"),
    ],
)
def test_object_ids(frame, path, strict, positional):
    row = frame([(path,)], "p string").select(
        paths.object_id_strict(F.col("p")).alias("s"), paths.object_id_positional(F.col("p")).alias("q")
    ).first()
    assert (row.s, row.q) == (strict, positional)


def test_batch_and_basename(frame):
    row = frame([("B1/B1_x_IM1.png",)], "p string").select(
        paths.batch_id(F.col("p")).alias("b"), paths.image_basename(F.col("p")).alias("n")
    ).first()
    assert (row.b, row.n) == ("B1", "B1_x_IM1.png")


@pytest.mark.parametrize(
    "uri, bucket, key, store",
    [
        ("s3://bucket/a/b.png", "bucket", "a/b.png", True),
        ("s3://bucket//a/b.png", "bucket", "a/b.png", True),
        ("s3://bucket/a?x=1#t", "bucket", "a", True),
        ("s3://bucket", "bucket", "", True),
        ("local/file.png", "", "local/file.png", False),
        ("https://host/p#top", "host", "p", False),
    ],
)
def test_uri_parts(frame, uri, bucket, key, store):
    col = F.col("u")
    row = frame([(uri,)], "u string").select(
        paths.uri_bucket(col).alias("b"), paths.uri_key(col).alias("k"), paths.is_object_store_uri(col).alias("s")
    ).first()
    assert (row.b, row.k, row.s) == (bucket, key, store)


@pytest.mark.parametrize(
    "raw, clean",
    [
        (" Light_Bulb ", "light bulb"),
        ("_Bolt", " bolt"),
        ("\t\n Nut \x1f", "nut"),
        ("", ""),
        (None, "none"),
    ],
)
def test_normalize_label(frame, raw, clean):
    assert frame([(raw,)], "x string").select(text.normalize_label(F.col("x")).alias("y")).first().y == clean


def test_fill_template(frame):
    row = frame([("a photo of a {}", "Light Bulb")], "t string, c string").select(
        text.fill_template(F.col("t"), F.col("c")).alias("p")
    ).first()
    assert row.p == "a photo of a light bulb"


def test_unmatched_paths_sample_and_count(frame):
    bad = [(i, f"B/x{i:02}.png") for i in range(25)]
    df = frame(bad + [(99, "B/B_1_IM1.png")], "pos int, image_path string")
    out = labels.unmatched_paths(df, ["pos"]).collect()
    assert [r.image_path for r in out] == [p for _, p in bad[:10]]
    assert {r.total_unmatched for r in out} == {25}


def test_parser_disagreements(frame):
    df = frame([("F_1/F_1_9_IM1.png",), ("B/B_1_IM1.png",), ("B/bad.png",)], "image_path string")
    assert [tuple(r) for r in labels.parser_disagreements(df).collect()] == [("F_1/F_1_9_IM1.png", "9", "1")]


def test_prediction_fields_parse(frame):
    df = frame([("True", "1.5"), ("false", ""), ("", None), (None, "0"), ("yes", "2")], "f string, t string")
    out = df.select(outcomes.parse_flag(F.col("f")).alias("f"), outcomes.parse_timing(F.col("t")).alias("t")).collect()
    assert [tuple(r) for r in out] == [(True, 1.5), (False, None), (None, None), (None, 0.0), (False, 2.0)]
