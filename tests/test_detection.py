import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.functions.boxes import crop_region, expand_bbox
from sightline.operators import detection, numeric


@pytest.mark.parametrize(
    "box, size, expansion, expected",
    [
        ((30, 12, 70, 92), (160, 120), 0.5, (10, 0, 90, 120)),
        ((4, 60, 44, 76), (48, 80), 0.25, (0, 56, 48, 80)),
        ((7, 9, 31, 25), (64, 64), 0.0, (7, 9, 31, 25)),
        ((10.9, 3.2, 20.1, 8.7), (64, 64), 0.1, (9, 2, 21, 9)),
        ((-0.5, -3.0, 1.0, 1.0), (64, 64), 0.0, (0, 0, 1, 1)),
    ],
)
def test_expanded_box(frame, box, size, expansion, expected):
    df = frame([(*map(float, box), *size)], "a double, b double, c double, d double, w int, h int")
    cols = [F.col(c) for c in "abcdwh"]
    row = df.select(expand_bbox(*cols, expansion).alias("e")).first().e
    assert tuple(row) == expected
    found = [np.array([[*box, 0.9]], dtype=float)]
    region, detected = numeric.best_boxes(found, np.array([size[0]]), np.array([size[1]]), expansion)
    assert tuple(region[0]) == expected and detected[0]


def boxes(frame, rows):
    return frame(rows, "image string, box int, xmin double, ymin double, xmax double, ymax double, confidence double")


def test_best_box_ties_and_nan(frame):
    df = boxes(
        frame,
        [
            ("a", 1, 0.0, 0.0, 10.0, 10.0, 0.1),
            ("a", 2, 50.0, 50.0, 100.0, 100.0, 0.99),
            ("b", 7, 1.0, 1.0, 2.0, 2.0, 0.5),
            ("b", 3, 3.0, 3.0, 4.0, 4.0, 0.5),
            ("c", 1, 0.0, 0.0, 1.0, 1.0, math.nan),
            ("c", 2, 5.0, 5.0, 6.0, 6.0, 0.0),
            ("d", 1, 8.0, 8.0, 9.0, 9.0, math.nan),
        ],
    )
    best = {r.image: (r.box, r.xmin) for r in detection.best_detection(df, ["image"], ["box"]).collect()}
    assert best == {"a": (2, 50.0), "b": (3, 3.0), "c": (2, 5.0), "d": (1, 8.0)}


def test_no_detection_leaves_the_whole_image(frame):
    images = frame([("a", 100, 80), ("z", 100, 80)], "image string, img_w int, img_h int")
    best = frame([("a", 1.0, 2.0, 3.0, 4.0)], "image string, xmin double, ymin double, xmax double, ymax double")
    with_box = best.join(images, "image").transform(lambda df: detection.expanded_boxes(df, 0.0)).select("image", "bbox")
    paired = detection.pair_detections(images, with_box, ["image"])
    out = paired.select("image", "yolo_detected", "bbox", crop_region(F.col("bbox"), F.col("img_w"), F.col("img_h")).alias("r"))
    rows = {r.image: (r.yolo_detected, r.bbox is None, tuple(r.r)) for r in out.collect()}
    assert rows == {"a": (True, False, (1, 2, 3, 4)), "z": (False, True, (0, 0, 100, 80))}


def test_hot_image_is_reduced_before_the_shuffle(frame):
    df = boxes(frame, [("hot", i, 0.0, 0.0, 1.0, 1.0, i / 1000) for i in range(900)] + [("cold", 1, 0.0, 0.0, 1.0, 1.0, 0.5)])
    best = detection.best_detection(df, ["image"], ["box"])
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("max_by") >= 2
    assert {r.image: r.box for r in best.collect()} == {"hot": 899, "cold": 1}
