"""Input views derived from the given tables; each has the same definition in SQL (see oracles)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sightline.functions import vectors
from sightline.schemas import UNKNOWN

PREFIX = "s3://images/raw/"
# Fixed values of the fixtures: the letters counted by the stand-in encoder, prompt templates, and
# the image size.
LETTERS = "etaoinshrdlucmpf"
TEMPLATES = ["a photo of a {}", "a {} on the ground", "close-up: {}"]
WIDTH, HEIGHT = 200, 160


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(column: str) -> Column:
    return F.col(column).cast("string")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One image path per line item, some malformed."""
    batch = F.concat(F.lit("FRS"), text("l_suppkey"))
    number = F.lpad(text("l_linenumber"), 4, "0")
    order = F.col("l_orderkey")
    path = (
        F.when(order % 97 == 0, F.concat(batch, F.lit("/malformed.png")))
        .when(order % 89 == 0, F.concat(batch, F.lit("/FRSX_"), text("l_partkey"), F.lit("-B_IM0001.png")))
        .when(order % 83 == 0, F.concat(batch, F.lit("/"), batch, F.lit("_"), text("l_partkey"), F.lit("_B_IM0001.png")))
        .otherwise(
            F.concat(batch, F.lit("/"), batch, F.lit("_"), text("l_partkey"), F.lit("-B_IM"), number, F.lit(".png"))
        )
    )
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return table(spark, sf_dir, "lineitem").select(*keys, path.alias("image_path"))


def database_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded IDs with names, one part in 13 missing."""
    part = table(spark, sf_dir, "part").filter("p_partkey % 13 <> 0")
    return part.select(F.concat(F.lit(" "), text("p_partkey"), F.lit("-B ")).alias("id"), F.col("p_name").alias("name"))


def database(spark: SparkSession, sf_dir: str) -> DataFrame:
    return database_rows(spark, sf_dir).select(F.trim("id").alias("object_id"), F.trim("name").alias("label"))


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").filter("p_partkey % 7 = 0")
    label = F.when(F.col("p_partkey") % 70 != 0, F.col("p_type"))
    return part.select(F.concat(text("p_partkey"), F.lit("-B")).alias("object_id"), label.alias("label"))


def synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").filter("p_name < 'm'")
    noun = F.get(F.split("p_name", " "), F.lit(1))
    return part.select(F.lower("p_name").alias("category"), noun.alias("canonical")).distinct()


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction records with every outcome."""
    rows = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type"),
        F.col("l_partkey") == F.col("p_partkey"),
    )
    name, kind = F.lower("p_name"), F.col("p_type")
    head_ms = F.col("l_tax") * 100
    parts = [F.lit("IM")] + [text(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    turn = F.col("l_orderkey") % 3
    return rows.select(
        F.concat_ws("_", *parts).alias("image"),
        F.concat(text("l_partkey"), F.lit("-B")).alias("object_id"),
        name.alias("mobileclip_gt"),
        F.when(turn == 0, name).when(turn == 1, F.lower(kind)).otherwise("rock").alias("mobileclip_top1"),
        F.when(F.col("l_partkey") % 5 == 0, name).otherwise("twig").alias("mobileclip_top2"),
        F.when(F.col("l_partkey") % 11 == 0, UNKNOWN).otherwise(kind).alias("classifier_gt"),
        F.when(F.col("l_suppkey") % 4 == 0, "PROMO").otherwise(kind).alias("classifier_pred"),
        F.when(F.col("l_linenumber") != 7, F.col("l_suppkey") % 10 != 0).alias("yolo_detected"),
        F.when(F.col("l_linenumber") != 6, F.col("l_quantity")).alias("mobileclip_ms"),
        head_ms.alias("classifier_ms"),
        F.when(F.col("l_linenumber") != 5, F.col("l_quantity") + head_ms).alias("pipeline_ms"),
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several boxes per image with tied confidences; some images have none."""
    rows = table(spark, sf_dir, "lineitem").filter("l_orderkey % 19 <> 0")
    x = (F.col("l_partkey") % 150).cast("double") + 0.37
    y = (F.col("l_suppkey") % 90).cast("double") + 0.61
    return rows.select(
        F.col("l_orderkey").alias("image_id"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_discount").alias("confidence"),
        x.alias("xmin"),
        y.alias("ymin"),
        (x + F.col("l_quantity")).alias("xmax"),
        (y + F.col("l_quantity") * 2).alias("ymax"),
        F.lit(WIDTH).alias("img_w"),
        F.lit(HEIGHT).alias("img_h"),
    )


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One image per order."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("image_id"), F.lit(WIDTH).alias("img_w"), F.lit(HEIGHT).alias("img_h")
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four prompts per label: the mean vectors of its rows by vec_id modulo four, so every vector counts."""
    parts = embeddings(spark, sf_dir).select(
        F.col("label").alias("category_idx"),
        F.pmod("vec_id", F.lit(4)).cast("int").alias("template_idx"),
        F.posexplode(vectors.as_double(F.col("embedding"))).alias("pos", "x"),
    )
    means = parts.groupBy("category_idx", "template_idx", "pos").agg(F.avg("x").alias("x"))
    whole = means.groupBy("category_idx", "template_idx").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("cells"))
    return whole.select("category_idx", "template_idx", F.col("cells.x").alias("vec"))


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten logits per embedding: ten times the sums of every tenth element, so all elements count."""
    whole = vectors.as_double(F.col("embedding"))
    tenth = lambda i: F.filter(whole, lambda x, j: j % 10 == i)
    scaled = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.aggregate(tenth(i), F.lit(0.0), lambda s, x: s + x) * 10)
    return embeddings(spark, sf_dir).select("vec_id", F.col("label").alias("label_idx"), scaled.alias("logits"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One training run per event type, one epoch per day."""
    daily = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("run_id"), F.col("ts").cast("date").alias("d"))
    daily = daily.agg((F.avg("value") / 100).alias("val_accuracy"), F.stddev_pop("value").alias("train_loss"))
    epoch = F.row_number().over(Window.partitionBy("run_id").orderBy("d"))
    return daily.select("run_id", epoch.cast("int").alias("epoch"), "val_accuracy", "train_loss")


def latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.col("event_type").alias("stage"), F.col("value").alias("ms"))


def type_encoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label encoder of the head's classes: part types."""
    from sightline.operators.dataset import fit_label_encoder

    return fit_label_encoder(table(spark, sf_dir, "part"), "p_type")


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One classified sample per event: run, epoch (day), truth and prediction."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run_id"),
        F.col("ts").cast("date").cast("string").alias("epoch"),
        (F.col("user_id") % 10).alias("y"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_id") % 10).otherwise(F.col("user_id") % 10).alias("y_pred"),
    )


def letter_encoder():
    """Stand-in encoder: counts of sixteen letters in the text, or in the crop's columns of it."""
    letters, width = LETTERS, WIDTH

    def encode(part: pd.DataFrame) -> np.ndarray:
        seen = part["text"]
        if "crop_xmin" in part:
            seen = [t[len(t) * a // width : len(t) * b // width] for t, a, b in zip(seen, part["crop_xmin"], part["crop_xmax"])]
        return np.array([[t.count(c) for c in letters] for t in seen], dtype=np.float32)

    return encode


def text_detector():
    """Stand-in detector: up to three boxes, placed by the counts of the first letters in the whole text."""
    letters = LETTERS[:7]

    def detect(part: pd.DataFrame) -> list:
        found = []
        for text in part["text"]:
            n = [text.count(c) for c in letters]
            if n[0] % 101 == 0:
                raise ValueError("unreadable image")
            i = np.arange(n[1] % 4, dtype=float)
            x, y = n[2] % 90 + i, n[3] % 60 + 2 * i
            found.append(np.stack([x, y, x + 10 + n[4] % 50 + i, y + 20 + n[5] % 40 + i, (n[6] % 7 + i) / 100], axis=1))
        return found

    return detect
