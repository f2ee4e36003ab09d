"""Queries on vectors, boxes, prompts and model hooks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.catalog import fixtures as fx
from sightline.catalog.registry import r6, register
from sightline.functions import vectors
from sightline.functions.boxes import crop_region
from sightline.operators import detection, head, hooks, hybrid, zeroshot
from sightline.operators.dataset import fit_label_encoder
from sightline.session import materialize, shared_dir, spread
from sightline.sources import sinks
from sightline.sources.tables import read_head, read_prompt_bank

TIES = ["l_linenumber", "l_partkey", "l_suppkey"]


@register(
    "l2_normalize",
    """SELECT vec_id, round(norm, 6) AS norm, round(list_sum(u), 6) AS unit_sum, round(list_min(u), 6) AS unit_min, round(list_max(u), 6) AS unit_max,
  round(u[1], 6) AS unit_first, round(u[len(u)], 6) AS unit_last, round(sqrt(list_sum(list_transform(u, lambda x: x * x))), 6) AS unit_norm
FROM (SELECT vec_id, norm, list_transform(v, lambda x: x / norm) AS u FROM fx_vectors) t""",
)
def l2_normalize(spark, d):
    unit = fx.embeddings(spark, d).withColumn("u", vectors.l2_normalize(F.col("embedding")))
    return unit.select(
        "vec_id",
        r6(vectors.l2_norm(F.col("embedding"))).alias("norm"),
        r6(vectors.total(F.col("u"))).alias("unit_sum"),
        r6(F.array_min("u")).alias("unit_min"),
        r6(F.array_max("u")).alias("unit_max"),
        r6(F.element_at("u", 1)).alias("unit_first"),
        r6(F.element_at("u", -1)).alias("unit_last"),
        r6(vectors.l2_norm(F.col("u"))).alias("unit_norm"),
    )


def stored_bank(spark, d):
    """The bank as a written table, so that joins know its size."""
    return materialize(fx.bank(spark, d), "bank")


def first_prompts(spark, d):
    """Each vector with the first prompt of its own label."""
    prompts = stored_bank(spark, d).filter("template_idx = 0").select(F.col("category_idx").alias("label"), "vec")
    return fx.embeddings(spark, d).join(prompts, "label")


@register(
    "dot_similarity",
    """SELECT vec_id, round(list_sum(list_transform(list_zip(v, vec), lambda p: p[1] * p[2])), 6) AS similarity
FROM fx_vectors JOIN fx_bank ON category_idx = label WHERE template_idx = 0""",
)
def dot_similarity(spark, d):
    rows = first_prompts(spark, d)
    return rows.select("vec_id", r6(vectors.dot(F.col("embedding"), F.col("vec"))).alias("similarity"))


@register(
    "logit_scale",
    """SELECT vec_id, round(list_sum(list_transform(list_zip(v, vec), lambda p: p[1] * p[2])) * exp(4.6052::DOUBLE), 6) AS logit
FROM fx_vectors JOIN fx_bank ON category_idx = label WHERE template_idx = 0""",
)
def logit_scale(spark, d):
    similarity = vectors.dot(F.col("embedding"), F.col("vec"))
    return first_prompts(spark, d).select("vec_id", r6(vectors.scale_logits(similarity, 4.6052)).alias("logit"))


@register(
    "softmax_probs",
    "SELECT vec_id, " + ", ".join(
        f"round(exp(logits[{i + 1}] - list_max(logits)) / list_sum(list_transform(logits, lambda x: exp(x - list_max(logits)))), 6) AS p{i}"
        for i in range(10)
    ) + " FROM fx_logits",
)
def softmax_probs(spark, d):
    probs = fx.logits(spark, d).withColumn("p", vectors.softmax(F.col("logits")))
    return probs.select("vec_id", *[r6(F.get("p", F.lit(i))).alias(f"p{i}") for i in range(10)])


@register("argmax_class", "SELECT vec_id, CAST(list_position(logits, list_max(logits)) - 1 AS INTEGER) AS class_idx, l.label AS class_name FROM fx_logits JOIN (SELECT DISTINCT label FROM embeddings) l ON l.label = list_position(logits, list_max(logits)) - 1")
def argmax_class(spark, d):
    best = fx.logits(spark, d).select("vec_id", vectors.argmax(F.col("logits")).alias("class_idx"))
    encoder = materialize(fit_label_encoder(fx.embeddings(spark, d)), "encoder")
    names = encoder.select(F.col("label_idx").alias("class_idx"), F.col("label").alias("class_name"))
    return best.join(names, "class_idx").select("vec_id", "class_idx", "class_name")


EXPANDED = """CAST(greatest(0, trunc(xmin - (xmax - xmin) * 0.2::DOUBLE)) AS INTEGER) AS bx0, CAST(greatest(0, trunc(ymin - (ymax - ymin) * 0.2::DOUBLE)) AS INTEGER) AS by0,
  CAST(least(img_w, trunc(xmax + (xmax - xmin) * 0.2::DOUBLE)) AS INTEGER) AS bx1, CAST(least(img_h, trunc(ymax + (ymax - ymin) * 0.2::DOUBLE)) AS INTEGER) AS by1"""


def box_columns(column: str):
    return [F.col(f"{column}.{c}").alias(n) for c, n in zip(["xmin", "ymin", "xmax", "ymax"], ["bx0", "by0", "bx1", "by1"])]


@register("expand_bbox", f"SELECT image_id, l_linenumber, l_partkey, l_suppkey, {EXPANDED} FROM fx_detections")
def expand_bbox(spark, d):
    boxes = detection.expanded_boxes(fx.detections(spark, d))
    return boxes.select("image_id", *TIES, *box_columns("bbox"))


@register("best_detection", "SELECT image_id, l_linenumber, l_partkey, l_suppkey, confidence, xmin, ymin, xmax, ymax FROM fx_best")
def best_detection(spark, d):
    return detection.best_detection(fx.detections(spark, d), ["image_id"], TIES)


@register(
    "pair_detections",
    """SELECT o.o_orderkey AS image_id, b.confidence, b.xmin, b.ymin, b.xmax, b.ymax, b.image_id IS NOT NULL AS yolo_detected
FROM orders o LEFT JOIN fx_best b ON b.image_id = o.o_orderkey""",
)
def pair_detections(spark, d):
    paired = detection.pair_detections(fx.images(spark, d), best_detection(spark, d), ["image_id"])
    return paired.select("image_id", "confidence", "xmin", "ymin", "xmax", "ymax", "yolo_detected")


@register(
    "yolo_detected",
    f"""SELECT o.o_orderkey AS image_id, b.image_id IS NOT NULL AS yolo_detected,
  coalesce(bx0, 0) AS bx0, coalesce(by0, 0) AS by0, coalesce(bx1, 200) AS bx1, coalesce(by1, 160) AS by1
FROM orders o LEFT JOIN (SELECT image_id, {EXPANDED} FROM fx_best) b ON b.image_id = o.o_orderkey""",
)
def yolo_detected(spark, d):
    best = detection.best_detection(fx.detections(spark, d), ["image_id"], TIES, keep=["img_w", "img_h"])
    boxes = detection.expanded_boxes(best).select("image_id", "bbox")
    paired = detection.pair_detections(fx.images(spark, d), boxes, ["image_id"])
    region = crop_region(F.col("bbox"), F.col("img_w"), F.col("img_h"))
    return paired.withColumn("region", region).select("image_id", "yolo_detected", *box_columns("region"))


def categories(spark, d):
    """Distinct part names as categories."""
    names = fit_label_encoder(fx.table(spark, d, "part"), "p_name")
    return names.select(F.col("label_idx").alias("category_idx"), F.col("label").alias("category"))


@register("expand_prompts", "SELECT category_idx, category, template_idx, template, prompt FROM fx_prompts")
def expand_prompts(spark, d):
    return zeroshot.expand_prompts(categories(spark, d), fx.TEMPLATES)


@register(
    "score_prompts",
    """SELECT vec_id, CAST(count(*) AS INTEGER) AS categories, round(max(score), 6) AS best, round(min(score), 6) AS worst,
  round(sum(score * (category_idx + 1)), 6) AS checksum FROM fx_scores GROUP BY vec_id""",
)
def score_prompts(spark, d):
    """All category scores of each vector stay one array; the check weighs each by its category."""
    bank = zeroshot.load_bank(fx.bank(spark, d))
    scored = zeroshot.score_prompts(fx.embeddings(spark, d), bank)
    return scored.select(
        "vec_id",
        F.size("scores").alias("categories"),
        r6(F.array_max("scores")).alias("best"),
        r6(F.array_min("scores")).alias("worst"),
        r6(vectors.total(F.transform("scores", lambda x, i: x * (i + 1)))).alias("checksum"),
    )


@register(
    "best_template",
    """SELECT vec_id, CAST(category_idx AS INTEGER) AS category_idx, round(max(list_sum(list_transform(list_zip(v, vec), lambda p: p[1] / norm * p[2]))), 6) AS score
FROM fx_vectors JOIN fx_bank ON category_idx = label WHERE norm > 0 GROUP BY vec_id, category_idx""",
)
def best_template(spark, d):
    """Best of the four templates of each vector's own category, from prompt-level scores."""
    prompts = stored_bank(spark, d).withColumnRenamed("category_idx", "label")
    pairs = fx.embeddings(spark, d).join(prompts, "label")
    unit = vectors.l2_normalize(F.col("embedding"))
    scored = pairs.select(
        "vec_id", F.col("label").alias("category_idx"), "template_idx", vectors.dot(unit, F.col("vec")).alias("score")
    )
    return zeroshot.best_template(scored).select("vec_id", "category_idx", r6("score").alias("score"))


@register(
    "topk_categories",
    "SELECT vec_id, CAST(r AS INTEGER) AS rank, CAST(category_idx AS INTEGER) AS category_idx, round(score, 6) AS score FROM fx_ranked WHERE r <= 2",
)
def topk_categories(spark, d):
    return zeroshot.topk_categories(fx.embeddings(spark, d), fx.bank(spark, d)).withColumn("score", r6("score"))


@register(
    "topk_blocked",
    "SELECT vec_id, CAST(r AS INTEGER) AS rank, CAST(category_idx AS INTEGER) AS category_idx, round(score, 6) AS score FROM fx_ranked WHERE r <= 2",
)
def topk_blocked(spark, d):
    """The same result with a bank in slices of 8 KiB."""
    best = zeroshot.topk_categories(fx.embeddings(spark, d), fx.bank(spark, d), slice_bytes=8 << 10)
    return best.withColumn("score", r6("score"))


@register(
    "zero_shot_accuracy",
    """SELECT count(*) AS n, round(avg(CASE WHEN r1 = label THEN 1.0::DOUBLE ELSE 0 END), 6) AS top1_accuracy,
  round(avg(CASE WHEN r1 = label OR r2 = label THEN 1.0::DOUBLE ELSE 0 END), 6) AS top2_accuracy
FROM (SELECT vec_id, label, max(CASE WHEN r = 1 THEN category_idx END) AS r1, max(CASE WHEN r = 2 THEN category_idx END) AS r2
  FROM fx_ranked WHERE r <= 2 GROUP BY vec_id, label) t""",
)
def zero_shot_accuracy(spark, d):
    """Top-1 and top-2 accuracy of prompt similarity against the labels, without a shuffle of the vectors."""
    bank = zeroshot.load_bank(fx.bank(spark, d))
    best = zeroshot.topk_arrays(fx.embeddings(spark, d), bank).select("label", F.col("top.idx").alias("idx"))
    first = F.get("idx", F.lit(0)) == F.col("label")
    either = F.array_contains("idx", F.col("label"))
    return best.filter("idx IS NOT NULL").agg(
        F.count(F.lit(1)).alias("n"),
        r6(F.avg(F.when(first, 1.0).otherwise(0.0))).alias("top1_accuracy"),
        r6(F.avg(F.when(either, 1.0).otherwise(0.0))).alias("top2_accuracy"),
    )


# --- hooks ------------------------------------------------------------------------------------


@register(
    "embed_batches",
    "SELECT doc_id, " + ", ".join(f"v[{i + 1}] AS e{i}" for i in range(16)) + ", CAST(NULL AS VARCHAR) AS error FROM fx_letters",
)
def embed_batches(spark, d):
    texts = spread(fx.table(spark, d, "documents").select("doc_id", "text"))
    embedded = hooks.embed_batches(texts, fx.letter_encoder, drop=("text",))
    return embedded.select("doc_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(16)], "error")


@register(
    "detect_batches",
    """SELECT doc_id AS image_id, CAST(i AS INTEGER) AS box_id, CAST(x + i AS DOUBLE) AS xmin, CAST(y + 2 * i AS DOUBLE) AS ymin,
  CAST(x + 2 * i + w AS DOUBLE) AS xmax, CAST(y + 3 * i + h AS DOUBLE) AS ymax, CAST(c + i AS DOUBLE) / 100 AS confidence, false AS failed FROM fx_text_boxes
UNION ALL SELECT doc_id, 0, NULL::DOUBLE, NULL, NULL, NULL, NULL, true FROM fx_letters WHERE CAST(v[1] AS BIGINT) % 101 = 0""",
)
def detect_batches(spark, d):
    """Boxes by the content of each document."""
    rows = hooks.detect_batches(document_images(spark, d), fx.text_detector, ["image_id"], batch_size=1024)
    box = [F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("xmin", "ymin", "xmax", "ymax", "confidence")]
    return rows.select("image_id", "box_id", *box, F.col("error").isNotNull().alias("failed"))


def prompt_bank(spark, d):
    """Prompts of all part names, encoded and at unit length."""
    prompts = zeroshot.expand_prompts(categories(spark, d), fx.TEMPLATES).withColumn("text", F.col("prompt"))
    encoded = hooks.embed_batches(prompts, fx.letter_encoder, normalize=True, drop=("text",))
    return encoded.select("category_idx", "category", "template_idx", "template", F.col("embedding").alias("vec"))


@register(
    "build_prompt_bank",
    "SELECT category_idx, category, template_idx, " + ", ".join(f"round(vec[{i + 1}], 5) AS v{i}" for i in range(16)) + " FROM fx_prompt_bank",
)
def build_prompt_bank(spark, d):
    path = shared_dir(spark, "prompt_bank")
    sinks.write_prompt_bank(prompt_bank(spark, d), path)
    bank = read_prompt_bank(spark, path)
    values = [F.round(F.get("vec", F.lit(i)).cast("double"), 5).alias(f"v{i}") for i in range(16)]
    return bank.select("category_idx", "category", "template_idx", *values)


def document_images(spark, d):
    """Documents as images: their text is the picture."""
    size = [F.lit(fx.WIDTH).alias("img_w"), F.lit(fx.HEIGHT).alias("img_h")]
    return spread(fx.table(spark, d, "documents")).select(F.col("doc_id").alias("image_id"), "text", *size)


def type_head(spark, d) -> tuple[head.Head, DataFrame]:
    """A stored head that scores each part type by the letters of its name, read back with its classes."""
    names = fx.type_encoder(spark, d).withColumn("text", F.lower("label"))
    encoded = hooks.embed_batches(names, fx.letter_encoder, normalize=True).orderBy("label_idx").select("embedding").collect()
    weights = np.array([r["embedding"] for r in encoded], dtype=np.float64).T
    path = shared_dir(spark, "head")
    sinks.write_head(head.Head([weights], [np.zeros(weights.shape[1])], [], []), names, path)
    return read_head(spark, path)


def predicted_documents(spark, d, rows=None):
    """Hybrid predictions for ``rows`` (all documents by default)."""
    path = shared_dir(spark, "prompt_bank")
    sinks.write_prompt_bank(prompt_bank(spark, d), path)
    stored = spark.read.parquet(path)
    net, classes = type_head(spark, d)
    return hybrid.hybrid_predict(
        document_images(spark, d) if rows is None else rows,
        fx.text_detector,
        fx.letter_encoder,
        zeroshot.load_bank(stored),
        stored.filter("template_idx = 0"),
        net,
        classes,
        keep=["image_id"],
        synonyms=fx.synonyms(spark, d),
    )


HYBRID = ["image_id", "mobileclip_top1", "mobileclip_top2", "classifier_pred", "yolo_detected"]


@register("hybrid_predict", f"SELECT {', '.join(HYBRID)} FROM fx_hybrid")
def hybrid_predict(spark, d):
    """Detect, crop, embed, the two best categories by their dataset labels, and the head's class."""
    return predicted_documents(spark, d).filter("error IS NULL").select(*HYBRID)


@register("score_head")
def score_head(spark, d):
    rows = fx.embeddings(spark, d)
    width, classes = rows.agg(F.max(F.size("embedding")), F.count_distinct("label")).first()
    scored = head.score_head(rows, head.random_head(width, classes, seed=7))
    return scored.select(
        "vec_id",
        vectors.argmax(F.col("logits")).alias("class_idx"),
        r6(F.array_max("logits")).alias("top_logit"),
        r6(F.array_max(vectors.softmax(F.col("logits")))).alias("top_prob"),
    )


@register(
    "score_linear_head",
    """SELECT vec_id, CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS class_idx, round(list_max(z), 6) AS top_logit, round(list_sum(list_transform(list_zip(z, range(1, 11)), lambda p: p[1] * p[2])), 5) AS checksum
FROM (SELECT vec_id, list_transform(range(10), lambda c: list_sum(list_transform(list_zip(v, range(len(v))), lambda p: p[1] / norm * ((p[2] * 7 + c * 3) % 11 - 5) / 10)) + (c % 3) / 8::DOUBLE) AS z FROM fx_vectors WHERE norm > 0) t""",
)
def score_linear_head(spark, d):
    """A head without hidden layers, of fixed weights."""
    rows = fx.embeddings(spark, d)
    width = rows.agg(F.max(F.size("embedding"))).first()[0]
    weights = ((np.arange(width)[:, None] * 7 + np.arange(10) * 3) % 11 - 5) / 10
    scored = head.score_head(rows, head.Head([weights], [np.arange(10) % 3 / 8], [], [])).filter("logits IS NOT NULL")
    weighed = vectors.total(F.transform("logits", lambda x, i: x * (i + 1)))
    return scored.select("vec_id", vectors.argmax(F.col("logits")).alias("class_idx"), r6(F.array_max("logits")).alias("top_logit"), F.round(weighed, 5).alias("checksum"))
