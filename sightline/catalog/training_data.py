"""Queries on the training set: encoder, split, weights, loss and fitted heads."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.catalog import fixtures as fx
from sightline.catalog.registry import r6, register
from sightline.functions import vectors
from sightline.operators import dataset, head, hooks, training
from sightline.plans.preparation import prepare
from sightline.session import materialize, shared_dir, spread
from sightline.sources import sinks, tables


@register("fit_label_encoder", "SELECT CAST(row_number() OVER (ORDER BY p_name) - 1 AS INTEGER) AS label_idx, p_name AS label FROM (SELECT DISTINCT p_name FROM part) t")
def fit_label_encoder(spark, d):
    return dataset.fit_label_encoder(fx.table(spark, d, "part"), "p_name")


@register(
    "embedding_stats",
    "SELECT count(*) AS n, CAST(min(len(embedding)) AS INTEGER) AS min_dim, CAST(max(len(embedding)) AS INTEGER) AS max_dim, count(DISTINCT label) AS classes FROM embeddings",
)
def embedding_stats(spark, d):
    return dataset.embedding_stats(fx.embeddings(spark, d))


@register("stratified_split", "SELECT vec_id, label, split FROM fx_split")
def stratified_split(spark, d):
    return dataset.stratified_split(fx.embeddings(spark, d)).select("vec_id", "label", "split")


@register("class_weights", "SELECT label, n, round(weight, 6) AS weight FROM fx_weights")
def class_weights(spark, d):
    train = dataset.stratified_split(fx.embeddings(spark, d)).filter("split = 'train'")
    return dataset.class_weights(train).withColumn("weight", r6("weight"))


@register(
    "concat_samples",
    """SELECT source, label, count(*) AS n, round(sum(s), 4) AS total FROM
(SELECT 'embeddings' AS source, label, list_sum(v) AS s FROM fx_vectors UNION ALL SELECT 'bank', category_idx, list_sum(vec) FROM fx_bank) t GROUP BY 1, 2""",
)
def concat_samples(spark, d):
    rows = fx.embeddings(spark, d).select(F.lit("embeddings").alias("source"), "label", "embedding")
    prompts = fx.bank(spark, d).select(
        F.lit("bank").alias("source"), F.col("category_idx").alias("label"), F.col("vec").alias("embedding")
    )
    total = vectors.total(vectors.as_double(F.col("embedding")))
    return dataset.concat_samples(rows, prompts).groupBy("source", "label").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(total), 4).alias("total")
    )


@register(
    "weighted_ce_loss",
    """SELECT round(avg(loss), 6) AS loss, count(*) AS batches FROM
(SELECT vec_id // 64 AS batch, (0.9::DOUBLE * sum(-w[label_idx + 1] * logp[label_idx + 1]) + 0.1::DOUBLE / 10 * sum(-list_sum(list_transform(list_zip(w, logp), lambda p: p[1] * p[2])))) / sum(w[label_idx + 1]) AS loss
 FROM fx_logp CROSS JOIN (SELECT list(weight ORDER BY label) AS w FROM fx_weights) x GROUP BY 1) t""",
)
def weighted_ce_loss(spark, d):
    """Loss of all rows in batches of 64 keys, with the weights of the train split."""
    train = dataset.stratified_split(fx.embeddings(spark, d)).filter("split = 'train'")
    weights = dataset.class_weights(train)
    rows = fx.logits(spark, d).withColumn("batch", F.floor(F.col("vec_id") / 64))
    losses = training.weighted_ce_loss(rows, training.weight_vector(weights, "label"), "batch")
    return training.epoch_loss(losses).withColumn("loss", r6("loss"))


@register("train_head", "SELECT unnest(['train', 'val']) AS split, count(DISTINCT lang) AS classes, true AS learned, true AS reloaded_alike FROM documents")
def train_head(spark, d):
    """A linear head that tells a document's language by its letters, fitted on the train side, stored and read back:
    is it right for four rows of five on each side, and does the stored head score like the fitted one?"""
    texts = spread(fx.table(spark, d, "documents").filter("lang IS NOT NULL")).select("doc_id", "text", F.col("lang").alias("label"))
    rows = materialize(hooks.embed_batches(texts, fx.letter_encoder, normalize=True, drop=("text",)).filter("error IS NULL"), "letters")
    samples, weights, encoder = prepare(rows, "doc_id")
    model = head.train_linear_head(samples.filter("split = 'train'"), weights, reg=1e-6)
    path = shared_dir(spark, "head")
    sinks.write_head(head.linear_head(model), encoder, path)
    stored, classes = tables.read_head(spark, path)
    scored = head.score_head(head.score_linear_head(samples, model), stored, out="again", normalize=False)
    named = scored.withColumn("class_idx", vectors.argmax(F.col("again"))).join(classes.select(F.col("label_idx").alias("class_idx"), F.col("label").alias("found")), "class_idx")
    differ = F.array_max(F.transform(F.arrays_zip("logits", "again"), lambda x: F.abs(x["logits"] - x["again"])))
    return named.groupBy("split").agg(
        F.count_distinct("label").alias("classes"),
        (F.avg(F.when(F.col("found") == F.col("label"), 1.0).otherwise(0.0)) >= 0.8).alias("learned"),
        (F.max(differ) < 1e-9).alias("reloaded_alike"),
    )
