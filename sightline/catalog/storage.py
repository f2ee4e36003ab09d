"""Queries that write the given tables in one of the file formats and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.catalog import fixtures as fx
from sightline.catalog.evaluation import HYBRID_RATES, hybrid_sql, rounded, saved_predictions
from sightline.catalog.labelling import classifier_labels
from sightline.catalog.registry import r6, register
from sightline.catalog.scoring import categories
from sightline.catalog.views import POSITIONAL_ID, PREFIX
from sightline.functions import paths, vectors
from sightline.operators import hooks, labels, metrics
from sightline.operators.labels import resolve_labels
from sightline.plans.embedding import extract_embeddings, run_manifest
from sightline.plans.preparation import prepare
from sightline.schemas import PREDICTION_FIELDS
from sightline.session import materialize, shared_dir, spread
from sightline.sources import documents, sinks, tables

DOCUMENT_ROWS = 20_000  # entries per written document


def pieces(df: DataFrame, key: str) -> DataFrame:
    """Add ``piece``: rows spread by hash over documents of about DOCUMENT_ROWS entries."""
    count = df.agg(F.ceil(F.count(F.lit(1)) / DOCUMENT_ROWS).alias("n")).scalar()
    return df.withColumn("piece", F.pmod(F.xxhash64(key), F.greatest(count, F.lit(1))))


def write_documents(docs: DataFrame, path: str) -> None:
    """One document per line."""
    docs.select("value").write.text(path)


def dictionary(key: str, value: str):
    """JSON object of a group's (key, value) pairs."""
    entries = F.map_from_entries(F.collect_list(F.struct(key, value)))
    return F.to_json(entries, {"ignoreNullFields": "false"})


@register("read_manifest", f"SELECT image_path, '{PREFIX}' AS prefix, '{PREFIX}' || image_path AS uri FROM fx_manifest")
def read_manifest(spark, d):
    path = shared_dir(spark, "manifest")
    listed = F.to_json(F.concat(F.array(F.lit("#")), F.collect_list("image_path")))
    docs = pieces(fx.manifest(spark, d), "image_path").groupBy("piece").agg(listed.alias("value"))
    header = F.lit('{"prefix": "%s"}' % PREFIX)
    write_documents(docs.select(F.replace("value", F.lit('"#"'), header).alias("value")), path)
    return documents.read_manifest(spark, path, whole_files=False).select("image_path", "prefix", "uri")


def manifest_lines(spark, d) -> DataFrame:
    path = shared_dir(spark, "manifest_lines")
    fx.manifest(spark, d).select(F.lit(PREFIX).alias("prefix"), "image_path").write.json(path)
    return documents.read_manifest_lines(spark, path)


@register(
    "read_manifest_lines",
    "SELECT count(*) AS n, count(DISTINCT image_path) AS paths, 1::BIGINT AS first_pos, count(*) AS last_pos, CAST(count(*) * (count(*) + 1) // 2 AS BIGINT) AS pos_sum FROM fx_manifest",
)
def read_manifest_lines(spark, d):
    return manifest_lines(spark, d).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("image_path").alias("paths"),
        F.min("pos").alias("first_pos"),
        F.max("pos").alias("last_pos"),
        F.sum("pos").alias("pos_sum"),
    )


@register("read_label_map", "SELECT object_id, label FROM fx_names")
def read_label_map(spark, d):
    """Half of the documents are objects, half are record lists."""
    path = shared_dir(spark, "label_map")
    records = F.to_json(F.collect_list(F.struct("object_id", F.col("label").alias("name"))))
    rows = pieces(fx.database(spark, d), "object_id").withColumn("shape", F.pmod(F.crc32("object_id"), F.lit(2)))
    docs = rows.groupBy("piece", "shape").agg(
        F.when(F.col("shape") == 0, dictionary("object_id", "label")).otherwise(records).alias("value")
    )
    write_documents(docs, path)
    return documents.read_label_map(spark, path, whole_files=False)


@register("read_override_map", "SELECT object_id, label FROM fx_overrides")
def read_override_map(spark, d):
    path = shared_dir(spark, "overrides")
    docs = pieces(fx.overrides(spark, d), "object_id").groupBy("piece").agg(dictionary("object_id", "label").alias("value"))
    write_documents(docs, path)
    return documents.read_override_map(spark, path, whole_files=False)


@register("read_id_name_csv", "SELECT object_id, label FROM fx_names")
def read_id_name_csv(spark, d):
    path = shared_dir(spark, "database")
    rows = fx.database_rows(spark, d).withColumnRenamed("id", "trainingID")
    rows.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return documents.read_id_name_csv(spark, path, "trainingID", multi_line=False)


@register("read_synonyms", "SELECT category, canonical FROM fx_synonyms")
def read_synonyms(spark, d):
    path = shared_dir(spark, "synonyms")
    lists = pieces(fx.synonyms(spark, d), "category").withColumn("listed", F.array("canonical", F.lit("unused")))
    doc = F.concat(F.lit('{"category_to_objects": '), dictionary("category", "listed"), F.lit("}"))
    write_documents(lists.groupBy("piece").agg(doc.alias("value")), path)
    return documents.read_synonyms(spark, path, whole_files=False)


@register("read_prompts", "SELECT category_idx, category, template_idx, template FROM fx_prompts")
def read_prompts(spark, d):
    """The category list is one document: it is the class list of a classifier."""
    path = shared_dir(spark, "prompts")
    names = F.transform(F.array_sort(F.collect_list(F.struct("category_idx", "category"))), lambda c: c["category"])
    lists = F.struct(names.alias("categories"), F.array(*[F.lit(t) for t in fx.TEMPLATES]).alias("templates"))
    write_documents(categories(spark, d).agg(F.to_json(lists).alias("value")), path)
    return documents.read_prompt_pairs(spark, path)


@register(
    "read_images",
    "SELECT page_id // 50 AS shard, CAST(sum(octet_length(encode(html)) + 1) AS BIGINT) AS bytes, count(*) AS pages FROM pages GROUP BY 1",
)
def read_images(spark, d):
    """Raw pages as binary payloads: fifty pages to a folder, read whole."""
    path = shared_dir(spark, "images")
    shards = fx.table(spark, d, "pages").select(F.floor(F.col("page_id") / 50).alias("shard"), "html")
    clean = shards.withColumn("html", F.concat("html", F.lit("\x00")))
    clean.write.partitionBy("shard").option("lineSep", "\n").text(path)
    files = tables.read_images(spark, path, pattern="part-*")
    ends = F.length(F.col("content")) - F.length(F.replace(F.decode("content", "ISO-8859-1"), F.lit("\x00"), F.lit("")))
    return (
        files.select(F.regexp_extract("uri", r"shard=(\d+)", 1).cast("bigint").alias("shard"), "length", ends.alias("ends"))
        .groupBy("shard")
        .agg((F.sum("length") - F.sum("ends")).alias("bytes"), F.sum("ends").cast("bigint").alias("pages"))
    )


@register(
    "read_manifest_images",
    """SELECT CAST(page_id AS VARCHAR) || '.html' AS image_path, CASE WHEN page_id % 37 <> 0 THEN strlen(html) END AS length, CASE WHEN page_id % 37 <> 0 THEN md5(html) END AS digest,
  CASE WHEN page_id % 37 = 0 THEN 'image not found' END AS failure FROM pages WHERE html IS NOT NULL""",
)
def read_manifest_images(spark, d):
    """Pages as image files named by a manifest, some of which are missing."""
    path = shared_dir(spark, "page_files")
    name = F.concat(F.col("page_id").cast("string"), F.lit(".html"))
    pages = spread(fx.table(spark, d, "pages").filter("html IS NOT NULL")).select("page_id", name.alias("image_path"), F.col("html").cast("binary").alias("content"))
    materialize(sinks.write_images(pages.filter("page_id % 37 <> 0"), path), "written_images")
    manifest = pages.select("image_path", F.concat(F.lit(f"{path}/"), "image_path").alias("uri"))
    images = tables.read_manifest_images(manifest, task_bytes=1 << 20)
    return images.select("image_path", "length", F.md5("content").alias("digest"), F.regexp_extract("read_error", "^[^:]+", 0).alias("failure"))


def document_rows(spark, d) -> DataFrame:
    """Documents as images of seven batches, some with malformed paths."""
    batch = F.concat(F.lit("D"), (F.col("doc_id") % 7).cast("string"))
    name = F.concat(batch, F.lit("_"), (F.col("doc_id") % 3000).cast("string"), F.lit("-B_IM"), F.col("doc_id").cast("string"), F.lit(".png"))
    path = F.when(F.col("doc_id") % 31 == 0, F.concat(batch, F.lit("/broken.png"))).otherwise(F.concat(batch, F.lit("/"), name))
    return spread(fx.table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "text", path.alias("image_path"))


def document_embeddings(spark, d) -> DataFrame:
    return extract_embeddings(document_rows(spark, d), classifier_labels(spark, d), fx.letter_encoder, payload=("text",))


EMBEDDED = f"""SELECT split_part(image_path, '/', 1) AS batch_id, split_part(image_path, '/', -1) AS image, m.object_id AS "objectID",
  CASE WHEN r.object_id IS NULL THEN 'UNKNOWN' ELSE r.label END AS label, 16 AS dim, list_sum(list_transform(list_zip(v, range(1, 17)), lambda p: p[1] * p[2])) AS checksum
FROM (SELECT p.doc_id, image_path, v, {POSITIONAL_ID} AS object_id FROM fx_doc_paths p JOIN fx_letters l ON l.doc_id = p.doc_id) m
LEFT JOIN (SELECT * FROM fx_resolved WHERE mapped) r ON r.object_id = m.object_id WHERE m.object_id IS NOT NULL"""


def checksum(vector: str):
    """Element sum weighted by position."""
    weighted = F.transform(vectors.as_double(F.col(vector)), lambda x, i: x * (i + 1))
    return vectors.total(weighted)


@register("extract_embeddings", EMBEDDED)
def extract_embeddings_query(spark, d):
    good = document_embeddings(spark, d).filter("error IS NULL")
    return good.select("batch_id", "image", "objectID", "label", F.size("embedding").alias("dim"), checksum("embedding").alias("checksum"))


CROPPED = f"""SELECT split_part(image_path, '/', -1) AS image, m.object_id AS "objectID", CASE WHEN r.object_id IS NULL THEN 'UNKNOWN' ELSE r.label END AS label,
  list_sum(list_transform(list_zip(v, range(1, 17)), lambda p: p[1] * p[2])) AS checksum, error
FROM (SELECT p.image_path, {POSITIONAL_ID} AS object_id, CASE WHEN {POSITIONAL_ID} IS NOT NULL AND p.doc_id % 41 <> 0 THEN s.v END AS v,
  CASE WHEN {POSITIONAL_ID} IS NULL THEN 'Unexpected filename format' WHEN p.doc_id % 41 = 0 THEN 'image not found' WHEN s.doc_id IS NULL THEN 'ValueError' END AS error
  FROM fx_doc_paths p LEFT JOIN fx_seen_letters s ON s.doc_id = p.doc_id) m LEFT JOIN (SELECT * FROM fx_resolved WHERE mapped) r ON r.object_id = m.object_id"""


@register(
    "run_manifest",
    f"""SELECT image, "objectID", label, checksum, CAST(NULL AS VARCHAR) AS error FROM ({CROPPED}) t WHERE error IS NULL
UNION ALL SELECT image, NULL, NULL, NULL, error FROM ({CROPPED}) t WHERE error IS NOT NULL""",
)
def run_manifest_query(spark, d):
    """From a manifest and image files to records and failures: read, detect, crop, embed, label."""
    path = shared_dir(spark, "document_files")
    rows = document_rows(spark, d).filter("text IS NOT NULL")
    files = rows.filter("doc_id % 41 <> 0").select("image_path", F.col("text").alias("content"))
    materialize(sinks.write_images(files, path), "written_images")
    manifest = rows.select(F.col("doc_id").alias("pos"), "image_path", F.concat(F.lit(f"{path}/"), "image_path").alias("uri"))
    decode = lambda images: images.select(
        "pos", "image_path", "read_error", F.decode("content", "UTF-8").alias("text"), F.lit(fx.WIDTH).alias("img_w"), F.lit(fx.HEIGHT).alias("img_h")
    )
    records, failures = run_manifest(manifest, classifier_labels(spark, d), fx.letter_encoder, fx.text_detector, prepare=decode)
    good = records.select("image", "objectID", "label", checksum("embedding").alias("checksum"), F.lit(None).cast("string").alias("error"))
    short = F.regexp_extract("error", r"^[^:(]+", 0)
    bad = failures.select(F.element_at(F.split("image", "/"), -1).alias("image"), short.alias("error"))
    return good.unionByName(bad, allowMissingColumns=True)


@register("write_embeddings", EMBEDDED)
def write_embeddings(spark, d):
    """Written by batch, then read back with the batch taken from the folder name."""
    path = shared_dir(spark, "embeddings")
    sinks.write_embeddings(document_embeddings(spark, d).filter("error IS NULL"), path)
    back = tables.read_embeddings(spark, path)
    batch = F.regexp_extract(F.input_file_name(), r"batch_id=([^/]+)/", 1)
    return back.select(
        batch.alias("batch_id"), "image", "objectID", "label", F.size("embedding").alias("dim"), checksum("embedding").alias("checksum")
    )


@register(
    "read_embeddings",
    """SELECT concat('V', CAST(vec_id AS VARCHAR)) AS image, CAST(label AS VARCHAR) AS label, len(v) AS dim,
  round(list_sum(list_transform(list_zip(v, range(1, len(v) + 1)), lambda p: p[1] * p[2])), 4) AS checksum FROM fx_vectors""",
)
def read_embeddings(spark, d):
    """Lists of records, one list per file, a failures file beside them being ignored."""
    path = shared_dir(spark, "embedding_files")
    records = fx.embeddings(spark, d).select(
        F.concat(F.lit("V"), F.col("vec_id").cast("string")).alias("image"),
        F.lit("id").alias("objectID"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<float>").alias("embedding"),
    )
    lists = pieces(records, "image").groupBy("piece").agg(
        F.to_json(F.collect_list(F.struct("image", "objectID", "label", "embedding"))).alias("value")
    )
    lists.write.partitionBy("piece").text(f"{path}/lists")
    spark.range(1).select(F.lit("x").alias("image"), F.lit("e").alias("error")).write.json(f"{path}/failures")
    back = tables.read_embeddings(spark, path, pattern="*.txt")
    return back.select("image", "label", F.size("embedding").cast("bigint").alias("dim"), F.round(checksum("embedding"), 4).alias("checksum"))


SAVED = """SELECT image, object_id, mobileclip_gt, mobileclip_top1, mobileclip_top2, classifier_gt, classifier_pred, yolo_detected, mobileclip_ms,
  round(classifier_ms, 6) AS classifier_ms, round(pipeline_ms, 6) AS pipeline_ms, strict_hit OR head_hit AS hybrid_correct FROM fx_flags"""


@register("read_predictions", SAVED)
def read_predictions(spark, d):
    back = tables.read_predictions(spark, saved_predictions(spark, d))
    return back.withColumn("classifier_ms", r6("classifier_ms")).withColumn("pipeline_ms", r6("pipeline_ms"))


@register(
    "write_predictions",
    """SELECT image, classifier_pred, CASE WHEN yolo_detected THEN 'True' WHEN yolo_detected IS NOT NULL THEN 'False' END AS yolo_detected,
  CASE WHEN strict_hit OR head_hit THEN 'True' ELSE 'False' END AS hybrid_correct, mobileclip_ms IS NULL AS no_time FROM fx_flags""",
)
def write_predictions(spark, d):
    """The written text itself: flag spelling and empty fields."""
    schema = ", ".join(f"{name} string" for name in PREDICTION_FIELDS)
    raw = spark.read.schema(schema).csv(saved_predictions(spark, d), header=True, enforceSchema=False)
    return raw.select("image", "classifier_pred", "yolo_detected", "hybrid_correct", F.col("mobileclip_ms").isNull().alias("no_time"))


@register("write_label_map", "SELECT object_id, label FROM fx_resolved WHERE mapped")
def write_label_map(spark, d):
    path = shared_dir(spark, "label_lines")
    sinks.write_label_map(classifier_labels(spark, d), path)
    return documents.read_label_lines(spark, path)


@register(
    "write_failures",
    f"SELECT image_path AS image, 'Unexpected filename format: ' || image_path AS error FROM fx_manifest WHERE {POSITIONAL_ID} IS NULL",
)
def write_failures(spark, d):
    path = shared_dir(spark, "failures")
    checked = fx.manifest(spark, d).withColumn("error", paths.path_error(F.col("image_path")))
    sinks.write_failures(hooks.failure_split(checked)[1], path)
    return spark.read.schema("image string, error string").json(path)


@register("write_report", f"SELECT {hybrid_sql('strict_hit')} FROM fx_flags")
def write_report(spark, d):
    path = shared_dir(spark, "report")
    report = metrics.metrics_report(fx.predictions(spark, d), fx.type_encoder(spark, d))
    sinks.write_report(report, path)
    return rounded(spark.read.schema(report.schema).json(path).select("hybrid.*"), HYBRID_RATES)


def prepared(spark, d) -> str:
    path = shared_dir(spark, "prepared")
    rows = fx.embeddings(spark, d).withColumn("label", F.col("label").cast("string"))
    sinks.write_prepared(*prepare(rows, "vec_id"), path)
    return path


@register(
    "read_prepared",
    """SELECT split, label AS label_idx, count(*) AS n, round(sum(list_sum(CAST(embedding AS DOUBLE[]))), 4) AS total FROM fx_split GROUP BY 1, 2""",
)
def read_prepared(spark, d):
    train, val, _ = tables.read_prepared(spark, prepared(spark, d))
    both = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
    return both.groupBy("split", "label_idx").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(vectors.total(vectors.as_double(F.col("embedding")))), 4).alias("total")
    )


@register("write_prepared", "SELECT label AS label_idx, CAST(label AS VARCHAR) AS label, n, round(weight, 6) AS weight FROM fx_weights")
def write_prepared(spark, d):
    """The two lookup tables of a prepared dataset."""
    path = prepared(spark, d)
    weights = tables.read_prepared(spark, path)[2]
    encoder = documents.read_label_encoder(spark, f"{path}/label_encoder", whole_files=False)
    return encoder.join(weights, "label_idx").select("label_idx", "label", "n", r6("weight").alias("weight"))


@register("read_label_encoder", "SELECT label_idx, label FROM fx_encoder")
def read_label_encoder(spark, d):
    path = shared_dir(spark, "encoder")
    encoder = fx.type_encoder(spark, d).withColumn("label_idx", F.col("label_idx").cast("string"))
    write_documents(encoder.agg(dictionary("label_idx", "label").alias("value")), path)
    return documents.read_label_encoder(spark, path, whole_files=False)


@register(
    "read_prompt_bank",
    """SELECT category_idx, CAST(template_idx AS INTEGER) AS template_idx, len(vec) AS dim,
  round(list_sum(list_transform(list_zip(vec, range(1, len(vec) + 1)), lambda p: p[1] * p[2])), 4) AS checksum FROM fx_bank""",
)
def read_prompt_bank(spark, d):
    path = shared_dir(spark, "bank")
    sinks.write_prompt_bank(fx.bank(spark, d), path)
    bank = tables.read_prompt_bank(spark, path)
    return bank.select("category_idx", "template_idx", F.size("vec").cast("bigint").alias("dim"), F.round(checksum("vec"), 4).alias("checksum"))


@register("write_training_outputs", "SELECT run_id, epoch, round(val_accuracy, 6) AS val_accuracy, round(train_loss, 6) AS train_loss FROM fx_history")
def write_training_outputs(spark, d):
    path = shared_dir(spark, "training")
    counts = labels.known_class_filter(
        metrics.confusion_counts(fx.predictions(spark, d), "classifier_gt", "classifier_pred"), fx.type_encoder(spark, d), "y"
    )
    sinks.write_training_outputs(
        fx.history(spark, d),
        metrics.classification_metrics(counts),
        metrics.classification_report(counts, fx.type_encoder(spark, d)),
        path,
    )
    back = spark.read.schema("run_id string, epoch int, val_accuracy double, train_loss double").json(f"{path}/training_history")
    return rounded(back, ["val_accuracy", "train_loss"])


@register("resolve_written_labels", "SELECT object_id, label, mapped FROM fx_resolved")
def resolve_written_labels(spark, d):
    """Label resolution from files alone: manifest, database and overrides as written above."""
    ids = labels.distinct_object_ids(read_manifest(spark, d))
    return resolve_labels(ids, read_override_map(spark, d), read_id_name_csv(spark, d))
