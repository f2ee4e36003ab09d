"""Queries on paths, labels and label maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.catalog import fixtures as fx
from sightline.catalog.registry import register
from sightline.catalog.views import POSITIONAL_ID, PREFIX, STRICT_ID, normalized
from sightline.functions import paths
from sightline.functions.text import normalize_label
from sightline.operators import hooks, labels
from sightline.plans.label_map import build_label_map
from sightline.session import materialize

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@register("object_id_strict", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {STRICT_ID} AS object_id FROM fx_manifest")
def object_id_strict(spark, d):
    return fx.manifest(spark, d).select(*KEYS, paths.object_id_strict(F.col("image_path")).alias("object_id"))


@register("object_id_positional", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {POSITIONAL_ID} AS object_id FROM fx_manifest")
def object_id_positional(spark, d):
    return fx.manifest(spark, d).select(*KEYS, paths.object_id_positional(F.col("image_path")).alias("object_id"))


@register("batch_id", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, split_part(image_path, '/', 1) AS batch_id FROM fx_manifest")
def batch_id(spark, d):
    return fx.manifest(spark, d).select(*KEYS, paths.batch_id(F.col("image_path")).alias("batch_id"))


@register("image_basename", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, split_part(image_path, '/', -1) AS image FROM fx_manifest")
def image_basename(spark, d):
    return fx.manifest(spark, d).select(*KEYS, paths.image_basename(F.col("image_path")).alias("image"))


@register(
    "split_uri",
    f"""SELECT uri, starts_with(uri, 's3://') AS is_object_store, split_part(split_part(split_part(substr(uri, strpos(uri, '://') + 3), '/', 1), '?', 1), '#', 1) AS bucket,
  ltrim(regexp_extract(uri, '^[^:]+://[^/?#]*([^?#]*)', 1), '/') AS key
FROM (SELECT url AS uri FROM pages UNION ALL SELECT '{PREFIX}' || image_path FROM fx_manifest) t""",
)
def split_uri(spark, d):
    urls = fx.table(spark, d, "pages").select(F.col("url").alias("uri"))
    uris = urls.unionAll(fx.manifest(spark, d).select(F.concat(F.lit(PREFIX), "image_path")))
    uri = F.col("uri")
    return uris.select(
        "uri",
        paths.is_object_store_uri(uri).alias("is_object_store"),
        paths.uri_bucket(uri).alias("bucket"),
        paths.uri_key(uri).alias("key"),
    )


DIRTY = "concat(' ', replace(p_name, ' ', '_'), CASE WHEN p_partkey % 2 = 0 THEN '_' ELSE ' ' END)"


@register("normalize_label", f"SELECT p_partkey, {normalized(DIRTY)} AS label FROM part")
def normalize_label_query(spark, d):
    ends = F.when(F.col("p_partkey") % 2 == 0, "_").otherwise(" ")
    dirty = F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("_")), ends)
    return fx.table(spark, d, "part").select("p_partkey", normalize_label(dirty).alias("label"))


CANONICAL = f"""SELECT p.p_partkey, coalesce(s.canonical, {normalized('p.p_name')}) AS canonical
FROM part p LEFT JOIN fx_synonyms s ON s.category = {normalized('p.p_name')}"""


@register("canonical_label", CANONICAL)
def canonical_label(spark, d):
    part = fx.table(spark, d, "part").select("p_partkey", "p_name")
    return labels.synonym_join(part, fx.synonyms(spark, d), "p_name", "canonical").select("p_partkey", "canonical")


@register(
    "synonym_join",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(s.canonical, {normalized('p.p_name')}) AS canonical
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN fx_synonyms s ON s.category = {normalized('p.p_name')}""",
)
def synonym_join(spark, d):
    """The synonym table meets the parts, of which there are far fewer than line items."""
    part = fx.table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    named = labels.synonym_join(part, fx.synonyms(spark, d), "p_name", "canonical").select("l_partkey", "canonical")
    return fx.table(spark, d, "lineitem").join(named, "l_partkey").select(*KEYS, "canonical")


@register("distinct_object_ids", "SELECT object_id FROM fx_ids")
def distinct_object_ids(spark, d):
    return labels.distinct_object_ids(fx.manifest(spark, d))


@register(
    "unmatched_paths",
    f"""SELECT image_path, (SELECT count(*) FROM fx_manifest WHERE {STRICT_ID} IS NULL) AS total_unmatched
FROM fx_manifest WHERE {STRICT_ID} IS NULL ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, image_path LIMIT 10""",
)
def unmatched_paths(spark, d):
    return labels.unmatched_paths(fx.manifest(spark, d), KEYS)


@register(
    "parser_disagreements",
    f"""SELECT image_path, strict_id, positional_id FROM
(SELECT image_path, {STRICT_ID} AS strict_id, {POSITIONAL_ID} AS positional_id FROM fx_manifest) t WHERE strict_id IS DISTINCT FROM positional_id""",
)
def parser_disagreements(spark, d):
    return labels.parser_disagreements(fx.manifest(spark, d))


@register("resolve_labels", "SELECT object_id, label, mapped FROM fx_resolved")
def resolve_labels(spark, d):
    ids = labels.distinct_object_ids(fx.manifest(spark, d))
    return labels.resolve_labels(ids, fx.overrides(spark, d), fx.database(spark, d))


@register("unmapped_ids", "SELECT object_id FROM fx_resolved WHERE NOT mapped")
def unmapped_ids(spark, d):
    ids = labels.distinct_object_ids(fx.manifest(spark, d))
    return labels.unmapped_ids(ids, fx.overrides(spark, d), fx.database(spark, d))


@register(
    "unmapped_sample",
    """SELECT object_id, (SELECT count(*) FROM fx_resolved WHERE NOT mapped) AS total_unmapped
FROM fx_resolved WHERE NOT mapped ORDER BY object_id LIMIT 10""",
)
def unmapped_sample(spark, d):
    return labels.unmapped_sample(unmapped_ids(spark, d))


@register(
    "build_label_map",
    """SELECT 'classifier' AS ground_truth, object_id, label, mapped FROM fx_resolved
UNION ALL SELECT 'mobileclip', i.object_id, d.label, d.object_id IS NOT NULL FROM fx_ids i LEFT JOIN fx_names d ON d.object_id = i.object_id""",
)
def build_label_map_query(spark, d):
    manifest, names, curated = fx.manifest(spark, d), fx.database(spark, d), fx.overrides(spark, d)
    both = [
        build_label_map(manifest, names, curated, truth).select(F.lit(truth).alias("ground_truth"), "*")
        for truth in ("classifier", "mobileclip")
    ]
    return both[0].unionByName(both[1])


def classifier_labels(spark, d):
    """Resolved labels of the head's vocabulary, unmapped IDs left out, as a written label map."""
    return materialize(resolve_labels(spark, d).filter("mapped").select("object_id", "label"), "head_labels")


@register(
    "label_lookup_default",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN r.object_id IS NULL THEN 'UNKNOWN' ELSE r.label END AS label
FROM (SELECT *, {POSITIONAL_ID} AS object_id FROM fx_manifest) m LEFT JOIN (SELECT * FROM fx_resolved WHERE mapped) r ON r.object_id = m.object_id""",
)
def label_lookup_default(spark, d):
    rows = fx.manifest(spark, d).withColumn("object_id", paths.object_id_positional(F.col("image_path")))
    return labels.label_lookup_default(rows, classifier_labels(spark, d)).select(*KEYS, "label")


@register(
    "dual_truth_join",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  coalesce(s.canonical, {normalized("CASE WHEN a.object_id IS NULL THEN 'UNKNOWN' ELSE a.label END")}) AS mobileclip_gt,
  CASE WHEN r.object_id IS NULL THEN 'UNKNOWN' ELSE r.label END AS classifier_gt
FROM (SELECT *, {POSITIONAL_ID} AS object_id FROM fx_manifest) m
LEFT JOIN fx_names a ON a.object_id = m.object_id
LEFT JOIN fx_synonyms s ON s.category = {normalized("CASE WHEN a.object_id IS NULL THEN 'UNKNOWN' ELSE a.label END")}
LEFT JOIN (SELECT * FROM fx_resolved WHERE mapped) r ON r.object_id = m.object_id""",
)
def dual_truth_join(spark, d):
    rows = fx.manifest(spark, d).withColumn("object_id", paths.object_id_positional(F.col("image_path")))
    joined = labels.dual_truth_join(rows, fx.database(spark, d), classifier_labels(spark, d), fx.synonyms(spark, d))
    return joined.select(*KEYS, "mobileclip_gt", "classifier_gt")


@register(
    "group_by_label",
    """SELECT label, (place - 1) // 100 AS piece, string_agg(object_id, ',' ORDER BY place) AS object_ids
FROM (SELECT label, object_id, row_number() OVER (PARTITION BY label ORDER BY object_id) AS place FROM fx_names) t GROUP BY 1, 2""",
)
def group_by_label(spark, d):
    grouped = labels.group_by_label(fx.database(spark, d), size=100)
    return grouped.select("label", "piece", F.array_join("object_ids", ",").alias("object_ids"))


@register("reverse_label_map", "SELECT object_id, label FROM fx_names")
def reverse_label_map(spark, d):
    return labels.reverse_label_map(labels.group_by_label(fx.database(spark, d)))


@register(
    "duplicate_ids",
    "SELECT object_id, count(*) AS n FROM (SELECT object_id FROM fx_names UNION ALL SELECT object_id FROM fx_overrides) t GROUP BY 1 HAVING count(*) > 1",
)
def duplicate_ids(spark, d):
    both = labels.group_by_label(fx.database(spark, d)).unionByName(labels.group_by_label(fx.overrides(spark, d)))
    return labels.duplicate_ids(both)


@register("sorted_label_map", "SELECT object_id, label FROM fx_resolved WHERE mapped ORDER BY object_id")
def sorted_label_map(spark, d):
    return resolve_labels(spark, d).filter("mapped").select("object_id", "label").orderBy("object_id")


@register("batch_counts", "SELECT split_part(image_path, '/', 1) AS batch_id, count(*) AS n FROM fx_manifest GROUP BY 1")
def batch_counts(spark, d):
    return labels.batch_counts(fx.manifest(spark, d))


@register(
    "limit_images",
    "SELECT l_orderkey, l_linenumber, image_path FROM fx_manifest ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 1000",
)
def limit_images(spark, d):
    return labels.limit_images(fx.manifest(spark, d), 1000, order=KEYS).select("l_orderkey", "l_linenumber", "image_path")


@register(
    "failure_split",
    f"""SELECT image_path AS image, 'Unexpected filename format: ' || image_path AS error FROM fx_manifest WHERE {POSITIONAL_ID} IS NULL""",
)
def failure_split(spark, d):
    checked = fx.manifest(spark, d).withColumn("error", paths.path_error(F.col("image_path")))
    return hooks.failure_split(checked)[1]
