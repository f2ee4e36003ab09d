"""Manifests, label tables and prompt files.

The JSON inputs are single documents: a file (``whole_files``) or, for many documents, one per line.
One document is parsed by one task, which suits lookups; manifests and label tables of any size are
read by the ``*_lines`` readers, which Spark can split. Repeated keys keep the last value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sightline.defaults import CATEGORIES, TEMPLATES
from sightline.functions.text import normalize_label, strip
from sightline.session import materialize


def _documents(spark: SparkSession, path: str, whole_files: bool) -> DataFrame:
    texts = spark.read.text(path, wholetext=whole_files).withColumn("doc_id", _file_order())
    return texts.filter(F.trim("value") != "")


def _file_order() -> Column:
    """Orders rows by file name, place of the block in the file, and place in the block; Spark scans files by size."""
    return F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))


def read_manifest(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """``[{"prefix": uri}, path, ...]`` as (pos, prefix, image_path, uri), positions from 1."""
    items = _documents(spark, path, whole_files).select(F.from_json("value", "array<string>").alias("items"))
    rows = items.select(
        F.get_json_object(F.get("items", F.lit(0)), "$.prefix").alias("prefix"),
        F.posexplode("items").alias("pos", "image_path"),
    ).filter("pos > 0")
    return rows.select("pos", "prefix", "image_path", F.concat("prefix", "image_path").alias("uri"))


def read_manifest_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of (prefix, image_path), for manifests too large for one document.

    Positions are consecutive in the order of file names: each row's place in its block plus the rows of
    the blocks before it. The list of block sizes is written, so it can be broadcast.
    """
    rows = spark.read.schema("prefix string, image_path string").json(path)
    placed = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__at"), F.monotonically_increasing_id().alias("__id"))
    sizes = placed.groupBy("__file", "__at").agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    before = Window.orderBy("__file", "__at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__file", "__at", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    known = materialize(offsets, "manifest_offsets")
    joined = placed.join(known, ["__file", "__at"])
    return joined.select(
        (F.col("__before") + F.col("__id") - F.col("__first") + 1).alias("pos"),
        "prefix",
        "image_path",
        F.concat("prefix", "image_path").alias("uri"),
    )


def last_per_key(df: DataFrame, key: str, value: str, order: Column) -> DataFrame:
    """One row per key: the value that comes last in ``order``, which may be NULL."""
    last = F.max_by(F.struct(F.col(value).alias("v")), order)
    return df.groupBy(key).agg(last.alias("last")).select(key, F.col("last.v").alias(value))


def read_label_map(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """``{id: label}`` or ``[{"object_id", "name"}, ...]`` as (object_id, label)."""
    docs = _documents(spark, path, whole_files)
    is_list = strip(F.col("value")).startswith("[")
    records = F.transform(
        F.from_json("value", "array<struct<object_id:string,name:string>>"),
        lambda r: F.struct(r["object_id"].alias("object_id"), r["name"].alias("label")),
    )
    entries = F.transform(
        F.map_entries(F.from_json("value", "map<string,string>")),
        lambda e: F.struct(e["key"].alias("object_id"), e["value"].alias("label")),
    )
    rows = docs.select("doc_id", F.posexplode(F.when(is_list, records).otherwise(entries)).alias("pos", "r"))
    return last_per_key(rows.select("doc_id", "pos", "r.*"), "object_id", "label", F.struct("doc_id", "pos"))


def read_override_map(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """Curated ``{id: label}``; an ID may be present with a NULL label."""
    docs = _documents(spark, path, whole_files)
    rows = docs.select("doc_id", F.posexplode(F.map_entries(F.from_json("value", "map<string,string>"))).alias("pos", "e"))
    named = rows.select("doc_id", "pos", F.col("e.key").alias("object_id"), F.col("e.value").alias("label"))
    return last_per_key(named, "object_id", "label", F.struct("doc_id", "pos"))


def read_label_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of (object_id, label), as the label-map sink writes them."""
    return spark.read.schema("object_id string, label string").json(path)


def read_id_name_csv(spark: SparkSession, path: str, id_column: str, name_column: str = "name", multi_line: bool = True) -> DataFrame:
    """ID database with a header, both columns stripped, last row per ID, as (object_id, label).

    ``multi_line`` allows line breaks inside quotes; switch it off to let Spark split large files.
    """
    rows = spark.read.csv(path, header=True, multiLine=multi_line, escape='"', encoding="UTF-8")
    clean = rows.select(
        strip(F.coalesce(F.col(id_column), F.lit(""))).alias("object_id"),
        strip(F.coalesce(F.col(name_column), F.lit(""))).alias("label"),
        _file_order().alias("row"),
    )
    return last_per_key(clean, "object_id", "label", F.col("row"))


def read_synonyms(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """``{"category_to_objects": {category: [label, ...]}}`` as normalised (category, canonical).

    The first label of each list counts; an empty list is an error. Of categories that normalise
    alike, the last counts.
    """
    schema = "category_to_objects map<string,array<string>>"
    docs = _documents(spark, path, whole_files).select(
        "doc_id", F.from_json("value", schema).alias("doc")
    )
    entries = docs.select("doc_id", F.posexplode(F.map_entries("doc.category_to_objects")).alias("pos", "e"))
    first = F.when(
        F.size("e.value") == 0, F.raise_error(F.concat(F.lit("no labels for category "), F.col("e.key"))).cast("string")
    ).otherwise(F.get("e.value", F.lit(0)))
    named = entries.select(
        "doc_id", "pos", normalize_label(F.col("e.key")).alias("category"), normalize_label(first).alias("canonical")
    )
    return last_per_key(named, "category", "canonical", F.struct("doc_id", "pos"))


def _prompt_config(spark: SparkSession, path: str | None, whole_files: bool) -> DataFrame:
    """One row with the two lists of a prompt file, or of the default configuration."""
    if path is None:
        lists = [F.array(*[F.lit(v) for v in values]) for values in (CATEGORIES, TEMPLATES)]
        return spark.range(1).select(lists[0].alias("categories"), lists[1].alias("templates"))
    schema = "categories array<string>, templates array<string>"
    docs = _documents(spark, path, whole_files).select(F.from_json("value", schema).alias("doc"))
    return docs.select("doc.categories", "doc.templates")


def read_prompts(spark: SparkSession, path: str | None = None, whole_files: bool = True) -> tuple[DataFrame, DataFrame]:
    """``{"categories": [...], "templates": [...]}`` as (category_idx, category) and (template_idx, template)."""
    config = _prompt_config(spark, path, whole_files)
    categories = config.select(F.posexplode("categories").alias("category_idx", "category"))
    templates = config.select(F.posexplode("templates").alias("template_idx", "template"))
    return categories, templates


def read_prompt_pairs(spark: SparkSession, path: str | None = None, whole_files: bool = True) -> DataFrame:
    """All (category, template) pairs of a prompt file, from its own two lists."""
    config = _prompt_config(spark, path, whole_files)
    with_category = config.select("templates", F.posexplode("categories").alias("category_idx", "category"))
    return with_category.select(
        "category_idx", "category", F.posexplode("templates").alias("template_idx", "template")
    )


def read_label_encoder(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """``{"0": name, ...}`` as (label_idx, label); the indices must be 0..C-1."""
    docs = _documents(spark, path, whole_files)
    entries = docs.select(F.posexplode(F.map_entries(F.from_json("value", "map<string,string>"))).alias("pos", "e"))
    named = entries.select("pos", F.col("e.key").cast("int").alias("label_idx"), F.col("e.value").alias("label"))
    names = last_per_key(named, "label_idx", "label", F.col("pos"))
    everything = Window.partitionBy()
    gap = (F.min("label_idx").over(everything) != 0) | (
        F.max("label_idx").over(everything) != F.count(F.lit(1)).over(everything) - 1
    )
    checked = F.when(gap, F.raise_error(F.lit("label indices are not 0..C-1")).cast("int"))
    return names.select(checked.otherwise(F.col("label_idx")).alias("label_idx"), "label")
