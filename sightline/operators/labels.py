"""Resolving object IDs to labels, and grouping labels.

Label tables hold one row per ID. Lookups are plain equi-joins without hints: Spark broadcasts a
side only when its measured size allows, and otherwise splits hot keys of the sort-merge join at
run time. Nothing here gathers a label's IDs without a bound on the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.functions import paths
from sightline.functions.text import normalize_label
from sightline.schemas import UNKNOWN
from sightline.session import materialize


def lookup(df: DataFrame, table: DataFrame, key: Column, table_key: str, table_value: str, out: str) -> DataFrame:
    """Left-join ``table_value`` as ``out``; ``<out>_found`` tells a hit with a NULL value from a miss."""
    probe = table.select(
        F.col(table_key).alias("__key"), F.col(table_value).alias(out), F.lit(True).alias(f"{out}_found")
    )
    joined = df.withColumn("__probe", key).join(probe, F.col("__probe") == F.col("__key"), "left")
    return joined.withColumn(f"{out}_found", F.col(f"{out}_found").isNotNull()).drop("__probe", "__key")


def distinct_object_ids(manifest: DataFrame, path: str = "image_path") -> DataFrame:
    """Distinct IDs of the well-formed paths.

    The test for a match is on the aggregate; as a row filter it would run the pattern twice per path.
    """
    ids = manifest.select(paths.object_id_strict(F.col(path)).alias("object_id"))
    counted = ids.groupBy("object_id").agg(F.count("object_id").alias("n"))
    return counted.filter("n > 0").select("object_id")


def unmatched_paths(manifest: DataFrame, order: Sequence[str], path: str = "image_path", sample: int = 10) -> DataFrame:
    """The first ``sample`` malformed paths in manifest order, each with the count of all of them."""
    bad = manifest.filter(paths.object_id_strict(F.col(path)).isNull())
    total = bad.agg(F.count(F.lit(1)).alias("n")).scalar()
    return bad.orderBy(*order, path).limit(sample).select(path, total.alias("total_unmatched"))


def parser_disagreements(manifest: DataFrame, path: str = "image_path") -> DataFrame:
    """Paths for which the strict and the positional rule give different IDs."""
    both = manifest.select(
        path,
        paths.object_id_strict(F.col(path)).alias("strict_id"),
        paths.object_id_positional(F.col(path)).alias("positional_id"),
    )
    return both.filter(~F.col("strict_id").eqNullSafe(F.col("positional_id")))


def resolve_labels(ids: DataFrame, overrides: DataFrame | None, database: DataFrame | None) -> DataFrame:
    """Label of each ID from ``overrides`` (object_id, label), else from ``database`` (object_id, label).

    An override wins because its key is present, even when its label is NULL. ``mapped`` is false
    for an ID found in neither table.
    """
    out = ids.select("object_id")
    label, mapped = F.lit(None).cast("string"), F.lit(False)
    if database is not None:
        out = lookup(out, database, F.col("object_id"), "object_id", "label", "db_label")
        label, mapped = F.col("db_label"), F.col("db_label_found")
    if overrides is not None:
        out = lookup(out, overrides, F.col("object_id"), "object_id", "label", "override")
        label = F.when(F.col("override_found"), F.col("override")).otherwise(label)
        mapped = F.col("override_found") | mapped
    return out.select("object_id", label.alias("label"), mapped.alias("mapped"))


def unmapped_ids(ids: DataFrame, *tables: DataFrame | None) -> DataFrame:
    """IDs that no table knows."""
    out = ids.select("object_id")
    for table in tables:
        if table is not None:
            out = out.join(table.select("object_id"), "object_id", "left_anti")
    return out


def unmapped_sample(unmapped: DataFrame, sample: int = 10) -> DataFrame:
    """The first IDs in order, each with the count of all unmapped IDs."""
    total = unmapped.agg(F.count(F.lit(1)).alias("n")).scalar()
    return unmapped.orderBy("object_id").limit(sample).select("object_id", total.alias("total_unmapped"))


def group_by_label(labels: DataFrame, size: int = 10_000) -> DataFrame:
    """Each label's IDs as one sorted list in pieces of ``size``: (label, piece, object_ids).

    Pieces are numbered from 0 in ID order, so a label's pieces one after the other are its whole list.
    The rows are sorted over all tasks by label and ID and written; a row's rank is its place in its
    range plus the label's rows in the ranges before, so a hot label fills many ranges and many pieces.
    Rows without an ID are left out, a repeated ID is listed each time, and a NULL label is a label.
    """
    rows = labels.filter("object_id IS NOT NULL").select("label", "object_id", F.monotonically_increasing_id().alias("__row"))
    order = ["label", "object_id", "__row"]  # the row number lets a range end within a repeated ID
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "label", "object_id", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at")
    )
    stored = materialize(ranges, "label_ranges")
    sizes = stored.groupBy("label", "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy("label").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("label").alias("__label"), F.col("__part").alias("__p"), (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift")
    )
    known = materialize(offsets, "label_offsets")  # a row per label and range, so the planner knows its size
    ranked = stored.join(known, (F.col("__part") == F.col("__p")) & F.col("label").eqNullSafe(F.col("__label")))
    piece = F.floor((F.col("__at") + F.col("__shift")) / size)
    return (
        ranked.withColumn("piece", piece)
        .groupBy("label", "piece")
        .agg(F.array_sort(F.collect_list("object_id")).alias("object_ids"))
    )


def reverse_label_map(grouped: DataFrame) -> DataFrame:
    """(label, object_ids) back to one row per ID; an ID listed twice is an error."""
    per_id = _id_counts(grouped)
    checked = F.when(
        F.col("n") > 1, F.raise_error(F.concat(F.lit("Duplicate ObjectID found: "), F.col("object_id")))
    ).otherwise(F.col("label"))
    return per_id.select("object_id", checked.cast("string").alias("label"))


def duplicate_ids(grouped: DataFrame) -> DataFrame:
    """IDs listed more than once, without raising."""
    return _id_counts(grouped).filter("n > 1").select("object_id", "n")


def _id_counts(grouped: DataFrame) -> DataFrame:
    ids = grouped.select("label", F.explode("object_ids").alias("object_id"))
    return ids.groupBy("object_id").agg(F.min("label").alias("label"), F.count(F.lit(1)).alias("n"))


def label_lookup_default(df: DataFrame, labels: DataFrame, key: str = "object_id", out: str = "label", default: str = UNKNOWN) -> DataFrame:
    """Label of each row's ID; ``default`` only where the ID is unknown."""
    found = lookup(df, labels, F.col(key), "object_id", "label", "__value")
    value = F.when(F.col("__value_found"), F.col("__value")).otherwise(F.lit(default))
    return found.withColumn(out, value).drop("__value", "__value_found")


def synonym_join(df: DataFrame, synonyms: DataFrame, label: str, out: str) -> DataFrame:
    """Canonical form of ``label`` through a table (category, canonical) of normalised categories."""
    found = lookup(df, synonyms, normalize_label(F.col(label)), "category", "canonical", "__syn")
    value = F.when(F.col("__syn_found"), F.col("__syn")).otherwise(normalize_label(F.col(label)))
    return found.withColumn(out, normalize_label(value)).drop("__syn", "__syn_found")


def truth_table(zero_shot_labels: DataFrame, head_labels: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Both truths per ID: (object_id, truth_a, truth_b, in_a, in_b), truth A in canonical form.

    Made of label tables alone, so the data needs a single join, with a table of known size.
    """
    canonical = synonym_join(zero_shot_labels.select("object_id", "label"), synonyms, "label", "label")
    a = canonical.select("object_id", F.col("label").alias("truth_a"), F.lit(True).alias("in_a"))
    b = head_labels.select("object_id", F.col("label").alias("truth_b"), F.lit(True).alias("in_b"))
    return a.join(b, "object_id", "full")


def dual_truth_join(df: DataFrame, zero_shot_labels: DataFrame, head_labels: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Add truth A (canonical, ``mobileclip_gt``) and truth B (raw, ``classifier_gt``) to each row.

    A miss gets the default label, for truth A in its canonical form.
    """
    truths = materialize(truth_table(zero_shot_labels, head_labels, synonyms), "truths")
    truths = truths.withColumnRenamed("object_id", "__key")
    word = synonyms.filter(F.col("category") == F.lower(F.lit(UNKNOWN)))
    default = word.agg(normalize_label(F.coalesce(F.first("canonical"), F.lit(UNKNOWN))).alias("u")).scalar()
    joined = df.join(truths, F.col("object_id") == F.col("__key"), "left")
    return (
        joined.withColumn("mobileclip_gt", F.when(F.col("in_a"), F.col("truth_a")).otherwise(default))
        .withColumn("classifier_gt", F.when(F.col("in_b"), F.col("truth_b")).otherwise(F.lit(UNKNOWN)))
        .drop("__key", "truth_a", "truth_b", "in_a", "in_b")
    )


def encode_labels(df: DataFrame, encoder: DataFrame, label: str, out: str) -> DataFrame:
    """Replace nothing, add the class index of ``label``; NULL for a label outside the encoder."""
    return lookup(df, encoder, F.col(label), "label", "label_idx", out).drop(f"{out}_found")


def known_class_filter(df: DataFrame, encoder: DataFrame, label: str = "classifier_gt") -> DataFrame:
    return df.join(encoder.select(F.col("label").alias(label)), label, "left_semi")


def skipped_unknown(df: DataFrame, encoder: DataFrame, label: str = "classifier_gt") -> DataFrame:
    """Number of rows whose label is outside the encoder; rows are counted per label before the join."""
    per_label = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    unknown = per_label.join(encoder.select(F.col("label").alias(label)), label, "left_anti")
    return unknown.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("skipped"))


def limit_images(manifest: DataFrame, max_images: int, pos: str = "pos", order: Sequence[str] | None = None) -> DataFrame:
    """The first images in manifest order; -1 keeps all.

    With consecutive positions (counted from 1) this is a plain filter. ``order`` names the sort
    columns of a manifest that has none; Spark then keeps only ``max_images`` rows per task.
    """
    if max_images == -1:
        return manifest
    if order is not None:
        return manifest.orderBy(*order).limit(max_images)
    return manifest.filter(F.col(pos) <= max_images)


def batch_counts(manifest: DataFrame, path: str = "image_path") -> DataFrame:
    return manifest.groupBy(paths.batch_id(F.col(path)).alias("batch_id")).agg(F.count(F.lit(1)).alias("n"))
