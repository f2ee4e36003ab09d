"""Embeddings, predictions, prepared datasets, prompt banks and images."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.functions.outcomes import parse_flag, parse_timing
from sightline.operators.head import Head, unpack
from sightline.schemas import EMBEDDING_RECORD, PREDICTION_FLAGS, PREDICTION_RECORD, PREDICTION_TIMINGS
from sightline.session import materialize, spread


def read_embeddings(spark: SparkSession, path: str, pattern: str | None = None, documents: bool = True) -> DataFrame:
    """Embedding records of all matching files below ``path``; no such file is an error.

    By default both layouts are read: ``*_embeddings.json`` files, each one record or one list of records, and
    the sink's ``part-*`` files with a record per line. A ``pattern`` limits it to one layout: ``documents`` or lines.
    """
    layouts = [("*_embeddings.json", True), ("part-*", False)] if pattern is None else [(pattern, documents)]
    found, missing = [], []
    for name, whole in layouts:
        reader = spark.read.schema(EMBEDDING_RECORD).option("recursiveFileLookup", True).option("pathGlobFilter", name)
        found.append(reader.option("multiLine", whole).json(path))
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name)
        missing.append(listing.load(path).select("path").isEmpty())
    if all(missing):
        raise FileNotFoundError(f"no embedding files below {path}")
    rows = [df for df, none in zip(found, missing) if not none]
    return rows[0] if len(rows) == 1 else rows[0].union(rows[1])


def parse_prediction_types(text: DataFrame) -> DataFrame:
    """Typed prediction records from text columns, in the fixed order.

    Empty flags and timings are NULL, empty labels stay; a column the table lacks is NULL.
    """
    out = []
    for field in PREDICTION_RECORD:
        column = F.col(field.name)
        if field.name not in text.columns:
            column = F.lit(None).cast(field.dataType)
        elif field.name in PREDICTION_FLAGS:
            column = parse_flag(column)
        elif field.name in PREDICTION_TIMINGS:
            column = parse_timing(column)
        else:
            column = F.coalesce(column, F.lit(""))
        out.append(column.alias(field.name))
    return text.select(*out)


def read_predictions(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A saved prediction table; columns are found by the header's names."""
    return parse_prediction_types(spark.read.csv(path, header=True, escape='"', multiLine=multi_line))


def read_prepared(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, val, class weights) of a prepared dataset; each side reads only its own partition."""
    rows = spark.read.parquet(f"{path}/samples")
    train = rows.filter("split = 'train'").drop("split")
    val = rows.filter("split = 'val'").drop("split")
    return train, val, spark.read.parquet(f"{path}/weights")


def read_prompt_bank(spark: SparkSession, path: str) -> DataFrame:
    """A saved prompt bank; a missing or repeated cell, or uneven vectors, are an error."""
    bank = spark.read.parquet(path)
    check = bank.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("category_idx", "template_idx").alias("cells"),
        (F.max("category_idx") + 1).alias("c"),
        (F.max("template_idx") + 1).alias("t"),
        F.min(F.size("vec")).alias("lo"),
        F.max(F.size("vec")).alias("hi"),
    ).first()
    if not check["n"] == check["cells"] == check["c"] * check["t"] or check["lo"] != check["hi"]:
        raise ValueError(f"incomplete prompt bank: {check.asDict()}")
    return bank


def read_head(spark: SparkSession, path: str) -> tuple[Head, DataFrame]:
    """A stored head and the encoder (label_idx, label) of its classes."""
    rows = spark.read.parquet(f"{path}/weights").orderBy("array", "row").collect()  # the model's own weights
    arrays = []
    for number in range(rows[-1]["array"] + 1):
        own = [r for r in rows if r["array"] == number]
        values = np.array([r["cells"] for r in own])
        arrays.append(values if own[0]["dims"] == 2 else values[0])
    return unpack(arrays), spark.read.parquet(f"{path}/classes")


def read_images(spark: SparkSession, path: str, pattern: str = "*.png") -> DataFrame:
    """Image files as (uri, length, content).

    A job that does not select ``content`` only lists files. Image bytes should meet their hook in
    the scan stage and be dropped there; join its small results, not the bytes. Arrow batches of
    image bytes are bounded by ``spark.sql.execution.arrow.maxBytesPerBatch``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.load(path).select(F.col("path").alias("uri"), "length", "content")


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or plain path, and the path in it."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def open_uri(uri: str) -> bytes:
    """The bytes of a file of any file system that Arrow knows."""
    system, path = file_system(uri)
    with system.open_input_stream(path) as stream:
        return stream.read()


def uri_size(uri: str) -> int | None:
    """The size of a file, or None where there is none."""
    system, path = file_system(uri)
    info = system.get_file_info(path)
    return info.size if info.is_file else None


def read_manifest_images(
    manifest: DataFrame,
    uri: str = "uri",
    opener: Callable[[str], bytes] | None = None,
    sizer: Callable[[str], int | None] | None = None,
    task_bytes: int = 128 << 20,
    batch_bytes: int = 32 << 20,
) -> DataFrame:
    """The rows of a manifest with ``length``, ``content`` and ``read_error`` of their images.

    Only the listed files are opened, by ``opener``. A first pass asks for their sizes and deals the rows into shares
    of about ``task_bytes``, so that tasks read alike whatever the order of large files; a task passes its images on in
    batches of about ``batch_bytes``. A missing or unreadable image is a row with an error and without content. The
    sizes are written, the images are not.
    """
    read, size = opener or open_uri, sizer or (uri_size if opener is None else lambda _: 0)
    schema, listed = manifest.schema, manifest.columns
    at, loaded = listed.index(uri), [*listed, "length", "content", "read_error"]

    def measure(batches):
        held, number, task = 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            sizes, shares = [], []
            for name in batch.column(at).to_pylist():
                try:
                    sizes.append(None if name is None else size(name))
                except Exception:
                    sizes.append(None)
                held += sizes[-1] or 0
                shares.append(task << 32 | number)
                if held >= task_bytes:
                    held, number = 0, number + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array(shares, pa.int64())], names=[*listed, "length", "share"])

    def load(batches):
        for batch in batches:
            first, held, contents, errors = 0, 0, [], []
            for i, name in enumerate(batch.column(at).to_pylist()):
                try:
                    contents.append(read(name))
                    errors.append(None)
                except FileNotFoundError:
                    contents.append(None)
                    errors.append(f"image not found: {name}")
                except Exception as failure:
                    contents.append(None)
                    errors.append(f"image not readable: {name}: {failure!r}")
                held += len(contents[-1] or b"")
                if held >= batch_bytes or i == len(batch) - 1:
                    length = pa.array([None if c is None else len(c) for c in contents], pa.int64())
                    columns = [*batch.slice(first, len(contents)).columns[:-2], length, pa.array(contents, pa.binary()), pa.array(errors, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names=loaded)
                    first, held, contents, errors = i + 1, 0, [], []

    added = lambda *fields: T.StructType([*schema.fields, T.StructField("length", T.LongType()), *fields])
    sized = materialize(spread(manifest).mapInArrow(measure, added(T.StructField("share", T.LongType()))), "image_sizes")
    shares = max(sized.agg(F.count_distinct("share")).first()[0], 1)
    return sized.repartition(shares, "share").mapInArrow(load, added(T.StructField("content", T.BinaryType()), T.StructField("read_error", T.StringType())))


def match_manifest(manifest: DataFrame, results: DataFrame, key: str = "uri") -> DataFrame:
    """Manifest rows with the results computed for their image; an image without any is a failed row."""
    joined = manifest.join(results.withColumn("__seen", F.lit(True)), key, "left")
    missing = F.when(F.col("__seen").isNull(), F.concat(F.lit("image not found: "), F.col(key)))
    return joined.withColumn("error", F.coalesce(missing, F.col("error"))).drop("__seen")
