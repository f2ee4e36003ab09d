"""Writers. Every one is a distributed write; each is read back by its reader.

Writes grouped by batch or split use a rebalance, which packs small groups and lets Spark cut a hot
one into several tasks, instead of a hash shuffle that would send it to one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.operators.head import Head, pack
from sightline.schemas import PREDICTION_FIELDS
from sightline.sources.tables import file_system

FILE_ROWS = 1_000_000


def write_label_map(labels: DataFrame, path: str) -> None:
    """Resolved labels as JSON lines ordered by ID; NULL labels are kept."""
    rows = labels.select("object_id", "label").orderBy("object_id")
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_embeddings(records: DataFrame, path: str, batch: str = "batch_id") -> None:
    """Embedding records as JSON lines, in one folder per batch."""
    fields = ["image", "objectID", "label", "embedding", batch]
    packed = records.select(*fields).hint("rebalance", F.col(batch))
    packed.write.mode("overwrite").partitionBy(batch).option("maxRecordsPerFile", FILE_ROWS).json(path)


def write_predictions(records: DataFrame, path: str) -> None:
    """Predictions as CSV with a header, in the fixed column order."""
    flags = {"yolo_detected", "hybrid_correct"}
    columns = [
        F.initcap(F.col(c).cast("string")).alias(c) if c in flags else F.col(c) for c in PREDICTION_FIELDS
    ]
    records.select(*columns).write.mode("overwrite").option("escape", '"').csv(path, header=True, emptyValue="")


def write_failures(failures: DataFrame, path: str) -> bool:
    """Failures as JSON lines; nothing is written when there are none. Tells whether there were any."""
    if failures.isEmpty():
        return False
    failures.select("image", "error").write.mode("overwrite").json(path)
    return True


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as JSON; missing values are left out."""
    report.write.mode("overwrite").json(path)


def write_prepared(samples: DataFrame, weights: DataFrame, encoder: DataFrame, path: str) -> None:
    """Samples partitioned by split, class weights and the label encoder."""
    packed = samples.select("embedding", "label_idx", "split").hint("rebalance", F.col("split"))
    packed.write.mode("overwrite").partitionBy("split").option("maxRecordsPerFile", FILE_ROWS).parquet(f"{path}/samples")
    weights.write.mode("overwrite").parquet(f"{path}/weights")
    entries = F.array_sort(F.collect_list(F.struct(F.col("label_idx").alias("i"), F.col("label").cast("string").alias("name"))))
    names = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["i"].cast("string"), e["name"])))
    encoder.agg(F.to_json(names).alias("value")).write.mode("overwrite").text(f"{path}/label_encoder")


def write_head(head: Head, encoder: DataFrame, path: str) -> None:
    """A head's weights, a row of an array per line, and the encoder (label_idx, label) of its classes."""
    spark = encoder.sparkSession
    rows = [(i, array.ndim, k, row.tolist()) for i, array in enumerate(pack(head)) for k, row in enumerate(np.atleast_2d(array))]
    spark.createDataFrame(rows, "array int, dims int, row int, cells array<double>").write.mode("overwrite").parquet(f"{path}/weights")
    encoder.select("label_idx", "label").write.mode("overwrite").parquet(f"{path}/classes")


def write_images(images: DataFrame, path: str, name: str = "image_path", content: str = "content") -> DataFrame:
    """Each row's bytes as a file below ``path``, written by the tasks to any file system that Arrow knows.

    Returns (name, uri, length), which writes the files when it is stored. A repeated task replaces its own files.
    """
    kind = images.schema[name].dataType.simpleString()

    def store(batches):
        system, base = file_system(path)
        for batch in batches:
            names, contents = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for folder in {f"{base}/{n}".rsplit("/", 1)[0] for n in names}:
                system.create_dir(folder)
            for n, c in zip(names, contents):
                with system.open_output_stream(f"{base}/{n}") as stream:
                    stream.write(c)
            columns = [batch.column(0), pa.array([f"{path}/{n}" for n in names]), pa.array([len(c) for c in contents], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[name, "uri", "length"])

    return images.select(name, F.col(content).cast("binary")).mapInArrow(store, f"`{name}` {kind}, uri string, length long")


def write_prompt_bank(bank: DataFrame, path: str) -> None:
    bank.write.mode("overwrite").parquet(path)


def write_training_outputs(history: DataFrame, metrics: DataFrame, report: DataFrame, path: str) -> None:
    """Training history, metrics and per-class report as JSON."""
    history.write.mode("overwrite").json(f"{path}/training_history")
    metrics.write.mode("overwrite").json(f"{path}/metrics")
    report.write.mode("overwrite").json(f"{path}/classification_report")
