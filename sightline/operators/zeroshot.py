"""Zero-shot classification: similarity of image vectors to a bank of prompt vectors.

A bank is a table (category_idx, template_idx, vec) of any size. It is cut into slices of bounded size, each broadcast
on its own. A task streams the slices past each batch of images and keeps a running maximum or a running top-k, so it
holds one slice at a time, images stay where they are, and a batch is one matrix product per slice. A category among
the k best overall is among the k best of the slice that holds its best prompt, so any cut gives the same result. An
index without prompts is no category.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions.text import fill_template
from sightline.operators import numeric
from sightline.session import shared_dir

SLICE_BYTES = 64 << 20


def expand_prompts(categories: DataFrame, templates: Sequence[str]) -> DataFrame:
    """Every template filled with every category: (category_idx, category, template_idx, template, prompt)."""
    each = F.posexplode(F.array(*[F.lit(t) for t in templates])).alias("template_idx", "template")
    rows = categories.select("category_idx", "category", each)
    return rows.withColumn("prompt", fill_template(F.col("template"), F.col("category")))


@dataclass
class Bank:
    """Broadcast slices of a prompt bank: rows in the order of their categories, the categories, and each row's place
    among those. Plain arrays, as broadcasts carry no class definitions."""

    slices: list
    width: int
    categories: int


def each_slice(slices: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The slices one after the other; of several, each is read anew from the executor's disk when its turn comes."""
    for held in slices:
        yield held.value
        if len(slices) > 1:
            held.__dict__.pop("_value", None)


def bank_shape(bank: DataFrame) -> tuple[int, int, int]:
    """(prompts, vector width, categories); vectors of different widths are an error."""
    row = bank.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.size("vec")).alias("lo"),
        F.max(F.size("vec")).alias("hi"),
        (F.max("category_idx") + 1).alias("c"),
    ).first()
    if row["n"] == 0 or row["lo"] != row["hi"]:
        raise ValueError("a prompt bank needs vectors of one width")
    return row["n"], row["hi"], row["c"]


def load_bank(bank: DataFrame, slice_bytes: int = SLICE_BYTES) -> Bank:
    """The bank in broadcast slices of about ``slice_bytes``. The driver holds one slice at a time."""
    spark = bank.sparkSession
    rows, width, categories = bank_shape(bank)
    count = -(-rows * width * 8 // slice_bytes)
    if count > 1:
        path = shared_dir(spark, "bank-slices")
        number = F.pmod(F.xxhash64("category_idx", "template_idx"), F.lit(count)).cast("int")
        cut = bank.select("category_idx", "template_idx", "vec", number.alias("slice")).repartition(count, "slice")
        cut.write.partitionBy("slice").parquet(path)
        bank = spark.read.parquet(path)
    slices = []
    for i in range(count):
        part = (bank.filter(F.col("slice") == i) if count > 1 else bank).select("category_idx", "template_idx", "vec").toArrow()
        if part.num_rows:
            part = part.sort_by([("category_idx", "ascending"), ("template_idx", "ascending")])
            prompts, usable = numeric.to_matrix(part["vec"].combine_chunks(), width)
            if not usable.all():
                raise ValueError("a prompt bank holds a missing value")
            names, owner = np.unique(part["category_idx"].to_numpy().astype(np.int64), return_inverse=True)
            slices.append(spark.sparkContext.broadcast((prompts, names, owner)))
    return Bank(slices, width, int(categories))


def score_prompts(df: DataFrame, bank: Bank, vector: str = "embedding", out: str = "scores", logit_scale: float | None = None) -> DataFrame:
    """Add the array of best-template similarities by category index, NULL at an index without prompts.

    The whole array is NULL for a zero or unusable vector.
    """
    slices, width, categories = bank.slices, bank.width, bank.categories
    factor = 1.0 if logit_scale is None else float(np.exp(logit_scale))

    @F.arrow_udf("array<double>")
    def similarity(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            matrix, usable = numeric.to_matrix(batch, width)
            unit, has_norm = numeric.unit_rows(matrix)
            scores = np.full((len(unit), categories), -np.inf)
            for prompts, names, owner in each_slice(slices):
                scores[:, names] = np.maximum(scores[:, names], numeric.best_prompt_scores(unit, prompts, owner, len(names)))
            yield numeric.to_lists(scores * factor, usable & has_norm, pa.float64(), missing=-np.inf)

    return df.withColumn(out, similarity(F.col(vector)))


def best_categories(unit: np.ndarray, slices: list, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices and scores of the k best categories of each row, over all slices."""
    idx, top = np.empty((len(unit), 0), np.int64), np.empty((len(unit), 0))
    for prompts, names, owner in each_slice(slices):
        found, scores = numeric.top_categories(unit, prompts, owner, len(names), k)
        idx, top = numeric.merged_top(idx, top, names[found], scores, k)
    return idx, top


def topk_categories(df: DataFrame, bank: DataFrame, k: int = 2, key: str = "vec_id", vector: str = "embedding", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The k best categories of each image: (key, rank, category_idx, score), ranks from 1."""
    best = topk_arrays(df.select(key, vector), load_bank(bank, slice_bytes), k, vector)
    ranked = best.select(key, F.posexplode("top").alias("r", "t"))
    return ranked.select(
        key, (F.col("r") + 1).alias("rank"), F.col("t.idx").alias("category_idx"), F.col("t.score").alias("score")
    )


def topk_arrays(df: DataFrame, bank: Bank, k: int = 2, vector: str = "embedding", out: str = "top") -> DataFrame:
    """Add the k best (idx, score) pairs as one array per row, computed in the same batch as the scores."""
    slices, width = bank.slices, bank.width

    @F.arrow_udf("struct<idx:array<int>,score:array<double>>")
    def best(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            matrix, usable = numeric.to_matrix(batch, width)
            unit, has_norm = numeric.unit_rows(matrix)
            idx, top = best_categories(unit, slices, k)
            good = usable & has_norm
            yield pa.StructArray.from_arrays(
                [numeric.to_lists(idx.astype(np.int32), good, pa.int32()), numeric.to_lists(top, good, pa.float64())],
                names=["idx", "score"],
            )

    scored = df.withColumn("__best", best(F.col(vector)))
    return scored.withColumn(out, F.arrays_zip(F.col("__best.idx"), F.col("__best.score"))).drop("__best")


def best_template(scored: DataFrame, key: str = "vec_id") -> DataFrame:
    """Best score per image and category of a prompt-level score table (key, category_idx, template_idx, score)."""
    return scored.groupBy(key, "category_idx").agg(F.max("score").alias("score"))
