"""A corpus pipeline: language, toxicity, near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of `docs`, what the stage before kept. All but the
last return the columns of `documents`; the last returns the packed pieces.

Defined results: rows with a null or wordless text have no language and go at the first stage. Empty tables pass
through every stage as empty tables. Columns beyond those of `documents` are kept as they are, unless an operator
uses their name for its own result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm import language, nearcopies, packing, personal, toxicity
from sightline.session import shared_dir

LEAST_LANGUAGE_SCORE = 0.5
TOXIC = 0.5  # of documents that reach it, few are clean
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
#: No SQL can express the models, the near copies' components and the tokenizer.
ORACLE_SQL = None


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows go whose text has no letter, or no language that is more likely than not."""
    found = language.identify(docs, language.fit(docs))
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("lang_score") >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows go whose toxicity reaches the threshold, by a model of the labelled rows."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where(F.col("toxicity") < TOXIC).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id stays: five words, similarity 0.8."""
    return nearcopies.first_of_each(docs).select(*docs.columns)


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the text."""
    done = personal.redact(docs)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenized documents and their places in sequences of 1024 tokens."""
    return packing.packed(docs, TOKENIZER, END_ID)


STAGES = [
    ("language", keep_known_language),
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("personal data", redact_personal),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to `documents`; each stage's rows are written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
