"""Training-set preparation from embedding records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.operators import dataset
from sightline.operators.labels import encode_labels
from sightline.session import materialize


def prepare(records: DataFrame, key: str, label: str = "label", val_size: float = dataset.VAL_SIZE, seed: int = dataset.SEED, drop_unknown: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(samples with label_idx and split, class weights of the train side, encoder).

    Rows labelled UNKNOWN are a class like any other unless ``drop_unknown``.
    """
    rows = dataset.drop_unknown(records, label) if drop_unknown else records
    encoder = materialize(dataset.fit_label_encoder(rows, label), "label_encoder")
    coded = encode_labels(rows, encoder, label, "label_idx")
    samples = dataset.stratified_split(coded, "label_idx", key, val_size, seed)
    weights = materialize(dataset.class_weights(samples.filter(F.col("split") == "train"), "label_idx"), "class_weights")
    return samples, weights, encoder
