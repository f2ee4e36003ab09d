"""Record layouts shared by sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

UNKNOWN = "UNKNOWN"

EMBEDDING_RECORD = T.StructType(
    [
        T.StructField("image", T.StringType()),
        T.StructField("objectID", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)

# Columns of a saved prediction table, in file order.
PREDICTION_FIELDS = [
    "image",
    "object_id",
    "mobileclip_gt",
    "mobileclip_top1",
    "mobileclip_top2",
    "classifier_gt",
    "classifier_pred",
    "yolo_detected",
    "mobileclip_ms",
    "classifier_ms",
    "pipeline_ms",
    "hybrid_correct",
]
PREDICTION_FLAGS = ["yolo_detected", "hybrid_correct"]
PREDICTION_TIMINGS = ["mobileclip_ms", "classifier_ms", "pipeline_ms"]

PREDICTION_RECORD = T.StructType(
    [
        T.StructField(
            name,
            T.BooleanType()
            if name in PREDICTION_FLAGS
            else T.DoubleType()
            if name in PREDICTION_TIMINGS
            else T.StringType(),
        )
        for name in PREDICTION_FIELDS
    ]
)

# The four outcomes of the OR rule.
SOURCES = ["both", "mobileclip_only", "classifier_only", "neither"]

BOX_COLUMNS = ["xmin", "ymin", "xmax", "ymax", "confidence"]
