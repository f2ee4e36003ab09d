"""A key that holds a third of all rows or more must not end up in one task."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sightline.operators import dataset, labels, quantiles
from sightline.session import materialize
from sightline.sources import sinks


@pytest.fixture
def small_partitions(spark):
    """Sizes at which Spark treats these small tables as it would treat large ones."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "65536",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "65536",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def hot_rows(spark, n=60_000):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 997).cast("string"))
    return spark.range(0, n, 1, 8).select("id", key.alias("object_id"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))


def test_hot_batch_is_written_by_several_tasks(spark, small_partitions, tmp_path):
    rows = hot_rows(spark).select(
        F.col("payload").alias("image"), F.lit("o").alias("objectID"), F.lit("L").alias("label"),
        F.array(F.rand(1).cast("float")).alias("embedding"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("b"), (F.col("id") % 5).cast("string"))).alias("batch_id"),
    )
    sinks.write_embeddings(rows, str(tmp_path / "out"))
    assert len(list((tmp_path / "out/batch_id=hot").glob("*.json"))) > 3


def test_hot_key_of_a_lookup_is_split(spark, small_partitions):
    table = spark.range(997).select(F.col("id").cast("string").alias("object_id"), F.lit("x").alias("label"))
    out = labels.label_lookup_default(hot_rows(spark), table).select("payload", "label")
    rows = out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert len(rows) == 60_000 and sum(r.label == "UNKNOWN" for r in rows) == 20_000


def test_split_counts_with_a_hot_class(spark, tmp_path):
    hot_rows(spark).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7 + 1).alias("label")).write.parquet(str(tmp_path / "d"))
    out = dataset.stratified_split(spark.read.parquet(str(tmp_path / "d")), "label", "id")
    got = {r.label: (r.n, r.val) for r in out.groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "val").alias("val")).collect()}
    assert got[0] == (20_000, 2_000) and sum(v for _, v in got.values()) == 6_000
    assert all(abs(v - n * 0.1) < 1 for n, v in got.values())


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_quantiles_of_crowded_values(spark, monkeypatch, keys):
    """200,000 distinct values within 0.02 ms fall into few first cells; they are cut until each is small."""
    rng = np.random.default_rng(4)
    crowd = 50 + rng.random(200_000) * 0.02
    parts = {0: crowd, 1: np.concatenate([crowd, [np.nextafter(7, 8), 7.0] * 40_000, [-1e300, 1e300, 0.0]])}
    rows = [spark.createDataFrame(pd.DataFrame({"k": k, "ms": v})) for k, v in parts.items()]
    df = rows[0].union(rows[1])
    seen = []
    monkeypatch.setattr(quantiles, "materialize", lambda table, name: seen.append(name) or materialize(table, name))
    got = quantiles.summarize(df, keys, "ms", {"a": 0.001, "q": 0.2, "m": 0.5, "p": 0.95}).collect()
    assert len(seen) > 1  # at least one crowded cell was cut
    assert len(got) == (2 if keys else 1)
    for r in got:
        values = parts[r.k] if keys else np.concatenate(list(parts.values()))
        assert r.n == len(values) and (r.lowest, r.highest) == (values.min(), values.max())
        for name, share in (("a", 0.001), ("q", 0.2), ("m", 0.5), ("p", 0.95)):
            assert r[name] == pytest.approx(np.quantile(values, share), rel=1e-14)
