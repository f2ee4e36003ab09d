"""URL filters: rules first, gradient-boosted trees on lexical features for the rest; SQL functions and pyspark.ml alone.

A rule names a host and the beginning of a path; it fits the host and its subdomains, and the longest fitting rule
wins. URLs that a rule decides are the labelled ones that the trees learn from: length, depth, digit ratio, entropy,
parameter counts, and how often URLs with the same host suffix were blocked. The block rates count all labelled URLs
of the table and are joined by suffix; only the trees are fitted on a sample of rows.

Defined results: a null URL, or one without `://`, has an empty host and path and fits no rule; the trees judge it by
its other features. Without labelled URLs of both verdicts every other URL gets the only verdict known, or `allow`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.session import materialize

BLOCK, ALLOW = "block", "allow"
TRAIN_ROWS = 20_000  # labelled rows that the trees are fitted on, by hash of the row
LEAST = 200  # rows of a verdict that the sample has at least, if there are as many
TREES, DEPTH = 15, 4
FEATURES = ["u_length", "u_host", "u_path", "u_depth", "u_digits", "u_entropy", "u_params", "u_labels", "u_hyphens", "u_rate"]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _UPPER.lower()), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):  # the longest is tested first
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def with_features(df: DataFrame, url: Column) -> DataFrame:
    """Adds the lexical features but the suffix rate, and u_suffix. Needs the columns host and path."""
    size = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    share = lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size
    entropy = F.aggregate(F.array_distinct(F.split(url, "")), F.lit(0.0), lambda s, c: s - F.when(c == "", 0.0).otherwise(share(c) * F.ln(F.greatest(share(c), F.lit(1e-12)))))
    return df.withColumns(
        {
            "u_length": F.length(url).cast("double"),
            "u_host": F.length("host").cast("double"),
            "u_path": F.length("path").cast("double"),
            "u_depth": (F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit("")))).cast("double"),
            "u_digits": F.length(F.regexp_replace(url, "[^0-9]", "")) / size,
            "u_entropy": entropy,
            "u_params": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
            "u_labels": F.size(F.split("host", "[.]")).cast("double"),
            "u_hyphens": (F.length("host") - F.length(F.replace("host", F.lit("-"), F.lit("")))).cast("double"),
            "u_suffix": suffix(F.col("host")),
        }
    )


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", keep: list[str] | None = None, rows: int = TRAIN_ROWS) -> DataFrame:
    """The kept columns with host, path, rule, verdict and score (the trees' block probability; null under a rule)."""
    keep = [c for c in (pages.columns if keep is None else keep) if c not in ("host", "path", "rule", "verdict", "score")]
    held = pages.select(F.struct(*keep).alias("_row"), F.coalesce(F.col(url), F.lit("")).alias("_url"))
    host, path = parts(F.col("_url"))
    cut = held.withColumns({"host": host, "path": path})
    rule, ruled = fitting(rules, F.col("host"), F.col("path"))
    known = cut.withColumns({"rule": rule, "ruled": ruled})
    labelled = known.where(F.col("ruled").isNotNull()).withColumn("label", (F.col("ruled") == BLOCK).cast("double"))
    counts = labelled.groupBy(suffix(F.col("host")).alias("u_suffix")).agg(F.count("*").alias("n"), F.sum("label").alias("bad"))
    counts = materialize(counts, "suffix-counts")
    total, blocked = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0.0))).first()
    out = [F.col(f"_row.{c}").alias(c) for c in keep] + [F.col("host"), F.col("path"), F.col("rule")]
    if blocked in (0, total):
        only = BLOCK if blocked else ALLOW
        return known.select(*out, F.coalesce("ruled", F.lit(only)).alias("verdict"), F.lit(None).cast("double").alias("score"))

    mean = blocked / total
    rates = counts.select(F.col("u_suffix").alias("_suffix"), ((F.col("bad") + mean) / (F.col("n") + 1)).alias("u_rate"))
    rated = lambda df: df.join(rates, F.col("u_suffix") == F.col("_suffix"), "left").drop("_suffix").withColumn("u_rate", F.coalesce("u_rate", F.lit(mean)))
    # a rare verdict is sampled more densely, and its rows weigh less
    even = min(1, rows / total)
    dense = {label: max(even, min(1, LEAST / n)) for label, n in ((0.0, total - blocked), (1.0, blocked))}
    share = F.when(F.col("label") == 1, dense[1.0]).otherwise(dense[0.0])
    named = [F.col(f"_row.{c}") for c in keep if "map<" not in (kind := dict(pages.dtypes)[c]) and "variant" not in kind]  # others have no hash
    sampled = labelled.where(F.pmod(F.xxhash64("_url", *named), F.lit(10**12)) < share * 10**12).withColumn("_weight", even / share)
    sample = rated(with_features(sampled.select("_url", "host", "path", "label", "_weight"), F.col("_url"))).select(*FEATURES, "label", "_weight")
    sample = materialize(sample, "labelled-urls")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    trees = GBTClassifier(featuresCol="_features", labelCol="label", weightCol="_weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7)
    model = trees.fit(assembler.transform(sample).select("_features", "label", "_weight"))
    scored = model.transform(assembler.transform(rated(with_features(known, F.col("_url")))))
    score = F.when(F.col("ruled").isNull(), vector_to_array("probability")[1])
    verdict = F.coalesce("ruled", F.when(vector_to_array("probability")[1] >= 0.5, BLOCK).otherwise(ALLOW))
    return scored.select(*out, verdict.alias("verdict"), score.alias("score"))
