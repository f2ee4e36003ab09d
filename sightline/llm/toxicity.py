"""Toxic documents by multiple-instance learning.

Only documents are labelled, not sentences. Each sentence has a probability from its words; a document is
toxic unless all its sentences are harmless: 1 - prod(1 - p). The weights are fitted to the document labels
through that noisy-or, after which the sentence probabilities tell where the offence lies.

Words are runs of letters and digits, lower-cased; sentences end at `.`, `!`, `?` or a line end. A word's
features are the word and its first letters (`STEMS`), so inflected forms of an insult are known by their stem;
each counts once per occurrence. Every feature of the labelled sample is kept, whichever way it points; a penalty
and a pace by evidence (`_trust`) hold those that say little near 0. The sample takes up to half its rows from
either label, and a row weighs as many as it stands for, so the scores keep the share of toxic documents.

Defined results: a null text, or one without words, has the probability of one wordless sentence. Repeated sentences
count each time. Documents that share a key are one to the fit, with the first of their texts in order. Without labels
of both kinds there are no features.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.llm.blocks import code_points, cuts, find, grouped, letter_table, runs, span_hashes, tidy, with_columns
from sightline.session import discard, materialize

TRAIN_ROWS = 6_000  # labelled documents that the model is fitted on, half of either label, by hash of their id
STEMS = (4, 5)  # lengths of the word beginnings that are features
STEPS = 150
PENALTY = 1e-4
SURE = 4.0  # standard errors from which a weight moves freely
POWER = 2
THRESHOLD = 0.7
_TABLE: list[np.ndarray] = []
_ENDS = ".!?\n"


def _alnum() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(letter_table(str.isalnum))
    return _TABLE[0]


@dataclass
class ToxicityModel:
    """Sorted word hashes, their weights, and the log odds of a sentence without any of them."""

    words: np.ndarray
    weights: np.ndarray
    bias: float


def sentences_of(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Features of all words, the sentence of each (numbered over all texts), and per sentence its text, start and end.

    Positions count the code points of the lower-cased text; lower-casing changes the length of very few characters.
    """
    low = [t.lower() for t in texts]
    units = code_points("\n".join(low))
    firsts = np.cumsum([0] + [len(t) + 1 for t in low[:-1]])
    starts, ends = runs(_alnum()[units])
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none, none, none
    stop = np.isin(units, code_points(_ENDS))
    part = np.cumsum(stop)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = part[1:] != part[:-1]
    sentence = np.cumsum(new) - 1
    text = np.searchsorted(firsts, starts[new], "right") - 1
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)
    features, places = [span_hashes(units, starts, ends)], [sentence]
    for n in STEMS:
        long = ends - starts > n
        features.append(span_hashes(units, starts[long], starts[long] + n) ^ np.uint64(n))
        places.append(sentence[long])
    return np.concatenate(features), np.concatenate(places), text, starts[new] - firsts[text], ends[last] - firsts[text]


def _chosen(labels: DataFrame, key: str, label: str, rows: int) -> DataFrame:
    """k, y and w, the labelled documents that a row of the sample stands for: about `rows` keys."""
    marked = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    marked = marked.select(F.col(key).alias("k"), (F.col(label) > 0).cast("int").alias("y"))
    one = marked.groupBy("k").agg(F.max("y").alias("y"))  # a row labelled twice is toxic if one label says so
    totals = {r.y: r["count"] for r in one.groupBy("y").count().collect()}
    part = {y: min(1.0, rows / 2 / n) for y, n in totals.items()}
    share = F.when(F.col("y") == 1, part.get(1, 1.0)).otherwise(part.get(0, 1.0))
    place = F.shiftrightunsigned(F.xxhash64(F.col("k").cast("string")), 11) / float(1 << 53)
    return one.where(place < share).withColumn("w", 1 / share)


def _sampled(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, rows: int) -> DataFrame:
    """y, t and w of the chosen keys, stored. Texts meet the stored keys where they are read, so only the sample's move."""
    chosen = materialize(_chosen(labels, key, label, rows), "toxicity-keys")
    texts = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    one = texts.join(chosen, "k").groupBy("k", "y", "w").agg(F.min("t").alias("t"))
    sample = materialize(one.select("y", "t", "w"), "toxicity-sample")
    discard(chosen)
    return sample


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Learns from labelled documents: of either label all up to half of `rows`, beyond that a sample by hash of the key.

    Tasks cut the texts into sentences and features; the driver fits the weights on the sample, which `rows` bounds.
    """
    sample = _sampled(docs, labels, text, key, label, rows)
    if len(sample.select("y").distinct().collect()) < 2:
        discard(sample)
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), -6.0)

    def occurrences(batches):
        for batch in batches:
            marks, texts, shares = (batch.column(i).to_pylist() for i in range(3))
            for a, b in grouped(texts):
                hashes, sentence, owner, *_ = sentences_of(texts[a:b])
                words = hashes[np.argsort(sentence, kind="stable")]
                sizes = np.bincount(sentence, minlength=len(owner))
                first = np.searchsorted(owner, np.arange(b - a + 1))
                ends = np.append(0, np.cumsum(sizes))[first]
                pieces = lambda x, at: [x[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]
                columns = [pa.array(marks[a:b], pa.int32()), pa.array(shares[a:b], pa.float64()), pa.array(np.diff(first).astype(np.int64))]
                columns += [pa.array(pieces(words, ends), pa.binary()), pa.array(pieces(sizes.astype(np.int32), first), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["y", "w", "n", "words", "sizes"])

    held = sample.mapInArrow(tidy(occurrences), "y int, w double, n long, words binary, sizes binary").toArrow()
    discard(sample)
    y, w, n = (held[c].to_numpy().astype(np.float64) for c in ("y", "w", "n"))
    sizes = np.frombuffer(b"".join(held["sizes"].to_pylist()), np.int32)
    hashes = np.frombuffer(b"".join(held["words"].to_pylist()), np.uint64)
    del held
    table = np.unique(hashes)
    return _solve(table, y, n.astype(np.int64), np.searchsorted(table, hashes).astype(np.int32), sizes, w)


def _trust(table: np.ndarray, word: np.ndarray, ends: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How freely each feature's weight may move, 0 to 1: by how many standard errors the toxic share of its documents
    is off the sample's. Thousands of words occur in one toxic document by chance; few do so in many of them."""
    n, bad = np.zeros(len(table)), np.zeros(len(table))
    for first, last, mark in zip(np.append(0, ends[:-1]), ends, y, strict=True):
        found = np.unique(word[first:last])
        n[found] += 1
        bad[found] += mark
    part = y.mean()
    gain = (bad - n * part) / np.sqrt(n * part * (1 - part) + 1)
    return np.minimum(1, np.abs(gain) / SURE) ** POWER


def _solve(table: np.ndarray, y: np.ndarray, n: np.ndarray, word: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> ToxicityModel:
    """Weighted maximum likelihood of the document labels under the noisy-or, with a small penalty, by adaptive steps.

    Documents have `n` sentences each, sentences `sizes` features, and `word` says which. All are in order, so sums over
    a sentence are sums over a slice.
    """
    owner = np.repeat(np.arange(len(y)), n)
    firsts = np.append(0, np.cumsum(sizes)[:-1])[: len(sizes)]
    share = weights / weights.sum()
    ends = np.append(0, np.cumsum(sizes))[np.cumsum(n)]
    trust = _trust(table, word, ends, y)
    plain = (n == 0).astype(np.float64)  # a document without words counts as one wordless sentence
    theta, m, v = np.zeros(len(table) + 1), np.zeros(len(table) + 1), np.zeros(len(table) + 1)
    theta[-1] = -6.0
    rate = 0.1
    for step in range(1, STEPS + 1):
        w, b = theta[:-1] * trust, theta[-1]
        z = b + (np.add.reduceat(w[word], firsts) if len(word) else np.zeros(0))
        p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-b))
        calm = np.bincount(owner, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(y)) + plain * np.log1p(-p0)
        noisy = np.clip(-np.expm1(calm), 1e-9, 1.0)
        pull = np.where(y > 0, (1 - noisy) / noisy, -1.0) * share  # d log likelihood / d (-calm)
        force = pull[owner] * p
        gradient = np.append(np.bincount(word, weights=np.repeat(force, sizes), minlength=len(table)), force.sum() + (pull * plain).sum() * p0)
        gradient[:-1] = gradient[:-1] * trust - PENALTY * theta[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        theta[-1] = min(theta[-1], -4.0)
    return ToxicityModel(table, theta[:-1] * trust, float(theta[-1]))


def judge(model: ToxicityModel, texts: list[str | None]) -> tuple[np.ndarray, list[list[dict]]]:
    """Score of every text, and its offending sentences (start, end, probability)."""
    calm, spans = np.zeros(len(texts)), [[] for _ in texts]
    counted = np.zeros(len(texts), np.int64)
    quiet = -np.log1p(np.exp(model.bias))
    parts, owner, offset = [], [], []
    for i, text in enumerate(texts):
        at = 0
        for piece in cuts(text or "", blank="\n.!?"):
            parts.append(piece)
            owner.append(i)
            offset.append(at)
            at += len(piece)
    for a, b in grouped(parts):
        hashes, sentence, which, starts, ends = sentences_of(parts[a:b])
        if not len(hashes):
            continue
        row = np.array(owner[a:b])[which]
        at = find(model.words, hashes)
        weight = np.bincount(sentence[at >= 0], weights=model.weights[at[at >= 0]], minlength=len(which))
        z = model.bias + weight
        calm += np.bincount(row, weights=-np.logaddexp(0, z), minlength=len(texts))
        counted += np.bincount(row, minlength=len(texts))
        for s in np.flatnonzero(z >= 0):  # more likely offensive than not
            shift = offset[a + which[s]]
            spans[row[s]].append({"start": int(starts[s]) + shift, "end": int(ends[s]) + shift, "score": float(1 / (1 + np.exp(-z[s])))})
    calm[counted == 0] = quiet
    return -np.expm1(calm), spans


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The rows with `toxicity` (0 to 1) and `offending`, the sentences that are more likely toxic than not."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the features of at most TRAIN_ROWS documents
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
    fields = [T.StructField("toxicity", T.DoubleType()), T.StructField("offending", T.ArrayType(span))]
    return with_columns(docs, text, fields, lambda: lambda texts: judge(shared.value, texts))
