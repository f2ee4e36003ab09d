"""Language of texts: word-first backoff.

A known word scores by its log frequency in each language. An unseen word falls back to its character
n-grams: the longest order of which the model knows at least one n-gram gives the mean of their log
frequencies, so every word weighs the same. Texts are lower-cased; words are runs of letters.

Every word and n-gram of the sample is kept, with the languages it was seen in. One that a language lacks has the same
frequency in all such languages, below any that was seen, so no language gains by a small sample.

Defined results: a null text, or one without a letter, is `und` with score 0. Without any learned
language every text is `und`. Languages that tie are taken in alphabetical order. The score is the
share of the best language after at most `CERTAINTY` words' worth of evidence.
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

UNKNOWN = "und"
ORDERS = (5, 4, 3, 2, 1)
TRAIN_ROWS = 20_000  # labelled rows that the model is fitted on, by hash of their id and text
LEAST = 200  # rows of a language that the sample has at least, if there are as many
CERTAINTY = 8
_EDGE = 0x110000  # stands before and after a word in its n-grams
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(letter_table(str.isalpha))
    return _LETTERS[0]


class Frequencies:
    """Rows of log frequencies, one per hash, of which only those that were seen are stored."""

    def __init__(self, bounds: np.ndarray, lang: np.ndarray, value: np.ndarray, unseen: np.ndarray):
        self.bounds, self.lang, self.value, self.unseen = bounds, lang, value, unseen

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        rows = np.tile(self.unseen, (len(at), 1))
        count = self.bounds[at + 1] - self.bounds[at]
        place = np.repeat(self.bounds[at] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        rows[np.repeat(np.arange(len(at)), count), self.lang[place]] = self.value[place]
        return rows


@dataclass
class LanguageModel:
    """Per order (0 for words): sorted hashes and their log frequency in each language."""

    languages: list[str]
    tables: dict[int, tuple[np.ndarray, np.ndarray | Frequencies]]


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, and starts, ends and text numbers of their words."""
    low = [t.lower() for t in texts]
    units = code_points("\n".join(low))
    starts, ends = runs(letters()[units])
    firsts = np.cumsum([0] + [len(t) + 1 for t in low[:-1]])
    return units, starts, ends, np.searchsorted(firsts, starts, "right") - 1


def distinct(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words, the place of one instance of each, and each word's number."""
    return np.unique(span_hashes(units, starts, ends), return_index=True, return_inverse=True)


def grams(units: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words' n-grams, edges included, and the word each belongs to."""
    lengths = ends - starts + 2
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(firsts, lengths)
    inside = (place > 0) & (place < np.repeat(lengths, lengths) - 1)
    padded = np.full(len(place), _EDGE, np.uint32)
    padded[inside] = units[(np.repeat(starts, lengths) + place - 1)[inside]]
    count = np.maximum(lengths - order + 1, 0)
    word = np.repeat(np.arange(len(starts)), count)
    at = firsts[word] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return span_hashes(padded, at, at + order), word


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows: int = TRAIN_ROWS) -> LanguageModel:
    """Learns from the labelled rows: all of them up to `rows`, beyond that a sample by hash, and at least `LEAST` of each language.

    The counting is distributed; the driver gets the counts of the sample.
    """
    labelled = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"))
    sizes = materialize(labelled.groupBy("l").agg(F.count("*").alias("size")), "language-sizes")
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shares = sizes.select(F.col("l").alias("_l"), F.greatest(F.lit(min(1, rows / max(total, 1))), F.least(F.lit(1.0), LEAST / F.col("size"))).alias("share"))
    sample = labelled.join(shares, F.col("l") == F.col("_l")).where(F.pmod(F.xxhash64("k", "t"), F.lit(10**12)) < F.col("share") * 10**12).select("t", "l")

    def count(batches):
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
            names = sorted(set(langs))
            for a, b in grouped(texts):
                for name in names:
                    own = [piece for t, x in zip(texts[a:b], langs[a:b], strict=True) if x == name for piece in cuts(t)]
                    if not own:
                        continue
                    units, starts, ends, _ = words_of(own)
                    if not len(starts):
                        continue
                    hashes, one, number = distinct(units, starts, ends)
                    found = {0: (hashes, np.bincount(number))}
                    for order in ORDERS:
                        h, word = grams(units, starts[one], ends[one], order)
                        u, inverse = np.unique(h, return_inverse=True)
                        found[order] = u, np.bincount(inverse, weights=found[0][1][word], minlength=len(u)).astype(np.int64)
                    for order, (h, n) in found.items():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(h), order, np.int32)), pa.array(h.view(np.int64)), pa.array([name] * len(h)), pa.array(n.astype(np.int64))],
                            names=["order", "hash", "l", "n"],
                        )

    counts = materialize(sample.mapInArrow(tidy(count), "order int, hash long, l string, n long").groupBy("order", "hash", "l").agg(F.sum("n").alias("n")), "language-counts")
    names = sorted(r.l for r in counts.where("order = 0").select("l").distinct().collect())
    totals = {(r.order, r.l): (r.n, r.kinds) for r in counts.groupBy("order", "l").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()}
    tables = {}
    for order in (0, *ORDERS):
        if not names:
            continue
        part = counts.where(F.col("order") == order).select("hash", "l", "n").toArrow()
        hashes = part.column("hash").to_numpy().view(np.uint64)
        which = part.column("l").combine_chunks().dictionary_encode() if len(part) else pa.array([], pa.string()).dictionary_encode()
        number = np.array([names.index(x) for x in which.dictionary.to_pylist()], np.int32)
        code, n = number[which.indices.to_numpy()], part.column("n").to_numpy()
        by = np.argsort(hashes, kind="stable")
        known, first = np.unique(hashes[by], return_index=True)
        size = np.array([totals.get((order, name), (0, 0))[0] for name in names], np.float64)
        kinds = max([1] + [k for (o, _), (_, k) in totals.items() if o == order])
        base = size + 0.5 * kinds
        value = np.log((n[by] + 0.5) / base[code[by]]).astype(np.float32)
        unseen = np.full(len(names), np.log(0.5 / base.max()), np.float32)
        tables[order] = known, Frequencies(np.append(first, len(by)), code[by], value, unseen)
    discard(counts, sizes)
    return LanguageModel(names, tables)


def word_scores(model: LanguageModel, hashes: np.ndarray, units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row of log frequencies per distinct word."""
    scores = np.zeros((len(hashes), len(model.languages)), np.float32)
    known, table = model.tables[0]
    at = find(known, hashes)
    scores[at >= 0] = table[at[at >= 0]]
    left = np.flatnonzero(at < 0)
    for order in ORDERS:
        if not len(left):
            break
        known, table = model.tables[order]
        h, word = grams(units, starts[left], ends[left], order)
        at = find(known, h)
        word, at = word[at >= 0], at[at >= 0]
        n = np.bincount(word, minlength=len(left))
        rows = table[at]
        sums = np.column_stack([np.bincount(word, weights=rows[:, j], minlength=len(left)) for j in range(rows.shape[1])])
        scores[left[n > 0]] = (sums[n > 0] / n[n > 0, None]).astype(np.float32)
        left = left[n == 0]
    return scores


def predict(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of every text."""
    parts, owner = [], []
    for i, text in enumerate(texts):
        for piece in cuts(text or ""):
            parts.append(piece)
            owner.append(i)
    width = len(model.languages)
    total, words = np.zeros((len(texts), width)), np.zeros(len(texts), np.int64)
    for a, b in grouped(parts):
        units, starts, ends, which = words_of(parts[a:b])
        if not len(starts):
            continue
        row = np.array(owner[a:b])[which]
        words += np.bincount(row, minlength=len(texts))
        if width:
            hashes, one, number = distinct(units, starts, ends)
            scores = word_scores(model, hashes, units, starts[one], ends[one])[number]
            for j in range(width):
                total[:, j] += np.bincount(row, weights=scores[:, j], minlength=len(texts))
    if not width:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    evidence = total / np.maximum(words, 1)[:, None] * np.minimum(words, CERTAINTY)[:, None]
    share = np.exp(evidence - evidence.max(axis=1, keepdims=True))
    share /= share.sum(axis=1, keepdims=True)
    best = np.argmax(share, axis=1)
    names = [model.languages[b] if n else UNKNOWN for b, n in zip(best, words, strict=True)]
    return names, np.where(words > 0, share[np.arange(len(texts)), best], 0.0)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows with `lang_pred` and `lang_score`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is that of the sample's vocabulary
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())]
    return with_columns(docs, text, fields, lambda: lambda texts: predict(shared.value, texts))
