"""Phrase collocations from count streams kept in prefix order and in suffix order.

A phrase of two words or more is a candidate if it occurs often enough in its language. Cutting it after its first k
words gives the counts of both parts, and the score of the cut is floor(scale * a / (left + right)). Candidates that lie
in a longer phrase which is nearly as frequent are dropped.

Streams. All phrase counts are one table. Sorted by the words before each cut it meets the table of counts in prefix
order, which gives the left counts; sorted by the words after the cut it meets them in suffix order, which gives the
right counts; a phrase without its last or without its first word meets the same streams, which gives the extension
counts. Both sides of each join are sorted streams that are read in lockstep (merge joins, no hash tables). One word
more on either side is enough for the extensions: a longer phrase holds such an extension, which is at least as frequent.

Pruning. A phrase is only as frequent as each part of it. A first pass therefore counts all words and pairs in cells of
a large table (2**32 cells, cut into buckets that are added up one after the other, whatever the size of the corpus).
Cells below the least count hold no frequent phrase; the others are marked in a bitmap of fixed size. A second pass does
the same for the longer phrases whose pairs are all marked, and the third counts the phrases that are marked themselves.
Different words that share a cell or a bit cost work and change nothing, as the third pass counts the phrases themselves.

Defined results: a null text is empty and a null language is `und`. A-Z are lower-cased. Repeated rows count each. A
language without candidates has no row. Ties of scores go to the smaller k; ranks are by score and count, descending,
and phrase in UTF-8 order. Other columns of the documents are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.blocks import grouped, mix, runs, span_hashes
from sightline.llm.memory import text_slices
from sightline.session import materialize

LONGEST, LEAST, SHARE, SCALE = 4, 30, 80, 2_000_000
UNKNOWN = "und"
BLOCK = 1 << 20  # bytes worked on at once
BUCKET = 1 << 20  # cells of a bucket: 2**32 cells in 4,096 buckets
MARKS = 1 << 27  # bits of the bitmap: 16 MB
FLUSH = 1 << 23  # keys that a task holds before it sends their counts
_BLANK, _STOP = 1, 2
_KINDS = np.zeros(256, np.uint8)
_KINDS[[0x20, 0x09]] = _BLANK
_KINDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = _STOP
_CUT = b" \t.,;:!?\n\x0b\x0c\r"
_NEXT = re.compile(rb"(?:[ \t.,;:!?\n\x0b\x0c\r]*[^ \t.,;:!?\n\x0b\x0c\r]+){0,%d}" % (LONGEST - 1))
_STEP = np.uint64(0xD1342543DE82EF95)


def parts(text: bytes, size: int = BLOCK) -> Iterator[tuple[bytes, int]]:
    """Pieces of a text and how many bytes of each it owns; the rest are the next words, which its last phrases need."""
    first = 0
    while len(text) - first > size:
        last = max(text.rfind(c, first, first + size) for c in _CUT)
        if last < 0:  # one word: up to its end
            last = min((at for c in _CUT if (at := text.find(c, first + size)) >= 0), default=len(text) - 1)
        yield text[first : _NEXT.match(text, last + 1).end()], last + 1 - first
        first = last + 1
    yield text[first:], len(text) - first


class Words:
    """The words of some texts of one language: their keys, the pieces they lie in, and which the texts own."""

    def __init__(self, texts: list[tuple[bytes, int]], lang: str):
        raw = b"\n".join(t for t, _ in texts).lower() + b"\n"  # of bytes: A-Z only
        units = np.frombuffer(raw, np.uint8)
        kind = _KINDS[units]
        starts, ends = runs(kind == 0)
        firsts = np.cumsum([0] + [len(t) + 1 for t, _ in texts[:-1]])
        limits = firsts + np.array([n for _, n in texts], np.int64)
        text = np.searchsorted(firsts, starts, "right") - 1
        self.own = starts < limits[text]
        piece = np.cumsum(kind == _STOP)[starts]
        self.joined = np.append(piece[1:] == piece[:-1], False)  # is the next word in the same piece?
        salt = np.uint64(int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "replace"), digest_size=8).digest(), "little"))
        self.keys = mix(span_hashes(units, starts, ends) + salt)
        # the words alone, one blank after each: a phrase is a slice
        mask = kind == 0
        mask[ends] = True
        self.units = units[mask].copy()
        self.ends = np.cumsum(ends - starts + 1) - 1
        self.starts = self.ends - (ends - starts)
        self.units[self.ends] = 0x20

    def grams(self, bitmap: np.ndarray | None, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each number of words: keys of the phrases that begin at the words, and where those begin that the texts
        own. With a bitmap, phrases of three words and more begin only where their pairs are marked."""
        key, begins, linked = self.keys, self.own, self.joined
        for k in range(1, longest + 1):
            if k > 1:
                ahead = lambda x, by: np.append(x[by:], np.zeros(min(by, len(x)), x.dtype))
                key = mix(key * _STEP + ahead(self.keys, k - 1))
                if k == 2 and bitmap is not None:
                    linked = linked & _marked(bitmap, key)
                begins = begins & ahead(linked, k - 2)
            yield k, key, np.flatnonzero(begins)

    def phrases(self, at: np.ndarray, words: int) -> pa.Array:
        """The phrases of so many words that begin at the given words."""
        start = self.starts[at]
        size = self.ends[at + words - 1] - start
        offsets = np.append(0, np.cumsum(size))
        data = self.units[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def _blocks(batches, size: int = BLOCK) -> Iterator[tuple[str, Words]]:
    """The words of all texts, block by block, one language at a time."""
    for batch, texts in (x for whole in batches for x in text_slices(whole, 1, rows=4096, size=4 * size)):
        langs = batch.column(0).to_pylist()
        for lang in dict.fromkeys(langs):
            own = [p for t, x in zip(texts, langs, strict=True) if x == lang for p in parts(t.encode("utf-8", "replace"), size)]
            for a, b in grouped([t for t, _ in own], 2 * size):
                yield lang, Words(own[a:b], lang)


def _cells(batches, least: int, shortest: int, longest: int, bitmap: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Counts of the cells of the phrases of so many words, in sorted runs: a bucket, its cells, and their counts (up to the least)."""
    held, size = [], 0

    def sent() -> Iterator[pa.RecordBatch]:
        cells = np.sort(np.concatenate(held))
        edge = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
        count = np.minimum(np.diff(np.append(edge, len(cells))), least).astype(np.uint32)
        cells = cells[edge]
        bucket = cells // np.uint32(BUCKET)
        cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(cells))
        for first in range(0, len(cut) - 1, 256):
            some = list(zip(cut[first:-1][:256].tolist(), cut[first + 1 :][:256].tolist(), strict=True))
            columns = [pa.array([int(bucket[a]) for a, _ in some], pa.int32())]
            columns += [pa.array([x[a:b].tobytes() for a, b in some], pa.binary()) for x in (cells, count)]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "cells", "counts"])

    for _, words in _blocks(batches):
        for k, keys, at in words.grams(bitmap, longest):
            if k >= shortest:
                held.append((keys[at] >> np.uint64(32)).astype(np.uint32))
                size += len(at)
        if size > FLUSH:
            yield from sent()
            held, size = [], 0
    if size:
        yield from sent()


def _marks(batches, least: int) -> Iterator[pa.RecordBatch]:
    """The bits of each bucket's part of the bitmap. The rows of a bucket follow one another."""
    share = MARKS // ((1 << 32) // BUCKET)
    bucket, total = None, np.zeros(BUCKET, np.int64)

    def done() -> Iterator[pa.RecordBatch]:
        marked = np.flatnonzero(total >= least)
        if len(marked):
            bits = np.zeros(share, bool)
            bits[marked * share // BUCKET] = True
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["bucket", "bits"])

    for batch in batches:
        for number, cells, counts in zip(*(batch.column(i) for i in range(3)), strict=True):
            if number.as_py() != bucket:
                if bucket is not None:
                    yield from done()
                bucket = number.as_py()
                total[:] = 0
            total[np.frombuffer(cells.as_buffer(), np.uint32) % np.uint32(BUCKET)] += np.frombuffer(counts.as_buffer(), np.uint32)
    if bucket is not None:
        yield from done()


def _marked(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys >> np.uint64(64 - (MARKS.bit_length() - 1))
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _counted(batches, bitmap: np.ndarray, longest: int) -> Iterator[pa.RecordBatch]:
    """(lang, words, phrase, n) of every block: all words (0, without a phrase), and the marked phrases."""
    for lang, words in _blocks(batches):
        out = [(0, pa.array([""]), pa.array([int(words.own.sum())]))]
        for k, keys, at in words.grams(bitmap, longest):
            at = at[_marked(bitmap, keys[at])]
            if not len(at):
                continue
            found = pc.value_counts(words.phrases(at, k))
            out.append((k, found.field("values"), found.field("counts")))
        for k, phrase, n in out:
            size = len(phrase)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * size, pa.string()), pa.array(np.full(size, k, np.int32)), phrase, n.cast(pa.int64())], names=["lang", "words", "phrase", "n"])


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, words, phrase, n): every phrase that occurs `least` times, and under 0 words the number of all words."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("t"))

    def marked(shortest: int, longest: int, known) -> np.ndarray:
        """The bitmap of the phrases of so many words, beside those that are known."""
        cells = rows.mapInArrow(lambda batches: _cells(batches, least, shortest, longest, known and known.value), "bucket int, cells binary, counts binary")
        marks = cells.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda batches: _marks(batches, least), "bucket int, bits binary")
        width, bitmap = MARKS * BUCKET // (1 << 32) // 8, known.value.copy() if known else np.zeros(MARKS // 8, np.uint8)
        for row in marks.collect():  # at most 16 MB, whatever the corpus
            bitmap[row.bucket * width : (row.bucket + 1) * width] |= np.frombuffer(row.bits, np.uint8)
        return bitmap

    short = spark.sparkContext.broadcast(marked(1, min(2, longest), None))
    shared = spark.sparkContext.broadcast(marked(3, longest, short)) if longest > 2 else short
    counted = rows.mapInArrow(lambda batches: _counted(batches, shared.value, longest), "lang string, words int, phrase string, n long")
    found = materialize(counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).where((F.col("words") == 0) | (F.col("n") >= least)), "phrase-counts")
    short.destroy()
    if shared is not short:
        shared.destroy()
    return found


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, share: int = SHARE, text: str = "text", lang: str = "lang") -> DataFrame:
    """Per kept phrase: lang, phrase, a, l, r and score of its lowest-scoring cut, and n, the words of its language."""
    counts = phrase_counts(docs, longest, least, text, lang)
    words = F.split("phrase", " ")
    joined = lambda first, size: F.array_join(F.slice(words, first, size), " ")
    phrases = counts.where("words > 1").withColumnRenamed("n", "a")
    stream = lambda side, name: counts.where(f"words between 1 and {longest - 1}").select("lang", F.col("phrase").alias(side), F.col("n").alias(name)).hint("merge")

    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"first": joined(F.lit(1), F.col("k")), "rest": joined(F.col("k") + 1, F.col("words") - F.col("k"))})
    cuts = cuts.join(stream("first", "l"), ["lang", "first"]).join(stream("rest", "r"), ["lang", "rest"])
    # exact: products may pass 64 bits; the score is at most scale / 2, as no part is rarer than the phrase
    score = F.expr(f"(CAST(a AS DECIMAL(20, 0)) * CAST({SCALE} AS DECIMAL(10, 0))) DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    cuts = cuts.withColumn("score", score.cast("long"))
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    longer = phrases.where("words > 2").select("lang", F.col("a").alias("extended"), F.explode(F.array(joined(F.lit(1), F.col("words") - 1), joined(F.lit(2), F.col("words") - 1))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("extended").alias("extended"))
    inside = F.col("extended").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * share
    kept = lowest.join(longer.hint("merge"), ["lang", "phrase"], "left").where(~F.coalesce(inside, F.lit(False)))
    total = counts.where("words = 0").select("lang", "n")
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").join(total, "lang")


def best_collocations(docs: DataFrame, first: int = 2000, longest: int = LONGEST, least: int = LEAST, share: int = SHARE, text: str = "text", lang: str = "lang") -> DataFrame:
    """The first phrases of each language with their rank: the report asks for so many.

    Ranks are taken in parts of a language first, so that no task orders all phrases of a language.
    """
    found = collocations(docs, longest, least, share, text, lang)
    slots = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(slots))
    some = found.withColumn("_part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= first)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
