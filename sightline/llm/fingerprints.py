"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the smallest hash among its inner s-mers lies at its first or last
place. Whether a k-mer is chosen depends on the k-mer alone, so an edit elsewhere moves no anchor. A fingerprint
keeps every anchor of the whole text with its place: base64 of five bytes each, the step from the anchor before and
the hash. Any `WINDOW` successive k-mers hold an anchor, so a step fits in its byte. Two fingerprints are matched by
the longest sequence of anchors that is in order in both.

Defined results: the fingerprint of an empty or null text is empty. A text without an anchor (shorter than a k-mer,
or a little longer) has its own hash as its one anchor. Equal fingerprints have likeness 1; an empty one and another
have 0. In the order of keys, null keys come last and rows with equal keys are ordered by their texts; the only row
of a table is its own successor.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.llm.blocks import BLOCK, code_points, grouped, mix, span_hashes, with_columns

INNER, WINDOW = 5, 16  # s, and the s-mers of a k-mer: k = 20
KMER = INNER + WINDOW - 1
_STORED = np.dtype([("step", "u1"), ("hash", ">u4")])
_MASK_BYTES = 1 << 26  # of masks kept while two fingerprints are matched


def _anchors(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and 32-bit hash of every closed syncmer of texts that are joined in one block."""
    units = code_points("\n".join(texts)).astype(np.uint64)
    none = np.zeros(0, np.int64)
    if len(units) < KMER:
        return none, none, none.astype(np.uint64)
    smer = units[: len(units) - INNER + 1].copy()
    for j in range(1, INNER):
        smer *= np.uint64(0x100000001B3)
        smer += units[j : len(units) - INNER + 1 + j]
    smer = mix(smer)
    low, reach = smer, 1
    while reach < WINDOW:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    at = np.flatnonzero((low == smer[: len(low)]) | (low == smer[WINDOW - 1 :]))
    lengths = np.array([len(t) for t in texts], np.int64)
    firsts = np.cumsum(lengths + 1) - lengths - 1
    text = np.searchsorted(firsts, at, "right") - 1
    inside = at + KMER <= (firsts + lengths)[text]
    at, text = at[inside], text[inside]
    value = np.zeros(len(at), np.uint64)
    for j in range(0, WINDOW, INNER):
        value = mix(value ^ smer[at + j])
    return text, at - firsts[text], value >> np.uint64(32)


def fingerprints(texts: list[str]) -> list[str]:
    """All anchors in the order of their places, each as its step and hash, in base64."""
    parts = []  # a long text in parts that overlap by a k-mer less one
    for i, text in enumerate(texts):
        step = BLOCK - KMER + 1
        parts += [(i, x, text[x : x + BLOCK]) for x in range(0, max(len(text) - KMER + 1, 1), step)]
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    for a, b in grouped([p for _, _, p in parts]):
        text, place, value = _anchors([p for _, _, p in parts[a:b]])
        owner = np.array([i for i, _, _ in parts[a:b]])[text]
        shift = np.array([x for _, x, _ in parts[a:b]])[text]
        found.append((owner, place + shift, value))
    owner, place, value = (np.concatenate(x) for x in zip(*found, strict=True))
    bound = np.searchsorted(owner, np.arange(len(texts) + 1))
    stored = np.zeros(len(owner), _STORED)
    stored["hash"] = value
    step = np.diff(place, prepend=0)
    first = bound[:-1][bound[:-1] < bound[1:]]
    step[first] = place[first]
    stored["step"] = step
    out = [base64.b64encode(stored[a:b].tobytes()).decode() for a, b in zip(bound[:-1], bound[1:], strict=True)]
    for i, text in enumerate(texts):
        if text and not out[i]:
            units = code_points(text)
            whole = int(span_hashes(units, np.array([0]), np.array([len(units)]))[0]) >> 32
            out[i] = base64.b64encode(np.array([(0, whole)], _STORED).tobytes()).decode()
    return out


def anchors(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of a fingerprint's anchors."""
    stored = np.frombuffer(base64.b64decode(fingerprint), _STORED)
    return np.cumsum(stored["step"], dtype=np.int64), stored["hash"].astype(np.int64)


def _in_order(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b, n = a[head:], b[head:], n - head
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    a, b = a[np.isin(a, b)], b[np.isin(b, a)]
    if not len(a):
        return head + tail
    where: dict[int, list[int]] = {}
    for i, x in enumerate(b.tolist()):
        where.setdefault(x, []).append(i)
    if sum(len(where[x]) for x in a.tolist()) <= 16 * (len(a) + len(b)):
        ends: list[int] = []
        for x in a.tolist():
            for i in reversed(where[x]):
                k = bisect_left(ends, i)
                ends[k : k + 1] = [i]
        return head + tail + len(ends)
    # many repeats: a bit per place of b; a cleared one ends a longer sequence
    full = (1 << len(b)) - 1
    state, masks = full, {}
    for x in a.tolist():
        if (mask := masks.get(x)) is None:
            flags = np.zeros(len(b), np.uint8)
            flags[where[x]] = 1
            mask = int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")
            if (len(masks) + 1) * len(b) <= 8 * _MASK_BYTES:
                masks[x] = mask
        hit = state & mask
        state = ((state + hit) | (state - hit)) & full
    return head + tail + len(b) - state.bit_count()


def likeness(one: str, two: str) -> float:
    """Twice the anchors matched in order, over all anchors of both."""
    if one == two:
        return 1.0
    if not one or not two:
        return 0.0
    a, b = anchors(one)[1], anchors(two)[1]
    return 2 * _in_order(a, b) / (len(a) + len(b))


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with `fingerprint`."""
    return with_columns(docs, text, [T.StructField("fingerprint", T.StringType())], lambda: lambda texts: [fingerprints([t or "" for t in texts])])


def ordered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, borrowed) in partitions by descending key: each holds its rows in order, then the row after them.

    Bounds come from quantiles of the keys; only the first rows of the partitions are moved twice. The text is
    shuffled once. The last partition borrows the first row of all.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    bounds = sorted(set(rows.where("k is not null").select(F.col("k").cast("double")).approxQuantile("k", [i / parts for i in range(1, parts)], 0.25 / parts)))
    above = F.size(F.filter(F.array(*[F.lit(x) for x in bounds]), lambda x: x >= F.col("k").cast("double"))) if bounds else F.lit(0)
    part = F.when(F.col("k").isNull(), len(bounds)).otherwise(above)
    rows = rows.withColumn("part", part.cast("int"))
    heads = sorted((r.part, r.head) for r in rows.groupBy("part").agg(F.max("k").alias("head")).collect())  # a row per partition
    targets = [(heads[i - 1][0], head) for i, (_, head) in enumerate(heads)]
    kind = rows.schema["k"].dataType
    after = spark.createDataFrame(targets, T.StructType([T.StructField("to", T.IntegerType()), T.StructField("head", kind)]))
    lent = rows.join(F.broadcast(after), F.col("k").eqNullSafe(F.col("head"))).select("k", "t", F.col("to").alias("part"), F.lit(True).alias("borrowed"))
    both = rows.select("k", "t", "part", F.lit(False).alias("borrowed")).unionByName(lent)
    return both.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "borrowed", F.desc_nulls_last("k"), F.xxhash64("t"), "t").select("k", "t", "borrowed")


def compared(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document against itself with its second half replaced, and against the next one in descending order.

    The edited text's last floor(n / 2) code points are replaced by as many first ones of the next document, or by
    all of them.
    """

    def apply(batches):
        last = None  # the row that still waits for its successor: key, text, fingerprint
        for batch in batches:
            keys, texts, borrowed = (batch.column(i).to_pylist() for i in range(3))
            for a, b in grouped(texts):
                prints = fingerprints(texts[a:b])
                pairs = []
                for k, t, f, lent in zip(keys[a:b], texts[a:b], prints, borrowed[a:b], strict=True):
                    if last is not None:
                        pairs.append((last, t, f))
                    last = None if lent else (k, t, f)
                edited = [t[: len(t) - len(t) // 2] + after[: len(t) // 2] for (_, t, _), after, _ in pairs]
                changed = fingerprints(edited)
                rows = [
                    (k, len(t), hashlib.sha256(e.encode("utf-8", "replace")).hexdigest(), f, g, likeness(f, g), likeness(f, h))
                    for ((k, t, f), _, h), e, g in zip(pairs, edited, changed, strict=True)
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, batch.column(0).type if i == 0 else None) for i, c in enumerate(zip(*rows, strict=True))], names=names)

    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [dict(docs.dtypes)[key], "long", "string", "string", "string", "double", "double"]
    return ordered(docs, key, text).mapInArrow(apply, ", ".join(f"`{n}` {t}" for n, t in zip(names, types, strict=True)))
