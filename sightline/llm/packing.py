"""Packing tokenized documents into sequences of fixed capacity.

Lengths are packed, not documents: Spark counts the pieces of each length, and the counts (at most `capacity` of
them) are enough to plan. Exact complements come first: sequences that one, two, three or four lengths fill to the
last token, found by hashing the sums of single lengths, pairs and triples under the counts still available. What
no combination fills is packed best-fit, longest first. The plan lists, per length, ranges of ranks and the place
that each rank gets; documents find theirs by their rank among the pieces of their length, so no document passes
through the driver and a length that a third of all pieces share is ranked in many tasks.

Tokens. The text is split as the tokenizer splits it, by array operations, and each distinct piece of a block is
tokenized once, by the tokenizer's model alone where nothing else would change it; texts with code points unknown here, or with an added token of the tokenizer (`<|endoftext|>`), which
it takes out before it splits, go to the tokenizer whole.

Defined results: a null text is an empty one, whose only id is the closing id. Repeated rows are packed each.
"""

from __future__ import annotations

import functools
import json
import os
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sightline.llm.blocks import grouped, tidy
from sightline.llm.bpe import safe_pieces
from sightline.llm.memory import Memory, Spans, text_slices
from sightline.session import materialize

CAPACITY = 1024
_OTHER, _LETTER, _NUMBER, _SPACE, _UNKNOWN, _GAP = range(6)
_BLANKS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.cache
def classes() -> np.ndarray:
    kinds = {"L": _LETTER, "N": _NUMBER}
    table = np.zeros(0x110001, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        table[c] = _UNKNOWN if kind == "Cn" else kinds.get(kind[0], _OTHER)
    table[_BLANKS] = _SPACE
    table[0x110000] = _GAP
    return table


@functools.cache
def byte_letters() -> dict[int, str]:
    """The letter by which byte-level tokenizers write each byte: itself if it can be seen, else the next from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(other)}


def split_points(units: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where the splitting pattern's matches begin; texts are separated by single gaps."""
    n = len(units)
    before = np.append(np.uint8(_GAP), kind[:-1])
    start = kind != before
    space = units == 0x20
    start[1:] &= ~(space[:-1] & (kind[1:] != _SPACE) & (kind[1:] != _GAP))  # a run takes the space before it
    blank = kind == _SPACE
    after = np.append(kind[1:], np.uint8(_GAP))
    start |= blank & (after != _SPACE) & (after != _GAP)  # the last blank before a run stands alone or joins it
    quote = np.flatnonzero((units == 0x27) & start)
    if len(quote):
        tail = np.concatenate([units, np.zeros(3, units.dtype)])
        one, two = tail[quote + 1], tail[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        hit = short | long
        at, size = quote[hit], np.where(short, 2, 3)[hit]
        start[at + 1] = False
        inside = at + size < n
        start[(at + size)[inside]] |= kind[(at + size)[inside]] == _LETTER
    return start


class Ids:
    """Token ids of texts; remembers the ids of the pieces seen so far."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memory = Memory(self._by_model if self._only_bytes() else self._by_tokenizer)

    def _only_bytes(self) -> bool:
        """Whether all that the tokenizer does to a piece before its model is to write its bytes as letters."""
        steps = json.loads(self.tokenizer.to_str())
        split = steps["pre_tokenizer"] or {}
        return not steps["normalizer"] and split.get("type") == "ByteLevel" and not split["add_prefix_space"] and split["use_regex"]

    def _by_tokenizer(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _by_model(self, pieces: list[str]) -> list[list[int]]:
        tokenize, letters = self.tokenizer.model.tokenize, byte_letters()
        return [[t.id for t in tokenize(p.encode().decode("latin-1").translate(letters))] for p in pieces]

    def has_added(self, text: str) -> bool:
        return any(content in text for content in self.added)

    def of(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text, without special tokens."""
        spans = Spans(texts, lambda units: split_points(units, classes()[units]))
        ids, bound = spans.ids(self.memory)
        out = [ids[a:b] for a, b in zip(bound[:-1], bound[1:], strict=True)]
        unknown = np.flatnonzero(classes()[spans.units] == _UNKNOWN)
        strange = np.unique(np.searchsorted(spans.firsts, unknown, "right") - 1)
        for i in {*strange.tolist(), *(i for i, t in enumerate(texts) if self.has_added(t))}:
            out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, "<u4")
        return out


@functools.cache
def worker_ids(path: str) -> Ids:
    """One per Python worker, which runs many tasks."""
    return Ids(path)


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, text: str = "text", key: str = "doc_id", ids: bool = False) -> DataFrame:
    """One row per piece: the key, piece, start, length, ids_crc32 and, if asked for, the ids.

    Only documents longer than the capacity are cut, into full pieces after a first one that may be shorter.
    """
    rows = docs.select(key, F.col(text).alias("t"))

    def apply(batches):
        tokens = worker_ids(path)
        last = np.array([end_id], "<u4")
        for batch, texts in (x for whole in batches for x in text_slices(whole, 1)):
            for a, b in grouped(texts):
                parts = [(i, p) for i in range(a, b) for p in ([texts[i]] if tokens.has_added(texts[i]) else safe_pieces(texts[i]))]
                owner = [i for i, _ in parts]
                got = [[] for _ in range(a, b)]
                for i, x in zip(owner, tokens.of([p for _, p in parts]), strict=True):
                    got[i - a].append(x)
                out = []
                for i, own in enumerate(got, a):
                    whole = np.concatenate([*own, last])
                    cut = len(whole) % capacity or capacity
                    edges = [0, *range(min(cut, len(whole)), len(whole) + 1, capacity)]
                    for k, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                        out.append((i, k, x, y - x, zlib.crc32(whole[x:y].tobytes()), whole[x:y] if ids else None))
                where, number, start, length, crc, values = zip(*out, strict=True)
                columns = [batch.column(0).take(pa.array(where)), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = [key, "piece", "start", "length", "ids_crc32"]
                if ids:
                    columns, names = [*columns, pa.array(values, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = dict(rows.dtypes)[key]
    return rows.mapInArrow(tidy(apply), f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids)


def _take(left: np.ndarray, combination: list[int]) -> int:
    """How often the combination can be taken from what is left."""
    return min(int(left[x]) // combination.count(x) for x in set(combination))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Combinations of lengths and how many sequences hold each; uses every piece once."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] += n
    out: list[tuple[list[int], int]] = []

    def use(combination: list[int]) -> None:
        n = _take(left, combination)
        if n > 0:
            for x in combination:
                left[x] -= n
            out.append((combination, n))

    def pair(total: int) -> tuple[int, int] | None:
        """The pair of available lengths with the sum that can be taken most often."""
        a = np.arange(1, total // 2 + 1)
        if not len(a):
            return None
        often = np.minimum(left[a], left[total - a])
        if total % 2 == 0:
            often[-1] = left[total // 2] // 2
        k = int(np.argmax(often))
        return (int(a[k]), total - int(a[k])) if often[k] > 0 else None

    use([capacity])
    for a in range(capacity - 1, 0, -1):  # pairs
        if 2 * a >= capacity and left[a]:
            use([a, capacity - a])
    for a in range(capacity - 2, 0, -1):  # a length and the pair that fills its gap
        while left[a] and (found := pair(capacity - a)):
            before = left[a]
            use([a, *found])
            if left[a] == before:
                break
    for a in range(capacity - 3, 0, -1):  # a length and the triple that fills its gap
        for b in [int(x) for x in np.flatnonzero(left[: capacity - a]) if x]:
            while left[a] and left[b] and (found := pair(capacity - a - b)):
                before = int(left[a])
                use([a, b, *found])
                if left[a] == before:
                    break
            if not left[a]:
                break
    gaps: dict[int, list[tuple[list[int], int]]] = {}  # open sequences by what still fits
    for a in range(capacity, 0, -1):
        n = int(left[a])
        for gap in sorted(g for g in gaps if g >= a):  # the tightest first
            fits, after = gap // a, []
            for held, m in gaps.pop(gap):
                full = min(m, n // fits)
                for k, times in ((fits, full), (0, m - full)):
                    if k == 0 and times and (more := n - full * fits):  # one sequence takes the rest
                        gaps.setdefault(gap - more * a, []).append((held + [a] * more, 1)) if gap - more * a != gap else None
                        n -= more
                        times -= 1
                    if times:
                        (after if k == 0 else gaps.setdefault(gap - k * a, [])).append((held + [a] * k, times))
                n -= full * fits
            if after:
                gaps.setdefault(gap, []).extend(after)
            if not n:
                break
        if n:
            fits = capacity // a
            for k, times in ((fits, n // fits), (n % fits, 1 if n % fits else 0)):
                if times:
                    gaps.setdefault(capacity - k * a, []).append(([a] * k, times))
    return out + [x for group in gaps.values() for x in group]


def pack(table: DataFrame, capacity: int = CAPACITY, key: str = "doc_id") -> DataFrame:
    """The pieces with `sequence_id` and `offset`: gapless sequences of at most the capacity.

    The table needs the columns of `pieces`; it is read several times, so pass one that is stored.
    """
    spark = table.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = table.withColumn("_b", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    sizes = materialize(rows.groupBy("length", "_b").agg(F.count("*").alias("_n")), "sizes")
    counts = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most `capacity` rows
    keys, firsts, offsets, next_rank, sequence = [], [], [], dict.fromkeys(counts, 0), 0
    for lengths, times in plan(counts, capacity):
        offset = 0
        for length in lengths:
            keys.append(length * (1 << 44) + next_rank[length])
            firsts.append(sequence - next_rank[length])  # plus the rank: the sequence
            offsets.append(offset)
            next_rank[length] += times
            offset += length
        sequence += times
    by = np.argsort(np.array(keys, np.int64), kind="stable")
    places = spark.sparkContext.broadcast((np.array(keys, np.int64)[by], np.array(firsts, np.int64)[by], np.array(offsets, np.int64)[by]))

    before = sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_b")) - F.col("_n")).drop("_n")
    order = Window.partitionBy("length", "_b").orderBy(key, "piece", "ids_crc32")
    ranked = rows.withColumn("_r", F.row_number().over(order) - 1).join(before, ["length", "_b"])
    ranked = ranked.select(*table.columns, (F.col("_r") + F.col("_before")).alias("_rank"))
    names = table.columns

    def place(batches):
        starts, bases, at = places.value
        for batch in batches:
            rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy(zero_copy_only=False)
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            k = np.searchsorted(starts, length * (1 << 44) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), pa.array(bases[k] + rank), pa.array(at[k])], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {t}" for c, t in table.dtypes)
    return ranked.mapInArrow(tidy(place), f"{schema}, sequence_id long, offset long")


def packed(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, text: str = "text", key: str = "doc_id", ids: bool = False) -> DataFrame:
    """Tokenizes, cuts and packs the documents."""
    return pack(materialize(pieces(docs, path, end_id, capacity, text, key, ids), "pieces"), capacity, key)
