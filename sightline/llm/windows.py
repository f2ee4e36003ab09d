"""Packing tokenized documents into equal windows by multiway differencing.

The tokens of all documents form one line, in the order of the stored pieces. The line is cut into groups of
`GROUP` windows, each packed in a task of its own, so that a group has the same size whatever the corpus or the length
of a document. Within a group whole windows of long pieces are set apart, and the rest are spread by differencing: every
piece begins as a partition of its own, and the two partial partitions with the largest differences are merged, the
fullest windows of one with the emptiest of the other. Where a window exceeds the capacity, one window more is tried.
The windows are then near-equal; as pieces may be cut, the emptiest are taken apart to fill the others to the last
token. A group is a whole number of windows, so nothing is left, but in the last one: what is left there becomes
sequences whose lengths are different powers of two, which need no padding.

Tokens. The tokenizer must make its words lower-case and split them at white space and at punctuation. Words without
white space, and the punctuation after their letters, are tokenized once and remembered.

Defined results: a null text is an empty one, whose only id is the closing id. Repeated rows are packed each. Other
columns of the documents are not read.
"""

from __future__ import annotations

import functools
import heapq
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sightline.llm.blocks import grouped
from sightline.llm.bpe import safe_pieces
from sightline.llm.memory import GAP, Memory, Spans, text_slices
from sightline.session import materialize

CAPACITY = 4096
GROUP = 64  # windows that a task packs together

KEPT = 500_000  # pieces that a worker remembers
_BLANKS = " \t\n\r"
_BLANK, _LETTER, _STOP, _GAP = 1, 2, 3, 4
_KINDS = np.zeros(GAP + 1, np.uint8)
_KINDS[[ord(c) for c in _BLANKS]] = _BLANK
_KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KINDS[[ord(c) for c in ",.;:!?"]] = _STOP
_KINDS[GAP] = _GAP

Partition = list[tuple[int, object]]  # windows that hold anything, the fullest first: tokens, and what is in them


def _merge(a: Partition, b: Partition, windows: int) -> Partition:
    """The fullest windows of one partition with the emptiest of the other."""
    alone = max(windows - len(b), 0)  # that many of b are empty
    out = a[:alone] + b[: max(windows - len(a), 0)]
    for i in range(alone, len(a)):
        x, y = a[i], b[windows - 1 - i]
        out.append((x[0] + y[0], (x[1], y[1])))
    out.sort(key=lambda w: -w[0])
    return out


def _inside(content) -> list[int]:
    found, open_ = [], [content]
    while open_:
        x = open_.pop()
        if isinstance(x, tuple):
            open_.extend(x)
        else:
            found.append(x)
    return sorted(found)


def differenced(lengths: list[int], windows: int) -> list[list[int]]:
    """The pieces spread over so many windows by multiway differencing: per window the indices of its pieces."""
    heap = [(-n, i, [(n, i)]) for i, n in enumerate(lengths)]
    if windows == 1:
        return [list(range(len(lengths)))]
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        both = _merge(heapq.heappop(heap)[2], heapq.heappop(heap)[2], windows)
        least = both[-1][0] if len(both) == windows else 0
        heapq.heappush(heap, (least - both[0][0], number, both))
        number += 1
    found = [_inside(content) for _, content in heap[0][2]] if heap else []
    return found + [[] for _ in range(windows - len(found))]


def balanced(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Near-equal windows of at most the capacity: one window more whenever it is exceeded."""
    large = sum(2 * n > capacity for n in lengths)  # no two of these share a window
    windows = max(-(-sum(lengths) // capacity), large)
    while True:
        found = differenced(lengths, windows) if windows else []
        if all(sum(lengths[i] for i in w) <= capacity for w in found):
            return found
        windows += 1


def filled(lengths: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, start, length): full windows, and of the rest different powers of two.

    Pieces as long as a window or longer are cut into whole windows first. The emptiest of the balanced windows are
    taken apart, and fill the gaps of the others in order, cut where a gap ends.
    """
    out = [[(i, start, capacity)] for i, n in enumerate(lengths) for start in range(0, n - capacity + 1, capacity)]
    rest = [(i, n // capacity * capacity, n % capacity) for i, n in enumerate(lengths) if n % capacity]
    windows = balanced([n for *_, n in rest], capacity)
    windows.sort(key=lambda w: (-sum(rest[k][2] for k in w), w))
    full = sum(n for *_, n in rest) // capacity
    pool = [rest[k] for w in reversed(windows[full:]) for k in w]  # taken from its end

    def take(size: int) -> list[tuple[int, int, int]]:
        taken = []
        while size:
            i, start, n = pool.pop()
            used = min(n, size)
            taken.append((i, start, used))
            if used < n:
                pool.append((i, start + used, n - used))
            size -= used
        return taken

    for w in windows[:full]:
        held = [rest[k] for k in w]
        out.append(held + take(capacity - sum(n for *_, n in held)))
    left = sum(n for *_, n in pool)
    for power in reversed(range(left.bit_length())):
        if left >> power & 1:
            out.append(take(1 << power))
    return out


def piece_starts(units: np.ndarray) -> np.ndarray:
    """Where pieces begin: blanks, what follows them, and punctuation after a letter."""
    kind = _KINDS[units]
    start = kind == _GAP
    start[:1] = True
    before, after = kind[:-1], kind[1:]
    start[1:] |= (before == _GAP) | ((before == _BLANK) != (after == _BLANK)) | ((before == _LETTER) & (after == _STOP))
    return start


@functools.cache
def worker_words(path: str) -> tuple[Memory, str]:
    """One per Python worker, which runs many tasks; and the type that holds an id."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
    tokenizer = Tokenizer.from_file(path)
    memory = Memory(lambda words: [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)], KEPT)
    return memory, "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def tokenized(docs: DataFrame, path: str, end_id: int, longest: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Pieces of at most `longest` tokens in the order of each task: part (the task), before (tokens of the task before
    the piece), the key, doc_tokens, start, length, and the ids of two or four bytes."""
    rows = docs.select(F.col(key), F.col(text).alias("t"))
    kind = dict(rows.dtypes)[key]

    def apply(batches):
        memory, width = worker_words(path)
        part, before = TaskContext.get().partitionId(), 0
        for batch, texts in (x for whole in batches for x in text_slices(whole, 1)):
            for a, b in grouped(texts):
                cut = [list(safe_pieces(t)) for t in texts[a:b]]
                own = [p for c in cut for p in c]
                # a special token's string is one in lower case only
                ids, bound = Spans(own, piece_starts, skip=_BLANKS, lower=not any("<|" in t for t in own)).ids(memory)
                ends = bound[np.cumsum([len(c) for c in cut])]
                ids = np.insert(ids, ends, end_id).astype(width)
                ends = ends + np.arange(1, len(ends) + 1)
                size = np.diff(ends, prepend=0)
                count = -(-size // longest)
                doc = np.repeat(np.arange(len(size)), count)
                start = longest * (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count))
                length = np.minimum(size[doc] - start, longest)
                offsets = np.append(0, np.cumsum(length)) * ids.itemsize
                held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)])
                columns = [pa.array(np.full(len(doc), part, np.int32)), pa.array(before + np.cumsum(length) - length), batch.column(0).take(pa.array(a + doc))]
                columns += [pa.array(x.astype(np.int64)) for x in (size[doc], start, length)]
                yield pa.RecordBatch.from_arrays([*columns, held.cast(pa.binary())], names=["part", "before", key, "doc_tokens", "start", "length", "ids"])
                before += int(length.sum())

    return rows.mapInArrow(apply, f"part int, before long, `{key}` {kind}, doc_tokens long, start long, length long, ids binary")


def pack(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, group: int = GROUP, text: str = "text", key: str = "doc_id", ids: bool = False) -> DataFrame:
    """Per piece: the key, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, its ids."""
    whole = group * capacity
    table = materialize(tokenized(docs, path, end_id, whole, text, key), "tokens")
    parts = table.groupBy("part").agg(F.sum("length").alias("n"))  # one row per task
    base = materialize(parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base")), "parts")
    width = 2 if worker_words(path)[1] == "<u2" else 4
    line = table.join(base, "part").withColumn("at", F.col("base") + F.col("before"))
    first, last = F.expr(f"at div {whole}"), F.expr(f"(at + length - 1) div {whole}")
    cut = line.withColumn("group", F.explode(F.sequence(first, last)))  # at most two
    low = F.greatest(F.col("group") * whole - F.col("at"), F.lit(0))
    high = F.least((F.col("group") + 1) * whole - F.col("at"), F.col("length"))
    cut = cut.withColumns({"low": low, "high": high})
    cut = cut.select("group", (F.col("at") + F.col("low")).alias("at"), key, "doc_tokens", (F.col("start") + F.col("low")).alias("start"), F.expr(f"substring(ids, int(low * {width} + 1), int((high - low) * {width}))").alias("ids"))
    names, kind = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"], dict(docs.dtypes)[key]

    def packed(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at").combine_chunks()
        held = [np.frombuffer(x.as_buffer(), f"<u{width}") for x in rows.column("ids").combine_chunks()]
        starts, number = rows.column("start").to_numpy(), rows.column("group")[0].as_py() if len(rows) else 0
        out = []
        for k, sequence in enumerate(filled([len(x) for x in held], capacity)):
            offset = 0
            for i, start, n in sequence:
                own = held[i][start : start + n].astype("<u4")
                out.append((i, int(starts[i]) + start, n, zlib.crc32(own.tobytes()), number << 20 | k, offset, own if ids else None))
                offset += n
        where, start, length, crc, sequence_id, offset, values = zip(*out, strict=True)
        at = pa.array(where)
        columns = [rows.column(key).take(at), start, length, crc, rows.column("doc_tokens").take(at), sequence_id, offset]
        columns = [x if isinstance(x, pa.ChunkedArray) else pa.array(x, pa.int64()) for x in columns] + [pa.array(values, pa.list_(pa.int32()))] * ids
        return pa.table(columns, names=names + ["ids"] * ids)

    return cut.groupBy("group").applyInArrow(packed, f"`{key}` {kind}, " + ", ".join(f"{c} long" for c in names[1:]) + ", ids array<int>" * ids)
