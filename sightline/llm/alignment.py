"""Alignment of two tokenizations of the same texts.

The tokens of both cover the same bytes. Where tokens of both end at one byte, the text is cut into groups; tokens whose
byte ranges overlap are linked. All documents of a block are walked at once: one state vector holds the place of every
document in its A and its B tokens, each step emits the current links and cuts and advances whichever token ends first,
and finished documents are taken out of the vector. A long document takes several places of the vector, one for every
`LANE` bytes: a place starts at the tokens that hold its first byte and emits the links that begin in its bytes.

Counts of linked id pairs. Every task numbers the pairs that it meets, sends each number once with its count, and keeps
per document the numbers with how often they occur. The totals come back per number, and documents are summed in the
task that has their numbers: no table of all pairs is broadcast, and no link is shuffled by its pair.

Tokenizers. A is a byte-level BPE file of the tokenizers library and gets a space before the text, B a sentence-piece
model, which adds that space itself. Both cut a text before a single space between two characters that are no white
space, so that words are tokenized once and remembered. Special tokens have no meaning inside a text.

Defined results: a text that is null or empty, or whose A or B bytes are not those of the space and the text (one with
U+2581, say), has no tokens: all its numbers are 0, its digest is the empty string and its groups are null. Repeated
rows are aligned each. Other columns of the documents are not read.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sightline.llm.blocks import find, grouped
from sightline.llm.bpe import safe_pieces
from sightline.llm.memory import Memory, Spans, text_slices, word_starts
from sightline.session import materialize

LANE = 1024  # bytes of a place in the state vector
BLOCK = 1 << 20  # code points of a block
NUMBERED = 1 << 18  # pairs after which a task begins to number anew
HELD, ROW = 1 << 25, 128  # bytes of documents after which it does so too, and what a document adds
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, starts: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (an index into the A tokens, one into the B tokens) in order, and the cuts.

    Documents lie one after the other in one line of bytes. `ends_a` and `ends_b` are where the tokens of all end,
    `starts` where documents begin, with the end of the last.
    """
    sizes = np.diff(starts)
    count = -(-sizes // lane)
    of = np.repeat(np.arange(len(sizes)), count)
    low = starts[of] + lane * (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count))
    high = np.minimum(low + lane, starts[of + 1])
    a, b = np.searchsorted(ends_a, low, "right"), np.searchsorted(ends_b, low, "right")
    begin_a, begin_b = np.append(0, ends_a)[a], np.append(0, ends_b)[b]
    owned = np.maximum(begin_a, begin_b) >= low  # else the first link begins in the place before
    links_a, links_b, cuts = [], [], []
    while len(a):
        end_a, end_b = ends_a[a], ends_b[b]
        links_a.append(a if owned is None else a[owned])
        links_b.append(b if owned is None else b[owned])
        same = end_a == end_b
        cuts.append(end_a[same] if owned is None else end_a[same & owned])
        owned = None
        going = np.minimum(end_a, end_b) < high
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        if not going.all():
            a, b, high = a[going], b[going], high[going]
    if not links_a:
        return (np.zeros(0, np.int64),) * 3
    first, second = np.concatenate(links_a), np.concatenate(links_b)
    order = np.argsort(first + second, kind="stable")  # every step advances one of both
    return first[order], second[order], np.sort(np.concatenate(cuts))


class Pair:
    """The ids of texts by two tokenizers, with the bytes of every token."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        a = Tokenizer.from_file(path_a)
        a.encode_special_tokens = True
        b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece of the model spans a space, so words cannot be tokenized one by one")
        self.a = Memory(lambda words: [e.ids for e in a.encode_batch_fast(words, add_special_tokens=False)])
        self.b = Memory(lambda words: b.encode([w[1:] for w in words], num_threads=1))
        self.bytes_a = _byte_level([a.id_to_token(i) or "" for i in range(a.get_vocab_size())])
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.flat_a, self.flat_b = (np.frombuffer(b"".join(t), np.uint8) for t in (self.bytes_a, self.bytes_b))

    def ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The A ids of all texts in order and where those of each text begin, and the same of B."""
        spans = Spans(texts, word_starts)
        return [spans.ids(self.a), spans.ids(self.b)]


def _byte_level(tokens: list[str]) -> list[bytes]:
    """The bytes of byte-level tokens: printable characters of Latin-1 stand for themselves, the rest follow from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    table = {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(rest)}
    return [bytes(table[c] for c in t) for t in tokens]


@functools.cache
def worker_pair(path_a: str, path_b: str) -> Pair:
    """One per Python worker, which runs many tasks."""
    return Pair(path_a, path_b)


def _gathered(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    return flat[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())]


def _same_bytes(pair: Pair, ids: list[np.ndarray], bounds: list[np.ndarray], whole: list[bytes]) -> np.ndarray:
    """Whether the tokens of both sides join to each text's bytes."""
    want, lengths = np.frombuffer(b"".join(whole), np.uint8), np.array([len(x) for x in whole], np.int64)
    good = np.ones(len(whole), bool)
    for x, bound, size, flat in zip(ids, bounds, (pair.size_a, pair.size_b), (pair.flat_a, pair.flat_b), strict=True):
        total = np.append(0, np.cumsum(size[x]))[bound]
        good &= np.diff(total) == lengths
        first = np.cumsum(size) - size
        if good.all():
            differ = np.flatnonzero(_gathered(flat, first[x], size[x]) != want)
            good[np.searchsorted(np.cumsum(lengths), differ, "right")] = False
        else:
            at = np.cumsum(lengths) - lengths
            for i in np.flatnonzero(good):
                own = x[bound[i] : bound[i + 1]]
                good[i] = np.array_equal(_gathered(flat, first[own], size[own]), want[at[i] : at[i] + lengths[i]])
    return good


@functools.cache
def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of all numbers below n, seven bytes each, and how many digits each has."""
    table, size = np.zeros((n, 7), np.uint8), np.zeros(n, np.int64)
    for i in range(n):
        digits = b"%d" % i
        table[i, : len(digits)] = np.frombuffer(digits, np.uint8)
        size[i] = len(digits)
    return table, size


def _listing(ids: list[np.ndarray], group: list[np.ndarray], kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """`a1,a2|b1;a3|b2;` of all groups as bytes, and how many bytes each group takes."""
    number = np.concatenate(ids).astype(np.int64)
    side = np.repeat([0, 1], [len(x) for x in ids])
    key = 2 * np.concatenate(group) + side
    order = np.argsort(key, kind="stable")
    key, number = key[order], number[order]
    last = np.append(key[1:] != key[:-1], True)
    table, size = _digits(kinds)
    cells = table[number]
    length = size[number] + 1
    cells[np.arange(len(number)), length - 1] = np.where(~last, ord(","), np.where(key % 2 == 0, ord("|"), ord(";")))
    text = cells[np.arange(7) < length[:, None]]
    return text, np.bincount(key // 2, weights=length).astype(np.int64) if len(key) else np.zeros(0, np.int64)


class Numbers:
    """Numbers of id pairs in the order in which a task meets them, and how often each occurs."""

    def __init__(self):
        self.codes, self.at, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def of(self, codes: np.ndarray, times: np.ndarray) -> np.ndarray:
        """The numbers of distinct sorted pairs, which occur so often."""
        place = find(self.codes, codes)
        new = place < 0
        number = np.empty(len(codes), np.int64)
        number[~new] = self.at[place[~new]]
        number[new] = len(self.codes) + np.arange(new.sum())
        if new.any():
            both = np.concatenate([self.codes, codes[new]])
            by = np.argsort(both, kind="stable")
            self.codes, self.at = both[by], np.concatenate([self.at, number[new]])[by]
            self.count = np.append(self.count, np.zeros(int(new.sum()), np.int64))
        self.count[number] += times
        return number


def _steps(number: np.ndarray, times: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending numbers as steps of two bytes, and their times as bytes; larger ones are split over several entries."""
    step, rest = np.diff(number, prepend=0), times
    extra = np.maximum(step // 65_535, (rest - 1) // 255)
    if extra.any():
        steps, counts = [], []
        for s, t in zip(step.tolist(), rest.tolist(), strict=True):
            while s > 65_535:
                steps.append(65_535), counts.append(0)
                s -= 65_535
            while t > 255:
                steps.append(s), counts.append(255)
                s, t = 0, t - 255
            steps.append(s), counts.append(t)
        step, rest = np.array(steps), np.array(counts)
    return step.astype("<u2").tobytes(), rest.astype(np.uint8).tobytes()


FIELDS = "n_a long, n_b long, n_groups long, n_links long"
NAMES = ["n_a", "n_b", "n_groups", "n_links"]


def _block(whole: list[str], pair: Pair, update) -> list[tuple | None]:
    """Per text, which begins with its space: the numbers of NAMES, its groups as bytes, its pair numbers and their times.

    `update` gets the distinct pairs of the block and their times, and gives their numbers. A text without tokens gives None.
    """
    raw = [t.encode("utf-8") for t in whole]
    found = pair.ids(whole)
    ids, bounds = [x for x, _ in found], [x for _, x in found]
    good = _same_bytes(pair, ids, bounds, raw) & np.array([len(x) > 0 for x in raw])
    if not good.all():  # the others leave the line
        for s in (0, 1):
            size = np.diff(bounds[s])
            ids[s] = ids[s][np.repeat(good, size)]
            bounds[s] = np.append(0, np.cumsum(np.where(good, size, 0)))
    line = np.append(0, np.cumsum(np.where(good, [len(x) for x in raw], 0)))
    ends = [np.cumsum(size[x]) for size, x in zip((pair.size_a, pair.size_b), ids, strict=True)]
    a, b, cuts = lockstep(ends[0], ends[1], line[np.append(True, np.diff(line) > 0)])
    n_groups = np.diff(np.append(0, np.searchsorted(cuts, line[1:], "right")))
    doc_of = np.searchsorted(line[1:], ends[0][a] if len(a) else a, "left")
    n_links = np.bincount(doc_of, minlength=len(whole))
    listing, taken = _listing(ids, [np.searchsorted(cuts, e) for e in ends], max(len(pair.size_a), len(pair.size_b)))
    text_at = np.append(0, np.cumsum(taken))[np.append(0, np.cumsum(n_groups))]
    codes, inverse, times = np.unique((ids[0][a].astype(np.int64) << 32) | ids[1][b].astype(np.int64), return_inverse=True, return_counts=True)
    held, count = np.unique((doc_of << 40) | update(codes, times)[inverse], return_counts=True)
    at = np.searchsorted(held, np.arange(len(whole) + 1, dtype=np.int64) << 40)
    numbers, out = held & ((1 << 40) - 1), []
    for i in range(len(whole)):
        counted = np.array([*(bounds[s][i + 1] - bounds[s][i] for s in (0, 1)), n_groups[i], n_links[i]])
        own = slice(at[i], at[i + 1])
        out.append((counted, listing[text_at[i] : text_at[i + 1]][:-1].tobytes(), numbers[own], count[own]) if good[i] else None)
    return out


def _long(whole: str, pair: Pair, update) -> tuple | None:
    """The same of a very long text, in pieces cut where tokens of both end."""
    pieces = list(safe_pieces(whole, BLOCK))
    for piece in pieces:
        found = pair.ids([piece])
        if not _same_bytes(pair, [x for x, _ in found], [x for _, x in found], [piece.encode("utf-8")]).all():
            return None
    parts = [_block([piece], pair, update)[0] for piece in pieces]
    numbers, inverse = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
    times = np.bincount(inverse, weights=np.concatenate([p[3] for p in parts])).astype(np.int64)
    return sum(p[0] for p in parts), b";".join(p[1] for p in parts), numbers, times


def _aligned(texts: list[str], pair: Pair, group_text: bool, update) -> list[tuple]:
    """Per text: the numbers of NAMES, the digest, the groups if asked for, and its pair numbers with their times."""
    out: list[tuple] = []
    for first, last in grouped(texts, BLOCK):
        whole = [(" " + t) if t else "" for t in texts[first:last]]
        for found in _block(whole, pair, update) if len(whole) > 1 or len(whole[0]) <= BLOCK else [_long(whole[0], pair, update)]:
            if found is None:
                out.append((0, 0, 0, 0, "", None, b"", b""))
            else:
                counted, listing, numbers, times = found
                out.append((*counted.tolist(), hashlib.sha256(listing).hexdigest(), listing.decode() if group_text else None, *_steps(numbers, times)))
    return out


def _walk(batches, path_a: str, path_b: str, key: str, group_text: bool) -> Iterator[pa.RecordBatch]:
    """Rows of documents, and after some of them the numbered pairs that they use, all under one number of their set."""
    pair, part, numbers, held, part_of = worker_pair(path_a, path_b), TaskContext.get().partitionId(), Numbers(), 0, 0

    def rows(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        names = [key, "book", *NAMES, "groups_sha256", "groups", "steps", "times", "codes", "counts"]
        kinds = [kind, pa.int64(), *[pa.int64()] * 4, pa.string(), pa.string(), *[pa.binary()] * 4]
        arrays = [columns.get(c, pa.nulls(n, k)) for c, k in zip(names, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(arrays, kinds, strict=True)], names=names)

    def book() -> pa.RecordBatch:
        codes = np.empty(len(numbers.codes), np.int64)
        codes[numbers.at] = numbers.codes
        return rows(book=[part << 20 | part_of], codes=[codes.tobytes()], counts=[numbers.count.tobytes()])

    kind = pa.int64()
    for batch, texts in (x for whole in batches for x in text_slices(whole, 1)):
        kind = batch.column(0).type
        found = _aligned(texts, pair, group_text, numbers.of)
        columns = list(zip(*found, strict=True))
        yield rows(**{key: batch.column(0), "book": [part << 20 | part_of] * len(found)}, **dict(zip([*NAMES, "groups_sha256", "groups", "steps", "times"], columns, strict=True)))
        held += sum(ROW + len(groups or "") + len(x) + len(y) for *_, groups, x, y in found)
        if len(numbers.codes) > NUMBERED or held > HELD:
            yield book()
            numbers, held, part_of = Numbers(), 0, part_of + 1
    if len(numbers.codes):
        yield book()


def _exploded(batches) -> Iterator[pa.RecordBatch]:
    """(book, number, pair, n) of the numbered pairs of each book."""
    for batch in batches:
        for book, codes, counts in zip(*(batch.column(i) for i in range(3)), strict=True):
            pair, n = (np.frombuffer(x.as_buffer(), np.int64) for x in (codes, counts))
            for first in range(0, len(pair), 65_536):
                some = slice(first, first + 65_536)
                size = len(pair[some])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, book.as_py())), pa.array(np.arange(first, first + size, dtype=np.int32)), pa.array(pair[some]), pa.array(n[some])], names=["book", "number", "pair", "n"])


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id", groups: bool = False) -> DataFrame:
    """Per document: its key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, if asked for, the groups."""
    rows = docs.select(F.col(key), F.col(text).alias("t"))
    kind = dict(rows.dtypes)[key]
    schema = f"`{key}` {kind}, book long, {FIELDS}, groups_sha256 string, groups string, steps binary, times binary, codes binary, counts binary"
    walked = materialize(rows.mapInArrow(lambda batches: _walk(batches, path_a, path_b, key, groups), schema), "aligned")
    numbered = walked.where("codes is not null").select("book", "codes", "counts").mapInArrow(_exploded, "book long, number int, pair long, n long")
    total = materialize(numbered.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    most = total.groupBy(F.expr("pair & 4294967295").alias("b")).agg(F.max("n").alias("most"))
    judged = total.withColumn("b", F.expr("pair & 4294967295")).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    answers = numbered.select("book", "number", "pair").join(judged, "pair").select("book", "number", "n", "best")
    plain = [key, *NAMES, "groups_sha256", *["groups"] * groups]

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        """The documents of a book with the totals of its numbers."""
        order = right.column("number").to_numpy()
        n, best = np.zeros(len(order), np.int64), np.zeros(len(order), bool)
        n[order], best[order] = right.column("n").to_numpy(), right.column("best").to_numpy()
        sums, bests = [], []
        for steps, times in zip(left.column("steps").combine_chunks(), left.column("times").combine_chunks(), strict=True):
            number = np.cumsum(np.frombuffer(steps.as_buffer(), "<u2"), dtype=np.int64)
            often = np.frombuffer(times.as_buffer(), np.uint8).astype(np.int64)
            number = number[often > 0]
            often = often[often > 0]
            sums.append(int(n[number] @ often))
            bests.append(int(best[number] @ often))
        return left.select(plain).append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))

    out = f"`{key}` {kind}, {FIELDS}, groups_sha256 string{', groups string' * groups}, n_best long, count_sum long"
    texts = walked.where("codes is null").select(*plain, "book", "steps", "times")
    return texts.groupBy("book").cogroup(answers.groupBy("book")).applyInArrow(summed, out)
