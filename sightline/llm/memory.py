"""Ids of the distinct pieces of texts, remembered between blocks, so that a tokenizer sees each piece once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sightline.llm.blocks import code_points, find, span_hashes

GAP = 0x110000  # stands between texts, where no code point can
KEPT = 250_000  # pieces that a worker remembers: about 20 MB with their ids and the copies while merging
_WHITE = np.zeros(GAP + 1, bool)
_WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, GAP]] = True


def _merged(a: tuple, b: tuple) -> tuple:
    both = [np.concatenate(x) for x in zip(a, b, strict=True)]
    by = np.argsort(both[0], kind="stable")
    return tuple(x[by] for x in both)


class Memory:
    """The ids of pieces, in flat arrays of bounded size: `store[start : start + size]` for each piece.

    `encode` gives the ids of every piece of a list. When `kept` pieces are exceeded, all are forgotten.
    """

    def __init__(self, encode: Callable[[list[str]], list], kept: int = KEPT):
        self.encode, self.kept = encode, kept
        self.forget()

    def forget(self) -> None:
        # sorted hashes with the place and number of their ids: one large table, and one of recent pieces
        self.tables = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(2)]
        self.store, self.used = np.zeros(1 << 16, np.uint32), 0

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        got = self.encode(texts)
        size = np.fromiter(map(len, got), np.int64, len(got))
        more = int(size.sum())
        if self.used + more > len(self.store):
            self.store = np.append(self.store[: self.used], np.zeros(self.used // 2 + 2 * more, np.uint32))
        self.store[self.used : self.used + more] = np.fromiter(chain.from_iterable(got), np.uint32, more)
        new = hashes, self.used + np.cumsum(size) - size, size
        self.used += more
        old, recent = self.tables
        recent = _merged(recent, new)
        if 8 * len(recent[0]) > len(old[0]) + 50_000:
            old, recent = _merged(old, recent), tuple(x[:0] for x in recent)
        self.tables = [old, recent]

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start, size = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for known, where, count in self.tables:
            at = find(known, hashes)
            hit = at >= 0
            start[hit], size[hit] = where[at[hit]], count[at[hit]]
        return start, size

    def of(self, joined: str, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the store and number of ids of distinct pieces of a text."""
        if sum(len(t[0]) for t in self.tables) > self.kept or self.used > 8 * self.kept:
            self.forget()
        start, size = self._places(hashes)
        new = np.flatnonzero(start < 0)
        if len(new):
            self._learn(hashes[new], [joined[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            start[new], size[new] = self._places(hashes[new])
        return start, size

    def flat(self, place: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The ids at the given places, in order."""
        return self.store[np.repeat(place - (np.cumsum(size) - size), size) + np.arange(size.sum())]


class Spans:
    """Texts as one array of code points, cut into pieces, the equal ones found.

    `split` marks where pieces begin in an array of code points in which gaps stand between texts. Pieces that begin with
    one of `skip` are left out. `lower` makes A-Z lower-case, but not before a combining mark.
    """

    def __init__(self, texts: list[str], split: Callable[[np.ndarray], np.ndarray], skip: str = "", lower: bool = False):
        self.joined = "\x00".join(texts)
        lengths = np.array([len(t) for t in texts], np.int64)
        self.units = code_points(self.joined).copy()
        if lower:
            large = (self.units - np.uint32(0x41)) < 26
            large[:-1] &= self.units[1:] < 0x300
            self.units[large] += 32
            self.joined = self.units.tobytes().decode("utf-32-le", "surrogatepass")
        self.units[(np.cumsum(lengths + 1) - 1)[:-1]] = GAP
        self.firsts = np.cumsum(lengths + 1) - lengths - 1
        starts = np.flatnonzero(split(self.units))
        ends = np.append(starts[1:], len(self.units))
        real = ~np.isin(self.units[starts], [GAP, *map(ord, skip)])
        self.starts, self.ends = starts[real], ends[real]
        hashes = span_hashes(self.units, self.starts, self.ends)
        self.hashes, self.one, self.number = np.unique(hashes, return_index=True, return_inverse=True)

    def ids(self, memory: Memory) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and where those of each text begin and end."""
        place, size = memory.of(self.joined, self.hashes, self.starts[self.one], self.ends[self.one])
        count = size[self.number]
        ends = np.append(0, np.cumsum(count))
        return memory.flat(place[self.number], count), ends[np.searchsorted(self.starts, np.append(self.firsts, len(self.units)))]


def word_starts(units: np.ndarray) -> np.ndarray:
    """Where words begin: at a single space between two characters that are no white space, and after gaps.

    No piece of a byte-level or sentence-piece vocabulary spans such a place.
    """
    white = _WHITE[units]
    gap = units == GAP
    start = gap.copy()
    start[:1] = True
    start[1:] |= gap[:-1]
    if len(units) > 2:
        start[1:-1] |= (units[1:-1] == 0x20) & ~white[:-2] & ~white[2:]
    return start


def text_slices(batch: pa.RecordBatch, column: int, rows: int = 512, size: int = 1 << 22) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with their texts (null as empty), so that only few texts are Python objects at once."""
    sizes = np.array(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    first, held = 0, 0
    for i in range(len(batch) + 1):
        if i == len(batch) or i - first >= rows or (held and held + sizes[i] > size):
            if i > first:
                part = batch.slice(first, i - first)
                yield part, [t or "" for t in part.column(column).to_pylist()]
            first, held = i, 0
        if i < len(batch):
            held += sizes[i]
