"""Texts as flat arrays of code points, so that per-character work runs as array operations in blocks of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

BLOCK = 1 << 19  # code points worked on at once; a longer text is cut where an operator allows it
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> list[np.ndarray]:
    """Powers of the hash base and of its inverse, for positions below n."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, BLOCK + 1), base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS


def span_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans of an array; equal spans have equal hashes wherever they lie."""
    up, down = powers(len(units) + 1)
    total = np.zeros(len(units) + 1, np.uint64)
    np.cumsum((units.astype(np.uint64) + np.uint64(1)) * up[: len(units)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.zeros(len(mask) + 2, np.int8)
    edges[1:-1] = mask
    at = np.flatnonzero(np.diff(edges))
    return at[::2], at[1::2]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grouped(texts: list[str], size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together hold about `size` code points; a longer text is alone."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield first, i
            first, held = i, 0
        held += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def cuts(text: str, size: int = BLOCK, blank: str = " \t\n\r\x0b\x0c") -> Iterator[str]:
    """Pieces of about `size` code points, each but the last ending in one of the given characters.

    Where none follows, the piece grows until one does.
    """
    first = 0
    while len(text) - first > size:
        last = max(text.rfind(c, first + size // 2, first + size) for c in blank)
        if last < 0:
            last = min((at for c in blank if (at := text.find(c, first + size)) >= 0), default=len(text) - 1)
        yield text[first : last + 1]
        first = last + 1
    yield text[first:]


def letter_table(test: Callable[[str], bool]) -> np.ndarray:
    """For every code point whether the test holds."""
    return np.fromiter((test(chr(c)) for c in range(0x110000)), bool, 0x110000)


def find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of the values in a sorted table, -1 where missing."""
    if not len(table):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)


def tidy(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """The task function, which at its end gives freed memory back to the system.

    Python workers live on between tasks and stages, and would otherwise keep the most that any of them has needed.
    """

    def run(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if trim:
            trim(0)

    return run


def with_columns(df: DataFrame, text: str, fields: list[T.StructField], make: Callable[[], Callable]) -> DataFrame:
    """The rows with computed columns, one Arrow batch at a time.

    `make` is called once per task and gives a function from a list of texts (None for null) to one
    list or array per field. Columns of the input that have a computed column's name are replaced.
    """
    kept = [f for f in df.schema.fields if f.name not in {x.name for x in fields}]
    schema, added = T.StructType([*kept, *fields]), [to_arrow_type(f.dataType) for f in fields]

    def apply(batches):
        work = make()
        for batch in batches:
            columns = work(batch.column(batch.schema.get_field_index(text)).to_pylist())
            arrays = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            arrays += [pa.array(c, t) for c, t in zip(columns, added, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields])

    return df.mapInArrow(tidy(apply), schema)
