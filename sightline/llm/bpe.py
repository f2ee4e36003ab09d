"""Byte-level BPE with the tiktoken library and a local rank file.

Texts are encoded without special tokens. A long text is first cut at safe boundaries, places where no match of
the splitting pattern can span: before a single space between two characters that are no white space. Long runs of
white space are cut out too, as they are matches of their own. Decoding
joins the raw bytes of the ids, so ids that end inside a character lose nothing.

Defined results: a null text is encoded as the empty text: no ids. Code points that UTF-8 cannot hold (lone
surrogates) become the replacement character. Decoding null gives null, an id without a rank fails the job.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sightline.llm.blocks import BLOCK, with_columns

_SAFE = re.compile(r"(?<=\S) (?=\S)")
_RUN = 4096  # white space from which a run is cut out, as the library's pattern fails on runs of a million
_BLANK = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def safe_pieces(text: str, size: int = BLOCK) -> Iterator[str]:
    """Pieces of at least `size` code points (the last may be shorter), cut where no pattern match can span."""
    first = 0
    while len(text) - first > size:
        found = _SAFE.search(text, first + size)
        if not found:
            break
        yield text[first : found.start()]
        first = found.start()
    yield text[first:]


@functools.cache
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file: lines of a base64 token and its rank. Nothing is cached on disk."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode_text(enc: tiktoken.Encoding, text: str) -> list[int]:
    """The ids of a text. A long run of white space is one match of the pattern, which the library's call for single
    matches encodes: the whole run at the end of the text, else all but its last character, which may join what follows."""
    if len(text) <= _RUN:
        return enc.encode_ordinary(text)
    ids, first = [], 0
    for run in re.finditer(f"{_BLANK}{{{_RUN},}}", text):
        last = run.end() - (run.end() < len(text))
        ids += _encode_plain(enc, text[first : run.start()])
        ids += enc._encode_single_piece(text[run.start() : last])
        first = last
    return ids + _encode_plain(enc, text[first:])


def _encode_plain(enc: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= BLOCK:
        return enc.encode_ordinary(text)
    return [x for piece in safe_pieces(text) for x in enc.encode_ordinary(piece)]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """The rows with `ids`."""
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    return with_columns(docs, text, fields, lambda: lambda texts: [[encode_text(encoding(path, pattern), t or "") for t in texts]])


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """The rows with `bytes`, the raw bytes of the ids."""
    fields = [T.StructField("bytes", T.BinaryType())]
    return with_columns(docs, ids, fields, lambda: lambda rows: [[None if x is None else encoding(path, pattern).decode_bytes(x) for x in rows]])


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """The rows with the number of ids, the SHA-256 of the ids (little-endian, 32 bits) and that of their decoded bytes."""

    def make():
        enc = encoding(path, pattern)

        def work(texts):
            rows = []
            for t in texts:
                ids = encode_text(enc, t or "")
                rows.append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(enc.decode_bytes(ids)).hexdigest()))
            return list(zip(*rows, strict=True)) if rows else [[], [], []]

        return work

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return with_columns(docs, text, fields, make)
