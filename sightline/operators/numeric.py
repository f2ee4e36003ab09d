"""Small numpy helpers that run inside tasks on one Arrow batch at a time."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa


def to_matrix(vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column as a matrix, and which rows are whole vectors of that width.

    Rows that are NULL, of another width, or hold a NULL element come out as zeros and unusable.
    """
    values = vectors.flatten()
    lengths = np.asarray(vectors.value_lengths().fill_null(-1))
    usable = lengths == width
    if usable.all() and values.null_count == 0:
        return values.to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64), usable
    out = np.zeros((len(vectors), width))
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)
    missing = values.is_null().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])
    for row in np.flatnonzero(usable):
        part = slice(starts[row], starts[row + 1])
        if missing[part].any():
            usable[row] = False
        else:
            out[row] = flat[part]
    return out, usable


def unit_rows(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows at unit length, and which rows have a length at all; zero rows stay zero."""
    norms = np.sqrt((matrix * matrix).sum(axis=1))
    has_norm = norms > 0
    return matrix / np.where(has_norm, norms, 1.0)[:, None], has_norm


def to_lists(matrix: np.ndarray, usable: np.ndarray, kind: pa.DataType, missing: float | None = None) -> pa.Array:
    """Matrix rows as a list column; unusable rows and cells equal to ``missing`` are NULL."""
    widths = np.where(usable, matrix.shape[1], 0)
    offsets = np.concatenate([[0], np.cumsum(widths)]).astype(np.int32)
    cells = np.ascontiguousarray(matrix[usable]).ravel()
    values = pa.array(cells, type=kind, mask=None if missing is None else cells == missing)
    mask = pa.array(~usable)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=mask)


SLICE_CELLS = 4 << 20  # similarities held at once: 32 MB


def best_prompt_scores(unit: np.ndarray, prompts: np.ndarray, owner: np.ndarray, categories: int) -> np.ndarray:
    """[rows, categories] best similarity of each row to any prompt of each category.

    ``owner`` gives each prompt's category in ascending order.
    """
    best = np.full((len(unit), categories), -np.inf)
    firsts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    step = max(1, SLICE_CELLS // len(prompts))
    for start in range(0, len(unit), step):
        similarity = unit[start : start + step] @ prompts.T
        best[start : start + step, owner[firsts]] = np.maximum.reduceat(similarity, firsts, axis=1)
    return best


def top_categories(unit: np.ndarray, prompts: np.ndarray, owner: np.ndarray, categories: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices and scores of the k best categories per row, a slice of rows at a time."""
    step = max(1, SLICE_CELLS // max(len(prompts), categories))
    width = min(k, categories)
    idx, top = np.empty((len(unit), width), dtype=np.int64), np.empty((len(unit), width))
    for start in range(0, len(unit), step):
        part = slice(start, start + step)
        idx[part], top[part] = stable_top_k(best_prompt_scores(unit[part], prompts, owner, categories), k)
    return idx, top


def stable_top_k(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the k best columns; equal scores (to nine places) go by index."""
    order = np.argsort(-np.round(scores, 9), axis=1, kind="stable")[:, :k]
    return order, np.take_along_axis(scores, order, axis=1)


def merged_top(idx: np.ndarray, top: np.ndarray, more_idx: np.ndarray, more_top: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of two lists per row; a category in both counts with its better score. Equal scores go by index."""
    both_idx, both_top = np.concatenate([idx, more_idx], axis=1), np.concatenate([top, more_top], axis=1)
    same = idx[:, :, None] == more_idx[:, None, :]
    worse = np.concatenate([(same & (top[:, :, None] < more_top[:, None, :])).any(axis=2), (same & (top[:, :, None] >= more_top[:, None, :])).any(axis=1)], axis=1)
    both_top = np.where(worse, -np.inf, both_top)
    width = min(k, both_idx.shape[1] - int(worse[:1].sum()))
    order = np.lexsort((both_idx, -np.round(both_top, 9)), axis=1)[:, :width]
    return np.take_along_axis(both_idx, order, axis=1), np.take_along_axis(both_top, order, axis=1)


def best_boxes(found: list, widths: np.ndarray, heights: np.ndarray, expansion: float) -> tuple[np.ndarray, np.ndarray]:
    """Padded region of the most confident box per row and whether there was one; else the whole image.

    A NaN or infinite coordinate is an error, which the caller's halving of batches pins to its row.
    """
    region = np.stack([np.zeros(len(found)), np.zeros(len(found)), widths, heights], axis=1)
    detected = np.array([len(boxes) > 0 for boxes in found], dtype=bool)
    if detected.any():
        rows = [boxes[int(np.argmax(np.nan_to_num(boxes[:, 4], nan=-np.inf)))] for boxes in found if len(boxes)]
        low, high = np.array(rows)[:, 0:2], np.array(rows)[:, 2:4]
        if not (np.isfinite(low).all() and np.isfinite(high).all()):
            raise ValueError("a box has a coordinate that is not finite")
        pad = (high - low) * expansion
        size = region[detected, 2:4]
        region[detected, 0:2] = np.maximum(0, np.trunc(low - pad))
        region[detected, 2:4] = np.minimum(size, np.trunc(high + pad))
    return np.clip(region, -(2**31), 2**31 - 1).astype(np.int32), detected


class Erf:
    """Vectorised error function: cubic Hermite interpolation of ``math.erf`` on a fine grid."""

    LIMIT, STEPS = 6.0, 4096

    def __init__(self):
        self.step = self.LIMIT / self.STEPS
        grid = np.arange(self.STEPS + 2) * self.step
        self.value = np.array([math.erf(x) for x in grid])
        self.slope = 2 / math.sqrt(math.pi) * np.exp(-grid * grid) * self.step

    def __call__(self, x: np.ndarray) -> np.ndarray:
        size = np.minimum(np.abs(x), self.LIMIT) / self.step
        cell = size.astype(np.int64)
        t = size - cell
        v0, v1, s0, s1 = self.value[cell], self.value[cell + 1], self.slope[cell], self.slope[cell + 1]
        rise = v1 - v0
        return np.sign(x) * (v0 + t * (s0 + t * (3 * rise - 2 * s0 - s1 + t * (s0 + s1 - 2 * rise))))
