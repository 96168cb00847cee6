"""Hashed character n-grams of whole rows, on numpy arrays."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

from adlens.llm.common import text_bytes

BITS = 16
NONE = 1 << BITS  # the bucket of what isn't counted
#: Below this code point letters are folded; beyond, they are taken as they are.
FOLDED = 0x600


@cache
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


@cache
def folded() -> np.ndarray:
    return np.array([ord(x) if len(x := chr(i).lower()) == 1 else i for i in range(FOLDED)], np.uint32)


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The rows' code points one after another, and each row's start with the end last; bytes that aren't UTF-8 are U+FFFD."""
    data, off = text_bytes(column)
    try:
        text = data.tobytes().decode("utf-8")
    except UnicodeDecodeError:
        rows = [data[i:j].tobytes().decode("utf-8", "replace") for i, j in zip(off[:-1], off[1:], strict=True)]
        text, first = "".join(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    else:
        first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[off]
    return np.frombuffer(text.encode("utf-32-le"), np.uint32), first


def buckets(points: np.ndarray, off: np.ndarray, n: int, blank: int | None = None) -> np.ndarray:
    """The bucket of the n-gram that starts at each code point; NONE where it would leave its row or holds only `blank`."""
    if len(points) < n:
        return np.full(len(points), NONE, np.int32)
    h = np.full(len(points) - n + 1, n, np.uint32)
    for k in range(n):
        h = (h ^ points[k : len(points) - n + 1 + k]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    out = np.full(len(points), NONE, np.int32)
    out[: len(h)] = (h >> np.uint32(32 - BITS)).astype(np.int32)
    for k in range(1, n):
        at = off[1:] - k
        out[at[at >= off[:-1]]] = NONE
    if blank is not None:
        only = points == blank
        for k in range(1, n):
            only[:-k] &= points[k:] == blank
        out[only] = NONE
    return out


def sums_by_row(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The sums of `values` over each row's stretch, zero for rows without any."""
    out = np.zeros((len(off) - 1, *values.shape[1:]), np.float64)
    full = np.diff(off) > 0
    if full.any():
        out[full] = np.add.reduceat(values, off[:-1][full], axis=0, dtype=np.float64)
    return out
