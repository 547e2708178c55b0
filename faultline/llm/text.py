"""Vectorised word scanning over Arrow text columns (used inside tasks).

A text column is one byte buffer plus offsets, so words of a whole batch are
found with array operations and no Python string is made.  Words are identified
by a 64-bit fingerprint: with V distinct words the expected number of colliding
pairs is about V^2 / 2^65.
"""
from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa


def process_cache() -> dict:
    """A dictionary that lives as long as the Python process.

    Tasks get this package's functions by value, with module variables of their own,
    so what should outlast a task can't be one."""
    return sys.modules.setdefault("_faultline_process_cache", types.ModuleType("_faultline_process_cache")).__dict__


# Byte classes. Bytes from 0x80 on (parts of non-ASCII letters) always belong to words.
_ALL = np.arange(256)
ALNUM = ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x41) & (_ALL <= 0x5A)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80)
NOT_SPACE = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))
FOLD = np.where((_ALL >= 0x41) & (_ALL <= 0x5A), _ALL + 32, _ALL).astype(np.uint8)

_BYTE_CODE = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64)[FOLD]
_BASE = 0x9E3779B97F4A7C15
_SEGMENT = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection), so that any bit range of the result can serve as a hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    powers = process_cache().get("powers")
    if powers is None or len(powers[0]) < n:
        powers = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(max(n, _SEGMENT), b, dtype=np.uint64)
            p[0] = 1
            powers.append(np.cumprod(p))
        process_cache()["powers"] = powers
    return powers


def fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprint of data[start:end], A-Z folded, for ascending non-overlapping ranges.

    Prefix sums of byte_code * base^position give every range's polynomial; the
    inverse power moves it to position 0.  Works segment by segment."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        first = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, first + _SEGMENT, "right")))
        seg = _BYTE_CODE[data[first:int(ends[j - 1])]]
        power, inverse = _powers(len(seg) + 1)
        seg *= power[: len(seg)]
        sums = np.zeros(len(seg) + 1, dtype=np.uint64)
        np.cumsum(seg, out=sums[1:])
        lo, hi = starts[i:j] - first, ends[i:j] - first
        out[i:j] = (sums[hi] - sums[lo]) * inverse[lo]
        i = j
    return mix(out)


class Words(NamedTuple):
    """Words of some documents in order: byte ranges in the buffer, fingerprints,
    and per document the index of its first word (n + 1 entries)."""
    start: np.ndarray
    end: np.ndarray
    code: np.ndarray
    first: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null reads as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)), at


def groups(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``limit`` bytes (a longer document is alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j
        i = j


def edges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``inside`` that don't cross a document border."""
    n = len(inside)
    opens, closes = inside.copy(), inside.copy()
    if n:
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        full = offsets[1:] > offsets[:-1]
        a, z = offsets[:-1][full], offsets[1:][full] - 1
        opens[a] = inside[a]
        closes[z] = inside[z]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = ALNUM) -> Words:
    """Words of documents data[offsets[i]:offsets[i+1]]; ranges are relative to offsets[0]."""
    part = data[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    start, end = edges(is_word[part], offsets)
    return Words(start, end, fingerprints(part, start, end), np.searchsorted(start, offsets))


def code_points(data: np.ndarray) -> np.ndarray:
    """For each byte position the number of code points that begin before it (n + 1 entries)."""
    out = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def list_column(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    """List array of consecutive runs of ``values`` with the given sizes."""
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
