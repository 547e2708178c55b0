"""Separator-normalised texts: words of a batch with one separator after each (used inside tasks)."""
from __future__ import annotations

from typing import NamedTuple

import numpy as np

from . import text as tx

BLANK, NEWLINE = 0x20, 0x0A


class Normal(NamedTuple):
    """Words of some documents, A-Z lower-cased, in one buffer.

    ``data`` begins with a newline; after each word stands a blank, or a newline after a
    document's last.  ``at``: where each word begins in it; ``start``, ``end``: its bytes in
    the original; ``first``: the first word of each document (n + 1 entries)."""
    data: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def normalised(data: np.ndarray, offsets: np.ndarray) -> Normal:
    """Words of documents data[offsets[i]:offsets[i+1]]; byte ranges are relative to offsets[0]."""
    part = tx.FOLD[data[offsets[0]:offsets[-1]]]
    offsets = offsets - offsets[0]
    start, end = tx.edges(tx.ALNUM[part], offsets)
    first = np.searchsorted(start, offsets)
    size = end - start + 1
    at = np.cumsum(size) - size + 1
    out = np.empty(int(size.sum()) + 1, dtype=np.uint8)
    out[0] = NEWLINE
    inside = np.ones(len(out), dtype=bool)
    inside[0] = False
    inside[at + size - 1] = False
    out[inside] = part[tx.ALNUM[part]]
    out[at + size - 1] = BLANK
    last = first[1:][np.diff(first) > 0] - 1
    out[at[last] + size[last] - 1] = NEWLINE
    return Normal(out, at, start, end, first)
