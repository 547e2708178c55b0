"""Fill-in-the-middle training texts with a piece table.

A document is a list of descriptors (buffer, start, end) over two immutable buffers, its
text and the sentinels.  Cutting splits descriptors, an arrangement permutes the parts and
puts a sentinel descriptor before each, and digests are streamed descriptor by descriptor.
Restoring reads an output as a piece table of its own and applies the inverse permutation.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx

# The parts (0 prefix, 1 middle, 2 suffix) in the order in which each form writes them.
ARRANGEMENTS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
#: Sentinels of prefix, middle and suffix.
SENTINELS = ("<P>", "<M>", "<S>")
TEXT, MARKS = 0, 1


class Piece(NamedTuple):
    buffer: int
    start: int
    end: int


class PieceTable:
    """Bytes given as descriptors over immutable buffers; nothing is copied until it is read."""

    def __init__(self, buffers: Sequence, pieces: Iterable[Piece]):
        self.buffers = [memoryview(b) for b in buffers]
        self.pieces = list(pieces)

    @classmethod
    def of(cls, text, marks=b"") -> PieceTable:
        return cls([text, marks], [Piece(TEXT, 0, len(text))])

    def cut(self, places: Sequence[int]) -> list[list[Piece]]:
        """The descriptors between ascending places, splitting those that a place falls into."""
        parts: list[list[Piece]] = []
        rest, at = self.pieces, 0
        for place in places:
            part: list[Piece] = []
            while rest and at + rest[0].end - rest[0].start <= place:
                part.append(rest[0])
                at += rest[0].end - rest[0].start
                rest = rest[1:]
            if rest and place > at:
                buffer, start, end = rest[0]
                part.append(Piece(buffer, start, start + place - at))
                rest = [Piece(buffer, start + place - at, end), *rest[1:]]
                at = place
            parts.append(part)
        return [*parts, rest]

    def reads(self) -> Iterator[memoryview]:
        for buffer, start, end in self.pieces:
            yield self.buffers[buffer][start:end]

    def bytes(self) -> bytes:
        return b"".join(self.reads())

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for view in self.reads():
            digest.update(view)
        return digest.hexdigest()


def sentinel_buffer(sentinels: Sequence[bytes]) -> tuple[bytes, list[Piece]]:
    """All sentinels in one buffer, and a descriptor for each."""
    ends = np.cumsum([len(s) for s in sentinels]).tolist()
    return b"".join(sentinels), [Piece(MARKS, e - len(s), e) for s, e in zip(sentinels, ends, strict=True)]


def arranged(text: bytes, places: tuple[int, int], form: str, marks: bytes, mark: list[Piece]) -> PieceTable:
    """The parts of ``text`` cut at two places, each behind its sentinel, in the order of ``form``."""
    table = PieceTable.of(text, marks)
    parts = table.cut(places)
    table.pieces = [p for k in ARRANGEMENTS[form] for p in (mark[k], *parts[k])]
    return table


def rebuilt(output: bytes, form: str, sentinels: Sequence[bytes]) -> PieceTable:
    """The text of an output: its parts found between the sentinels, in their old order."""
    table = PieceTable.of(output)
    if form == "plain":
        return table
    order = ARRANGEMENTS[form]
    begins, at = [], 0
    for k in order:
        begins.append(output.index(sentinels[k], at))
        at = begins[-1] + len(sentinels[k])
    ends = [*begins[1:], len(output)]
    parts = [Piece(TEXT, b + len(sentinels[k]), e) for k, b, e in zip(order, begins, ends, strict=True)]
    inverse = sorted(range(len(order)), key=order.__getitem__)
    table.pieces = [parts[i] for i in inverse]
    return table


def unit_ends(text: np.ndarray, unit: str) -> np.ndarray:
    """Where each unit ends: a line with its newline (the last may lack it), or a code point."""
    if unit == "line":
        ends = np.flatnonzero(text == 0x0A) + 1
    else:
        ends = np.flatnonzero((text & 0xC0) != 0x80)[1:]
    return ends if len(text) == (ends[-1] if len(ends) else 0) else np.append(ends, len(text))


class Rule(NamedTuple):
    """What decides on form and cuts."""
    arranged_percent: int
    spm_percent: int
    unit: str
    sentinels: tuple[bytes, bytes, bytes]


def transformed(text: bytes, draw: str, rule: Rule, marks: bytes, mark: list[Piece]) -> tuple[int, str, int | None, int | None, PieceTable]:
    """(units, form, prefix and middle code points, output) of one text; draw: 32 hex digits."""
    view = np.frombuffer(text, dtype=np.uint8)
    ends = unit_ends(view, rule.unit)
    n = len(ends)
    h1, h2, h3, h4 = (int(draw[i:i + 8], 16) for i in range(0, 32, 8))
    if not text or any(s in text for s in rule.sentinels) or h3 % 100 >= rule.arranged_percent:
        return n, "plain", None, None, PieceTable.of(text)
    a, z = sorted(int(ends[k - 1]) if k else 0 for k in (h1 % (n + 1), h2 % (n + 1)))
    form = "spm" if h4 % 100 < rule.spm_percent else "psm"
    points = [int(np.count_nonzero((view[b:e] & 0xC0) != 0x80)) for b, e in ((0, a), (a, z))]
    return n, form, points[0], points[1], arranged(text, (a, z), form, marks, mark)


def _transform(batches: Iterable[pa.RecordBatch], text_col: str, carry: list[str], rule: Rule, output: bool, restored: bool, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    marks, mark = sentinel_buffer(rule.sentinels)
    for batch in batches:
        data, offsets = tx.utf8(batch.column(text_col))
        draws = batch.column("_draw").to_pylist()
        for i, j in tx.groups(offsets, shard_bytes):
            rows = []
            for k in range(i, j):
                n, form, prefix, middle, table = transformed(data[offsets[k]:offsets[k + 1]].tobytes(), draws[k], rule, marks, mark)
                written = table.bytes() if output or restored else None
                rows.append((n, form, prefix, middle, table.sha256(), rebuilt(written, form, rule.sentinels).sha256() if restored else None, written))
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=False)]
            names = ["n_units", "form", "prefix_chars", "middle_chars", "output_sha256"]
            if restored:
                arrays, names = [*arrays, pa.array(columns[5], pa.string())], [*names, "restored_sha256"]
            if output:
                arrays, names = [*arrays, pa.array(columns[6], pa.binary()).cast(pa.string())], [*names, "output"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(i, j - i) for c in carry], *arrays], [*carry, *names])


ADDED = ("n_units", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", "output")


def fill_in_middle(docs: DataFrame, *, seed: int = 7, arranged_percent: int = 100, spm_percent: int = 50, unit: str = "line", sentinels: Sequence[str] = SENTINELS,
                   id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, output: bool = True, restored: bool = False, shard_bytes: int = 4 << 20) -> DataFrame:
    """The ``carry`` columns of ``docs`` (all but the text unless given) with

    * n_units: lines (``unit="line"``) or code points (``"character"``) of the text
    * form: plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle)
    * prefix_chars, middle_chars: code points of these parts; null if plain
    * output_sha256 and, with ``output``, output: the text in its form
    * with ``restored``, restored_sha256: digest of the text rebuilt from output and form alone

    Cuts and form are drawn from the sha256 of ``seed:id``.  ``arranged_percent`` of the texts are
    arranged, ``spm_percent`` of those as spm.  A text is plain if it is empty or holds a sentinel,
    so that every output can be read back.  A null text is empty; a null id draws as the empty
    string; rows with one id draw alike; repeated rows stay.  A part may be empty.  Columns named
    like an added one are left out.  No shuffle; a task holds a batch of texts and outputs of about
    ``shard_bytes`` (or of one longer text).
    """
    marks = tuple(s.encode() for s in sentinels)
    if len({*marks, b""}) != 4 or any(s[0:1] in s[1:] or a != s and (a in s) for s in marks for a in marks):
        raise ValueError("sentinels must differ, hold none of the others, and their first character once")
    carry = [c for c in docs.columns if c not in (text_col, *ADDED)] if carry is None else carry
    rule = Rule(arranged_percent, spm_percent, unit, marks)
    draw = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256), 1, 32)
    fields = [T.StructField("n_units", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
              T.StructField("middle_chars", T.LongType()), T.StructField("output_sha256", T.StringType())]
    fields += [T.StructField("restored_sha256", T.StringType())] * restored + [T.StructField("output", T.StringType())] * output
    return docs.select(*dict.fromkeys([*carry, text_col]), draw.alias("_draw")).mapInArrow(
        lambda it: _transform(it, text_col, carry, rule, output, restored, shard_bytes), T.StructType([docs.schema[c] for c in carry] + fields))


def _restore(batches: Iterable[pa.RecordBatch], sentinels: tuple) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [rebuilt((o or "").encode(), f or "plain", sentinels).bytes() for o, f in zip(batch.column("output").to_pylist(), batch.column("form").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], [*batch.schema.names, "restored"])


def restore(arranged_docs: DataFrame, *, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """``arranged_docs`` with restored, the text rebuilt from its columns output and form (a null form is plain)."""
    marks, rows = tuple(s.encode() for s in sentinels), arranged_docs.drop("restored")
    return rows.mapInArrow(lambda it: _restore(it, marks), T.StructType(rows.schema.fields + [T.StructField("restored", T.StringType())]))
