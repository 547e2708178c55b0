"""License notices, found with a few edits.

Texts are normalised to lower-case words with one blank between.  A notice that may have
k edits is split into k + 1 seeds: whatever k edits do, one seed stays whole (pigeonhole).
An Aho-Corasick automaton finds the seeds of all notices in one pass; each one
fixes a small place in which the notice must lie, and there the regex library's
bounded-error matching finds the best match, its edits and its span.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx
from .normal import BLANK, NEWLINE, normalised

# Notices (their words, lower-cased) and labels.
BASE_NOTICES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
MORE_NOTICES = (
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("boost software license", "bsl"),
    ("bsd license", "bsd"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("creative commons attribution", "cc-by"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nc", "cc-by-nc"),
    ("cc by nd", "cc-by-nd"),
    ("cc0 1 0 universal", "cc0"),
)
NOTICES = BASE_NOTICES + MORE_NOTICES


class Notice(NamedTuple):
    text: bytes
    label: str
    edits: int
    pattern: object


class Found(NamedTuple):
    """A notice at data[begin:end] of the normalised text."""
    notice: int
    begin: int
    end: int
    edits: int


class Notices:
    """The seeds of some notices in one automaton, and a bounded-error pattern for each."""

    def __init__(self, notices: Sequence[tuple[str, str]], letters_per_edit: int, most_edits: int):
        self.notices: list[Notice] = []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, (words, label) in enumerate(notices):
            text = words.encode()
            edits = min(most_edits, len(text) // letters_per_edit)
            pattern = regex.compile(rb"(?b)(?<=[ \n])(?:%s){e<=%d:[^\n]}(?=[ \n])" % (regex.escape(text, literal_spaces=True), edits)) if edits else None
            self.notices.append(Notice(text, label, edits, pattern))
            borders = [len(text) * i // (edits + 1) for i in range(edits + 2)]
            for a, z in zip(borders[:-1], borders[1:], strict=True):
                seeds.setdefault(text[a:z].decode("latin-1"), []).append((k, z))
        self.automaton = ahocorasick.Automaton()
        for seed, where in seeds.items():
            self.automaton.add_word(seed, where)
        self.automaton.make_automaton()

    def candidates(self, data: bytes) -> set[tuple[int, int]]:
        """(notice, where it begins if nothing before the seed was edited) of every seed."""
        return {(k, last + 1 - z) for last, where in self.automaton.iter(data.decode("latin-1")) for k, z in where}

    def verified(self, data: bytes, notice: int, at: int) -> Found | None:
        """The best match around a candidate.  A place that equals the notice has no edits to verify."""
        text, _, edits, pattern = self.notices[notice]
        end = at + len(text)
        if at > 0 and data.startswith(text, at) and data[at - 1] in (BLANK, NEWLINE) and data[end] in (BLANK, NEWLINE):
            return Found(notice, at, end, 0)
        if pattern is None:
            return None
        low = max(0, at - edits - 1)
        match = pattern.search(data[low:end + edits + 1])
        return Found(notice, low + match.start(), low + match.end(), sum(match.fuzzy_counts)) if match and match.end() > match.start() else None

    def find(self, data: bytes) -> list[Found]:
        """All places of all notices by place: each exact one, and of overlapping ones of one notice else the best."""
        kept: dict[int, list[Found]] = {}
        found = {self.verified(data, k, at) for k, at in self.candidates(data)} - {None}
        for f in sorted(found, key=lambda f: (f.begin, f.end)):
            own = kept.setdefault(f.notice, [])
            while own and f is not None and own[-1].end > f.begin and (own[-1].edits or f.edits):
                if own[-1].edits > f.edits:
                    own.pop()
                else:
                    f = None
            if f is not None:
                own.append(f)
        return sorted((f for own in kept.values() for f in own), key=lambda f: (f.begin, f.notice))


SPAN = T.StructType([T.StructField("label", T.StringType()), T.StructField("notice", T.StringType()), T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()),
                     T.StructField("first_word", T.LongType()), T.StructField("edits", T.IntegerType())])


def _scan(batches: Iterable[pa.RecordBatch], notices: Sequence[tuple[str, str]], letters_per_edit: int, most_edits: int, text_col: str, carry: list[str], shard_bytes: int) -> Iterator[pa.RecordBatch]:
    search = Notices(notices, letters_per_edit, most_edits)
    for batch in batches:
        data, offsets = tx.utf8(batch.column(text_col))
        for i, j in tx.groups(offsets, shard_bytes):
            normal = normalised(data, offsets[i:j + 1])
            found = search.find(normal.data.tobytes())
            first = np.searchsorted(normal.at, [f.begin for f in found], "right") - 1
            last = np.searchsorted(normal.at, [f.end - 1 for f in found], "right") - 1
            doc = np.searchsorted(normal.first, first, "right") - 1
            points = tx.code_points(data[offsets[i]:offsets[j]]) if found else np.zeros(1, dtype=np.int64)
            origin = points[(offsets[i:j] - offsets[i])[doc]] if found else np.zeros(0, dtype=np.int64)
            spans = pa.StructArray.from_arrays(
                [pa.array([search.notices[f.notice].label for f in found], pa.string()), pa.array([search.notices[f.notice].text.decode() for f in found], pa.string()),
                 pa.array(points[normal.start[first]] - origin if found else origin, pa.int64()), pa.array(points[normal.end[last]] - origin if found else origin, pa.int64()),
                 pa.array(first - normal.first[doc] if found else origin, pa.int64()), pa.array([f.edits for f in found], pa.int32())], SPAN.names)
            yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(i, j - i) for c in carry], pa.array(np.diff(normal.first), pa.int64()),
                                              tx.list_column(spans, np.bincount(doc, minlength=j - i))], [*carry, "n_words", "notices"])


def find_notices(docs: DataFrame, notices: Sequence[tuple[str, str]] = NOTICES, *, letters_per_edit: int = 10, most_edits: int = 3, text_col: str = "text",
                 carry: list[str] | None = None, shard_bytes: int = 4 << 20) -> DataFrame:
    """The ``carry`` columns of ``docs`` (all columns unless given) with

    * n_words: words, runs of ASCII letters and digits and of non-ASCII characters
    * notices: the notices in the text by place: label, notice, begin and end (code points of
      the text, end exclusive), first_word (from 0) and edits

    A notice may have one edit (a byte of the normalised text inserted, lost or replaced) for
    every ``letters_per_edit`` bytes, at most ``most_edits``; shorter ones are found exactly.  It
    begins and ends with a word.  Every exact place is reported; of places of one notice that
    overlap with edits, the one with the fewest edits (the first of equals).  A null or empty
    text has no words; repeated rows stay; input columns named like an added one are left out.
    ``notices`` must be words as defined here, lower-cased, one blank between, none twice.  No shuffle;
    a task holds a batch of texts, and shards of about ``shard_bytes`` (or of one longer text).
    """
    if any(not w or " ".join(regex.findall(r"[0-9a-z]+|[^\x00-\x7F]+", w)) != w for w, _ in notices) or len({w for w, _ in notices}) != len(notices):
        raise ValueError("notices are lower-case words with one blank between, none twice")
    carry = [c for c in docs.columns if c not in ("n_words", "notices")] if carry is None else carry
    notices = [tuple(n) for n in notices]
    return docs.select(*dict.fromkeys([*carry, text_col])).mapInArrow(
        lambda it: _scan(it, notices, letters_per_edit, most_edits, text_col, carry, shard_bytes),
        T.StructType([docs.schema[c] for c in carry] + [T.StructField("n_words", T.LongType()), T.StructField("notices", T.ArrayType(SPAN))]))


def labels(spans: Column) -> Column:
    """Distinct labels of spans, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")


def summary(found: DataFrame, base: Sequence[tuple[str, str]] = BASE_NOTICES, *, id_col: str = "doc_id") -> DataFrame:
    """Per row: the exact places of the base notices, all labels, and score: the best match's share of
    the notice that is unedited (0 without notices)."""
    exact = F.filter("notices", lambda s: (s["edits"] == 0) & s["notice"].isin([w for w, _ in base]))
    start = F.transform("_base", lambda s: s["first_word"])
    spans = F.array_join(F.transform("notices", lambda s: F.concat_ws(":", s["label"], s["begin"].cast("string"), s["end"].cast("string"), s["edits"].cast("string"))), ",")
    score = F.array_max(F.transform("notices", lambda s: 1 - s["edits"] / F.length(s["notice"])))
    return found.withColumn("_base", exact).select(
        id_col, "n_words", F.size("_base").cast("bigint").alias("n_base"), F.array_min(start).alias("first_word"), F.array_max(start).alias("last_word"),
        labels(F.col("_base")).alias("base_labels"), labels(F.col("notices")).alias("labels"), F.coalesce(score, F.lit(0.0)).alias("score"), spans.alias("spans"))
