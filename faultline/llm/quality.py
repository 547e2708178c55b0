"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed with array operations over a shard's bytes.  The trees are
grown on binned statistics of a bounded sample of labelled documents and flattened
into arrays, so that a batch of documents walks all trees level by level.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx
from .common import lean

# Byte classes of the statistics.
_CLASSES = ("upper", "lower", "digit", "space", "newline", "stop", "comma", "bar", "symbol", "high")
_CLASS = np.full(256, 8)
_CLASS[0x41:0x5B], _CLASS[0x61:0x7B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 0, 1, 2, 9
_CLASS[[0x20, 0x09]], _CLASS[[0x0A, 0x0B, 0x0C, 0x0D]] = 3, 4
_CLASS[[ord(c) for c in ".!?"]], _CLASS[[ord(c) for c in ",;:"]], _CLASS[ord("|")] = 5, 6, 7

STATISTICS = ("log_bytes", "log_words", *[f"share_{c}" for c in _CLASSES], "word_length", "word_length_spread", "longest_word", "capitalised", "all_upper",
              "distinct_words", "top_word", "repeated_next", "distinct_pairs", "log_lines", "words_a_line", "repeated_lines", "symbol_end", "single_letters")


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each document; an empty text has zeros."""
    n = len(offsets) - 1
    w = tx.words(data, offsets, tx.NOT_SPACE)
    part = data[offsets[0]:offsets[-1]]
    size = np.diff(offsets)
    doc = w.doc()
    words = np.diff(w.first)
    some, at_least = np.maximum(size, 1), np.maximum(words, 1)
    out = np.zeros((n, len(STATISTICS)), dtype=np.float32)
    put = {name: k for k, name in enumerate(STATISTICS)}

    def per_doc(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=values, minlength=n) / at_least

    classes = np.bincount(np.repeat(np.arange(n), size) * 16 + _CLASS[part], minlength=16 * n).reshape(n, 16)
    out[:, put["log_bytes"]], out[:, put["log_words"]] = np.log1p(size), np.log1p(words)
    for k, c in enumerate(_CLASSES):
        out[:, put[f"share_{c}"]] = classes[:, k] / some
    if not len(doc):
        return out
    length = w.end - w.start
    mean = per_doc(length)
    out[:, put["word_length"]] = mean
    out[:, put["word_length_spread"]] = np.sqrt(np.maximum(per_doc(length.astype(np.float64) ** 2) - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    out[:, put["longest_word"]] = np.log1p(longest)
    upper = np.concatenate([[0], np.cumsum(_CLASS[part] == 0)])
    n_upper = upper[w.end] - upper[w.start]
    out[:, put["capitalised"]] = per_doc((_CLASS[part[w.start]] == 0) & (n_upper == 1))
    out[:, put["all_upper"]] = per_doc((n_upper >= 2) & (n_upper * 2 >= length))
    out[:, put["symbol_end"]] = per_doc(np.isin(_CLASS[part[w.end - 1]], (7, 8)))
    out[:, put["single_letters"]] = per_doc(length == 1)
    tag = tx.mix(doc.astype(np.uint64) + np.uint64(1))
    same = np.zeros(len(doc), dtype=bool)
    same[1:] = (w.code[1:] == w.code[:-1]) & (doc[1:] == doc[:-1])
    out[:, put["repeated_next"]] = per_doc(same)
    _, first, count = np.unique(w.code ^ tag, return_index=True, return_counts=True)
    out[:, put["distinct_words"]] = np.bincount(doc[first], minlength=n) / at_least
    top = np.zeros(n)
    np.maximum.at(top, doc[first], count)
    out[:, put["top_word"]] = top / at_least
    pair = tx.mix(w.code[:-1] * np.uint64(3) + w.code[1:]) ^ tag[1:]
    inside = doc[1:] == doc[:-1]
    _, first = np.unique(pair[inside], return_index=True)
    out[:, put["distinct_pairs"]] = np.bincount(doc[1:][inside][first], minlength=n) / np.maximum(words - 1, 1)
    lines = tx.words(data, offsets, _CLASS != 4)
    n_lines = np.diff(lines.first)
    line_doc = lines.doc()
    _, first = np.unique(lines.code ^ tx.mix(line_doc.astype(np.uint64) + np.uint64(1)), return_index=True)
    out[:, put["log_lines"]], out[:, put["words_a_line"]] = np.log1p(n_lines), np.log1p(words / np.maximum(n_lines, 1))
    out[:, put["repeated_lines"]] = 1 - np.bincount(line_doc[first], minlength=n) / np.maximum(n_lines, 1)
    return out


class Forest(NamedTuple):
    """Trees of equal depth as arrays: children of node i are 2i+1 and 2i+2."""
    start: float
    feature: np.ndarray      # (trees, 2^depth - 1)
    above: np.ndarray        # go right if the statistic is greater
    leaf: np.ndarray         # (trees, 2^depth)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        for feature, above, leaf in zip(self.feature, self.above, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > above[node])
            total += leaf[node - (len(leaf) - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, *, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: float = 3.0) -> Forest:
    """Logistic boosting by histograms of gradients.  Without rows, or with one label only, the forest is a constant."""
    y = np.asarray(y, dtype=np.float64)
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    n_features = x.shape[1]
    if not len(y) or y.min() == y.max():
        return Forest(start, np.zeros((0, 1), int), np.zeros((0, 1)), np.zeros((0, 2)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)     # bin b: cuts[b-1] < v <= cuts[b]
    inner, leaves = 2**depth - 1, 2**depth
    feature, above, leaf = np.zeros((trees, inner), int), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    total = np.full(len(y), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            count, base = 2**level, 2**level - 1
            best = np.full(count, 1e-6)
            cut = np.full(count, -1)
            for f in range(n_features):
                key = (node - base) * bins + binned[:, f]
                gs = np.bincount(key, weights=g, minlength=count * bins).reshape(count, bins).cumsum(1)
                hs = np.bincount(key, weights=h, minlength=count * bins).reshape(count, bins).cumsum(1)
                ga, ha = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (ga - gs) ** 2 / (ha - hs + ridge) - ga**2 / (ha + ridge)
                gain[(hs < least) | (ha - hs < least)] = 0
                k = gain[:, : len(cuts[f])].argmax(1) if len(cuts[f]) else np.zeros(count, int)
                got = gain[np.arange(count), k] if len(cuts[f]) else np.zeros(count)
                better = got > best
                best[better], cut[better] = got[better], k[better]
                feature[t, base:base + count][better] = f
            split = np.flatnonzero(cut >= 0)
            for k in split:
                above[t, base + k] = cuts[feature[t, base + k]][cut[k]]
            own = node - base
            right = (cut[own] >= 0) & (binned[np.arange(len(y)), feature[t, node]] > cut[own])
            node = 2 * node + 1 + right
        own = node - inner
        leaf[t] = rate * np.bincount(own, weights=g, minlength=leaves) / (np.bincount(own, weights=h, minlength=leaves) + ridge)
        total += leaf[t][own]
    return Forest(start, feature, above, leaf)


def _batches(batches: Iterable[pa.RecordBatch], text_col: str, shard_bytes: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        data, offsets = tx.utf8(batch.column(text_col))
        for i, j in tx.groups(offsets, shard_bytes):
            yield batch.slice(i, j - i), statistics(data, offsets[i:j + 1])


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, max_rows: int, id_col: str) -> DataFrame:
    """About ``max_rows`` labelled documents (all if there are fewer), chosen by a hash of the id.

    The labels of the sample are broadcast: they are bounded by ``max_rows``.  A label
    counts once a document; of contradicting ones the more frequent, then 1, counts."""
    labels = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
    n = labels.count()
    some = labels.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, max_rows / max(n, 1))))
    return docs.join(F.broadcast(some), id_col)


def fit(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality",
        max_rows: int = 40_000, shard_bytes: int = 2 << 20, **options) -> Forest:
    """Forest from a sample of at most about ``max_rows`` labelled documents (the documented bound).

    The documents are featurised in tasks; the driver gets one short row of numbers for
    each sampled document and grows the trees."""
    rows = labelled_sample(docs.select(id_col, text_col), labels, label_col, max_rows, id_col)
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("x", T.BinaryType())])

    def featurise(batches):
        for batch, x in _batches(batches, text_col, shard_bytes):
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array([r.tobytes() for r in x], pa.binary())], ["label", "x"])

    got = rows.select(F.col(id_col), F.col(text_col), "label").mapInArrow(lambda it: lean(featurise(it)), schema).toArrow()
    x = np.frombuffer(b"".join(got["x"].to_pylist()), dtype=np.float32).reshape(-1, len(STATISTICS))
    y = np.array(got["label"].to_pylist(), dtype=np.float64)
    order = np.lexsort((*x.T, y))          # whatever order the tasks ended in
    return grow(x[order], y[order], **options)


def score(docs: DataFrame, forest: Forest, *, text_col: str = "text", carry: list[str] | None = None, shard_bytes: int = 2 << 20) -> DataFrame:
    """The ``carry`` columns of ``docs`` (all unless given) with score, the probability of label 1.

    A null or empty text has the score of all-zero statistics.  Repeated rows stay; an
    input column named score is replaced.  No shuffle."""
    docs = docs.drop("score")
    carry = docs.columns if carry is None else carry
    model = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches):
        for batch, x in _batches(batches, text_col, shard_bytes):
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], pa.array(model.value.score(x), pa.float64())], [*carry, "score"])

    return docs.select(*dict.fromkeys([*carry, text_col])).mapInArrow(lambda it: lean(run(it)), T.StructType([docs.schema[c] for c in carry] + [T.StructField("score", T.DoubleType())]))
