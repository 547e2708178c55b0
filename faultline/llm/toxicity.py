"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's score is logistic in its
words and word beginnings (hashed); a document is toxic if any sentence is, so its
score is the noisy-or of theirs.  Weights are trained from document labels alone,
and the sentence scores then say which sentences offend.
"""
from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx
from .quality import labelled_sample

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".!?\n\r"]] = True
BEGINNINGS = (4, 6)


class Sentences(NamedTuple):
    """Features of the sentences of some documents, sentence by sentence."""
    feature: np.ndarray      # hashed features, a row for each word
    first: np.ndarray        # index of each sentence's first word (sentences + 1)
    doc: np.ndarray          # document of each sentence
    start: np.ndarray        # byte range of each sentence
    end: np.ndarray


def sentences(data: np.ndarray, offsets: np.ndarray, bits: int) -> Sentences:
    """Sentences (ended by . ! ? or a line break) that have words, with the features of each word:
    the word, and its first 4 and 6 bytes."""
    part, rel = data[offsets[0]:offsets[-1]], offsets - offsets[0]
    start, end = tx.edges(~_BREAK[part], rel)
    w = tx.words(data, offsets)
    used, first = np.unique(np.searchsorted(start, w.start, "right") - 1, return_index=True)
    codes, head, k = [w.code], np.zeros(len(w.start), dtype=np.uint64), 0
    folded = tx.FOLD[part]
    for n in BEGINNINGS:
        for k in range(k, n):
            at = np.minimum(w.start + k, w.end - 1)
            head |= np.where(w.start + k < w.end, folded[at], 0).astype(np.uint64) << np.uint64(8 * k)
        codes.append(tx.mix(head + (np.uint64(n) << np.uint64(56))))
        k = n
    feature = np.stack([(c >> np.uint64(64 - bits)).astype(np.int32) for c in codes], axis=1)
    return Sentences(feature, np.append(first, len(feature)), np.searchsorted(rel, start[used], "right") - 1, start[used], end[used])


class Model(NamedTuple):
    bits: int
    bias: float
    weight: np.ndarray


def sentence_scores(s: Sentences, m: Model) -> np.ndarray:
    if not len(s.doc):
        return np.zeros(0)
    z = np.add.reduceat(m.weight[s.feature].sum(1, dtype=np.float64), s.first[:-1]) + m.bias
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def noisy_or(scores: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """1 - product of (1 - score) over the sentences of each document; 0 without sentences."""
    return -np.expm1(np.bincount(doc, weights=np.log1p(-np.minimum(scores, 1 - 1e-12)), minlength=n))


def train(bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, *, bits: int, epochs: int = 15, steps: int = 400, batch: int = 256, rate: float = 1.0, ridge: float = 1e-6, min_docs: int = 4, min_z: float = 4.0) -> Model:
    """Adagrad on the likelihood of the document labels, for ``epochs`` passes and ``steps`` batches at least.

    bags: (features, a row for each word, and words a sentence) of each document.  The derivative of the noisy-or
    gives every sentence its share of the document's error.  Features keep weight 0
    unless they occur in ``min_docs`` documents and their share of toxic documents is
    ``min_z`` standard errors off the overall share: the rest would only learn single
    documents by heart.  Copies of a document count once."""
    once = list({(f.tobytes(), int(label)): i for i, ((f, _), label) in enumerate(zip(bags, y, strict=True))}.values())
    bags, y = [bags[i] for i in once], np.asarray(y)[once]
    weight = np.zeros(1 << bits)
    squares = np.full(1 << bits, 1e-3)
    y = np.asarray(y, dtype=np.float64)
    bias, bias_squares = -5.0, 1e-3
    if not len(y) or y.min() == y.max():
        return Model(bits, 5.0 if len(y) and y.max() == 1 else bias, weight.astype(np.float32))
    seen, toxic = np.zeros(1 << bits), np.zeros(1 << bits)
    for (feature, _), label in zip(bags, y, strict=True):
        own = np.unique(feature)
        seen[own] += 1
        toxic[own] += label
    kept = (seen >= min_docs) & (np.abs(toxic - seen * y.mean()) >= min_z * np.sqrt(seen * y.mean() * (1 - y.mean())))
    rng = np.random.default_rng(7)
    for _ in range(max(epochs, -(-steps // -(-len(y) // batch)))):
        order = rng.permutation(len(y))
        for k in range(0, len(order), batch):
            own = [i for i in order[k:k + batch] if len(bags[i][1])]
            if not own:
                continue
            feature = np.concatenate([bags[i][0] for i in own])
            size = np.concatenate([bags[i][1] for i in own])
            doc = np.repeat(np.arange(len(own)), [len(bags[i][1]) for i in own])
            first = np.cumsum(size) - size
            p = 1 / (1 + np.exp(-np.clip(np.add.reduceat(weight[feature].sum(1), first) + bias, -30, 30)))
            none = np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(own))
            share = np.where(y[own] == 1, -np.exp(none) / np.maximum(-np.expm1(none), 1e-9), 1.0)
            d = p * share[doc] / len(own)
            step = np.zeros(1 << bits)
            for column in feature.T:
                step += np.bincount(column, weights=np.repeat(d, size), minlength=1 << bits)
            step = (step + ridge * weight) * kept
            squares += step**2
            weight -= rate * step / np.sqrt(squares)
            db = d.sum()
            bias_squares += db**2
            bias -= 0.3 * rate * db / np.sqrt(bias_squares)
    return Model(bits, float(bias), weight.astype(np.float32))


def fit(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic",
        max_rows: int = 12_000, max_bytes: int = 128 << 20, bits: int = 18, shard_bytes: int = 2 << 20, **options) -> Model:
    """Weights from a sample of labelled documents: at most about ``max_rows`` of them, with at most about
    ``max_bytes`` of text together (the documented bounds), chosen by hashes of the id whatever their length.

    The driver gets the hashed features of the sampled documents, not their texts: about twice the bytes of these."""
    rows = labelled_sample(docs.select(id_col, text_col), labels, label_col, max_rows, id_col)
    size = rows.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    rows = rows.where(F.pmod(F.xxhash64(F.col(id_col), F.lit("bytes")), F.lit(1_000_000)) < int(1_000_000 * min(1.0, max_bytes / max(size, 1))))
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("label", T.IntegerType()), T.StructField("feature", T.BinaryType()), T.StructField("size", T.BinaryType())])

    def featurise(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            data, offsets = tx.utf8(b.column(text_col))
            for i, j in tx.groups(offsets, shard_bytes):
                s = sentences(data, offsets[i:j + 1], bits)
                edge = np.searchsorted(s.doc, np.arange(j - i + 1))
                size = np.diff(s.first).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    b.column("id").slice(i, j - i), b.column("label").slice(i, j - i),
                    pa.array([s.feature[s.first[a]:s.first[z]].tobytes() for a, z in zip(edge[:-1], edge[1:], strict=True)], pa.binary()),
                    pa.array([size[a:z].tobytes() for a, z in zip(edge[:-1], edge[1:], strict=True)], pa.binary())], ["id", "label", "feature", "size"])

    got = rows.select(F.col(id_col).cast("string").alias("id"), "label", F.col(text_col)).mapInArrow(featurise, schema).toArrow()
    got = got.sort_by("id")               # whatever order the tasks ended in
    bags = [(np.frombuffer(f, dtype=np.int32).reshape(-1, 1 + len(BEGINNINGS)), np.frombuffer(s, dtype=np.int32)) for f, s in zip(got["feature"].to_pylist(), got["size"].to_pylist(), strict=True)]
    return train(bags, np.array(got["label"].to_pylist()), bits=bits, **options)


def score(docs: DataFrame, model: Model, *, text_col: str = "text", carry: list[str] | None = None, least: float = 0.5, shard_bytes: int = 2 << 20) -> DataFrame:
    """The ``carry`` columns of ``docs`` (all unless given) with score and offending.

    score: noisy-or of the sentence scores; 0 for a text without words, null included.
    offending: (begin, end, score) of the sentences with a score of ``least`` or more, in
    code points.  Repeated rows stay; input columns named like an added one are replaced."""
    docs = docs.drop("score", "offending")
    carry = docs.columns if carry is None else carry
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            data, offsets = tx.utf8(b.column(text_col))
            for i, j in tx.groups(offsets, shard_bytes):
                s = sentences(data, offsets[i:j + 1], shared.value.bits)
                p = sentence_scores(s, shared.value)
                bad = np.flatnonzero(p >= least)
                points = tx.code_points(data[offsets[i]:offsets[j]]) if len(bad) else np.zeros(offsets[j] - offsets[i] + 1, dtype=np.int64)
                origin = points[offsets[i:j] - offsets[i]][s.doc[bad]]
                spans = pa.StructArray.from_arrays([pa.array(points[s.start[bad]] - origin, pa.int64()), pa.array(points[s.end[bad]] - origin, pa.int64()), pa.array(p[bad], pa.float64())], ["begin", "end", "score"])
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(i, j - i) for c in carry], pa.array(noisy_or(p, s.doc, j - i), pa.float64()),
                                                  tx.list_column(spans, np.bincount(s.doc[bad], minlength=j - i))], [*carry, "score", "offending"])

    return docs.select(*dict.fromkeys([*carry, text_col])).mapInArrow(run, T.StructType([docs.schema[c] for c in carry] + [T.StructField("score", T.DoubleType()), T.StructField("offending", T.ArrayType(span))]))
