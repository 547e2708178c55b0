"""Hidden Markov language model.

Words fall into hashed classes.  A state emits a class, and a class emits a word with
its smoothed relative frequency, so P(text) = P(classes) x product of P(word | class):
the latent part has a table of fixed size, the word part needs exact corpus counts.
Baum-Welch counts are summed over partitions; the scaled forward recursion gives
the exact likelihood of a whole text.
"""
from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx
from .common import grouped, keep

CLASS_BITS = 10
END = 1 << CLASS_BITS                # the class of the end token
STATES = 4
PIECE = 256                          # training runs pieces of so many tokens side by side
SPAN = 1024                          # scoring runs spans of so many tokens side by side
FREQUENT = 65_536                    # words with at least a share of 1/65536 of all tokens: there are at most so many


def _shards(batches: Iterable[pa.RecordBatch], shard_bytes: int) -> Iterator[tuple[pa.RecordBatch, tx.Words]]:
    for batch in batches:
        data, offsets = tx.utf8(batch.column("text"))
        for i, j in tx.groups(offsets, shard_bytes):
            yield batch.slice(i, j - i), tx.words(data, offsets[i:j + 1], tx.NOT_SPACE)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of each word in a shard, in training documents and in all."""
    for rows, w in _shards(batches, 8 << 20):
        held = rows.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        word, at, total = np.unique(w.code, return_inverse=True, return_counts=True)
        train = np.bincount(at, weights=~np.repeat(held, np.diff(w.first)), minlength=len(word)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(train), pa.array(total.astype(np.int64))], ["word", "train", "total"])


def _sums(at: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``weights`` by place, as doubles even where there are none (bincount gives integers then)."""
    return np.bincount(at, weights=weights, minlength=n).astype(np.float64)


def _position(table: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Index in the sorted table, -1 where it is absent."""
    if not len(table):
        return np.full(len(code), -1)
    at = np.minimum(np.searchsorted(table, code), len(table) - 1)
    return np.where(table[at] == code, at, -1)


def _rare(batches: Iterable[pa.RecordBatch], frequent: np.ndarray, parts: int, slices: int) -> Iterator[pa.RecordBatch]:
    """The tokens of all other words, packed by part of the vocabulary and slice of the documents."""
    for rows, w in _shards(batches, 8 << 20):
        size = np.diff(w.first)
        rare = np.flatnonzero(_position(frequent, w.code) < 0)
        uid = np.repeat(rows.column("uid").to_numpy(), size)[rare]
        code = w.code[rare]
        task = (code % np.uint64(parts)).astype(np.int64) * slices + uid % slices
        yield _packed(task, {"code": code, "uid": uid, "train": None}, "task")


def _rare_counts(batches: Iterable[pa.RecordBatch], parts: int, slices: int) -> Iterator[pa.RecordBatch]:
    """The words' training counts, packed by part, for every slice of it."""
    for batch in batches:
        code, train = batch.column("word").to_numpy().view(np.uint64), batch.column("train").to_numpy()
        for j in range(slices):
            yield _packed((code % np.uint64(parts)).astype(np.int64) * slices + j, {"code": code, "uid": None, "train": train}, "task")


def _packed(key: np.ndarray, columns: dict[str, np.ndarray | None], name: str) -> pa.RecordBatch:
    """One row for each value of ``key``, with its entries of all columns as binary arrays (None: a null column)."""
    order = np.argsort(key, kind="stable")
    used, edge = np.unique(key[order], return_index=True)
    edge = np.append(edge, len(key))
    cut = lambda x: pa.nulls(len(used), pa.binary()) if x is None else pa.array([x[a:z].tobytes() for a, z in zip(edge[:-1], edge[1:], strict=True)], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(used), *[cut(c if c is None else c[order]) for c in columns.values()]], [name, *columns])


def _unpacked(table: pa.Table, kinds: dict[str, type]) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(table[c].to_pylist()), dtype=t) for c, t in kinds.items()]


def _look_up(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Sum of log10(count + 1) and number of known tokens by document in one slice of one part of the
    vocabulary, packed by bucket of documents."""
    for _, table in grouped(batches, "task"):
        counted = pa.compute.is_valid(table["train"])
        word, train = _unpacked(table.filter(counted), {"code": np.uint64, "train": np.int64})
        code, uid = _unpacked(table.filter(pa.compute.invert(counted)), {"code": np.uint64, "uid": np.int64})
        order = np.argsort(word)
        count = train[order][np.searchsorted(word[order], code)] if len(code) else np.zeros(0, np.int64)         # every token's word is counted
        docs, own = np.unique(uid, return_inverse=True)
        log = _sums(own, np.log10(count + 1), len(docs))
        known = np.bincount(own, weights=count > 0, minlength=len(docs)).astype(np.int64)
        yield _packed(docs % buckets, {"uid": docs, "log": log, "known": known}, "bucket")


def _sum_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of each document over all parts of the vocabulary."""
    for _, table in grouped(batches, "bucket"):
        uid, log, known = _unpacked(table, {"uid": np.int64, "log": np.float64, "known": np.int64})
        docs, own = np.unique(uid, return_inverse=True)
        yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(_sums(own, log, len(docs))), pa.array(np.bincount(own, weights=known).astype(np.int64))], ["uid", "rare_log", "rare_known"])


def _classes(batches: Iterable[pa.RecordBatch], frequent: np.ndarray, count: np.ndarray, class_log: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Class sequence of each document (with the end) and what its frequent words and its classes add to the scores."""
    for rows, w in _shards(batches, 4 << 20):
        n = np.diff(w.first)
        doc = w.doc()
        at = _position(frequent, w.code)
        usual = at >= 0
        log = _sums(doc[usual], np.log10(count[at[usual]] + 1.0), len(n))
        known = np.bincount(doc[usual], weights=count[at[usual]] > 0, minlength=len(n)).astype(np.int64)
        kind = (w.code >> np.uint64(64 - CLASS_BITS)).astype(np.uint16)
        inside = _sums(doc, class_log[kind], len(n))
        seq = [np.append(kind[a:z], np.uint16(END)).tobytes() for a, z in zip(w.first[:-1], w.first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in ("uid", "id", "held_out")], pa.array(n + 1), pa.array(log), pa.array(known), pa.array(inside), pa.array(seq, pa.binary())],
                                         ["uid", "id", "held_out", "n_tokens", "log", "known", "inside", "seq"])


class Hmm(NamedTuple):
    start: np.ndarray        # (states,)
    step: np.ndarray         # (states, states)
    emit: np.ndarray         # (classes, states)


def first_guess(unigram: np.ndarray, states: int = STATES) -> Hmm:
    """States that tend to stay, each with its own random tilt of the class frequencies."""
    tilt = np.random.default_rng(5).uniform(0.2, 1.8, (len(unigram), states))
    return normalised(np.ones(states), np.full((states, states), 0.1 / max(states - 1, 1)) + np.eye(states) * 0.9, unigram[:, None] * tilt, unigram)


def normalised(start: np.ndarray, step: np.ndarray, emit: np.ndarray, unigram: np.ndarray) -> Hmm:
    """Counts to probabilities; every state keeps a small share of the class frequencies, so nothing is impossible."""
    emit = emit / np.maximum(emit.sum(0), 1e-300)
    emit = 0.999 * emit + 0.001 * unigram[:, None]
    step = step + 1e-6
    start = start + 1e-6
    return Hmm(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(0))


def lanes(first: np.ndarray, length: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut sequences into pieces: sequence, start and length of each piece, in order."""
    pieces = -(-length // size)
    of = np.repeat(np.arange(len(length)), pieces)
    k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return of, first[of] + k * size, np.minimum(length[of] - k * size, size)


def forward(seq: np.ndarray, at: np.ndarray, length: np.ndarray, before: np.ndarray, m: Hmm) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward recursion of many pieces side by side, longest first.

    before: state distribution at each piece's first token before its emission.
    Returns the last distribution and log10 of the likelihood."""
    log, scale = np.zeros(len(at)), np.ones(len(at))
    state = before.copy()
    live = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), "left")
    for t, n in enumerate(live):
        now = state[:n] if t == 0 else state[:n] @ m.step
        now = now * m.emit[seq[at[:n] + t]]
        total = now.sum(1)
        state[:n] = now / total[:, None]
        scale[:n] *= total
        if t % 16 == 15:
            log[:n] += np.log10(scale[:n])
            scale[:n] = 1
    return state, log + np.log10(scale)


def log_likelihoods(seq: np.ndarray, first: np.ndarray, length: np.ndarray, m: Hmm) -> np.ndarray:
    """log10 P(class sequence) of each document, exactly.

    A document's first span starts from the start distribution.  Every later span is run
    once from each state, all spans side by side, and the results are then chained."""
    s = len(m.start)
    doc, at, size = lanes(first, length, SPAN)
    later = np.flatnonzero(doc[1:] == doc[:-1]) + 1 if len(doc) else np.zeros(0, int)
    is_first = np.ones(len(doc), dtype=bool)
    is_first[later] = False
    piece = np.concatenate([np.flatnonzero(is_first), np.repeat(later, s)])
    before = np.concatenate([np.repeat(m.start[None, :], is_first.sum(), 0), np.tile(m.step, (len(later), 1))])
    order = np.argsort(-size[piece], kind="stable")
    state, log = np.empty((len(piece), s)), np.empty(len(piece))
    state[order], log[order] = forward(seq, at[piece[order]], size[piece[order]], before[order], m)
    heads = is_first.sum()
    total, now = log[:heads].copy(), state[:heads].copy()          # heads are in document order
    rank = np.arange(len(doc)) - np.flatnonzero(is_first)[doc] if len(doc) else np.zeros(0, int)
    late_log, late_state = log[heads:].reshape(-1, s), state[heads:].reshape(-1, s, s)
    for k in range(1, int(rank.max(initial=0)) + 1):
        some = np.flatnonzero(rank[later] == k)
        d = doc[later[some]]
        top = late_log[some].max(1)
        mixed = now[d] * 10 ** (late_log[some] - top[:, None])
        weight = mixed.sum(1)
        total[d] += top + np.log10(weight)
        now[d] = np.einsum("ds,dst->dt", mixed / weight[:, None], late_state[some])
    return total


def borders(seq: np.ndarray, of: np.ndarray, at: np.ndarray, size: np.ndarray, m: Hmm) -> tuple[np.ndarray, np.ndarray]:
    """Messages over the borders of pieces: the state distribution after the piece before (zeros for a first
    piece), and for each state after a piece the scaled likelihood of all that follows (ones for a last piece).

    Every later piece is run once from each state, all side by side, and the results are chained both ways."""
    s, n = len(m.start), len(of)
    come, go = np.zeros((n, s)), np.ones((n, s))
    later = np.flatnonzero(of[1:] == of[:-1]) + 1
    if not len(later):
        return come, go
    first = np.searchsorted(of, of[later])
    rank = later - first
    run = np.concatenate([np.unique(first), np.repeat(later, s)])
    heads = len(run) - len(later) * s
    before = np.concatenate([np.repeat(m.start[None, :], heads, 0), np.tile(m.step, (len(later), 1))])
    order = np.argsort(-size[run], kind="stable")
    state, log = np.empty((len(run), s)), np.empty(len(run))
    state[order], log[order] = forward(seq, at[run[order]], size[run[order]], before[order], m)
    come[run[:heads] + 1] = state[:heads]                 # each of these has a piece after it
    through = log[heads:].reshape(-1, s)
    through = 10 ** (through - through.max(1, keepdims=True))[:, :, None] * state[heads:].reshape(-1, s, s)     # from state to state over a piece
    by_rank = np.argsort(rank, kind="stable")
    edge = np.searchsorted(rank[by_rank], np.arange(1, rank.max() + 2))
    steps = [by_rank[a:z] for a, z in zip(edge[:-1], edge[1:], strict=True)]
    last = np.append(of[1:] != of[:-1], True)
    for k in steps:
        k = k[~last[later[k]]]
        out = np.einsum("ds,dst->dt", come[later[k]], through[k])
        come[later[k] + 1] = out / out.sum(1, keepdims=True)
    for k in reversed(steps):
        out = np.einsum("dst,dt->ds", through[k], go[later[k]])
        go[later[k] - 1] = out / out.max(1, keepdims=True)
    return come, go


def expected_counts(seq: np.ndarray, first: np.ndarray, length: np.ndarray, m: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expectation step over some whole documents: start, transition and emission counts."""
    s = len(m.start)
    of, at, size = lanes(first, length, PIECE)
    come, go = borders(seq, of, at, size, m)
    is_first = np.append(True, of[1:] != of[:-1])[:len(of)]
    start, step, emit = np.zeros(s), np.zeros((s, s)), np.zeros_like(m.emit)
    order = np.argsort(-size, kind="stable")
    for i in range(0, len(order), 4096):
        own = order[i:i + 4096]
        a, n_tokens = at[own], size[own]
        live = np.searchsorted(-n_tokens, -np.arange(n_tokens[0]), "left")
        begin = np.where(is_first[own][:, None], m.start, come[own] @ m.step)
        states, scales, kinds = [], [], []
        for t, n in enumerate(live):
            kind = seq[a[:n] + t]
            now = (begin[:n] if t == 0 else states[-1][:n] @ m.step) * m.emit[kind]
            total = now.sum(1, keepdims=True)
            states.append(now / total)
            scales.append(total)
            kinds.append(kind)
        end = np.empty((len(own), s))
        for t, n in enumerate(live):
            end[:n] = states[t]
        after = go[own] / (end * go[own]).sum(1, keepdims=True)
        for t in range(len(live) - 1, -1, -1):
            n = live[t]
            states[t] *= after[:n]                         # posterior of the states at t
            back = m.emit[kinds[t]] * after[:n] / scales[t]
            before = states[t - 1][:n] if t else come[own]           # no step leads to a document's first token
            step += m.step * (before.T @ back)
            after[:n] = back @ m.step.T
        start += states[0][is_first[own]].sum(0)
        kind = np.concatenate(kinds)
        post = np.concatenate(states)
        for k in range(s):
            emit[:, k] += np.bincount(kind, weights=post[:, k], minlength=len(emit))
    return start, step, emit


def _sequences(batch: pa.RecordBatch, limit: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    data, offsets = tx_binary(batch.column("seq"))
    for i, j in tx.groups(offsets, limit):
        o = (offsets[i:j + 1] - offsets[i]) // 2
        yield i, j, np.frombuffer(data[offsets[i]:offsets[j]].tobytes(), dtype=np.uint16), o[:-1], np.diff(o)


def tx_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    return np.frombuffer(data, dtype=np.uint8), np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]


def _expect(batches: Iterable[pa.RecordBatch], m: Hmm) -> Iterator[pa.RecordBatch]:
    """Expected counts of a partition, as (cell, value) rows: a fixed number of them."""
    total = np.zeros(len(m.start) + m.step.size + m.emit.size)
    for batch in batches:
        for _, _, seq, first, length in _sequences(batch):
            total += np.concatenate([x.ravel() for x in expected_counts(seq, first, length, m)])
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["cell", "value"])


def train(sequences: DataFrame, unigram: np.ndarray, rounds: int) -> Hmm:
    """Baum-Welch: each round sums the expected counts of all partitions by cell."""
    m, s = first_guess(unigram), STATES
    for _ in range(rounds):
        shared = sequences.sparkSession.sparkContext.broadcast(m)
        rows = sequences.select("seq").mapInArrow(lambda it, shared=shared: _expect(it, shared.value), "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
        total = np.zeros(s + s * s + len(unigram) * s)
        for r in rows:
            total[r["cell"]] = r["value"]
        m = normalised(total[:s], total[s:s + s * s].reshape(s, s), total[s + s * s:].reshape(-1, s), unigram)
    return m


def score_texts(docs: DataFrame, held_out: Column, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = 4, part_tokens: int = 2_000_000) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row for each row of ``docs``.

    Tokens are runs of bytes other than blanks and line ends, A-Z lower-cased, and one end
    token.  Counts cover all rows that are not held out.  base_score: sum of
    log10((c + 1) / (N + V + 1)).  score: log10 P(text) of the hidden Markov model,
    trained on the same rows; an unseen word has count 0 in its class.

    A null text is empty (one token, the end).  Repeated rows count as often as they
    occur.  Without training rows all counts are 0.  Words are told apart by 64-bit
    fingerprints.

    Words with 1/65536 of all tokens or more, at most 65536 of them, are broadcast with
    their counts.  The tokens of the others are shuffled packed by part of the vocabulary, to
    where their words' counts go too, and the sums come back packed by bucket of documents.  There are as many
    parts as tokens fill at ``part_tokens`` each, and each part is cut into slices of the documents, as many as
    the most frequent of these words fills: no task gets more than about two shares of tokens, whatever the words.
    """
    spark = docs.sparkSession
    rows = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("uid"), F.col(id_col).alias("id"), held_out.cast("boolean").alias("held_out"), F.col(text_col).alias("text"))
    rows = rows.withColumn("held_out", F.coalesce("held_out", F.lit(False)))
    counts = keep(rows.select("held_out", "text").mapInArrow(_count, "word long, train long, total long").groupBy("word").agg(F.sum("train").alias("train"), F.sum("total").alias("total")))
    kinds = counts.groupBy(F.shiftrightunsigned("word", 64 - CLASS_BITS).cast("int").alias("kind")).agg(
        F.sum("train").alias("train"), F.count(F.when(F.col("train") > 0, 1)).alias("words"), F.sum("total").alias("total")).collect()
    n_docs = rows.where(~F.col("held_out")).count()
    in_class, seen = np.zeros(END + 1), np.zeros(END + 1)
    for r in kinds:
        in_class[r["kind"]], seen[r["kind"]] = r["train"], r["words"]
    in_class[END], all_tokens = n_docs, sum(r["total"] for r in kinds)
    n, v = int(in_class.sum()), int(seen.sum()) + (n_docs > 0)
    usual = counts.where(F.col("total") * FREQUENT >= all_tokens).collect()           # at most FREQUENT rows
    usual = sorted((r["word"] % 2**64, r["train"]) for r in usual)
    frequent, count = np.array([u[0] for u in usual], dtype=np.uint64), np.array([u[1] for u in usual], dtype=np.float64)
    others = counts.where(F.col("total") * FREQUENT < all_tokens)
    n_rare, most = (x or 0 for x in others.agg(F.sum("total"), F.max("total")).first())
    class_log = np.log10(in_class + seen + 1)
    known_words = spark.sparkContext.broadcast((frequent, count, class_log))
    parts, slices = max(1, -(-n_rare // part_tokens)), max(1, -(-most // part_tokens))
    dealt = (rows.select("uid", "text").mapInArrow(lambda it: _rare(it, known_words.value[0], parts, slices), "task long, code binary, uid binary, train binary")
             .unionAll(others.select("word", "train").mapInArrow(lambda it: _rare_counts(it, parts, slices), "task long, code binary, uid binary, train binary")))
    sums = (dealt.repartition("task").sortWithinPartitions("task").mapInArrow(lambda it: _look_up(it, parts), "bucket long, uid binary, log binary, known binary")
            .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_sum_up, "uid long, rare_log double, rare_known long"))
    sequences = keep(rows.mapInArrow(lambda it: _classes(it, *known_words.value), _sequence_schema(rows)))
    unigram = (in_class + 0.5) / (in_class + 0.5).sum()
    model = spark.sparkContext.broadcast(train(sequences.where(~F.col("held_out")), unigram, rounds))

    def latent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["uid", "id", "held_out", "n_tokens", "log", "known", "inside"]
        for batch in batches:
            for i, j, seq, first, length in _sequences(batch):
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(i, j - i) for c in names], pa.array(log_likelihoods(seq, first, length, model.value))], [*names, "latent"])

    schema = [f for f in sequences.schema.fields if f.name != "seq"]
    scored = sequences.mapInArrow(latent, T.StructType([*schema, T.StructField("latent", T.DoubleType())]))
    once = scored.groupBy("uid").agg(F.count("*").alias("copies"), *[F.any_value(c).alias(c) for c in ("id", "held_out", "n_tokens", "log", "known", "inside", "latent")])
    words = F.col("log") + F.coalesce(F.col("rare_log"), F.lit(0.0)) / F.col("copies")
    end = math.log10(n_docs + 1)
    return once.join(sums, "uid", "left").withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select(
        "id", "held_out", "n_tokens",
        (F.col("known") + (F.coalesce(F.col("rare_known"), F.lit(0)) / F.col("copies")).cast("bigint") + int(n_docs > 0)).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (words + end - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"),
        (F.col("latent") + words - F.col("inside")).alias("score"))


def _sequence_schema(rows: DataFrame):
    return T.StructType([rows.schema["uid"], rows.schema["id"], rows.schema["held_out"], T.StructField("n_tokens", T.LongType()), T.StructField("log", T.DoubleType()),
                         T.StructField("known", T.LongType()), T.StructField("inside", T.DoubleType()), T.StructField("seq", T.BinaryType())])
