"""Importance resampling towards a target: hashed word n-grams by prefix CRCs.

Each separator-normalised text is scanned once, and the running CRC register is kept at every
byte.  A register is a polynomial over GF(2), and further bytes multiply it by a power of x:
the register at a range's start, shifted by the range's length, cancels all before it out of
the register at its end.  So the CRC-32 of any n-gram comes from two prefixes.  Counts of
hashed n-grams in corpus and target give each bucket a gain; a document's weight is its mean
gain, and with Gumbel noise the highest scores are a sample without replacement.
"""
from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx
from .common import keep, stored
from .normal import Normal, normalised

# Fixed value: the polynomial of CRC-32, lowest power in the highest bit.
POLYNOMIAL = np.uint32(0xEDB88320)
ONES = np.uint32(0xFFFFFFFF)
_LANE = 256


def _byte_table() -> np.ndarray:
    register = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        register = (register >> np.uint32(1)) ^ np.where(register & np.uint32(1), POLYNOMIAL, np.uint32(0))
    return register


class Shifts:
    """Appending 2^k zero bytes to a register, for each k: a linear map, tabled by its four bytes."""

    def __init__(self, levels: int = 34):
        self.step = _byte_table()
        value = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
        self.tables = [(value >> np.uint32(8)) ^ self.step[value & np.uint32(255)]]
        for _ in range(levels - 1):
            self.tables.append(self.by_power(self.tables[-1], len(self.tables) - 1))

    def by_power(self, register: np.ndarray, k: int) -> np.ndarray:
        t = self.tables[k]
        return t[0][register & np.uint32(255)] ^ t[1][(register >> np.uint32(8)) & np.uint32(255)] ^ t[2][(register >> np.uint32(16)) & np.uint32(255)] ^ t[3][register >> np.uint32(24)]

    def by(self, register: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Each register after ``size`` zero bytes."""
        out = register.copy()
        for k in range(int(size.max()).bit_length() if len(size) else 0):
            at = np.flatnonzero((size >> k) & 1)
            out[at] = self.by_power(out[at], k)
        return out


def _shifts() -> Shifts:
    cache = tx.process_cache()
    if "crc_shifts" not in cache:
        cache["crc_shifts"] = Shifts()
    return cache["crc_shifts"]


class RunningCrc:
    """The CRC register (begun at zero) after every byte of a buffer.

    Lanes of 256 bytes run side by side; a doubling scan over their last registers gives what
    comes before each lane, which is shifted in where a register is read."""

    def __init__(self, data: np.ndarray):
        self.shifts = _shifts()
        lanes = -(-len(data) // _LANE) or 1
        padded = np.zeros(lanes * _LANE, dtype=np.uint8)
        padded[: len(data)] = data
        columns = np.ascontiguousarray(padded.reshape(lanes, _LANE).T)
        self.local = np.empty((_LANE, lanes), dtype=np.uint32)
        register = np.zeros(lanes, dtype=np.uint32)
        for k in range(_LANE):
            register = (register >> np.uint32(8)) ^ self.shifts.step[(register ^ columns[k]) & np.uint32(255)]
            self.local[k] = register
        ends, far = register.copy(), 0
        while 1 << far < lanes:
            ends[1 << far:] ^= self.shifts.by_power(ends[: -(1 << far)], far + 8)
            far += 1
        self.before = np.concatenate([np.zeros(1, dtype=np.uint32), ends[:-1]])

    def at(self, place: np.ndarray) -> np.ndarray:
        """The register after the first ``place`` (1 or more) bytes."""
        lane, k = np.divmod(place - 1, _LANE)
        return self.local[k, lane] ^ self.shifts.by(self.before[lane], k + 1)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """CRC-32 of data[start:end] for ranges that begin after the first byte."""
        return self.at(end) ^ self.shifts.by(self.at(start) ^ ONES, end - start) ^ ONES


def ngram_hashes(normal: Normal, shortest: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, CRC-32) of all runs of n consecutive words, for each n."""
    n_words = len(normal.at)
    if not n_words:
        return
    running = RunningCrc(normal.data)
    doc = np.repeat(np.arange(len(normal.first) - 1), np.diff(normal.first))
    last = normal.first[1:][doc]                       # the word after each word's document
    size = normal.end - normal.start
    for n in range(shortest, longest + 1):
        k = np.flatnonzero(np.arange(n_words) + n <= last)
        if len(k):
            yield doc[k], running.ranges(normal.at[k], normal.at[k + n - 1] + size[k + n - 1])


def _counts(batches: Iterable[pa.RecordBatch], ngrams: tuple[int, int], buckets: int, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    """Features of each bucket in this partition (one row a bucket in use)."""
    total = np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        data, offsets = tx.utf8(batch.column(0))
        for i, j in tx.groups(offsets, shard_bytes):
            for _, code in ngram_hashes(normalised(data, offsets[i:j + 1]), *ngrams):
                total += np.bincount(code % np.uint32(buckets), minlength=buckets)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])


def _weights(batches: Iterable[pa.RecordBatch], text_col: str, carry: list[str], ngrams: tuple[int, int], gains: np.ndarray, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = tx.utf8(batch.column(text_col))
        for i, j in tx.groups(offsets, shard_bytes):
            normal = normalised(data, offsets[i:j + 1])
            n, total = np.zeros(j - i, dtype=np.int64), np.zeros(j - i, dtype=np.int64)
            for doc, code in ngram_hashes(normal, *ngrams):
                gain = np.concatenate([[0], np.cumsum(gains[code % np.uint32(len(gains))])])
                first = np.searchsorted(doc, np.arange(j - i + 1))
                n += np.diff(first)
                total += np.diff(gain[first])
            yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(i, j - i) for c in carry], pa.array(np.diff(normal.first), pa.int64()), pa.array(n, pa.int64()),
                                              pa.array(total // np.maximum(n, 1), pa.int64())], [*carry, "n_words", "n_features", "weight"])


def bucket_counts(docs: DataFrame, text_col: str = "text", *, ngrams: tuple[int, int] = (1, 1), buckets: int = 10_000, shard_bytes: int = 4 << 20) -> np.ndarray:
    """How many features of all texts fall into each bucket (the driver reads one row a bucket)."""
    rows = docs.select(text_col).mapInArrow(lambda it: _counts(it, ngrams, buckets, shard_bytes), "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the corpus."""
    buckets, s, t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (s + buckets) / ((a + 1) * (t + buckets)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def gumbel(seed: int, id_col: str) -> Column:
    """floor(1000 x) of a standard Gumbel draw x that the id fixes."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def score_at(scores: DataFrame, k: int, width: int = 1024) -> int:
    """The k-th highest of the integers in column ``score`` (k at most their number): first its bin, then its place in
    the bin.  Scores are sums of logarithms, so bins are few whatever the number of rows."""
    above = 0
    for part, value in ((scores, F.floor(F.col("score") / width)), (None, F.col("score"))):
        if part is None:
            part = scores.where(F.floor(F.col("score") / width) == found)  # noqa: F821
        for r in part.groupBy(value.alias("v")).count().orderBy(F.desc("v")).collect():
            if above + r["count"] >= k:
                found = r["v"]
                break
            above += r["count"]
    return found


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows with rank 1, 2, 3... in this order: a range sort, and each partition's rows counted.

    The last order column must tell all rows apart, so that no value fills a partition."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = keep(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)).withColumn("_at", F.monotonically_increasing_id())
    placed = placed.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))                # a row a partition
    return placed.join(F.broadcast(offsets), "_part").withColumn("rank", F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")


ADDED = ("n_words", "n_features", "weight", "score", "rank")


def importance_resample(docs: DataFrame, target: DataFrame, *, ngrams: tuple[int, int] = (1, 1), buckets: int = 10_000, least_words: int = 20, percent: int = 10, seed: int = 2024,
                        id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", carry: list[str] | None = None, shard_bytes: int = 4 << 20) -> DataFrame:
    """The ``carry`` columns of ``docs`` (all columns unless given) with

    * n_words; n_features: runs of ``ngrams[0]`` to ``ngrams[1]`` consecutive words, repeats counted
    * weight: floored mean of the gains of the features' buckets (0 without features); a bucket's
      gain is floor(1000 ln) of its smoothed share in all of ``target`` over that in all of ``docs``
    * score: weight plus floored 1000-fold Gumbel noise, fixed by the sha256 of ``seed:id``
    * rank: 1, 2, 3... of the drawn rows, by score (highest first), then id; null for all others

    Drawn are ``percent`` of 100 rows (floored) of those with at least ``least_words`` words.  Words are
    runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased; a feature's
    bucket is the CRC-32 of its words, joined by a blank, modulo ``buckets``.  A null text has
    no words; a null id draws as the empty string and ranks after others of its score; repeated rows
    are rows of their own (in any order among themselves).  Empty tables work: without a target all
    counts of it are 0.  Input columns named like an added one are left out.

    Two passes over the texts, with no shuffle of them; the driver sees one number a bucket and a
    histogram of scores.  Only rows at or above the last drawn score are sorted, by ranges.
    """
    carry = [c for c in docs.columns if c not in ADDED] if carry is None else carry
    gains = bucket_gains(bucket_counts(docs, text_col, ngrams=ngrams, buckets=buckets, shard_bytes=shard_bytes),
                         bucket_counts(target, target_text_col, ngrams=ngrams, buckets=buckets, shard_bytes=shard_bytes))
    added = [T.StructField(c, T.LongType()) for c in ADDED[:3]]
    weighed = docs.select(*dict.fromkeys([*carry, text_col])).mapInArrow(lambda it: _weights(it, text_col, carry, ngrams, gains, shard_bytes), T.StructType([docs.schema[c] for c in carry] + added))
    rows = stored(weighed.withColumn("score", F.col("weight") + gumbel(seed, id_col)), "resampling")
    large = rows.where(F.col("n_words") >= least_words)
    k = large.count() * percent // 100
    if not k:
        return rows.withColumn("rank", F.lit(None).cast("bigint"))
    last = score_at(large.select("score"), k)
    near = (F.col("n_words") >= least_words) & (F.col("score") >= last)
    drawn = ranked(rows.where(near).withColumn("_row", F.monotonically_increasing_id()), [F.desc("score"), F.asc_nulls_last(id_col), F.asc("_row")])
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank"))).drop("_row")
    return drawn.unionByName(rows.where(~near).withColumn("rank", F.lit(None).cast("bigint")))
