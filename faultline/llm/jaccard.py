"""Self-join of documents on the Jaccard similarity of their word n-grams.

Equal n-gram sets are one class.  MinHash bands bring classes together; a pair is
looked at in the first band that it shares.  Its MinHash values are compared a few
at a time, and the pair is dropped as soon as the posterior probability that its
similarity reaches the threshold is below a tolerance.  What is left is verified
exactly on the n-gram sets.
"""
from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .common import components, grouped, keep, lean, smallest_in_reach

HASHES, ROWS = 128, 4                     # MinHash values of 16 bits; values in a band
BANDS = HASHES // ROWS
_SEED = np.random.default_rng(99).integers(1, 2**32, (3, HASHES), dtype=np.uint32) | np.uint32(1)
CHECKS = (16, 32, 48, 64, 96, HASHES)     # numbers of values after which a pair is judged


def shingles(w: tx.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, code) of the distinct n-grams, sorted; a document of fewer words has one n-gram of them all."""
    n = len(w.code)
    count = np.diff(w.first)
    grams = np.where(count > 0, np.maximum(count - size + 1, 1), 0)
    doc = np.repeat(np.arange(len(count)), grams)
    at = np.arange(grams.sum()) - np.repeat(np.cumsum(grams) - grams - w.first[:-1], grams)
    code = np.zeros(len(at), dtype=np.uint64)
    length = np.minimum(count, size)[doc]
    padded = np.concatenate([w.code, np.zeros(size, dtype=np.uint64)])
    for k in range(size):
        code = code * np.uint64(0x9E3779B97F4A7C15) + np.where(k < length, padded[np.minimum(at + k, n)], np.uint64(k + 1))
    code = tx.mix(code)
    order = np.lexsort((code, doc))
    doc, code = doc[order], code[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
    return doc[new], code[new]


def signatures(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values (16 bits each) of consecutive non-empty sets that begin at ``first``."""
    out = np.empty((len(first), HASHES), dtype=np.uint16)
    low = (code >> np.uint64(32)).astype(np.uint32)
    for k in range(HASHES):
        v = (low ^ _SEED[0, k]) * _SEED[1, k]
        v ^= v >> np.uint32(15)
        v *= _SEED[2, k]
        least = np.minimum.reduceat(v, first)               # tends to 0 in large sets, so its bits are mixed again
        least = (least ^ (least >> np.uint32(16))) * np.uint32(0x7FEB352D)
        least = (least ^ (least >> np.uint32(15))) * np.uint32(0x846CA68B)
        out[:, k] = (least ^ (least >> np.uint32(16))) & np.uint32(0xFFFF)
    return out


def _sketch(batches: Iterable[pa.RecordBatch], size: int, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = tx.utf8(batch.column("text"))
        for i, j in tx.groups(offsets, shard_bytes):
            doc, code = shingles(tx.words(data, offsets[i:j + 1]), size)
            used, first = np.unique(doc, return_index=True)
            key: list[bytes | None] = [None] * (j - i)
            sig: list[bytes | None] = [None] * (j - i)
            if len(used):
                sums = np.stack([np.add.reduceat(tx.mix(code + np.uint64(s)), first) for s in (1, 2)], axis=1)
                for d, a, b in zip(used.tolist(), sums, signatures(code, first), strict=True):
                    key[d], sig[d] = a.tobytes(), b.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), batch.column("sum").slice(i, j - i), pa.array(key, pa.binary()), pa.array(sig, pa.binary()), pa.array(np.diff(offsets[i:j + 1]).astype(np.int64))], ["id", "sum", "key", "sig", "bytes"])


def fewest_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """For n compared values (with or without one band) the least number of equal ones that keeps a pair.

    With a uniform prior the similarity's posterior after m matches in n is Beta(m+1, n-m+1), and
    P(similarity >= t) = P(Binomial(n+1, t) <= m).  A 16-bit value also agrees by chance in 1 of 65536 cases, which is left out
    of the model: it only lets pairs through."""
    out: dict[int, int] = {}
    for n in {c - x for c in CHECKS for x in (0, ROWS)}:
        total, m = 0.0, -1
        while total < tolerance and m < n:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def likely_pairs(sig: np.ndarray, left: np.ndarray, right: np.ndarray | None, band: int, fewest: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (left x right, or all pairs of left) whose first common band is ``band`` and that survive the pruning."""
    bands = np.ascontiguousarray(sig).view(np.uint64)
    found = [(left[:0], left[:0])]                                    # a block may be empty
    for i in range(0, len(left), 128):
        a = left[i:i + 128]
        b = left if right is None else right
        ok = np.ones((len(a), len(b)), dtype=bool)
        if right is None:
            ok &= np.arange(i, i + len(a))[:, None] < np.arange(len(b))[None, :]
        for k in range(band):
            ok &= bands[a, k][:, None] != bands[b, k][None, :]
        x, y = np.nonzero(ok)
        x, y = a[x], b[y]
        same = np.zeros(len(x), dtype=np.int64)
        done, skipped = 0, band * ROWS
        for c in CHECKS:
            cols = [k for k in range(done, c) if not skipped <= k < skipped + ROWS]    # the band's own values are equal by choice
            same += (sig[x][:, cols] == sig[y][:, cols]).sum(1)
            done = c
            live = same >= fewest[c - ROWS if skipped < c else c]
            x, y, same = x[live], y[live], same[live]
        found.append((x, y))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _prune(batches: Iterable[pa.RecordBatch], fewest: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """For each task the documents with surviving pairs; partners: the other ids of the pairs listed with this one."""
    for task, table in grouped(batches, "task"):
        ids = table["id"].to_numpy()
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), dtype=np.uint16).reshape(-1, HASHES)
        own, lo, hi = table["block"].to_numpy(), table["lo"][0].as_py(), table["hi"][0].as_py()
        x, y = likely_pairs(sig, np.flatnonzero(own == lo), None if lo == hi else np.flatnonzero(own == hi), table["band"][0].as_py(), fewest)
        if not len(x):
            continue
        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        used = np.unique(np.concatenate([x, y]))
        edge = np.searchsorted(x, np.append(used, len(ids)))
        partner = ids[y]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(used), task), pa.int64()), pa.array(ids[used], pa.int64()), table["weight"].combine_chunks().take(pa.array(used)),
            pa.array([partner[a:z].tobytes() for a, z in zip(edge[:-1], edge[1:], strict=True)], pa.binary())], ["task", "id", "weight", "partners"])


def common_counts(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets[x] and sets[y] (sorted distinct codes)."""
    if len(x) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(x, y, strict=True)], dtype=np.int64)
    codes, at = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    total = np.zeros((len(sets), len(sets)))
    for a in range(0, len(codes), 2048):
        i, j = np.searchsorted(at, [a, a + 2048])
        part = np.zeros((len(sets), 2048), dtype=np.float32)
        part[row[i:j], at[i:j] - a] = 1
        total += part @ part.T
    return total[x, y].astype(np.int64)


def _verify(batches: Iterable[pa.RecordBatch], size: int, numerator: int, denominator: int) -> Iterator[pa.RecordBatch]:
    """Exact similarity of the surviving pairs; links (weighted by class size) and the smallest id in reach, per document."""
    for _, table in grouped(batches, "task"):
        table = table.sort_by("id")                             # a row a class
        ids = table["id"].to_numpy()
        data, offsets = tx.utf8(table["text"])
        doc, code = shingles(tx.words(data, offsets), size)
        edge = np.searchsorted(doc, np.arange(len(ids) + 1))
        sets = [code[a:z] for a, z in zip(edge[:-1], edge[1:], strict=True)]
        partners = [np.frombuffer(p, dtype=np.int64) for p in table["partners"].to_pylist()]
        x = np.repeat(np.arange(len(ids)), [len(p) for p in partners])
        y = np.searchsorted(ids, np.concatenate(partners))
        common = common_counts(sets, x, y)
        n = np.diff(edge)
        link = common * denominator >= numerator * (n[x] + n[y] - common)
        x, y = x[link], y[link]
        if not len(x):
            continue
        weight = table["weight"].to_numpy()
        links = np.bincount(x, weights=weight[y], minlength=len(ids)) + np.bincount(y, weights=weight[x], minlength=len(ids))
        low = smallest_in_reach(len(ids), x, y)
        some = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([pa.array(ids[some], pa.int64()), pa.array(links[some].astype(np.int64)), pa.array(ids[low[some]], pa.int64())], ["id", "links", "low"])


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: tuple[int, int] = (4, 5),
                    tolerance: float = 1e-6, block_rows: int = 256, block_bytes: int = 16 << 20, shard_bytes: int = 2 << 20, texts_apart: bool = False) -> DataFrame:
    """(id, n_links, component), a row for each row of ``docs``.

    With ``texts_apart`` also text_hash (xxhash64 of the text) and first: whether the row holds the text
    with the least (id, text_hash) of its component, so that one text of a component is first even
    where one id has several.

    A link is a pair of documents whose sets of ``size``-word n-grams have a Jaccard
    similarity of at least numerator / denominator (``threshold``).  Words are runs of
    ASCII letters and digits and of non-ASCII characters, A-Z lower-cased; a text of
    fewer words has one n-gram of them all.  A text without words (null too) links with
    nothing.  n_links counts other rows, copies included; component is the smallest id
    reachable over links.  Repeated rows are copies; different texts under one id are documents
    of their own, each with its own links.  ids are integers; a row with a null id is left out.

    A true link is missed only if no band agrees (below 1e-7 at the threshold) or if
    the pruning errs (about ``tolerance``).  Buckets and links stay distributed: buckets
    of more than ``block_rows`` classes or ``block_bytes`` of text are split into pairs of blocks,
    each a task of its own, so no task holds a hot bucket, and no pair is ever a row.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("sum")).where("id IS NOT NULL")
    sketch = keep(rows.mapInArrow(lambda it: lean(_sketch(it, size, shard_bytes)), "id long, sum long, key binary, sig binary, bytes long"))
    # a class is known by a number of its own; its text is that of its least (id, text hash)
    classes = sketch.where("key IS NOT NULL").groupBy("key").agg(F.min(F.struct("id", "sum")).alias("of"), F.count("*").alias("weight"), F.any_value("sig").alias("sig"), F.max("bytes").alias("bytes"))
    classes = keep(classes.select("key", "of", F.col("of.id").alias("doc"), "of.sum", "weight", "sig", "bytes", F.monotonically_increasing_id().alias("id")))
    entries = classes.select("id", "bytes", F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.struct(
        b.alias("band"), F.xxhash64(b, F.substring("sig", b * 2 * ROWS + 1, F.lit(2 * ROWS))).alias("bucket")))).alias("e")).select("id", "bytes", "e.band", "e.bucket")
    # buckets with the same documents need to be looked at only once, in the first band
    buckets = entries.groupBy("bucket", "band").agg(F.count("*").alias("m"), F.sum("bytes").alias("all_bytes"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit("again"))).alias("y")).where("m > 1")
    buckets = buckets.groupBy("m", "all_bytes", "x", "y").agg(F.min(F.struct("band", "bucket")).alias("f")).select("m", "all_bytes", "f.band", "f.bucket")
    met = entries.drop("bytes").join(buckets, ["bucket", "band"]).join(classes.select("id", "weight", "sig"), "id")
    n_blocks = F.least(F.col("m"), F.greatest(F.ceil(F.col("m") / block_rows), F.ceil(F.col("all_bytes") / block_bytes))).cast("int")
    dealt = (met.withColumn("block", F.pmod(F.xxhash64("id", F.lit("block")), n_blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
             .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
             .select(F.xxhash64("bucket", "band", "lo", "hi").alias("task"), "id", "weight", "sig", "band", "block", "lo", "hi"))
    fewest = fewest_matches(threshold[0] / threshold[1], tolerance)
    likely = keep(dealt.repartition("task").sortWithinPartitions("task").mapInArrow(lambda it: lean(_prune(it, fewest)), "task long, id long, weight long, partners binary"))
    texts = rows.groupBy(F.col("id").alias("doc"), "sum").agg(F.any_value("text").alias("text"))          # repeated rows are one before they travel
    found = likely.join(classes.select("id", "doc", "sum"), "id").join(texts, ["doc", "sum"]).select("task", "id", "weight", "partners", "text")
    found = keep(found.repartition("task").sortWithinPartitions("task").mapInArrow(lambda it: lean(_verify(it, size, *threshold)), "id long, links long, low long"))
    reach = components(classes, found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    named = reach.join(classes.select("id", "of"), "id")
    named = named.join(named.groupBy("component").agg(F.min("of").alias("least")), "component").select("id", "least")
    per_class = (classes.select("key", "id", "weight").join(found.groupBy("id").agg(F.sum("links").alias("links")), "id", "left").join(named, "id")
                 .select("key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "least"))
    out = sketch.select("id", "sum", "key").join(per_class, "key", "left")
    more = [F.col("sum").alias("text_hash"), F.coalesce(F.col("least") == F.struct("id", "sum"), F.lit(True)).alias("first")] if texts_apart else []
    return out.select("id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), F.coalesce("least.id", "id").alias("component"), *more)
