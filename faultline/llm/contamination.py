"""Benchmark decontamination with an FM-index per training shard.

Each task cuts its documents into shards, turns their words into symbols and
builds an FM-index (suffix order, wavelet matrix over the transformed text,
sampled positions).  All windows of the benchmark are searched backwards at
once, occurrences are located by walking to the next sampled position, and the
hit word ranges of a document are merged into removal spans.
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


class Wavelet:
    """Rank over a symbol sequence: one bit vector a level, high bit first, zeros before ones."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.bits = max(1, int(top).bit_length())
        self.words: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            padded = np.zeros((len(bit) // 64 + 1) * 64, dtype=np.uint8)
            padded[: len(bit)] = bit
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(packed)
            count = np.zeros(len(packed) + 1, dtype=np.int64)
            np.cumsum(np.bitwise_count(packed), out=count[1:])
            self.counts.append(count)
            self.zeros.append(len(bit) - int(count[-1]))
            one = bit.astype(bool)
            symbols = np.concatenate([symbols[~one], symbols[one]])
        self.base = self._descend(np.arange(top + 1), np.zeros(top + 1, dtype=np.int64))

    def _ones(self, k: int, i: np.ndarray) -> np.ndarray:
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[k][i >> 6] + np.bitwise_count(self.words[k][i >> 6] & low)

    def _descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k in range(self.bits):
            ones = self._ones(k, i)
            i = np.where((symbol >> (self.bits - 1 - k)) & 1, self.zeros[k] + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How many of the first i symbols are ``symbol``."""
        return self._descend(symbol, i) - self.base[symbol]

    def at(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at i, and its rank there."""
        symbol = np.zeros(len(i), dtype=np.int64)
        for k in range(self.bits):
            ones = self._ones(k, i)
            bit = (self.words[k][i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)
            symbol = symbol * 2 + bit.astype(np.int64)
            i = np.where(bit != 0, self.zeros[k] + ones, i - ones)
        return symbol, i - self.base[symbol]


def suffix_order(symbols: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Positions in suffix order.  Symbol 0 separates: each 0 is unlike all else and
    ordered by place, so that suffixes are compared up to their separator only.
    below[c]: symbols less than c.  Prefix doubling over the positions still tied."""
    n = len(symbols)
    rank = below[symbols]
    at = np.flatnonzero(symbols == 0)
    rank[at] = np.arange(len(at))
    counts = np.diff(below, append=n)
    tied = np.flatnonzero((symbols != 0) & (counts[symbols] > 1))
    step = 1
    while len(tied):
        key = (rank[tied] << 32) | rank[tied + step]
        order = np.argsort(key, kind="stable")
        key, tied = key[order], tied[order]
        old = key >> 32
        i = np.arange(len(key))
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        group = np.ones(len(key), dtype=bool)
        group[1:] = old[1:] != old[:-1]
        head = np.maximum.accumulate(np.where(new, i, 0))
        rank[tied] = old + head - np.maximum.accumulate(np.where(group, i, 0))
        alone = new.copy()
        alone[:-1] &= new[1:]
        tied = tied[~alone]
        step *= 2
    out = np.empty(n, dtype=np.int64)
    out[rank] = np.arange(n)
    return out


class FMIndex:
    """Index of symbols 1..top with separators 0; the last symbol must be 0."""

    def __init__(self, symbols: np.ndarray, top: int, every: int = 8):
        counts = np.bincount(symbols, minlength=top + 1)
        self.below = np.zeros(top + 2, dtype=np.int64)
        np.cumsum(counts, out=self.below[1:])
        order = suffix_order(symbols, self.below[:-1])
        before = symbols[order - 1]      # position 0 is preceded by the last symbol, a separator
        self.tree = Wavelet(before, top)
        kept = (order % every == 0) | (before == 0)
        self.kept = Wavelet(kept.astype(np.int64), 1)
        self.places = order[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of all patterns (rows of symbols, right-aligned) by backward search."""
        last = patterns[:, -1]
        lo, hi = self.below[last].copy(), self.below[last + 1].copy()
        for k in range(1, patterns.shape[1]):
            live = np.flatnonzero((hi > lo) & (lengths > k))
            if not len(live):
                break
            c = patterns[live, -1 - k]
            lo[live] = self.below[c] + self.tree.rank(c, lo[live])
            hi[live] = self.below[c] + self.tree.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: walk back until a row with a sampled position."""
        out = np.empty(len(rows), dtype=np.int64)
        todo, steps = np.arange(len(rows)), 0
        while len(todo):
            one, place = self.kept.at(rows)
            done = one == 1
            out[todo[done]] = self.places[place[done]] + steps
            todo, rows = todo[~done], rows[~done]
            symbol, rank = self.tree.at(rows)
            rows = self.below[symbol] + rank
            steps += 1
        return out


class Bench(NamedTuple):
    """Windows of a block of benchmark items over a vocabulary 1..V of sorted fingerprints."""
    vocabulary: np.ndarray
    patterns: np.ndarray      # windows, right-aligned
    lengths: np.ndarray
    owner: np.ndarray         # items of each window, one window after the other
    owner_first: np.ndarray
    items: list[str]


def bench_windows(items: list[tuple[str, str]], window: int) -> Bench | None:
    """All windows of ``window`` words (the whole item where it has fewer) of (item id, text)."""
    ids = sorted({i for i, _ in items})
    number = {x: k for k, x in enumerate(ids)}
    data, offsets = tx.utf8(pa.array([t or "" for _, t in items], pa.large_string()))
    w = tx.words(data, offsets)
    if not len(w.code):
        return None
    vocabulary, symbol = np.unique(w.code, return_inverse=True)
    symbol = symbol + 1
    owners: dict[tuple[int, ...], set[int]] = {}
    for k, (item, _) in enumerate(items):
        own = symbol[w.first[k]:w.first[k + 1]].tolist()
        for i in range(max(1, len(own) - window + 1) if own else 0):
            owners.setdefault(tuple(own[i:i + window]), set()).add(number[item])
    lengths = np.array([len(x) for x in owners])
    patterns = np.zeros((len(owners), window), dtype=np.int64)
    for k, x in enumerate(owners):
        patterns[k, window - len(x):] = x
    sizes = [len(x) for x in owners.values()]
    return Bench(vocabulary, patterns, lengths, np.array([y for x in owners.values() for y in sorted(x)], dtype=np.int64),
                 np.concatenate([[0], np.cumsum(sizes)]), ids)


def occurrences(w: tx.Words, bench: Bench) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every occurrence of a window in the words of a shard.

    Words outside the vocabulary become separators, and runs between them that are
    shorter than the shortest window are left out of the index: no window can lie there."""
    none = np.zeros(0, dtype=np.int64)
    at = np.searchsorted(bench.vocabulary, w.code)
    at[at == len(bench.vocabulary)] = 0
    known = bench.vocabulary[at] == w.code
    begin, end = tx.edges(known, w.first)
    long_enough = end - begin >= bench.lengths.min()
    begin, end = begin[long_enough], end[long_enough]
    if not len(begin):
        return none, none
    size = end - begin + 1                                   # with a separator after each run
    out = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(out[-1]) - np.repeat(out[:-1] - begin, size)   # word index of each symbol
    symbols = np.where(place < np.repeat(end, size), at[np.minimum(place, len(at) - 1)] + 1, 0)
    index = FMIndex(symbols, len(bench.vocabulary))
    lo, hi = index.search(bench.patterns, bench.lengths)
    found = np.flatnonzero(hi > lo)
    size = hi[found] - lo[found]
    if not len(found):
        return none, none
    rows = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - lo[found], size)
    return place[index.locate(rows)], np.repeat(found, size)


def shard_hits(w: tx.Words, bench: Bench | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hit mark per word, and the distinct (document, item) pairs of a shard."""
    n = len(w.code)
    hit = np.zeros(n, dtype=bool)
    none = np.zeros(0, dtype=np.int64)
    if bench is None or not n:
        return hit, none, none
    first, window = occurrences(w, bench)
    if not len(first):
        return hit, none, none
    change = np.bincount(first, minlength=n + 1) - np.bincount(first + bench.lengths[window], minlength=n + 1)
    hit = np.cumsum(change[:n]) > 0
    doc = np.searchsorted(w.first, first, "right") - 1
    pairs = np.unique(doc * len(bench.lengths) + window)
    doc, window = pairs // len(bench.lengths), pairs % len(bench.lengths)
    size = np.diff(bench.owner_first)[window]
    item = bench.owner[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - bench.owner_first[window], size)]
    pairs = np.unique(np.repeat(doc, size) * len(bench.items) + item)
    return hit, pairs // len(bench.items), pairs % len(bench.items)


def _scan(batches: Iterable[pa.RecordBatch], bench: Bench | None, text_col: str, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = tx.utf8(batch.column(text_col))
        for i, j in tx.groups(offsets, shard_bytes):
            w = tx.words(data, offsets[i:j + 1])
            hit, doc, item = shard_hits(w, bench)
            begin, end = tx.edges(hit, w.first)
            per_doc = np.bincount(np.searchsorted(w.first, begin, "right") - 1, minlength=j - i)
            part = data[offsets[i]:offsets[j]]
            points = tx.code_points(part) if len(begin) else np.zeros(1, dtype=np.int64)
            origin = np.repeat(points[np.minimum(offsets[i:j] - offsets[i], len(points) - 1)], per_doc)
            marks = np.concatenate([[0], np.cumsum(hit)])
            spans = pa.StructArray.from_arrays(
                [pa.array((points[w.start[begin]] - origin) if len(begin) else begin, pa.int64()),
                 pa.array((points[w.end[end - 1]] - origin) if len(begin) else begin, pa.int64())], ["begin", "end"])
            yield pa.RecordBatch.from_arrays(
                [*batch.slice(i, j - i).columns, pa.array(np.diff(w.first), pa.int64()), pa.array(marks[w.first[1:]] - marks[w.first[:-1]], pa.int64()),
                 tx.list_column(spans, per_doc),
                 tx.list_column(pa.array([bench.items[x] for x in item] if bench else [], pa.string()), np.bincount(doc, minlength=j - i))],
                [*batch.schema.names, "n_words", "n_hit", "removal", "items"])


def benchmark_spans(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", shard_bytes: int = 4 << 20, block_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with what each text shares with the benchmark.

    Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased.
    A window is ``window`` consecutive words of an item, or all words of a shorter
    one; items without words have none.  Adds

    * n_words, n_hit: words, and words inside any occurrence of a window
    * removal: merged runs of hit words as code point ranges (begin, end)
    * items: sorted ids (as strings) of the items with an occurring window

    A null text or item text has no words; a null item id reads as the empty string;
    repeated documents are rows of their own, repeated items count once.  An empty
    benchmark hits nothing.  Every other column passes through unchanged; an input
    column named like an added one is replaced.

    The benchmark is read in blocks of at most about ``block_bytes`` of text (chosen by
    item hash from its measured size); each block's windows travel with one pass, and
    the passes are chained in one stage.  No shuffle of documents takes place.
    """
    spark, docs = docs.sparkSession, docs.drop("n_words", "n_hit", "removal", "items")
    b = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"), F.col(item_text_col).alias("t")).where("t IS NOT NULL")
    total = b.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    fields = [f for f in docs.schema.fields]
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
             T.StructField("removal", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))),
             T.StructField("items", T.ArrayType(T.StringType()))]
    out = docs
    for k in range(blocks):
        rows = b.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).distinct().collect()   # at most about block_bytes
        bench = spark.sparkContext.broadcast(bench_windows([(r["i"], r["t"]) for r in rows], window))
        names = [f"_{n.name}_{k}" for n in added] if blocks > 1 else [n.name for n in added]
        got = out.mapInArrow(lambda it, bench=bench: lean(_scan(it, bench.value, text_col, shard_bytes)), T.StructType(out.schema.fields + added))
        out = got.withColumnsRenamed(dict(zip([n.name for n in added], names, strict=True)))
    if blocks > 1:
        # words hit by different blocks: merge the runs; a word is hit if any block hits it
        cols = lambda n: [F.col(f"_{n}_{k}") for k in range(blocks)]
        runs = F.array_sort(F.flatten(F.array(*cols("removal"))))
        merged = F.aggregate(runs, F.expr("CAST(array() AS array<struct<begin:bigint,end:bigint>>)"), lambda acc, r: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= r["begin"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["begin"].alias("begin"), F.greatest(F.element_at(acc, -1)["end"], r["end"]).alias("end")))))
            .otherwise(F.concat(acc, F.array(r))))
        word = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
        out = out.withColumn("removal", merged).withColumn("n_words", F.col("_n_words_0")).withColumn(
            "n_hit", F.aggregate("removal", F.lit(0).cast("bigint"), lambda acc, r: acc + F.size(F.regexp_extract_all(F.substring(F.col(text_col), (r["begin"] + 1).cast("int"), (r["end"] - r["begin"]).cast("int")), F.lit(word), F.lit(0)))))
        out = out.withColumn("items", F.array_sort(F.array_distinct(F.flatten(F.array(*cols("items"))))))
    return out.select(*[f.name for f in fields], *[f.name for f in added])


def remove_spans(df: DataFrame, *, text_col: str = "text", spans_col: str = "removal") -> DataFrame:
    """Cut the spans out of the text, a blank in place of each.  Texts without spans stay as they are."""
    n = F.size(spans_col)
    gap = lambda i: F.substring(F.col(text_col), (F.when(i == 0, F.lit(0)).otherwise(F.get(F.col(spans_col), i - 1)["end"]) + 1).cast("int"),
                                (F.when(i == n, F.length(text_col)).otherwise(F.get(F.col(spans_col), i)["begin"]) - F.when(i == 0, F.lit(0)).otherwise(F.get(F.col(spans_col), i - 1)["end"])).cast("int"))
    return df.withColumn(text_col, F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n), gap), " ")).otherwise(F.col(text_col)))
