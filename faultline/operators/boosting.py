"""J6-J8 gradient-boosted trees on binned features: one ensemble for all classes.

Features are binned once and rows are kept in blocks of arrays with their margins, in memory and dealt
over all cores.  A level of the trees of all classes is one small job: every task sums the gradients of its
blocks by (tree, node, feature, bin), one shuffle by node adds these arrays up, and each node's best
split is found where its sums are; the driver sees one split a node.  Gradients are scaled and
rounded, so that their sums are exact and trees don't depend on how the rows are dealt out.

If there is a class for every core and a task can hold the bins of all rows, these are sent once to as many tasks, and a
round is one job: blocks send the probabilities of each class, and the tasks grow whole trees.

A training set of one block needs no exchange between levels: the task that holds it grows
all its trees in one go, with the same functions and to the same result.
"""
from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

MISSING = 0          # bin of missing values; others are 1, 2, ...


class Settings(NamedTuple):
    """classes: 1 stands for logistic loss (label 0 or 1, one tree a round), more for softmax (a tree a class)."""
    classes: int
    features: int
    depth: int = 6
    rate: float = 0.05
    l2: float = 1.0
    least_hessian: float = 1.0
    rows_share: float = 0.9
    columns_share: float = 0.9
    bins: int = 64
    seed: int = 42
    scale: float = 2.0 ** 32
    missing: bool = True

    @property
    def nodes(self) -> int:
        return 2 ** (self.depth + 1) - 1


class Trees(NamedTuple):
    """Trees of some rounds as arrays (round, class, node); the children of node i are 2i + 1 and 2i + 2.

    feature is -1 at a leaf; a row goes left if its bin is at most ``bin`` (a missing value if ``missing_left``);
    value is the margin that a row ending there gets, cover the sum of hessians, gain that of the split."""
    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, rounds: int, s: Settings) -> Trees:
        shape = (rounds, s.classes, s.nodes)
        return cls(np.full(shape, -1, np.int16), np.zeros(shape, np.uint8), np.zeros(shape, bool), np.zeros(shape), np.zeros(shape), np.zeros(shape))

    @classmethod
    def joined(cls, parts: Sequence[Trees]) -> Trees:
        return cls(*(np.concatenate(a) for a in zip(*parts, strict=True)))

    def of(self, first: int, last: int | None = None) -> Trees:
        return Trees(*(a[first:last] for a in self))


class Split(NamedTuple):
    """Best splits of some nodes; scaled sums of the left side and of all of the node. feature is -1 without a gain."""
    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    gain: np.ndarray
    left_g: np.ndarray
    left_h: np.ndarray
    all_g: np.ndarray
    all_h: np.ndarray


# --------------------------------------------------------------------------
# Bins and blocks
# --------------------------------------------------------------------------
def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Upper edges of each feature's bins: approximate quantiles of all rows, in one aggregate."""
    shares = [i / bins for i in range(1, bins)]
    clean = [F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")) for f in features]
    row = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(f"q{i}") for i, c in enumerate(clean)]).first()
    return [np.unique(np.array(q or [], dtype=np.float64)) for q in row]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, dtype=np.uint8)
    for f, e in enumerate(edges):
        out[:, f] = np.searchsorted(e, x[:, f], "left") + 1
    out[np.isnan(x)] = MISSING
    return out


class Block:
    """Some rows: bins, label, weight (0 for validation rows), validation mark, draw key and margins."""

    def __init__(self, row: dict, s: Settings):
        self.n = row["n"]
        self.x = np.frombuffer(row["x"], np.uint8).reshape(self.n, s.features)
        self.y = np.frombuffer(row["y"], np.int32)
        self.w = np.frombuffer(row["w"], np.float64)
        self.held = np.frombuffer(row["held"], np.uint8).astype(bool)
        self.key = np.frombuffer(row["key"], np.uint64)
        self.margin = np.frombuffer(row["margin"], np.float64).reshape(self.n, s.classes).copy()


BLOCK = T.StructType([T.StructField("n", T.LongType()), *[T.StructField(c, T.BinaryType()) for c in ("x", "y", "w", "held", "key", "margin")],
                      T.StructField("weight", T.DoubleType()), T.StructField("missing", T.BooleanType())])


def _floats(batch: pa.RecordBatch, columns: Sequence[str]) -> np.ndarray:
    """The columns as a matrix; null is NaN."""
    out = np.empty((batch.num_rows, len(columns)))
    for k, c in enumerate(columns):
        out[:, k] = batch.column(c).cast(pa.float64()).to_pandas().to_numpy(dtype=np.float64, na_value=np.nan)
    return out


def _pack(batches: Iterable[pa.RecordBatch], features: list[str], edges: list[np.ndarray], classes: int, rows: int) -> Iterator[pa.RecordBatch]:
    for whole in _filled(batches, rows):
        for part in whole.to_batches():
            x = binned(_floats(part, features), edges)
            held = part.column("_held").to_numpy(zero_copy_only=False).astype(bool)
            w = np.where(held, 0.0, part.column("_w").to_numpy(zero_copy_only=False).astype(np.float64))
            y = part.column("_y").to_numpy(zero_copy_only=False).astype(np.int32)
            if len(y) and (y.min() < 0 or y.max() >= max(classes, 2)):
                raise ValueError("labels are class indices from 0")
            row = {"n": len(y), "x": x.tobytes(), "y": y.tobytes(), "w": w.tobytes(), "held": held.astype(np.uint8).tobytes(),
                   "key": part.column("_key").to_numpy(zero_copy_only=False).astype(np.int64).tobytes(), "margin": np.zeros((len(y), classes)).tobytes(),
                   "weight": float(w.sum()), "missing": bool((x == MISSING).any())}
            yield pa.RecordBatch.from_pylist([row], schema=_arrow(BLOCK))


def _filled(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The same rows in tables of one chunk with ``rows`` rows each (the last one: what remains), however they came."""
    held, n = [], 0
    for batch in batches:
        while n + batch.num_rows >= rows:
            yield pa.Table.from_batches([*held, batch.slice(0, rows - n)]).combine_chunks()
            batch, held, n = batch.slice(rows - n), [], 0
        if batch.num_rows:
            held, n = [*held, batch], n + batch.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _arrow(schema: T.StructType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(), "int": pa.int32()}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema.fields])


# --------------------------------------------------------------------------
# Gradients, sums and splits of a block
# --------------------------------------------------------------------------
def probabilities(margin: np.ndarray) -> np.ndarray:
    """Class probabilities of margins (of one column: of label 1)."""
    if margin.shape[1] == 1:
        return 1 / (1 + np.exp(-margin))
    e = np.exp(margin - margin.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def losses(margin: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Negative log-likelihood of each row's label."""
    if margin.shape[1] == 1:
        return np.logaddexp(0, np.where(y == 1, -margin[:, 0], margin[:, 0]))
    top = margin.max(axis=1)
    return np.log(np.exp(margin - top[:, None]).sum(axis=1)) + top - margin[np.arange(len(y)), y]


def derivatives(p: np.ndarray, wanted: np.ndarray, w: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Scaled, rounded first and second derivatives (row, class) by probabilities and which of them should be 1."""
    factor = (1.0 if s.classes == 1 else 2.0) * w[:, None]
    return np.rint((p - wanted) * w[:, None] * s.scale), np.rint(np.maximum(p * (1 - p), 1e-16) * factor * s.scale)


def gradients(b: Block, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    wanted = (b.y[:, None] == 1) if s.classes == 1 else (b.y[:, None] == np.arange(s.classes))
    return derivatives(probabilities(b.margin), wanted, b.w, s)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def drawn_rows(b: Block, s: Settings, r: int) -> np.ndarray:
    """Rows that take part in a round: drawn by a hash of the row itself."""
    number = _mixed(b.key ^ np.uint64((s.seed * 1_000_003 + r + 1) * 0x9E3779B97F4A7C15 % 2**64))
    return (b.w > 0) & ((number >> np.uint64(11)).astype(np.float64) < s.rows_share * 2.0**53)


def drawn_columns(s: Settings, r: int) -> np.ndarray:
    """(class, feature): whether a round's tree may split on it."""
    rng = np.random.default_rng([s.seed, r])
    n = max(1, round(s.columns_share * s.features))
    return np.argsort(rng.random((s.classes, s.features)), axis=1).argsort(axis=1) < n


def roots(n: int, s: Settings) -> np.ndarray:
    """(row, class): the root of each tree.  Nodes of a round are numbered through: class x nodes + node."""
    return np.tile(np.arange(s.classes) * s.nodes, (n, 1))


def descend(x: np.ndarray, at: np.ndarray, trees: Trees, r: int, s: Settings, steps: int) -> np.ndarray:
    """Nodes (row, class) that rows reach from ``at`` after so many steps (they stay at leaves)."""
    first, row = np.arange(s.classes) * s.nodes - 1, (np.arange(len(x)) * s.features)[:, None]
    feature, split, missing_left, flat = trees.feature[r].ravel(), trees.bin[r].ravel(), trees.missing_left[r].ravel(), x.ravel()
    for _ in range(steps):
        f = feature.take(at)
        inner = f >= 0
        if not inner.any():
            break
        v = flat.take(row + np.maximum(f, 0))
        right = v > split.take(at)
        if s.missing:
            right |= (v == MISSING) & ~missing_left.take(at)
        at = np.where(inner, 2 * at - first + right, at)
    return at


def add_rounds(margin: np.ndarray, x: np.ndarray, trees: Trees, s: Settings) -> None:
    for r in range(len(trees.feature)):
        margin += trees.value[r].ravel().take(descend(x, roots(len(x), s), trees, r, s, s.depth))


def cells_of(x: np.ndarray, s: Settings) -> np.ndarray:
    """(row, feature): the cell (feature, bin) of each value."""
    return x + np.arange(s.features, dtype=np.int64) * (s.bins + 1)


def block_sums(cells: np.ndarray, at: np.ndarray, g: np.ndarray, h: np.ndarray, drawn: np.ndarray, number: np.ndarray, s: Settings, out: np.ndarray) -> None:
    """Add a block's sums to out (2, node, feature, bin); number[class, node] is the node's place in it or -1."""
    place = number.ravel().take(at)
    pairs = np.flatnonzero((place >= 0) & drawn[:, None])
    place, row, values = place.ravel().take(pairs), pairs // s.classes, (g.ravel().take(pairs), h.ravel().take(pairs))
    size, flat = s.features * (s.bins + 1), out.reshape(2, -1)
    step = max(1, (1 << 19) // s.features)
    for a in range(0, len(pairs), step):
        where = ((place[a:a + step] * size)[:, None] + cells.take(row[a:a + step], axis=0)).ravel()
        for k in (0, 1):
            flat[k] += np.bincount(where, np.repeat(values[k][a:a + step], s.features), flat.shape[1])


def best_splits(sums: np.ndarray, may: np.ndarray, s: Settings) -> Split:
    """The best split of each node from its sums (2, node, feature, bin); may: (node, feature).  Ties: first feature, then first bin."""
    n = sums.shape[1]
    nodes = np.arange(n)
    total = sums[:, :, 0].sum(axis=2)
    G, H = total[:, :, None, None] / s.scale
    parent = (G * G / (H + s.l2))[:, 0, 0]
    left = np.cumsum(sums[..., 1:-1], axis=3)
    best = None
    for missing_left in ((False, True) if s.missing else (False,)):
        sides = left + sums[..., :1] if missing_left else left
        gl, hl = sides / s.scale
        hr = H - hl
        allowed = (hl >= s.least_hessian) & (hr >= s.least_hessian) & may[:, :, None]
        gr = G - gl
        gl *= gl
        gr *= gr
        hl += s.l2
        hr += s.l2
        gl /= hl
        gr /= hr
        gl += gr
        gain = np.where(allowed, gl, -1.0)
        k = gain.reshape(n, -1).argmax(axis=1)
        feature, split = k // gain.shape[2], k % gain.shape[2]
        chosen = sides[:, nodes, feature, split]
        now = [feature, split + 1, np.full(n, missing_left), gain[nodes, feature, split] - parent, *chosen]
        best = now if best is None else [np.where(now[3] > best[3], new, old) for old, new in zip(best, now, strict=True)]
    return Split(np.where(best[3] > 1e-9, best[0], -1), *best[1:], *total)


def _settle(trees: Trees, tree: np.ndarray, node: np.ndarray, split: Split, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Write splits into the only round of ``trees``; the (tree, node) pairs of their children."""
    def values(g, h):
        return -s.rate * (g / s.scale) / (h / s.scale + s.l2), h / s.scale
    root = node == 0
    trees.value[0, tree[root], 0], trees.cover[0, tree[root], 0] = values(split.all_g[root], split.all_h[root])
    on = split.feature >= 0
    t, n = tree[on], node[on]
    for field, column in ((trees.feature, split.feature), (trees.bin, split.bin), (trees.missing_left, split.missing_left), (trees.gain, split.gain)):
        field[0, t, n] = column[on]
    lg, lh = split.left_g[on], split.left_h[on]
    for child, g, h in ((2 * n + 1, lg, lh), (2 * n + 2, split.all_g[on] - lg, split.all_h[on] - lh)):
        trees.value[0, t, child], trees.cover[0, t, child] = values(g, h)
    return np.concatenate([t, t]), np.concatenate([2 * n + 1, 2 * n + 2])


def _worth(trees: Trees, tree: np.ndarray, node: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The nodes that are heavy enough to be split, in order."""
    on = trees.cover[0, tree, node] >= 2 * s.least_hessian
    order = np.lexsort((node[on], tree[on]))
    return tree[on][order], node[on][order]


def _numbers(tree: np.ndarray, node: np.ndarray, s: Settings) -> np.ndarray:
    number = np.full((s.classes, s.nodes), -1, dtype=np.int64)
    number[tree, node] = np.arange(len(tree))
    return number


def grown_trees(x: Sequence[np.ndarray], g: Sequence[np.ndarray], h: Sequence[np.ndarray], drawn: Sequence[np.ndarray], columns: np.ndarray, s: Settings) -> tuple[Trees, list[np.ndarray]]:
    """All levels of one round's trees from the bins and derivatives (row, class) of some blocks, and the nodes that rows reach; columns: (class, feature).

    Below the root only the smaller child of a node is summed up; the other one is what remains of the node."""
    trees, at = Trees.empty(1, s), [roots(len(b), s) for b in x]
    tree, node = np.arange(s.classes), np.zeros(s.classes, dtype=np.int64)

    def summed(tree: np.ndarray, node: np.ndarray) -> np.ndarray:
        sums, number = np.zeros((2, len(tree), s.features, s.bins + 1)), _numbers(tree, node, s)
        for i, b in enumerate(x):
            block_sums(cells_of(b, s), at[i], g[i], h[i], drawn[i], number, s, sums)
        return sums

    sums = summed(tree, node)
    for level in range(s.depth):
        above = _numbers(tree, node, s)
        tree, node = _worth(trees, *_settle(trees, tree, node, best_splits(sums, columns[tree], s), s), s)
        at = [descend(b, i, trees, 0, s, 1) for b, i in zip(x, at, strict=True)]
        if level + 1 == s.depth or not len(tree):
            break
        rows = sum(np.bincount(i[d].ravel(), minlength=s.classes * s.nodes) for i, d in zip(at, drawn, strict=True)).reshape(s.classes, s.nodes)
        other = node + np.where(node % 2 == 1, 1, -1)
        small = np.where((rows[tree, node] < rows[tree, other]) | ((rows[tree, node] == rows[tree, other]) & (node % 2 == 1)), node, other)
        pairs = np.unique(np.stack([tree, small]), axis=1)
        few = summed(*pairs)
        sums = sums[:, above[tree, (node - 1) // 2]]
        for i, own in enumerate(_numbers(*pairs, s)[tree, small]):
            if small[i] == node[i]:
                sums[:, i] = few[:, own]
            else:
                sums[:, i] -= few[:, own]
    return trees, at


def round_of_block(b: Block, r: int, s: Settings) -> Trees:
    """All levels of a round's trees from one block; its margins are brought up to date."""
    g, h = gradients(b, s)
    trees, (at,) = grown_trees([b.x], [g], [h], [drawn_rows(b, s, r)], drawn_columns(s, r), s)
    b.margin += trees.value[0].ravel().take(at)
    return trees


# --------------------------------------------------------------------------
# Rounds over all blocks
# --------------------------------------------------------------------------
def _blocks(batches: Iterable[pa.RecordBatch], s: Settings) -> Iterator[tuple[dict, Block]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield row, Block(row, s)


def _whole(batches: Iterable[pa.RecordBatch], s: Settings, first: int, rounds: int, patience: int | None, history: list[float]) -> Iterator[pa.RecordBatch]:
    """Rounds of a training set of one block; one row a round."""
    seen = list(history)
    for _, b in _blocks(batches, s):
        for r in range(first, rounds):
            trees = round_of_block(b, r, s)
            seen.append(float(losses(b.margin[b.held], b.y[b.held]).mean()) if b.held.any() else math.nan)
            yield pa.RecordBatch.from_pylist([{"round": r, "loss": seen[-1], **{f: a.tobytes() for f, a in zip(Trees._fields, trees, strict=True)}}], schema=_arrow(ROUND))
            if stops(seen, patience):
                break


ROUND = T.StructType([T.StructField("round", T.LongType()), T.StructField("loss", T.DoubleType()), *[T.StructField(f, T.BinaryType()) for f in Trees._fields]])


def _level(rows: Iterable[dict], s: Settings, growing: Trees, r: int, tree: np.ndarray, node: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Sums of this task's blocks for the nodes of a level, one array (2, node, feature, bin) a reducer; reducer p has the nodes p, p + parts, ..."""
    sums, number = np.zeros((2, len(tree), s.features, s.bins + 1)), _numbers(tree, node, s)
    for b in (Block(row, s) for row in rows):
        g, h = gradients(b, s)
        at = descend(b.x, roots(b.n, s), growing, 0, s, s.depth)
        block_sums(cells_of(b.x, s), at, g, h, drawn_rows(b, s, r), number, s, sums)
    for p in range(parts):
        yield p, np.ascontiguousarray(sums[:, p::parts])


def _splits(found: Iterable[tuple[int, np.ndarray]], s: Settings, columns: np.ndarray, parts: int) -> Iterator[tuple[np.ndarray, Split]]:
    """Places and best splits of the nodes of a reducer, whose arrays of all tasks are added up."""
    added: dict[int, np.ndarray] = {}
    for p, sums in found:
        added[p] = added[p] + sums if p in added else sums
    for p, sums in added.items():
        yield np.arange(p, len(columns), parts), best_splits(sums, columns[p::parts], s)


def _level_splits(blocks: RDD, s: Settings, growing: Trees, r: int, tree: np.ndarray, node: np.ndarray) -> Split:
    """The best splits of a level's nodes, in their order; one row a node comes to the driver."""
    columns, parts = drawn_columns(s, r)[tree], min(len(tree), blocks.ctx.defaultParallelism)
    sums = blocks.mapPartitions(lambda it: _level(it, s, growing, r, tree, node, parts)).partitionBy(parts, int)
    found = sums.mapPartitions(lambda it: _splits(it, s, columns, parts)).collect()
    order = np.argsort(np.concatenate([places for places, _ in found]))
    return Split(*(np.concatenate(field)[order] for field in zip(*(split for _, split in found), strict=True)))


def _dealt(rows: Iterable[dict], parts: int) -> Iterator[tuple[int, dict]]:
    """What stays the same of each block in all rounds, for every task that grows trees."""
    for row in rows:
        fixed = {c: v for c, v in row.items() if c != "margin"}
        yield from ((p, fixed) for p in range(parts))


def _asked(rows: Iterable[dict], s: Settings, parts: int) -> Iterator[tuple[int, dict]]:
    """Each block's probabilities of the classes p, p + parts, ... for task p."""
    for row in rows:
        found = probabilities(Block(row, s).margin)
        yield from ((p, {"number": row["number"], "margin": found[:, p::parts].tobytes()}) for p in range(parts))


def _grown(found: Iterable[tuple[int, dict]], s: Settings, r: int, parts: int) -> Iterator[tuple[np.ndarray, Trees]]:
    """A round's trees of the classes of this task, from all blocks; their margins are probabilities here."""
    tasks: dict[int, dict[int, dict]] = {}
    for p, part in found:
        blocks = tasks.setdefault(p, {})
        blocks[part["number"]] = blocks.get(part["number"], {}) | part
    for p, blocks in tasks.items():
        classes = np.arange(p, s.classes, parts)
        own = s._replace(classes=len(classes))
        held = [Block(blocks[number], own) for number in sorted(blocks)]
        g, h = zip(*(derivatives(b.margin, b.y[:, None] == classes, b.w, s) for b in held), strict=True)
        yield classes, grown_trees([b.x for b in held], g, h, [drawn_rows(b, s, r) for b in held], drawn_columns(s, r)[classes], own)[0]


def _class_trees(blocks: RDD, fixed: RDD, s: Settings, r: int, parts: int) -> Trees:
    """The trees of a round, each grown whole by a task that has all rows; one row a task comes to the driver."""
    asked = blocks.mapPartitions(lambda it: _asked(it, s, parts)).partitionBy(parts, int)
    out = Trees.empty(1, s)
    for classes, trees in blocks.ctx.union([fixed, asked]).mapPartitions(lambda it: _grown(it, s, r, parts)).collect():
        for field, found in zip(out, trees, strict=True):
            field[0, classes] = found[0]
    return out


def _advance(batches: Iterable[pa.RecordBatch], s: Settings, since: Trees) -> Iterator[pa.RecordBatch]:
    for row, b in _blocks(batches, s):
        add_rounds(b.margin, b.x, since, s)
        yield pa.RecordBatch.from_pylist([row | {"margin": b.margin.tobytes()}], schema=_arrow(BLOCK))


def _advanced(rows: Iterable[dict], s: Settings, since: Trees) -> Iterator[dict]:
    for row in rows:
        b = Block(row, s)
        add_rounds(b.margin, b.x, since, s)
        yield row | {"margin": b.margin.tobytes()}


def _loss(rows: Iterable[dict], s: Settings) -> Iterator[tuple[float, int]]:
    for b in (Block(row, s) for row in rows):
        yield float(losses(b.margin[b.held], b.y[b.held]).sum()), int(b.held.sum())


def stops(seen: Sequence[float], patience: int | None) -> bool:
    """Whether the last ``patience`` rounds brought no loss below the best before them."""
    return bool(patience) and bool(len(seen)) and not math.isnan(seen[0]) and len(seen) - 1 - int(np.argmin(seen)) >= patience


class Boosted:
    """A fitted ensemble.  losses: validation loss after each round (NaN without validation rows)."""

    def __init__(self, features: Sequence[str], edges: list[np.ndarray], settings: Settings, trees: Trees, losses: Sequence[float]):
        self.features, self.edges, self.settings, self.trees, self.losses = list(features), edges, settings, trees, list(losses)

    @property
    def rounds(self) -> int:
        return len(self.trees.feature)

    @property
    def best_round(self) -> int:
        """The round (from 1) with the least validation loss; the last one without validation."""
        return int(np.argmin(self.losses)) + 1 if self.losses and not math.isnan(self.losses[0]) else self.rounds

    def upto(self, rounds: int) -> Boosted:
        """The ensemble as it was after so many rounds."""
        return Boosted(self.features, self.edges, self.settings, self.trees.of(0, rounds), self.losses[:rounds])

    def margins_of(self, x: np.ndarray) -> np.ndarray:
        """Margins (row, class) of a feature matrix."""
        out = np.zeros((len(x), self.settings.classes))
        add_rounds(out, binned(x, self.edges), self.trees, self.settings)
        return out

    def score(self, df: DataFrame, out: str = "probs") -> DataFrame:
        """df with the array of class probabilities (two of them for logistic loss), which sum to 1."""
        arrays, rows = df.sparkSession.sparkContext.broadcast((self.features, self.edges, tuple(self.settings), tuple(self.trees))), df.drop(out)

        def scored(batches):
            features, edges, settings, trees = arrays.value
            model = Boosted(features, edges, Settings(*settings), Trees(*trees), [])
            for batch in batches:
                p = probabilities(model.margins_of(_floats(batch, features)))
                p = np.hstack([1 - p, p]) if p.shape[1] == 1 else p
                column = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32()), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, out])

        return rows.mapInArrow(scored, T.StructType([*rows.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))]))

    def importances(self, top: int | None = None) -> list[tuple[str, float]]:
        """Each feature's share of all gains, highest first."""
        gains = np.bincount(self.trees.feature[self.trees.feature >= 0], self.trees.gain[self.trees.feature >= 0], len(self.features))
        pairs = sorted(zip(self.features, gains / (gains.sum() or 1.0), strict=True), key=lambda t: (-t[1], t[0]))
        return pairs[:top] if top else pairs

    def save(self, spark: SparkSession, path: str) -> None:
        """One row a round, and one that describes the model (round -1)."""
        about = json.dumps({"features": self.features, "edges": [e.tolist() for e in self.edges], "settings": self.settings._asdict()})
        losses = [*self.losses, *[math.nan] * (self.rounds - len(self.losses))]
        rows = [(-1, math.nan, about, *[None] * len(Trees._fields))] + [(r, losses[r], None, *[a[r].tobytes() for a in self.trees]) for r in range(self.rounds)]
        schema = T.StructType([*ROUND.fields[:2], T.StructField("about", T.StringType()), *ROUND.fields[2:]])
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Boosted:
        about, *rounds = spark.read.parquet(path).orderBy("round").collect()
        d = json.loads(about["about"])
        s = Settings(**d["settings"])
        return cls(d["features"], [np.array(e) for e in d["edges"]], s, _read_rounds(rounds, s), [r["loss"] for r in rounds])


def _read_rounds(rows: Sequence, s: Settings) -> Trees:
    empty = Trees.empty(1, s)
    return Trees.joined([Trees.empty(0, s), *[Trees(*(np.frombuffer(r[f], e.dtype).reshape(e.shape).copy() for f, e in zip(Trees._fields, empty, strict=True))) for r in rows]])


def boost(df: DataFrame, features: Sequence[str], label: str, *, classes: int, weight: str | None = None, validation: str | None = None, rounds: int = 200, depth: int = 6, rate: float = 0.05,
          l2: float = 1.0, least_hessian: float = 1.0, rows_share: float = 0.9, columns_share: float = 0.9, bins: int = 64, patience: int | None = None, seed: int = 42,
          model: Boosted | None = None, block_rows: int = 1 << 14, task_rows: int = 1 << 18, keep_every: int = 25, task_bytes: int = 1 << 27) -> Boosted:
    """Fit ``rounds`` rounds (a tree a class each) to all rows of ``df``.

    label: class index from 0 (with ``classes=1``: 0 or 1, logistic loss).  Rows whose ``validation``
    column is true are not learned from; after each round their mean loss is taken, and with ``patience``
    fitting ends that many rounds after the best.  Rows with a null label, weight or mark are left out;
    a missing feature value goes the way that gains more.  In each round a row takes part with
    chance ``rows_share`` (drawn by its own hash) and each tree splits on ``columns_share`` of the features.

    With ``model`` fitting goes on from that model's last round, to ``rounds`` in all, with its bins and
    settings; the result is that of one run.  Rows are dealt over all cores, at most ``task_rows`` a task.  Blocks are
    kept in memory (on disk beyond it) with the margins of the round and checkpointed after every ``keep_every`` rounds,
    so a lost executor costs at most so many rounds of its rows.  With a class for every core and rows that take up to ``task_bytes``
    of a task, a round is one job whose tasks have all rows and grow whole trees; else a level is a job.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    features = list(features)
    if rounds and not 2 <= bins <= 254:
        raise ValueError("bins: 2 to 254")
    held = F.col(validation).cast("boolean") if validation else F.lit(False)
    rows = df.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("int").alias("_y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_w"),
                     held.alias("_held"), F.xxhash64(*[F.col(f).cast("double") for f in features], F.col(label).cast("int")).alias("_key"))
    rows = rows.where("_y IS NOT NULL AND _w IS NOT NULL AND _held IS NOT NULL")
    edges = model.edges if model else bin_edges(rows.where("NOT _held"), features, bins)
    k = model.settings.classes if model else classes
    n = rows.count()
    parts = max(1, -(-n // task_rows), min(-(-n // block_rows), spark.sparkContext.defaultParallelism))
    blocks = rows.repartition(parts).mapInArrow(lambda it: _pack(it, features, edges, k, block_rows), BLOCK).checkpoint()
    size = blocks.agg(F.count("*").alias("blocks"), F.sum("weight").alias("all"), F.max("missing").alias("missing")).first()
    if model:
        s, since, seen = model.settings, model.trees, list(model.losses)
    else:
        # rounded to multiples of a power of two that is small enough for sums of all rows to be exact in doubles
        room = min(40, 51 - math.ceil(math.log2((size["all"] or 0) + 2)))
        s = Settings(classes, len(features), depth, rate, l2, least_hessian, rows_share, columns_share, bins, seed, 2.0**room, bool(size["missing"]))
        since, seen = Trees.empty(0, s), []
    if size["blocks"] == 1:
        start, first = spark.sparkContext.broadcast(tuple(since)), len(since.feature)
        got = blocks.mapInArrow(lambda it: _advance(it, s, Trees(*start.value)), BLOCK).mapInArrow(lambda it: _whole(it, s, first, rounds, patience, seen), ROUND).collect()
        return Boosted(features, edges, s, Trees.joined([since, _read_rounds(got, s)]), seen + [r["loss"] for r in got])
    if not size["blocks"]:
        more = max(rounds - len(since.feature), 0)
        return Boosted(features, edges, s, Trees.joined([since, Trees.empty(more, s)]), seen + [math.nan] * more)
    kept = blocks.rdd.map(lambda row: {c: bytes(v) if isinstance(v, bytearray) else v for c, v in row.asDict().items()}).zipWithIndex().map(lambda e: e[0] | {"number": e[1]})
    last, done, tasks = since, since, min(s.classes, spark.sparkContext.defaultParallelism)
    by_class = 1 < s.classes >= spark.sparkContext.defaultParallelism and n * (s.features + 21 + 40 * -(-s.classes // tasks)) <= task_bytes
    fixed = kept.mapPartitions(lambda it: _dealt(it, tasks)).partitionBy(tasks, int).persist(StorageLevel.MEMORY_AND_DISK) if by_class else None
    for r in range(len(done.feature), rounds):
        if stops(seen, patience):
            break
        before, kept = kept, kept.mapPartitions(lambda it, last=last: _advanced(it, s, last)).persist(StorageLevel.MEMORY_AND_DISK)
        if (r - len(since.feature)) % keep_every == keep_every - 1:
            kept.checkpoint()
        if by_class:
            growing = _class_trees(kept, fixed, s, r, tasks)
            before.unpersist()
        else:
            growing, tree, node = Trees.empty(1, s), np.arange(s.classes), np.zeros(s.classes, dtype=np.int64)
            for level in range(s.depth):
                if not len(tree):
                    break
                tree, node = _worth(growing, *_settle(growing, tree, node, _level_splits(kept, s, growing, r, tree, node), s), s)
                if not level:
                    before.unpersist()
        last, done = growing, Trees.joined([done, growing])
        loss = math.nan
        if validation:
            after = kept.mapPartitions(lambda it, last=last: _advanced(it, s, last))
            found = after.mapPartitions(lambda it: _loss(it, s)).collect()             # two numbers a block
            total, held_rows = math.fsum(t for t, _ in found), sum(m for _, m in found)
            loss = total / held_rows if held_rows else math.nan
        seen.append(loss)
    kept.unpersist()
    if by_class:
        fixed.unpersist()
    return Boosted(features, edges, s, done, seen)
