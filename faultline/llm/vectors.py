"""Near-duplicate vectors by product quantisation.

Coarse inverted lists: every vector belongs to the cell of its nearest centroid,
and its residual is coded in subspaces.  Every vector is also a query: it probes
its own cell and all cells whose border it is near enough to, measures distances
to the codes there by table look-up, and the pairs that the code's own error
cannot rule out are compared exactly.
"""
from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, grouped, keep, smallest_in_reach


class Index(NamedTuple):
    top: np.ndarray            # (groups, d) centroids of groups of cells
    centroids: np.ndarray      # (cells, d), the cells of a group side by side
    first: np.ndarray          # where each group's cells begin, and the number of cells
    books: list[np.ndarray]    # of each subspace (codewords, width)
    bounds: list[int]          # where the subspaces begin, and d
    reach: float               # past the border of two cells a query still probes, for each unit between their centroids


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each row, and all values of x.c - |c|^2 / 2 (the greater, the nearer)."""
    near = x @ centroids.T - (centroids**2).sum(1) / 2
    return near.argmax(1), near


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = max(1, min(k, len(x)))
    centre = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([nearest(x[i:i + 8192], centre)[0] for i in range(0, len(x), 8192)])
        count = np.bincount(own, minlength=k)
        order = np.argsort(own, kind="stable")
        used = np.flatnonzero(count)
        centre[used] = np.add.reduceat(x[order], (np.cumsum(count) - count)[used]) / count[used, None]
    return centre


def fit_index(sample: np.ndarray, cells: int, radius: float, *, subspaces: int = 8, codewords: int = 256, margin: float = 3.0, seed: int = 11) -> Index:
    """Centroids and codebooks from sampled unit vectors.

    Cells are found in two steps, sqrt(cells) groups first and then the cells of each group, so that fitting and
    placing cost sqrt(cells) distances a vector.

    reach: a neighbour's offset of length ``radius`` in an unrelated direction has a component of
    about radius / sqrt(dimension) along the line between two centroids; queries probe a group or cell
    up to ``margin`` such deviations beyond its border.  The dimension is the effective one
    of the residuals, (sum of eigenvalues)^2 / sum of their squares."""
    sample = sample.astype(np.float32)
    d = sample.shape[1]
    top = kmeans(sample, math.ceil(math.sqrt(cells)), 8, seed)
    group = np.concatenate([nearest(sample[i:i + 8192], top)[0] for i in range(0, len(sample), 8192)])
    inner = []
    for g in range(len(top)):
        mine = sample[group == g]
        inner.append(kmeans(mine, round(cells * len(mine) / len(sample)), 8, seed + g) if len(mine) else top[g:g + 1])
    centroids, first = np.concatenate(inner), np.cumsum([0, *map(len, inner)])
    residual = np.empty_like(sample)
    for g, centre in enumerate(inner):
        at = np.flatnonzero(group == g)
        residual[at] = sample[at] - centre[nearest(sample[at], centre)[0]]
    bounds = [round(k * d / min(subspaces, d)) for k in range(min(subspaces, d) + 1)]
    words = max(1, min(codewords, len(sample) // 8))
    books = [kmeans(residual[:, a:z], words, 6, seed + a) for a, z in zip(bounds[:-1], bounds[1:], strict=True)]
    spread = np.cov(residual.T).reshape(d, d) if len(sample) > 2 else np.eye(d)
    effective = max(1.0, np.trace(spread) ** 2 / max((spread**2).sum(), 1e-12))
    return Index(top, centroids, first, books, bounds, margin * radius / math.sqrt(effective))


def probed(x: np.ndarray, index: Index) -> tuple[np.ndarray, list[np.ndarray]]:
    """Own cell and probed cells (ascending) of each row.

    Groups are chosen by their borders; the own cell is the nearest one of them all, and the cells of all of them
    are tested against its borders."""
    def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * a @ b.T, 0))

    home, near = nearest(x, index.top)
    groups = near[np.arange(len(x)), home][:, None] - near <= index.reach * distance(index.top, index.top)[home]
    groups[np.arange(len(x)), home] = True
    asked = [(slice(*index.first[g:g + 2]), np.flatnonzero(groups[:, g])) for g in np.flatnonzero(groups.any(0))]
    own, most = np.zeros(len(x), dtype=np.int64), np.full(len(x), -np.inf, dtype=np.float32)
    for cells, row in asked:
        best, near = nearest(x[row], index.centroids[cells])
        near = near[np.arange(len(row)), best]
        more = near > most[row]
        own[row[more]], most[row[more]] = best[more] + cells.start, near[more]
    found = []
    for cells, row in asked:
        centre = index.centroids[cells]
        q, cell = np.nonzero(most[row][:, None] - nearest(x[row], centre)[1] <= index.reach * distance(index.centroids[own[row]], centre) + 1e-6)
        found.append(np.stack([row[q], cell + cells.start]))
    row, cell = np.concatenate(found, axis=1)
    cell = cell[np.argsort(row, kind="stable")].astype(np.int32)
    return own, np.split(cell, np.cumsum(np.bincount(row, minlength=len(x)))[:-1])


def place(unit: np.ndarray, index: Index) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Own cell, probed cells, codes and coding error of each unit vector."""
    x = unit.astype(np.float32)
    own, probes = probed(x, index)
    residual = x - index.centroids[own]
    codes = np.stack([nearest(residual[:, a:z], book)[0] for a, z, book in zip(index.bounds[:-1], index.bounds[1:], index.books, strict=True)], axis=1)
    back = np.concatenate([book[codes[:, k]] for k, book in enumerate(index.books)], axis=1)
    error = np.sqrt(((residual - back).astype(np.float64) ** 2).sum(1))
    return own, probes, codes.astype(np.uint8), error


def code_distances(x: np.ndarray, cell: int, codes: np.ndarray, index: Index) -> np.ndarray:
    """Asymmetric distances: exact query, coded members, one look-up a subspace."""
    residual = x.astype(np.float32) - index.centroids[cell]
    total = np.zeros((len(x), len(codes)), dtype=np.float32)
    for k, book in enumerate(index.books):
        part = residual[:, index.bounds[k]:index.bounds[k + 1]]
        table = (part**2).sum(1)[:, None] + (book**2).sum(1)[None, :] - 2 * part @ book.T
        total += table[:, codes[:, k]]
    return np.sqrt(np.maximum(total, 0))


def _prepare(batches: Iterable[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    """id and unit vector, shorter ones padded to ``d``; null for rows that can't be compared."""
    for batch in batches:
        column = batch.column("v").cast(pa.list_(pa.float64()))
        size = np.array(pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        values = column.flatten().to_numpy(zero_copy_only=False)      # null components read as nan
        values, fits = values[np.repeat(size <= d, size)], size <= d
        size = np.where(fits, size, 0)
        x = np.zeros((len(size), d))
        row = np.repeat(np.arange(len(size)), size)
        x[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = values
        with np.errstate(all="ignore"):
            x /= np.abs(x).max(1, initial=0, keepdims=True)           # no overflow in the squares
            x /= np.sqrt((x**2).sum(1, keepdims=True))
        good = np.isfinite(x).all(1) & (size > 0)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([r.tobytes() if g else None for r, g in zip(x + 0.0, good, strict=True)], pa.binary())], ["id", "unit"])


def _rows(column: pa.ChunkedArray | pa.Array, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(-1, width)


def _compare(table: pa.Table, cell: int, index: Index, d: int, least: float) -> pa.RecordBatch | None:
    """All links between the queries and the members of one task, summed by vector."""
    member = table.filter(pa.array(table["member"].to_numpy()))
    query = table.filter(pa.array(~table["member"].to_numpy()))
    if not len(member) or not len(query):
        return None
    cells = len(index.centroids)
    ids = [t["id"].to_numpy() for t in (query, member)]
    x, y = _rows(query["unit"], np.float64, d), _rows(member["unit"], np.float64, d)
    codes, error = _rows(member["code"], np.uint8, len(index.books)), member["error"].to_numpy()
    home = query["cell"].to_numpy()
    probes = member["probes"].combine_chunks()
    listed = np.sort(np.repeat(np.arange(len(member)), np.diff(probes.offsets.to_numpy())) * cells + probes.flatten().to_numpy())
    radius = math.sqrt(max(0.0, 2 - 2 * least)) + 1e-3        # 1e-3: float32 tables
    found = []
    for i in range(0, len(x), 256):
        q, m = np.nonzero(code_distances(x[i:i + 256], cell, codes, index) <= radius + error[None, :])
        q += i
        # each pair once: inside a cell from the smaller id, else from the smaller cell, or from the only side that probes
        other = home[q] != cell
        want = m * cells + home[q]
        at = np.minimum(np.searchsorted(listed, want), max(len(listed) - 1, 0))
        both = listed[at] == want if len(listed) else np.zeros(len(q), dtype=bool)
        ok = np.where(other, (home[q] < cell) | ~both, ids[0][q] < ids[1][m])
        q, m = q[ok], m[ok]
        for k in range(0, len(q), 16384):
            a, b = q[k:k + 16384], m[k:k + 16384]
            link = np.einsum("ij,ij->i", x[a], y[b]) >= least
            found.append((a[link], b[link]))
    q, m = (np.concatenate([f[k] for f in found]) for k in (0, 1)) if found else (np.zeros(0, int), np.zeros(0, int))
    if not len(q):
        return None
    weight = [t["weight"].to_numpy() for t in (query, member)]
    all_ids, at = np.unique(np.concatenate([ids[0][q], ids[1][m]]), return_inverse=True)
    a, b = at[:len(q)], at[len(q):]
    links = np.bincount(a, weights=weight[1][m], minlength=len(all_ids)) + np.bincount(b, weights=weight[0][q], minlength=len(all_ids))
    low = smallest_in_reach(len(all_ids), a, b)
    return pa.RecordBatch.from_arrays([pa.array(all_ids, pa.int64()), pa.array(links.astype(np.int64)), pa.array(all_ids[low], pa.int64())], ["id", "links", "low"])


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95,
                    sample_rows: int = 32_768, block_rows: int = 1024) -> DataFrame:
    """(id, n_links, component): links are pairs with a cosine of ``least`` or more.

    Equal vectors are one class and are compared once.  A vector that is null, empty or
    zero, or holds null or non-finite components, links with nothing.  Shorter vectors
    than most count as padded with zeros; one that is longer than the commonest length (of
    two equally common ones the longer) is malformed and links with nothing.  Repeated rows are
    vectors of their own.  ids are integers; a row with a null id is left out.

    The index holds all vectors.  It has 4 sqrt(n) cells and is fitted on about ``sample_rows`` vectors
    (chosen by a hash), or on four a cell if that is more: 16 sqrt(n), half a million for a thousand million.
    Cells with over ``block_rows`` members or queries are dealt in blocks of that size to
    several tasks, so that a task never holds a whole hot cell.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v")).where("id IS NOT NULL")
    common = rows.where(F.size("v") > 0).groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = common["d"] if common else 0
    if not d:
        return rows.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component"))
    unit = keep(rows.mapInArrow(lambda it: _prepare(it, d), "id long, unit binary"))
    classes = keep(unit.where("unit IS NOT NULL").groupBy("unit").agg(F.min("id").alias("id"), F.count("*").alias("weight")))
    n = classes.count()
    cells = math.ceil(4 * math.sqrt(n))
    share = min(1.0, max(sample_rows, 4 * cells) / max(n, 1))
    sample = classes.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * share)).select("unit").toArrow()["unit"]
    points = np.sort(np.array(sample.to_pylist(), dtype=object)) if len(sample) else []
    points = np.frombuffer(b"".join(points), dtype=np.float64).reshape(-1, d) if len(points) else np.eye(1, d)
    cells = max(1, min(cells, len(points) // 4))
    shared = spark.sparkContext.broadcast(fit_index(points, cells, math.sqrt(max(0.0, 2 - 2 * least))))

    def indexed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 2048):
                b = whole.slice(i, 2048)
                own, probes, codes, error = place(_rows(b.column("unit"), np.float64, d), shared.value)
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("id", "weight", "unit")], pa.array(own, pa.int32()), pa.array(probes, pa.list_(pa.int32())),
                                                  pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)], ["id", "weight", "unit", "cell", "probes", "code", "error"])

    index = keep(classes.select("id", "weight", "unit").mapInArrow(indexed, "id long, weight long, unit binary, cell int, probes array<int>, code binary, error double"))
    # blocks of a cell's members and queries: at most one row a cell
    count = index.groupBy("cell").agg(F.count("*").alias("m"))
    asked = index.select(F.explode("probes").alias("cell")).groupBy("cell").agg(F.count("*").alias("q"))
    size = {r["cell"]: (-(-r["m"] // block_rows), -(-r["q"] // block_rows)) for r in count.join(asked, "cell").collect()}
    sizes = spark.sparkContext.broadcast(size)

    def dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 1024):
                b = whole.slice(i, 1024)
                task, row, member = [], [], []
                for k, (x, cell, probes) in enumerate(zip(b.column("id").to_pylist(), b.column("cell").to_pylist(), b.column("probes").to_pylist(), strict=True)):
                    h = (x * 0x9E3779B97F4A7C15 >> 20) & 0xFFFFFFFF
                    m, q = sizes.value[cell]
                    task += [(cell << 40) | (h % m) << 20 | j for j in range(q)]
                    row += [k] * q
                    member += [True] * q
                    for c in probes:
                        m, q = sizes.value.get(c, (0, 1))
                        task += [(c << 40) | j << 20 | h % q for j in range(m)]
                        row += [k] * m
                        member += [False] * m
                every, members = pa.array(row, pa.int64()), pa.array([k if m else None for k, m in zip(row, member, strict=True)], pa.int64())
                # a query needs neither code nor probes
                columns = [b.column(c).take(members if c in ("probes", "code") else every) for c in b.schema.names]
                yield pa.RecordBatch.from_arrays([pa.array(task, pa.int64()), pa.array(member), *columns], ["task", "member", *b.schema.names])

    def linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task, table in grouped(batches, "task"):
            got = _compare(table, int(task) >> 40, shared.value, d, least)
            if got is not None:
                yield got

    schema = T.StructType([T.StructField("task", T.LongType()), T.StructField("member", T.BooleanType()), *index.schema.fields])
    found = keep(index.mapInArrow(dealt, schema).repartition("task").sortWithinPartitions("task").mapInArrow(linked, "id long, links long, low long"))
    per_class = (classes.select("id", "weight", "unit").join(found.groupBy("id").agg(F.sum("links").alias("links")), "id", "left")
                 .join(components(classes, found.select(F.col("id").alias("a"), F.col("low").alias("b"))), "id", "left")
                 .select("unit", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component"))
    return unit.join(per_class, "unit", "left").select("id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), F.coalesce("component", "id").alias("component"))
