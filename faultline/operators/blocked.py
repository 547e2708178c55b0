"""Run-blocked execution: per-run sequential logic without per-run tasks.

A *run* (one simulation / one device stream) can be arbitrarily long, and one
run may hold a large share of all rows.  A window partitioned by the run key
alone sends that whole run to one task.  Every per-run operator in this
package is therefore expressed over **(run key, block)** groups, where a block
is a fixed span of ``block`` consecutive positions of the run:

* bounded look-back frames (rolling windows, ``lag``) duplicate the last
  ``halo`` rows of each block into the next block, compute the window inside
  the (run, block) group, and keep only the block's own rows;
* look-ahead frames (``lead``) duplicate the first rows of the next block;
* prefix quantities (running sums, running max, EWMA carries, state-machine
  states) are computed locally per block and combined on the table of blocks
  (one row for ``block`` rows of data): by a window where a sum or maximum
  will do, else with a pointer-doubling scan of equi-joins on (run key, rank -
  2^r).  Joins of rows keyed by (run, block) never concentrate a run in one task.

Every run takes the same path, whatever its length.  Positions may start
anywhere and have gaps unless a caller asserts that they are dense.

All of it is built from DataFrame operators (windows, joins, ``explode``);
no group ever holds more than ``block + halo`` rows.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

DEFAULT_BLOCK = 1024
BLK = "_blk"
HOME = "_home"


def block_of(pos: str | Column, block: int) -> Column:
    p = F.col(pos) if isinstance(pos, str) else pos
    return F.floor((p - F.lit(1)) / F.lit(block)).cast("long")


def with_halo(df: DataFrame, pos: str, block: int, before: int = 0, after: int = 0) -> DataFrame:
    """Assign rows to blocks and replicate boundary rows into neighbour blocks.

    Adds ``_blk`` (block id) and ``_home`` (True for the row's own block).  A row
    whose offset inside its block is ``>= block - before`` is also emitted into
    the next block; a row whose offset is ``< after`` also into the previous one.
    One scan, one ``explode``; the replicated share is ``(before+after)/block``.
    """
    if before > block or after > block:
        raise ValueError("halo larger than block")
    off = (F.col(pos) - F.lit(1)) % F.lit(block)
    shifts = F.array(F.lit(0))
    if before:
        shifts = F.when(off >= F.lit(block - before), F.array_append(shifts, F.lit(1))).otherwise(shifts)
    if after:
        shifts = F.when(off < F.lit(after), F.array_append(shifts, F.lit(-1))).otherwise(shifts)
    return (df.withColumn("_shift", F.explode(shifts))
            .withColumn(BLK, block_of(pos, block) + F.col("_shift"))
            .withColumn(HOME, F.col("_shift") == 0)
            .drop("_shift"))


def block_window(key: str | Sequence[str], pos: str) -> Window:
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys, BLK).orderBy(pos)


def dense_rows(df: DataFrame, key: str | Sequence[str], pos: str, out: str = "_row", block: int = DEFAULT_BLOCK) -> DataFrame:
    """``df`` with ``out``, the row's 1-based place in its run ordered by ``pos`` (which may
    start anywhere and have gaps): the place inside the (run, block of positions) plus
    the rows of the run's earlier blocks, summed on the table of blocks."""
    keys = [key] if isinstance(key, str) else list(key)
    d = df.withColumn(BLK, block_of(pos, block))
    before = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = d.groupBy(*keys, BLK).agg(F.count(F.lit(1)).alias("_n")).select(*keys, BLK, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    d = d.withColumn("_local", F.row_number().over(block_window(key, pos)))
    return d.join(offsets, keys + [BLK]).withColumn(out, F.col("_off") + F.col("_local")).drop("_off", "_local", BLK)


def halo_select(df: DataFrame, key: str | Sequence[str], pos: str,
                exprs: Callable[[Window], list[Column]], before: int = 0, after: int = 0,
                block: int = DEFAULT_BLOCK, dense: bool = False) -> DataFrame:
    """``df`` plus the columns ``exprs(w)``, where ``w`` is the run window.

    The result equals ``df.select("*", *exprs(Window.partitionBy(key).orderBy(pos)))``
    for frames reaching at most ``before`` rows back and ``after`` rows ahead.
    ``dense=True`` asserts that the positions of a run have no gaps (they may
    start anywhere) and saves the numbering of the rows, one exchange.
    """
    block = max(block, before, after, 1)
    place = pos
    if not dense:
        df, place = dense_rows(df, key, pos, block=block), "_row"
    ext = with_halo(df, place, block, before, after)
    w = block_window(key, place)
    out = ext.select("*", *exprs(w)).where(F.col(HOME)).drop(BLK, HOME)
    return out if dense else out.drop(place)


# --------------------------------------------------------------------------
# Prefix scans across blocks
# --------------------------------------------------------------------------
def doubling_scan(blocks: DataFrame, key: str | Sequence[str], values: Sequence[str],
                  combine: Callable[[dict[str, Column], dict[str, Column]], dict[str, Column]]) -> DataFrame:
    """Exclusive prefix over blocks: row k gets ``v_0 (+) ... (+) v_(k-1)``, null for the first block.

    ``blocks`` has one row per (key, ``_blk``) with columns ``values``.
    ``combine(earlier, later)`` returns the combined values as Column
    expressions (it must be associative).  The blocks that exist are ranked in
    their run (a window over the table of blocks, one row for ``block`` rows of
    data), so block numbers may have gaps.  Each round joins every block with the one
    ``2^r`` ranks earlier, and the rounds end when no block has an unread
    predecessor.  Rounds are written out so lineage stays linear.
    """
    keys = [key] if isinstance(key, str) else list(key)
    in_run = Window.partitionBy(*keys).orderBy(BLK)
    cur = blocks.select(*keys, BLK, F.row_number().over(in_run).alias("_rank"), *values)
    cur = stored(cur, "scan")
    longest = cur.agg(F.max("_rank")).first()[0] or 0
    step = 1
    while step < longest - 1:        # the last block's own value is never needed
        earlier = cur.select(*keys, (F.col("_rank") + F.lit(step)).alias("_rank"), F.lit(True).alias("_met"),
                             *[F.col(v).alias(f"_e_{v}") for v in values])
        joined = cur.join(earlier, on=keys + ["_rank"], how="left")
        comb = combine({v: F.col(f"_e_{v}") for v in values}, {v: F.col(v) for v in values})
        cur = stored(joined.select(*keys, BLK, "_rank", *[F.when(F.col("_met"), comb[v]).otherwise(F.col(v)).alias(v) for v in values]), "scan")
        step *= 2
    return cur.select(*keys, BLK, *[F.lag(v).over(Window.partitionBy(*keys).orderBy("_rank")).alias(v) for v in values])


# --------------------------------------------------------------------------
# Exact dense ordinal without a per-key window
# --------------------------------------------------------------------------
def ordinal_within(df: DataFrame, key: str, order: Sequence[str], out: str = "pos") -> DataFrame:
    """``row_number() over (partition by key order by order)`` for any key skew, as a long.

    A global sort range-partitions the rows (a hot key is split over many
    partitions by the sampled range bounds).  The sorted rows are checkpointed
    so the partition layout is fixed; the global index of a row is the number
    of rows in earlier partitions plus its offset in its partition.  The first
    index of each key comes from a (partition, key) table whose size is at most
    #keys + #partitions, joined back on (partition, key) - again no hot key.
    """
    sorted_df = df.orderBy(key, *order).withColumn("_mid", F.monotonically_increasing_id())
    ck = sorted_df.checkpoint(eager=True)
    part = F.shiftright(F.col("_mid"), 33)
    within = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    ck = ck.withColumn("_p", part).withColumn("_i", within)
    counts = ck.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by the partition count, safe to broadcast
    offsets = counts.select("_p", (F.coalesce(F.sum("_n").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_off"))
    g = ck.join(F.broadcast(offsets), "_p").withColumn("_g", F.col("_off") + F.col("_i"))
    firsts = (g.groupBy("_p", key).agg(F.min("_g").alias("_gm"))
              .withColumn("_first", F.min("_gm").over(Window.partitionBy(key)))
              .drop("_gm"))
    res = g.join(firsts, ["_p", key]).withColumn(out, F.col("_g") - F.col("_first") + 1)
    return res.drop("_mid", "_p", "_i", "_off", "_g", "_first")


# --------------------------------------------------------------------------
# Global cumulative sums without a single-partition window
# --------------------------------------------------------------------------
def global_prefix(df: DataFrame, order_col: str, values: Sequence[str], buckets: int = 64,
                  bucket_expr: Column | None = None) -> DataFrame:
    """Cumulative sums of ``values`` in ascending ``order_col`` (ties included).

    A window with ``orderBy`` and no ``partitionBy`` runs in one task.  Here the
    order range is cut into ``buckets`` ranges at approximate quantiles (one
    small aggregate action); each range is summed by its own window, and the
    totals of earlier ranges (a table of ``buckets`` rows) are added back.
    The result is exact; only the balance of the ranges is approximate.
    Output: the input columns with ``values`` replaced by their cumulative
    sums and the original values kept as ``_d_<value>``.
    """
    if bucket_expr is None:
        qs = [i / buckets for i in range(1, buckets)]
        row = df.agg(F.percentile_approx(F.col(order_col), qs, 10000).alias("q")).first()
        bounds = sorted({float(b) for b in (row["q"] or []) if b is not None})
        arr = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<double>")
        bucket_expr = F.size(F.filter(arr, lambda b: F.col(order_col).cast("double") > b))
    # bucket_expr must be monotone in order_col
    d = df.withColumn("_bkt", bucket_expr)
    for v in values:
        d = d.withColumn(f"_d_{v}", F.col(v))
    w = Window.partitionBy("_bkt").orderBy(order_col).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    local = d.select("*", *[F.sum(f"_d_{v}").over(w).alias(f"_l_{v}") for v in values])
    tot = d.groupBy("_bkt").agg(*[F.sum(f"_d_{v}").alias(f"_t_{v}") for v in values])
    wb = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    carry = tot.select("_bkt", *[F.coalesce(F.sum(f"_t_{v}").over(wb), F.lit(0)).alias(f"_c_{v}") for v in values])
    out = local.join(F.broadcast(carry), "_bkt")
    for v in values:
        out = out.withColumn(v, F.col(f"_l_{v}") + F.col(f"_c_{v}")).drop(f"_l_{v}", f"_c_{v}")
    return out.drop("_bkt")


def running_agg(df: DataFrame, key: str | Sequence[str], pos: str, value: Column, out: str, how: str = "sum",
                block: int = DEFAULT_BLOCK) -> DataFrame:
    """Running ``sum`` or ``max`` of ``value`` from the start of the run (inclusive).

    Local running aggregate per (run, block) window, plus that of the run's
    earlier blocks (a window over the table of block totals).  Nulls are skipped.
    """
    keys = [key] if isinstance(key, str) else list(key)
    agg = F.sum if how == "sum" else F.max
    d = df.withColumn(BLK, block_of(pos, block)).withColumn("_v", value)
    w = Window.partitionBy(*keys, BLK).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    totals = d.groupBy(*keys, BLK).agg(agg("_v").alias("_t")).select(*keys, BLK, agg("_t").over(earlier).alias("_t"))
    res = d.withColumn("_loc", agg("_v").over(w)).join(totals, keys + [BLK], "left")
    val = (F.when(F.col("_loc").isNotNull() | F.col("_t").isNotNull(), F.coalesce("_loc", F.lit(0)) + F.coalesce("_t", F.lit(0)))
           if how == "sum" else F.greatest(F.col("_loc"), F.col("_t")))
    return res.withColumn(out, val).drop("_v", "_loc", "_t", BLK)
