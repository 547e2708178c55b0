"""Alarm management: EWMA, baselines, tail-widened bands, breach/clear/ROC
flags, the deadband latch, KPIs and alarm episodes.

Everything is per run and ordered by a position (``sample``), which may
start anywhere and have gaps, and everything runs on (run, block) groups:

* EWMA ``z_i = a x_i + (1-a) z_{i-1}``, ``z_0 = x_0`` is an affine recurrence.
  Inside a block it has the closed form ``a d^r * sum_j d^-r_j x_j`` (a running
  window sum; ``d = 1 - a``, ``r`` = values before it in the block); the value entering a
  block is the composition of the earlier blocks' affine maps, combined by the
  doubling scan.  The block length is capped so ``d^-r`` stays below e^600.
* The deadband latch is a finite-state machine with a bounded state space.
  Every block's transition map (end state for every start state, as runs of
  start states that end alike) is computed from the block's rows alone; maps compose
  associatively and shrink (doubling scan on the JVM); finally each
  block is replayed from its now-known start state.  Batch and stream step
  through the same array of moves.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import BASELINE_EPS, SAMPLE_MINUTES
from ..session import stored
from .blocked import BLK, DEFAULT_BLOCK, block_of, doubling_scan, halo_select, running_agg


@dataclass(frozen=True)
class Tuning:
    alpha: float = 0.05
    sigma: float = 4.5
    pad: float = 55.0
    n_on: int = 5
    n_off: int = 32
    lockout: int = 90
    max_latch: int | None = 72
    roc_mult: float = 3.0
    hysteresis: float | None = 28.0
    tail: float = 0.35

    @classmethod
    def of(cls, d: dict) -> "Tuning":
        return cls(**d)


# --------------------------------------------------------------------------
# E4 EWMA
# --------------------------------------------------------------------------
def ewma_block_len(alpha: float, block: int) -> int:
    d = 1.0 - alpha
    if d <= 0.0:
        return block
    return max(1, min(block, int(600.0 / -math.log(d))))


def ewma(df: DataFrame, col: str, out: str, alpha: float, key: str = "run_key", pos: str = "sample",
         block: int = DEFAULT_BLOCK, diff_out: str | None = None) -> DataFrame:
    """Exponentially weighted moving average per run, seeded by the run's first value.

    The recurrence steps from row to row in ``pos`` order; gaps in ``pos`` have no
    weight.  A null value leaves the average as it is, and rows before the first
    value have none.

    ``diff_out`` also adds |z_i - z_(i-1)| (0 on the first row and where there is
    no average yet, E3 on the EWMA) inside the same (run, block) window: the previous
    value is ``lag(z)``, or, on a block's first row, the carry entering the block."""
    x = F.col(col).cast("double")
    d = 1.0 - alpha
    b = ewma_block_len(alpha, block)
    w = Window.partitionBy(key, BLK).orderBy(pos)
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    # _m: values so far in the block; _loc: what they add up to, had the block begun at 0
    rows = df.withColumn(BLK, block_of(pos, b)).withColumn("_m", F.count(x).over(running).cast("double"))
    decay = F.pow(F.lit(d), F.col("_m")) if d > 0 else F.when(F.col("_m") > 0, F.lit(0.0)).otherwise(F.lit(1.0))
    if d > 0:
        local = F.lit(alpha) * F.pow(F.lit(d), F.col("_m") - 1) * F.coalesce(F.sum(x * F.pow(F.lit(d), 1 - F.col("_m"))).over(running), F.lit(0.0))
    else:
        local = F.coalesce(F.last(x, ignorenulls=True).over(running), F.lit(0.0))
    rows = (rows.withColumn("_loc", local).withColumn("_dec", decay)
            .withColumn("_seeded", F.col("_loc") + F.col("_dec") * F.first(x, ignorenulls=True).over(running)))
    rows = stored(rows, "ewma")              # read by the block maps and by the rows that they are joined to
    # a block maps the value that enters it, c, to a c + b; without one it ends at s
    maps = rows.groupBy(key, BLK).agg(F.max_by("_dec", pos).alias("_a"), F.max_by("_loc", pos).alias("_b"), F.max_by("_seeded", pos).alias("_s"))

    def comb(e, lt):
        return {"_a": lt["_a"] * e["_a"], "_b": lt["_a"] * e["_b"] + lt["_b"], "_s": F.coalesce(lt["_a"] * e["_s"] + lt["_b"], lt["_s"])}
    carry = doubling_scan(maps, key, ["_a", "_b", "_s"], comb).select(key, BLK, F.col("_s").alias("_c"))
    res = rows.join(carry, [key, BLK], "left").withColumn(out, F.coalesce(F.col("_loc") + F.col("_dec") * F.col("_c"), F.col("_seeded")))
    if diff_out:
        prev = F.coalesce(F.lag(out, 1).over(w), F.col("_c"))
        res = res.withColumn(diff_out, F.abs(F.coalesce(F.col(out) - prev, F.lit(0.0))))
    return res.drop(BLK, "_m", "_loc", "_dec", "_seeded", "_c")


# --------------------------------------------------------------------------
# D22 baselines, E3 ROC, E5-E7 band and flags
# --------------------------------------------------------------------------
def alarm_signals(df: DataFrame, col: str, inject: int, tuning: Tuning, key: str = "run_key",
                  pos: str = "sample", block: int = DEFAULT_BLOCK) -> DataFrame:
    """Per row: ``z`` (EWMA), ``roc_abs``, band limits, ``breach_naive``,
    ``breach`` (EWMA outside the padded band), ``in_clear`` (inside the inner
    hysteresis band), ``roc_pre`` (rate-of-change pre-alarm)."""
    z = stored(ewma(df, col, "z", tuning.alpha, key, pos, block, diff_out="roc_abs"), "signals")      # read by the baselines and by the rows
    # the baselines read only each run's pre-injection prefix (filter pushed to the scan), and the run length
    base = baselines(z.where(F.col(pos) <= inject), col, inject, tuning, key, pos).drop("t_max").join(z.groupBy(key).agg(F.max(pos).alias("t_max")), key, "right")
    j = z.join(base, key)
    ramp = F.least(F.greatest((F.col(pos).cast("double") - F.lit(inject)) /
                              F.greatest(F.col("t_max").cast("double") - F.lit(inject), F.lit(1.0)), F.lit(0.0)),
                   F.lit(1.0))
    sm = F.lit(tuning.sigma) + F.lit(tuning.tail) * ramp
    j = (j.withColumn("hi_t", F.col("mu_z") + sm * F.col("sig_z"))
          .withColumn("lo_t", F.col("mu_z") - sm * F.col("sig_z"))
          .withColumn("lo_pad", F.col("lo_t") - F.lit(tuning.pad))
          .withColumn("hi_pad", F.col("hi_t") + F.lit(tuning.pad)))
    y = F.col(col).cast("double")
    j = j.withColumn("breach_naive", (y < 0.9 * F.col("mu_raw")) | (y > 1.1 * F.col("mu_raw")))
    j = j.withColumn("breach", (F.col("z") < F.col("lo_pad")) | (F.col("z") > F.col("hi_pad")))
    if tuning.hysteresis is not None:
        j = j.withColumn("in_clear", (F.col("z") >= F.col("lo_pad") + F.lit(tuning.hysteresis)) &
                         (F.col("z") <= F.col("hi_pad") - F.lit(tuning.hysteresis)))
    else:
        j = j.withColumn("in_clear", ~F.col("breach"))
    return j.withColumn("roc_pre", (F.col("roc_abs") > F.col("roc_thr")) & ~F.col("breach"))


def baselines(z: DataFrame, col: str, inject: int, tuning: Tuning, key: str = "run_key",
              pos: str = "sample") -> DataFrame:
    """Pre-injection mean of the raw signal, mean and population std
    (+1e-12) of the EWMA and of |dEWMA|; ROC threshold; last sample."""
    pre = F.col(pos) <= inject
    return z.groupBy(key).agg(
        F.avg(F.when(pre, F.col(col).cast("double"))).alias("mu_raw"),
        F.avg(F.when(pre, F.col("z"))).alias("mu_z"),
        (F.stddev_pop(F.when(pre, F.col("z"))) + F.lit(BASELINE_EPS)).alias("sig_z"),
        F.avg(F.when(pre, F.col("roc_abs"))).alias("roc_mu"),
        (F.stddev_pop(F.when(pre, F.col("roc_abs"))) + F.lit(BASELINE_EPS)).alias("roc_sig"),
        F.max(pos).alias("t_max"),
    ).withColumn("roc_thr", F.col("roc_mu") + F.lit(tuning.roc_mult) * F.col("roc_sig"))


# --------------------------------------------------------------------------
# E8 deadband latch
# --------------------------------------------------------------------------
class Latch:
    """The latch state machine with an integer state encoding.

    State (cur, on, off, lock, latch).  Off-latch states: index
    ``on * (lockout + 1) + lock``; latched states: ``S0 + off * L + latch - 1``.
    State 0 is the initial state.
    """

    def __init__(self, n_on: int, n_off: int, lockout: int, max_latch: int | None):
        self.n_on, self.n_off, self.lockout, self.max_latch = n_on, n_off, lockout, max_latch
        self.L = max(max_latch - 1, 1) if max_latch is not None else 1
        self.S0 = max(n_on, 1) * (lockout + 1)
        self.S = self.S0 + max(n_off, 1) * self.L

    def decode(self, idx):
        idx = np.asarray(idx)
        latched = idx >= self.S0
        on = np.where(latched, 0, idx // (self.lockout + 1))
        lock = np.where(latched, 0, idx % (self.lockout + 1))
        rel = idx - self.S0
        off = np.where(latched, rel // self.L, 0)
        latch = np.where(latched, rel % self.L + 1, 0)
        return latched.astype(np.int64), on, off, lock, latch

    def encode(self, cur, on, off, lock, latch):
        latch_c = np.minimum(np.maximum(latch, 1), self.L) if self.max_latch is None else latch
        return np.where(cur == 1, self.S0 + off * self.L + (latch_c - 1), on * (self.lockout + 1) + lock)

    def step(self, cur, on, off, lock, latch, b, c):
        """One sample for vectors of states (numpy, elementwise)."""
        idle = cur == 0
        # --- off-latch branch
        locked = lock > 0
        lock_n = np.where(idle & locked, lock - 1, lock)
        beff = np.where(locked, False, b)
        on_n = np.where(idle, np.where(beff, on + 1, 0), on)
        raise_ = idle & (on_n >= self.n_on)
        # --- latched branch
        latch_n = np.where(~idle, latch + 1, latch)
        if self.max_latch is not None:
            trip = ~idle & (latch_n >= self.max_latch)
        else:
            trip = np.zeros_like(idle)
            latch_n = np.where(~idle, 1, latch_n)
        off_n = np.where(~idle & ~trip, np.where(c, off + 1, 0), off)
        clear = ~idle & ~trip & (off_n >= self.n_off)
        reset = trip | clear
        cur2 = np.where(raise_, 1, np.where(reset, 0, cur))
        on2 = np.where(raise_ | reset, 0, on_n)
        off2 = np.where(raise_ | reset, 0, off_n)
        lock2 = np.where(reset, self.lockout, lock_n)
        latch2 = np.where(raise_, 1, np.where(reset, 0, latch_n))
        return cur2, on2, off2, lock2, latch2

    def moves(self) -> np.ndarray:
        """Next state for every state and input; the input is 2 * breach + clear."""
        parts = self.decode(np.arange(self.S))
        return np.stack([self.encode(*self.step(*parts, bool(k & 2), bool(k & 1))) for k in range(4)]).astype(np.int32)


def latch_inputs(breach, clear) -> np.ndarray:
    """2 * breach + clear; a missing flag counts as false."""
    return 2 * (np.asarray(breach) == True) + (np.asarray(clear) == True)  # noqa: E712


def through(moves: np.ndarray, inputs: np.ndarray) -> np.ndarray:
    """End state for every start state.  Inputs drive states together, so only the different ones
    still on the way, few after some steps, are moved on."""
    states = of = np.arange(moves.shape[1])
    for i, k in enumerate(inputs):
        states = moves[k][states]
        if i % 16 == 0 and len(states) > 1:
            states, again = np.unique(states, return_inverse=True)
            of = again[of]
    return states[of]


def as_runs(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of equal end states: start states from first[k] to before first[k + 1] end in to[k]."""
    first = np.flatnonzero(np.concatenate([[True], ends[1:] != ends[:-1]]))
    return first, ends[first]


def visited(moves: list[list[int]], start: int, inputs) -> list[int]:
    """States after each input."""
    out, state = [], start
    for k in inputs:
        state = moves[k][state]
        out.append(state)
    return out


def deadband_latch(df: DataFrame, tuning: Tuning, breach: str = "breach", clear: str = "in_clear",
                   key: str = "run_key", pos: str = "sample", out: str = "alarm",
                   block: int = DEFAULT_BLOCK) -> DataFrame:
    """Latched alarm per row (see module doc for the blocked scan).  A null flag counts as false."""
    fsm = Latch(tuning.n_on, tuning.n_off, tuning.lockout, tuning.max_latch)
    moves, latched = fsm.moves(), fsm.S0
    # read by the block tables, the list of last blocks and the replay: computed once
    rows = stored(df.withColumn(BLK, block_of(pos, block)), "latch")
    # only blocks with a successor need their table
    last = rows.groupBy(key).agg(F.max(BLK).alias("_last"))
    need = rows.join(last, key).where(F.col(BLK) < F.col("_last")).select(key, BLK, pos, breach, clear)

    def tables(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos)
        first, to = as_runs(through(moves, latch_inputs(pdf[breach], pdf[clear])))
        return pd.DataFrame({key: [pdf[key].iloc[0]], BLK: [int(pdf[BLK].iloc[0])], "_f": [[{"first": int(a), "to": int(b)} for a, b in zip(first, to)]]})
    key_type = df.schema[key].dataType.simpleString()
    runs = "array<struct<first:int,to:int>>"
    tabs = need.groupBy(key, BLK).applyInPandas(tables, f"{key} {key_type}, {BLK} long, _f {runs}")

    def comb(e, lt):
        # where each run of the earlier block goes on: the last run of the later one that begins at or before its end
        at = lambda s: F.element_at(F.filter(lt["_f"], lambda x: x["first"] <= s), -1)["to"]
        moved = F.transform(e["_f"], lambda x: F.struct(x["first"].alias("first"), at(x["to"]).alias("to")))
        # runs that now end alike become one
        shrunk = F.aggregate(moved, F.array().cast(runs), lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["to"] == x["to"]), acc).otherwise(F.concat(acc, F.array(x))))
        return {"_f": shrunk}
    # a run's last block has no table but does have a predecessor
    ends = tabs.unionByName(last.select(key, F.col("_last").alias(BLK), F.lit(None).cast(runs).alias("_f")))
    starts = doubling_scan(ends, key, ["_f"], comb).select(key, BLK, F.element_at("_f", 1)["to"].alias("_start"))
    rows = rows.join(starts, [key, BLK], "left").withColumn("_start", F.coalesce(F.col("_start"), F.lit(0)).cast("int"))
    out_schema = T.StructType([f for f in rows.schema.fields] + [T.StructField(out, T.IntegerType())])
    as_lists = moves.tolist()

    def replay(batches):
        # rows arrive grouped by (run, block) and ordered by position; a group may go on in the next batch
        group, state = None, 0
        for pdf in batches:
            keys, blks, starts = pdf[key].to_numpy(), pdf[BLK].to_numpy(), pdf["_start"].to_numpy()
            inputs = latch_inputs(pdf[breach], pdf[clear]).tolist()
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]) | (blks[1:] != blks[:-1])) + 1).tolist(), len(pdf)]
            states: list[int] = []
            for a, z in zip(edges[:-1], edges[1:]):
                if a < z:
                    if (keys[a], blks[a]) != group:
                        group, state = (keys[a], blks[a]), int(starts[a])
                    states += visited(as_lists, state, inputs[a:z])
                    state = states[-1]
            pdf[out] = (np.array(states, dtype=np.int64) >= latched).astype(np.int32)
            yield pdf
    ordered = rows.repartition(key, BLK).sortWithinPartitions(key, BLK, pos)
    return ordered.mapInPandas(replay, out_schema).drop(BLK, "_start")


# --------------------------------------------------------------------------
# E9 / D23 / D24 KPIs, E10 episodes, D33 display domain
# --------------------------------------------------------------------------
def alarm_kpis(df: DataFrame, methods: dict[str, str], inject: int, key: str = "run_key",
               pos: str = "sample", block: int = DEFAULT_BLOCK, dense: bool = False) -> DataFrame:
    """D23/E9 per run and method: false trips at t <= inject, transitions,
    0-based offset of the first post-injection trip (null if none).

    One pass marks the changes of all flags, one aggregate sums all methods, and the
    aggregated rows are spread out by method."""
    def build(w: Window) -> list[Column]:
        flags = [F.col(c).cast("int") for c in methods.values()]
        return [F.when(F.lag(f, 1).over(w) != f, 1).otherwise(0).alias(f"_tr_{m}") for m, f in zip(methods, flags)]
    marked = halo_select(df, key, pos, build, before=1, block=block, dense=dense)
    columns = []
    for m, c in methods.items():
        on = F.col(c).cast("int") == 1
        columns += [F.count_if(on & (F.col(pos) <= inject)).alias(f"_fa_{m}"), F.sum(f"_tr_{m}").alias(f"_ch_{m}"),
                    F.min(F.when(on & (F.col(pos) > inject), F.col(pos))).alias(f"_ft_{m}")]
    rows = F.array(*[F.struct(F.lit(m).alias("method"), F.col(f"_fa_{m}").alias("false_alarms_pre"), F.col(f"_ch_{m}").cast("long").alias("transitions"),
                              (F.col(f"_ft_{m}") - F.lit(inject + 1)).cast("int").alias("ttf_post")) for m in methods])
    return marked.groupBy(key).agg(*columns).select(key, F.inline(rows))


def first_trips(df: DataFrame, inject: int, key: str = "run_key", pos: str = "sample") -> DataFrame:
    """First ROC pre-alarm and first latched alarm after injection
    (0-based array index, as reported upstream, plus the sample itself)."""
    post = F.col(pos) > inject
    return df.groupBy(key).agg(
        F.min(F.when(post & F.col("roc_pre"), F.col(pos))).alias("first_pre_sample"),
        F.min(F.when(post & (F.col("alarm") == 1), F.col(pos))).alias("first_latched_sample"),
    ).select(key, (F.col("first_pre_sample") - 1).cast("int").alias("first_pre_index"), "first_pre_sample",
             (F.col("first_latched_sample") - 1).cast("int").alias("first_latched_index"), "first_latched_sample")


def episodes(df: DataFrame, alarm: str = "alarm", breach: str = "breach", key: str = "run_key",
             pos: str = "sample", block: int = DEFAULT_BLOCK, dense: bool = False) -> DataFrame:
    """Maximal runs of alarm = 1, split into breach part and linger part.

    Positions are reported 0-based like the upstream arrays.  The episode of
    a row is identified by the running max of episode-start positions.
    """
    def build(w: Window) -> list[Column]:
        prev = F.lag(F.col(alarm), 1).over(w)
        start = (F.col(alarm) == 1) & (prev.isNull() | (prev != 1))
        return [F.when(start, F.col(pos)).alias("_start_pos")]
    s = halo_select(df, key, pos, build, before=1, block=block, dense=dense)
    s = running_agg(s, key, pos, F.col("_start_pos"), "_ep", how="max", block=block)
    on = s.where(F.col(alarm) == 1)
    ep = on.groupBy(key, "_ep").agg(
        F.min(pos).alias("_s"), F.max(pos).alias("_l"), F.count(F.lit(1)).alias("total_on_samples"),
        F.min(F.when(~F.col(breach), F.col(pos))).alias("_fi"))
    linger = (F.col("_l") + 1 - F.coalesce(F.col("_fi"), F.col("_s"))).cast("long")
    return ep.select(
        key, (F.col("_s") - 1).cast("int").alias("start"), F.col("_l").cast("int").alias("end_exclusive"),
        (F.col("_l") - 1).cast("int").alias("last_on"), (F.col("_fi") - 1).cast("int").alias("first_ideal"),
        linger.alias("linger_samples"), F.col("total_on_samples").cast("long").alias("total_on_samples"),
        F.round(linger * F.lit(float(SAMPLE_MINUTES)), 1).alias("linger_minutes"))


def display_domain(df: DataFrame, col: str, key: str = "run_key") -> DataFrame:
    """[min - 4% span, max + 4% span], span floored at 1e-9; non-finite -> 2700..2900."""
    g = df.groupBy(key).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    span = F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1e-9))
    finite = F.col("_lo").isNotNull() & F.col("_hi").isNotNull() & ~F.isnan("_lo") & ~F.isnan("_hi")
    return g.select(key, F.when(finite, F.col("_lo") - 0.04 * span).otherwise(F.lit(2700.0)).alias("domain_lo"),
                    F.when(finite, F.col("_hi") + 0.04 * span).otherwise(F.lit(2900.0)).alias("domain_hi"))
