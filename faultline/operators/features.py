"""Per-run features: rolling statistics, first differences, trailing history.

Every function takes a telemetry-shaped DataFrame with a run key and a
position column (``sample``) and runs on (run, block) groups via
:mod:`faultline.operators.blocked`, so a hot run is spread over many tasks.
Sensors are cast to double before any aggregate.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import ROLLING_WINDOWS
from .blocked import BLK, DEFAULT_BLOCK, HOME, block_window, dense_rows, halo_select, with_halo


def rolling_names(sensors: Sequence[str], windows: Sequence[int] = ROLLING_WINDOWS) -> list[str]:
    """Canonical feature order: per window, per sensor, mean then std."""
    out: list[str] = []
    for w in windows:
        for s in sensors:
            out += [f"{s}_roll_mean_{w}", f"{s}_roll_std_{w}"]
    return out


def model_feature_columns(sensors: Sequence[str], windows: Sequence[int] = ROLLING_WINDOWS) -> list[str]:
    """Base sensors first, then the rolling features (52 + 52*5*2 = 572 for TEP)."""
    return list(sensors) + rolling_names(sensors, windows)


def _rolling_exprs(sensors: Sequence[str], windows: Sequence[int]):
    def build(w: Window) -> list[Column]:
        exprs: list[Column] = []
        for win in windows:
            frame = w.rowsBetween(-(win - 1), 0)
            for s in sensors:
                x = F.col(s).cast("double")
                exprs.append(F.avg(x).over(frame).alias(f"{s}_roll_mean_{win}"))
                # sample std; a frame with one value has no std -> 0 (min_periods = 1)
                exprs.append(F.coalesce(F.stddev_samp(x).over(frame), F.lit(0.0)).alias(f"{s}_roll_std_{win}"))
        return exprs
    return build


def _prefix_exprs(sensors: Sequence[str], windows: Sequence[int]):
    """Stage 1: centred running count / sum / sum of squares per sensor."""
    def build(w: Window) -> list[Column]:
        run = w.rowsBetween(Window.unboundedPreceding, 0)
        exprs: list[Column] = []
        for s in sensors:
            x = F.col(s).cast("double")
            y = x - F.first(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
            exprs += [F.count(x).over(run).alias(f"_n_{s}"), F.sum(y).over(run).alias(f"_s1_{s}"),
                      F.sum(y * y).over(run).alias(f"_s2_{s}"),
                      F.first(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding,
                                                                      Window.unboundedFollowing)).alias(f"_c_{s}")]
        return exprs
    return build


def _window_from_prefix(sensors: Sequence[str], windows: Sequence[int]):
    """Stage 2: windowed sums as differences of running sums (lag is O(1))."""
    def build(w: Window) -> list[Column]:
        exprs: list[Column] = []
        for win in windows:
            for s in sensors:
                def d(c):
                    return F.col(c) - F.coalesce(F.lag(c, win).over(w), F.lit(0))
                n, s1, s2 = d(f"_n_{s}"), d(f"_s1_{s}"), d(f"_s2_{s}")
                mean = F.when(n > 0, s1 / n + F.col(f"_c_{s}"))
                var = F.when(n > 1, F.greatest((s2 - s1 * s1 / n) / (n - 1), F.lit(0.0)))
                exprs += [mean.alias(f"{s}_roll_mean_{win}"),
                          F.coalesce(F.sqrt(var), F.lit(0.0)).alias(f"{s}_roll_std_{win}")]
        return exprs
    return build


def rolling_features(df: DataFrame, sensors: Sequence[str], windows: Sequence[int] = ROLLING_WINDOWS,
                     key: str = "run_key", pos: str = "sample", block: int = DEFAULT_BLOCK,
                     method: str = "prefix", dense: bool = False) -> DataFrame:
    """Trailing mean and sample std over the last ``w`` rows of the run
    (``min_periods = 1``; a single value has std 0).

    All frames share one (run, block) partitioning: one exchange, one sort.
    ``method="prefix"`` (default) is O(rows): running count / sum / sum of
    squares of values centred on the group's first value, differenced with
    ``lag(w)`` - every window size reuses the same three running sums.
    ``method="frame"`` uses sliding frames, O(rows x w), as a cross-check.
    The halo is ``max(windows) - 1`` rows.  Windows count rows, so gaps in ``pos`` don't
    matter; ``dense=True`` asserts that there are none and saves the numbering.
    """
    halo = max(windows) - 1
    if method == "frame":
        return halo_select(df, key, pos, _rolling_exprs(sensors, windows), before=halo, block=block, dense=dense)
    block = max(block, halo, 1)
    place = pos
    if not dense:
        df, place = dense_rows(df, key, pos, block=block), "_row"
    ext = with_halo(df, place, block, before=halo)
    w = block_window(key, place)
    stage1 = ext.select("*", *_prefix_exprs(sensors, windows)(w))
    stage2 = stage1.select("*", *_window_from_prefix(sensors, windows)(w))
    helpers = [f"_{p}_{s}" for s in sensors for p in ("n", "s1", "s2", "c")]
    return stage2.where(F.col(HOME)).drop(BLK, HOME, *helpers, *([] if dense else [place]))


def rolling_matrix(df: DataFrame, sensors: Sequence[str], windows: Sequence[int] = ROLLING_WINDOWS, key: str = "run_key",
                   pos: str = "sample", keep: Sequence[str] = (), block: int = DEFAULT_BLOCK, dense: bool = False) -> DataFrame:
    """The full model matrix - base sensors and all their rolling features - as float32.

    Hundreds of window columns make a plan that no code generator takes, so a (run,
    block) group with its halo is one array and all windows of all sensors are
    differences of three running sums.  Same results as ``rolling_features``.
    One exchange (two if the rows have to be numbered first)."""
    sensors, windows, keep = list(sensors), list(windows), list(keep)
    halo = max(windows) - 1
    block = max(block, halo, 1)
    place = pos
    if not dense:
        df, place = dense_rows(df, key, pos, block=block), "_row"
    ext = with_halo(df.select(key, pos, *({place} - {pos}), *keep, *[F.col(s).cast("double").alias(s) for s in sensors]), place, block, before=halo)
    names = rolling_names(sensors, windows)
    ids = [key, pos, *keep]
    schema = T.StructType([ext.schema[c] for c in ids] + [T.StructField(c, T.FloatType()) for c in sensors + names])

    def group_features(rows: pd.DataFrame) -> pd.DataFrame:
        x = rows[sensors].to_numpy(dtype=float)
        known = ~np.isnan(x)
        with np.errstate(all="ignore"):
            centre = np.where(known.any(0), np.where(known, x, 0).sum(0) / np.maximum(known.sum(0), 1), 0)
        y = np.where(known, x - centre, 0)
        zero = np.zeros((1, len(sensors)))
        n, s1, s2 = (np.concatenate([zero, np.cumsum(v, axis=0)]) for v in (known.astype(float), y, y * y))
        home = np.flatnonzero(rows[HOME].to_numpy(bool))
        out = [x[home]]
        for w in windows:
            first = np.maximum(home + 1 - w, 0)
            m, a, b = (v[home + 1] - v[first] for v in (n, s1, s2))
            with np.errstate(all="ignore"):
                mean = np.where(m > 0, a / m + centre, np.nan)
                std = np.where(m > 1, np.sqrt(np.maximum((b - a * a / m) / (m - 1), 0)), 0.0)
            out.append(np.stack([mean, std], axis=2).reshape(len(home), -1))
        features = pd.DataFrame(np.concatenate(out, axis=1).astype(np.float32), columns=sensors + names)
        return pd.concat([rows.iloc[home][ids].reset_index(drop=True), features], axis=1)

    def run(batches):
        held: list[pd.DataFrame] = []
        for batch in batches:
            for _, part in batch.groupby([key, BLK], sort=False):
                if held and (held[-1][key].iloc[0] != part[key].iloc[0] or held[-1][BLK].iloc[0] != part[BLK].iloc[0]):
                    yield group_features(pd.concat(held))
                    held = []
                held.append(part)
        if held:
            yield group_features(pd.concat(held))

    ordered = ext.repartition(key, BLK).sortWithinPartitions(key, BLK, place)
    return ordered.mapInPandas(run, schema)


def first_difference(df: DataFrame, col: str, out: str, key: str = "run_key", pos: str = "sample",
                     block: int = DEFAULT_BLOCK, dense: bool = False) -> DataFrame:
    """``x - lag(x)``, first row of the run 0."""
    def build(w: Window) -> list[Column]:
        return [F.coalesce(F.col(col) - F.lag(col, 1).over(w), F.lit(0.0)).alias(out)]
    return halo_select(df, key, pos, build, before=1, block=block, dense=dense)


def trailing_history(df: DataFrame, cols: Sequence[str], n: int = 48, key: str = "run_key",
                     pos: str = "sample", out: str = "history", block: int = DEFAULT_BLOCK, dense: bool = False) -> DataFrame:
    """The last ``n`` points (inclusive) of each row's run as an ordered array of structs."""
    def build(w: Window) -> list[Column]:
        frame = w.rowsBetween(-(n - 1), 0)
        return [F.collect_list(F.struct(F.col(pos), *[F.col(c) for c in cols])).over(frame).alias(out)]
    return halo_select(df, key, pos, build, before=n - 1, block=block, dense=dense)


def fault_onset(df: DataFrame, label: str = "faultNumber", key: str = "run_key", pos: str = "sample",
                when: Column | None = None) -> DataFrame:
    """First sample per run where the label is active (grouped, partial aggregation)."""
    cond = when if when is not None else (F.col(label) > 0)
    return df.groupBy(key).agg(F.min(F.when(cond, F.col(pos))).alias("onset_sample"))
