"""Structured Streaming forms of the alarm and alert operators.

K1  telemetry file source        ``readStream.schema(S).parquet`` + maxFilesPerTrigger
K2  live alert stream            stateless: probabilities + catalogue (stream-static join)
K3  stateful EWMA + ROC + latch  ``transformWithStateInPandas`` keyed by run
K4  rising-edge alert events     previous ``is_fault`` kept in the same state
K5  rolling features             a map state of the last ``max(windows)`` values
K6  windowed alert counts        watermark + tumbling / sliding / session windows, each emitted once
K7  late and duplicate samples   ``dropDuplicatesWithinWatermark``, or a seen-set that counts what it drops

Keyed state is a value a run, a map of the samples that wait, and an event-time timer that closes
idle runs, in the RocksDB state store: a batch writes what changed, not the whole state.

Per-run baselines (EWMA mean/std, ROC threshold, ramp end) need pre-fault
samples, which a stream cannot wait for: they come from a batch-fitted params
table joined to the stream (stream-static join).
"""
from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.alarms import Latch, Tuning, latch_inputs, visited

TELEMETRY_STREAM_SCHEMA = T.StructType([
    T.StructField("run_key", T.StringType()), T.StructField("faultNumber", T.IntegerType()),
    T.StructField("simulationRun", T.IntegerType()), T.StructField("sample", T.IntegerType()),
    T.StructField("xmeas_13", T.DoubleType()), T.StructField("xmeas_9", T.DoubleType()),
    T.StructField("xmv_10", T.DoubleType()), T.StructField("p_fault", T.DoubleType()),
    T.StructField("pred_fault", T.IntegerType()), T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
])


# --------------------------------------------------------------------------
# K1 source
# --------------------------------------------------------------------------
def telemetry_stream(spark: SparkSession, path: str, files_per_trigger: int = 1,
                     schema: T.StructType = TELEMETRY_STREAM_SCHEMA) -> DataFrame:
    """K1: telemetry files arriving in a folder (explicit schema, no inference)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for stateful streams: the caller's settings, RocksDB state and a number of state partitions.

    A stateful query takes these when it first starts and keeps them in its checkpoint for its lifetime.  The
    caller's session, in which others may start queries meanwhile, is not touched."""
    s = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            s.conf.set(key, value)
    s.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    s.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    return s


def run_to_completion(stream: DataFrame, sink_path: str, checkpoint: str, mode: str = "append", fmt: str = "parquet") -> dict[str, Any]:
    """Drive a streaming query over everything available (AvailableNow) into a
    file sink with a reliable checkpoint; blocks until done.

    Returns what its progress reports say: ``late``, rows dropped behind the watermark, and
    ``state_rows``, rows held in state after each batch."""
    q = (stream.writeStream.format(fmt).outputMode(mode).option("path", sink_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    states = [[dict(o) if isinstance(o, dict) else {"numRowsDroppedByWatermark": o.numRowsDroppedByWatermark, "numRowsTotal": o.numRowsTotal} for o in p.stateOperators] for p in q.recentProgress]
    return {"late": sum(o["numRowsDroppedByWatermark"] for p in states for o in p), "state_rows": [sum(o["numRowsTotal"] for o in p) for p in states]}


# --------------------------------------------------------------------------
# K3 / K4 keyed state: EWMA, ROC, latch, rising edge
# --------------------------------------------------------------------------
ALARM_OUT = T.StructType([
    T.StructField("run_key", T.StringType()), T.StructField("sample", T.IntegerType()),
    T.StructField("z", T.DoubleType()), T.StructField("roc_abs", T.DoubleType()),
    T.StructField("breach", T.BooleanType()), T.StructField("in_clear", T.BooleanType()),
    T.StructField("roc_pre", T.BooleanType()), T.StructField("alarm", T.IntegerType()),
    T.StructField("is_fault", T.IntegerType()), T.StructField("rising_edge", T.IntegerType()),
    T.StructField("late_samples", T.LongType()),
])
PARAMS = ("mu_z", "sig_z", "roc_thr", "t_max")


def due(sample: np.ndarray, last: int, reorder: int) -> int:
    """How many of the sorted waiting samples can go on: those that follow the last one
    without a gap, and those that lie ``reorder`` or more behind the newest."""
    if not len(sample):
        return 0
    in_order = sample == last + 1 + np.arange(len(sample))
    ready = len(sample) if in_order.all() else int(np.argmin(in_order))
    return max(ready, int(np.searchsorted(sample, sample[-1] - reorder, "right")))


def whole(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """A key's rows of a batch, which come in one part unless they are many."""
    parts = list(rows)
    return parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)


class RunProcessor(StatefulProcessor):
    """What the processors of a run share: samples that wait, late ones, and closing an idle run.

    ``run`` holds (last sample, late samples, timer) and what a subclass adds, ``waiting`` a row a sample that waits."""
    fields: Sequence[str] = ()                  # columns of a waiting sample, doubles
    own = ""                                    # what a subclass adds to ``run``, as DDL
    start: tuple = ()

    def __init__(self, reorder: int, idle_ms: int):
        self.reorder, self.idle_ms = reorder, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "last long, late long, timer long" + self.own)
        self.waiting = handle.getMapState("waiting", "sample long", ", ".join(f"{f} double" for f in self.fields))

    def goes_on(self, key: tuple, rows: dict[str, np.ndarray], values: tuple, late: int) -> tuple[pd.DataFrame | None, tuple]:
        """Output and new values for samples in order (an array of each field and of ``sample``)."""
        raise NotImplementedError

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # arrays, not data frames: a batch brings a run a few rows, and there are as many calls as runs
        arrived = whole(rows)
        last, late, timer, *values = self.run.get() or (0, 0, None, *self.start)     # runs begin at sample 1; one that begins later waits as if for a gap
        sample, columns = arrived["sample"].to_numpy(dtype=float), [arrived[f].to_numpy(dtype=float) for f in self.fields]
        fresh = sample > last
        late += int(len(sample) - fresh.sum())
        held = [(k[0], *v) for k, v in self.waiting.iterator()]
        sample, columns = sample[fresh].astype(np.int64), [c[fresh] for c in columns]
        if held:
            before = np.array(held, dtype=float)
            sample, columns = np.concatenate([before[:, 0].astype(np.int64), sample]), [np.concatenate([before[:, i], c]) for i, c in enumerate(columns, 1)]
        sample, first = np.unique(sample, return_index=True)
        n = due(sample, last, self.reorder)
        waiting = {"sample": sample} | {f: c[first] for f, c in zip(self.fields, columns, strict=True)}
        go, kept = {f: c[:n] for f, c in waiting.items()}, {k for k, *_ in held}
        for k in kept.intersection(go["sample"].tolist()):
            self.waiting.removeKey((k,))
        for k, *v in zip(*(c[n:].tolist() for c in waiting.values()), strict=True):
            if k not in kept:
                self.waiting.updateValue((k,), tuple(None if x != x else x for x in v))
        out, values = self.goes_on(key, go, self.primed(arrived, tuple(values)), late)
        now, newest = timerValues.getCurrentWatermarkInMs(), arrived["event_ms"].max()
        closes = int(max(now, newest if newest == newest else now)) + self.idle_ms
        if closes > (timer or 0):
            if timer:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(closes)
            timer = closes
        self.run.update((int(go["sample"][-1]) if n else last, int(late), timer, *values))
        if out is not None:
            yield out

    def primed(self, arrived: pd.DataFrame, values: tuple) -> tuple:
        return values

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        """The run is idle: what waits goes out, and its state is removed."""
        state = self.run.get()
        if state is not None:
            _, late, _, *values = state
            held = np.array(sorted(((k[0], *v) for k, v in self.waiting.iterator()), key=lambda row: row[0]), dtype=float).reshape(-1, 1 + len(self.fields))
            rest = {"sample": held[:, 0].astype(np.int64)} | {f: held[:, i] for i, f in enumerate(self.fields, 1)}
            out, _ = self.goes_on(key, rest, tuple(values), late)
            self.run.clear()
            self.waiting.clear()
            if out is not None:
                yield out

    def close(self) -> None:
        pass


class AlarmProcessor(RunProcessor):
    """EWMA, rate of change, bands, latch and rising edge of a run, from where the last batch left them."""
    fields = ("x", "is_fault")
    own = ", z double, latch int, prev_fault int, mu_z double, sig_z double, roc_thr double, t_max double"
    start = (None, 0, None, None, None, None, None)

    def __init__(self, t: Tuning, inject: int, reorder: int, idle_ms: int):
        super().__init__(reorder, idle_ms)
        fsm = Latch(t.n_on, t.n_off, t.lockout, t.max_latch)
        self.tuning, self.inject, self.moves, self.latched = t, inject, fsm.moves().tolist(), fsm.S0

    def primed(self, arrived: pd.DataFrame, values: tuple) -> tuple:
        return (*values[:3], *[float(arrived[p].iloc[0]) for p in PARAMS])

    def averages(self, x: np.ndarray, z: float | None) -> tuple[np.ndarray, np.ndarray]:
        """EWMA after each value, and its change; a missing value leaves it as it is."""
        out, change, alpha = np.full(len(x), np.nan), np.zeros(len(x)), self.tuning.alpha
        for i, v in enumerate(x):
            new = z if np.isnan(v) else v if z is None else alpha * v + (1 - alpha) * z
            change[i] = 0.0 if z is None or new is None else abs(new - z)
            z = new
            out[i] = np.nan if z is None else z
        return out, change

    def goes_on(self, key, rows, values, late):
        z, latch, prev_fault, mu, sig, roc_thr, t_max = values
        if not len(rows["sample"]):
            return None, values
        t = self.tuning
        sample, fault = rows["sample"], rows["is_fault"].astype(np.int64)
        zs, roc = self.averages(rows["x"], z)
        width = (t.sigma + t.tail * np.clip((sample - self.inject) / max(t_max - self.inject, 1.0), 0, 1)) * sig
        low, high = mu - width - t.pad, mu + width + t.pad
        breach = (zs < low) | (zs > high)
        clear = ~breach if t.hysteresis is None else (zs >= low + t.hysteresis) & (zs <= high - t.hysteresis)
        states = visited(self.moves, latch, latch_inputs(breach, clear).tolist())
        before = np.concatenate([[-1 if prev_fault is None else prev_fault], fault[:-1]])
        out = pd.DataFrame({
            "run_key": key[0], "sample": sample.astype("int32"), "z": zs, "roc_abs": roc, "breach": breach, "in_clear": clear, "roc_pre": (roc > roc_thr) & ~breach,
            "alarm": (np.array(states) >= self.latched).astype("int32"), "is_fault": fault.astype("int32"), "rising_edge": ((before == 0) & (fault == 1)).astype("int32"), "late_samples": late})
        return out, (None if np.isnan(zs[-1]) else float(zs[-1]), int(states[-1]), int(fault[-1]), mu, sig, roc_thr, t_max)


def stateful_alarms(stream: DataFrame, params: DataFrame, tuning: Tuning, inject: int, col: str = "xmeas_13",
                    threshold: float = 0.35, reorder: int = 8, idle_ms: int = 86_400_000, ts: str = "ts") -> DataFrame:
    """K3/K4: per-run EWMA, ROC, band flags, latched alarm and rising edge,
    with state carried across micro-batches.  ``params``: run_key, mu_z, sig_z,
    roc_thr, t_max (batch-fitted baselines).  The stream must be of a ``stream_session``.

    Samples that arrive out of order wait until the gap before them is filled or they lie
    ``reorder`` samples behind the newest.  A sample that comes after its successor
    went on is dropped and counted in ``late_samples``.  A run that falls ``idle_ms`` of
    event time behind the watermark is closed: what waits goes out and its state is removed."""
    s = watermarked(stream, ts, idle_ms).join(params.select("run_key", *PARAMS), "run_key")
    s = s.withColumn("is_fault", F.coalesce((F.col("p_fault") >= threshold).cast("double"), F.lit(0.0)))
    s = s.select("run_key", F.col("sample").cast("long").alias("sample"), F.col(col).cast("double").alias("x"), *[F.col(p).cast("double").alias(p) for p in PARAMS], "is_fault", "event_time", "event_ms")
    return s.groupBy("run_key").transformWithStateInPandas(AlarmProcessor(tuning, inject, reorder, idle_ms), ALARM_OUT, "append", "EventTime")


# --------------------------------------------------------------------------
# K5 rolling features from a ring of values
# --------------------------------------------------------------------------
class RollingProcessor(RunProcessor):
    """Trailing mean and std; ``recent`` holds the last values by their place modulo the widest window."""
    fields = ("x",)
    own = ", seen long"
    start = (0,)

    def __init__(self, col: str, windows: Sequence[int], reorder: int, idle_ms: int):
        super().__init__(reorder, idle_ms)
        self.col, self.windows, self.widest = col, tuple(windows), max(windows)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.recent = handle.getMapState("recent", "place int", "x double")

    def goes_on(self, key, rows, values, late):
        (seen,) = values
        n = len(rows["sample"])
        if not n:
            return None, values
        ring = {k[0]: v[0] for k, v in self.recent.iterator()}
        before = [ring.get((seen - i) % self.widest) if i <= seen else None for i in range(self.widest - 1, 0, -1)]
        x = np.concatenate([np.array([np.nan if v is None else v for v in before]), rows["x"]])
        out = {"run_key": key[0], "sample": rows["sample"].astype("int32")}
        for w in self.windows:
            view = np.lib.stride_tricks.sliding_window_view(x[self.widest - w:], w)
            some = ~np.isnan(view)
            count = some.sum(axis=1)
            mean = np.where(some, view, 0.0).sum(axis=1) / np.maximum(count, 1)
            square = np.where(some, (view - mean[:, None]) ** 2, 0.0).sum(axis=1)
            out[f"{self.col}_roll_mean_{w}"] = np.where(count > 0, mean, np.nan)
            out[f"{self.col}_roll_std_{w}"] = np.where(count > 1, np.sqrt(square / np.maximum(count - 1, 1)), 0.0)
        for place in range(max(seen, seen + n - self.widest), seen + n):
            v = x[self.widest - 1 + place - seen]
            self.recent.updateValue((place % self.widest,), (None if np.isnan(v) else float(v),))
        return pd.DataFrame(out | {"late_samples": late}), (seen + n,)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)
        self.recent.clear()


def stateful_rolling(stream: DataFrame, col: str, windows: Sequence[int] = (10, 20), reorder: int = 8, idle_ms: int = 86_400_000, ts: str = "ts") -> DataFrame:
    """K5: trailing mean and sample std per window for each new sample; the
    state keeps the last ``max(windows)`` values of the run, until the run is ``idle_ms`` behind the watermark.

    A missing value takes its place in the window and is skipped, as in batch.  Samples out of order wait,
    late ones are dropped and counted in ``late_samples``, and a closed run lets go what waits, as in stateful_alarms."""
    fields = [T.StructField("run_key", T.StringType()), T.StructField("sample", T.IntegerType())]
    for w in windows:
        fields += [T.StructField(f"{col}_roll_mean_{w}", T.DoubleType()), T.StructField(f"{col}_roll_std_{w}", T.DoubleType())]
    fields.append(T.StructField("late_samples", T.LongType()))
    s = watermarked(stream, ts, idle_ms).select("run_key", F.col("sample").cast("long").alias("sample"), F.col(col).cast("double").alias("x"), "event_time", "event_ms")
    out = s.groupBy("run_key").transformWithStateInPandas(RollingProcessor(col, windows, reorder, idle_ms), T.StructType(fields), "append", "EventTime")
    means = [c for c in out.columns if "_roll_mean_" in c]
    return out.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in means else F.col(c) for c in out.columns])


# --------------------------------------------------------------------------
# K6 windowed counts, K7 dedup
# --------------------------------------------------------------------------
def windowed_counts(alerts: DataFrame, ts: str = "ts", by: str = "severity", size: str = "1 hour",
                    slide: str | None = None, session_gap: str | None = None, watermark: str = "2 hours") -> DataFrame:
    """K6: alert counts per event-time window (tumbling, sliding or session).

    In append mode each window is emitted once, when the watermark passes its end, and its state is
    dropped; rows behind the watermark are not counted in (run_to_completion reports how many)."""
    w = with_event_time(alerts, ts).withWatermark("event_time", watermark)
    if session_gap:
        win = F.session_window("event_time", session_gap)
    else:
        win = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    return w.groupBy(win.alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), by, "n")


def dedup_samples(stream: DataFrame, ts: str = "ts", keys: Sequence[str] = ("run_key", "sample"),
                  watermark: str = "1 hour") -> DataFrame:
    """K7: drop repeated (run, sample) records that arrive within the watermark."""
    return with_event_time(stream, ts).withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(list(keys))


class SeenProcessor(StatefulProcessor):
    """First arrivals of the samples of a (run, block), and how many copies were dropped.

    What a block has seen is a bit a sample in its one value: a batch reads and writes it once, whatever it brings."""

    def __init__(self, keep_ms: int, size: int):
        self.keep_ms, self.size = keep_ms, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.block = handle.getValueState("block", "copies long, timer long, seen binary")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        arrived = whole(rows)
        copies, timer, bits = self.block.get() or (0, None, bytes(-(-self.size // 8)))
        seen = np.unpackbits(np.frombuffer(bits, np.uint8))
        sample = arrived["sample"].to_numpy(dtype=np.int64)
        first = sample[np.sort(np.unique(sample, return_index=True)[1])]
        place = first - 1 - int(key[1]) * self.size
        first, place = first[seen[place] == 0], place[seen[place] == 0]
        seen[place] = 1
        now = timerValues.getCurrentWatermarkInMs()
        closes = int(max(now, arrived["event_ms"].max())) + self.keep_ms
        if closes > (timer or 0):
            if timer:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(closes)
            timer = closes
        self.block.update((int(copies + len(sample) - len(first)), timer, np.packbits(seen).tobytes()))
        if len(first):
            yield pd.DataFrame({"run_key": key[0], "sample": first, "copies": pd.array([None] * len(first), dtype="Int64")})

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        """The watermark is past all samples of the block: its copies are told and its state is removed."""
        state = self.block.get()
        if state is not None:
            self.block.clear()
            yield pd.DataFrame({"run_key": [key[0]], "sample": pd.array([None], dtype="Int64"), "copies": pd.array([state[0]], dtype="Int64")})

    def close(self) -> None:
        pass


def counted_dedup(stream: DataFrame, ts: str = "ts", delay_ms: int = 3_600_000, block: int = 1024) -> DataFrame:
    """K7: first arrivals of each (run, sample), and the number of copies that were dropped.

    A row with ``sample`` is a first arrival; one without tells the ``copies`` dropped of a (run, block of
    ``block`` samples) once the watermark, ``delay_ms`` behind the newest event, is ``delay_ms`` past the block's newest
    sample, when what was seen of it is forgotten.  Rows behind the watermark are dropped before
    they get here; run_to_completion reports how many.  A run is split into blocks, so none fills a task."""
    s = watermarked(stream, ts, delay_ms).withColumn("block", F.floor((F.col("sample") - 1) / block))
    s = s.select("run_key", "block", F.col("sample").cast("long").alias("sample"), F.col("event_ms").cast("long").alias("event_ms"), "event_time")
    return s.groupBy("run_key", "block").transformWithStateInPandas(SeenProcessor(delay_ms, block), "run_key string, sample long, copies long", "append", "EventTime")


def watermarked(stream: DataFrame, ts: str, delay_ms: int) -> DataFrame:
    """With event_time as the watermark column, and event_ms."""
    s = with_event_time(stream, ts).withWatermark("event_time", f"{delay_ms} milliseconds")
    return s.withColumn("event_ms", F.unix_millis("event_time").cast("double"))


def with_event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP; wall-clock TIMESTAMP_NTZ columns are cast."""
    is_ntz = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    return df.withColumn("event_time", F.col(ts).cast("timestamp") if is_ntz else F.col(ts))


def scratch(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's checkpoint directory for stream state and sinks."""
    from ..session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "streams", name)
