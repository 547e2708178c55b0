"""Streaming queries: each publishes the telemetry derived from ``events`` as
ordered file slices, runs the streaming operator over them (AvailableNow,
state carried across micro-batches) and returns the sink as a DataFrame.
Stream results must equal the batch operators, so the batch oracles apply."""
from __future__ import annotations

import datetime
import os
import uuid

from pyspark.sql import functions as F

from ..operators import alarms as al
from ..sources.tables import EVENTS_INJECTION, incidents, telemetry
from ..streaming import alarms as st
from . import alert_queries as aq
from . import alarm_queries as alq
from . import sql as Q
from .registry import register

SLICES = 6
FILES_PER_TRIGGER = 8
IDLE_MS = 90 * 86_400_000      # the slices are cut by sample, not by time: no run is idle before the end


def publish(spark, sf_dir: str, name: str, copies: int = 1, by_time: bool = False) -> str:
    """Write telemetry slice by slice (oldest first) into one folder; returns it.

    Slices are sample ranges of every run, or, with ``by_time``, event-time
    ranges (what a watermark expects).  ``copies`` > 1 re-sends each slice
    (duplicate delivery)."""
    base = st.scratch(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    src = os.path.join(base, "in")
    t = telemetry(spark, sf_dir).select(*[f.name for f in st.TELEMETRY_STREAM_SCHEMA.fields])
    order = F.unix_micros(F.col("ts").cast("timestamp")) if by_time else F.col("sample").cast("long")
    t = t.withColumn("_order", order)
    lo, hi = t.agg(F.min("_order"), F.max("_order")).first()
    t = t.withColumn("_slice", F.least(F.floor((F.col("_order") - lo) * SLICES / (hi - lo + 1)), F.lit(SLICES - 1)).cast("int"))
    for k in range(SLICES):                       # as many writes as slices, whatever the size of the data
        part = t.where(F.col("_slice") == k).drop("_slice", "_order").repartition("run_key")
        for _ in range(copies):
            part.write.mode("append").parquet(src)
    return base


def files_per_trigger(spark, src: str) -> int:
    """Files a micro-batch takes: about a slice's (all its copies), so that the batches, each of which starts jobs, reads the
    static side and commits the state, stay as many as the slices while the files grow with the data."""
    return max(FILES_PER_TRIGGER, -(-len(spark.read.schema(st.TELEMETRY_STREAM_SCHEMA).parquet(src).inputFiles()) // SLICES))


def heartbeat(spark, src: str, schema, **values) -> None:
    """One row more, long after all others: its event time moves the watermark past them, so that windows
    and runs end.  On a live stream the next events do that."""
    row = {f.name: values.get(f.name) for f in schema.fields}
    spark.createDataFrame([tuple(row[f.name] for f in schema.fields)], schema).coalesce(1).write.mode("append").parquet(src)


def _params(spark, sf_dir):
    """Batch-fitted baselines, materialised once: the static side of a
    stream-static join is otherwise re-evaluated in every micro-batch."""
    p = alq.signals(spark, sf_dir).select("run_key", "mu_z", "sig_z", "roc_thr", "t_max").dropDuplicates(["run_key"])
    return p.checkpoint(eager=True)


def _alarm_stream(spark, sf_dir, name):
    base = publish(spark, sf_dir, name)
    src = os.path.join(base, "in")
    s = st.telemetry_stream(st.stream_session(spark), src, files_per_trigger=files_per_trigger(spark, src))
    out = st.stateful_alarms(s, _params(spark, sf_dir), alq.TUNING, EVENTS_INJECTION, idle_ms=IDLE_MS)
    st.run_to_completion(out, os.path.join(base, "out"), os.path.join(base, "chk"))
    return spark.read.parquet(os.path.join(base, "out"))


@register("k3_stream_deadband_latch", "K1 K3 E8", alq._oracle_prefix() + """
SELECT run_key, sample, breach, in_clear, alarm FROM alarmed""")
def k3(spark, sf_dir):
    return _alarm_stream(spark, sf_dir, "k3").select("run_key", "sample", "breach", "in_clear", "alarm")


@register("k4_stream_rising_edges", "K4 E11", "WITH " + Q.SCORED + """,
l AS (SELECT *, lag(is_fault) OVER (PARTITION BY run_key ORDER BY sample) AS prev FROM scored)
SELECT run_key, sample FROM l WHERE prev = 0 AND is_fault = 1""")
def k4(spark, sf_dir):
    return _alarm_stream(spark, sf_dir, "k4").where(F.col("rising_edge") == 1).select("run_key", "sample")


@register("k5_stream_rolling_features", "K5", "WITH " + Q.TELEMETRY + """
SELECT run_key, sample,
  round(avg(xmeas_13) OVER (PARTITION BY run_key ORDER BY sample ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS xmeas_13_roll_mean_10,
  round(coalesce(stddev_samp(xmeas_13) OVER (PARTITION BY run_key ORDER BY sample ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 0.0), 6) AS xmeas_13_roll_std_10,
  round(avg(xmeas_13) OVER (PARTITION BY run_key ORDER BY sample ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 6) AS xmeas_13_roll_mean_20,
  round(coalesce(stddev_samp(xmeas_13) OVER (PARTITION BY run_key ORDER BY sample ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0.0), 6) AS xmeas_13_roll_std_20
FROM telemetry""")
def k5(spark, sf_dir):
    base = publish(spark, sf_dir, "k5")
    src = os.path.join(base, "in")
    s = st.telemetry_stream(st.stream_session(spark), src, files_per_trigger=files_per_trigger(spark, src))
    out = st.stateful_rolling(s, "xmeas_13", (10, 20), idle_ms=IDLE_MS)
    st.run_to_completion(out, os.path.join(base, "out"), os.path.join(base, "chk"))
    r = spark.read.parquet(os.path.join(base, "out"))
    return r.select("run_key", "sample", *[F.round(c, 6).alias(c) for c in r.columns if c.startswith("xmeas_13_")])


@register("k2_stream_alerts", "K2 J16", aq._j16_sql())
def k2(spark, sf_dir):
    rows, params, imp = aq._fit(spark, sf_dir)
    base = publish(spark, sf_dir, "k2")
    src = os.path.join(base, "in")
    s = st.telemetry_stream(spark, src, files_per_trigger=files_per_trigger(spark, src))
    from ..operators import alerts as ops
    from ..sources.tables import with_class_probabilities
    a = ops.build_alerts(with_class_probabilities(s), "probs", F.to_timestamp_ntz(F.lit(aq.BASE_TS)),
                         aq.FEATS, params, imp)
    out = aq.flat_alerts(a)
    st.run_to_completion(out, os.path.join(base, "out"), os.path.join(base, "chk"))
    return spark.read.parquet(os.path.join(base, "out"))


_SEVERITY_SQL = "CASE WHEN value >= 150 THEN 'CRITICAL' WHEN value >= 100 THEN 'HIGH' WHEN value >= 50 THEN 'MEDIUM' ELSE 'LOW' END"


def _windowed(spark, sf_dir, **kind):
    """Counts by window and severity over a stream of incidents, published in ranges of event time.

    The watermark lies two ranges behind the newest incident, so none of a range is late."""
    base = st.scratch(spark, f"k6-{uuid.uuid4().hex[:12]}")
    src = os.path.join(base, "in")
    inc = incidents(spark, sf_dir).select("id", "ts", "severity").withColumn("_ms", F.unix_millis(F.col("ts").cast("timestamp")))
    lo, hi = inc.agg(F.min("_ms"), F.max("_ms")).first()
    width = ((hi or 0) - (lo or 0)) // SLICES + 1
    for k in range(SLICES):
        inc.where(F.floor((F.col("_ms") - (lo or 0)) / width) == k).drop("_ms").write.mode("append").parquet(src)
    schema = inc.drop("_ms").schema
    heartbeat(spark, src, schema, ts=datetime.datetime(2200, 1, 1), severity="none")
    s = st.stream_session(spark).readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_TRIGGER).parquet(src)
    counts = st.windowed_counts(s, watermark=f"{2 * width} milliseconds", **kind)
    st.run_to_completion(counts, os.path.join(base, "out"), os.path.join(base, "chk"))
    at = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c)
    return spark.read.schema(counts.schema).parquet(os.path.join(base, "out")).select(at("window_start"), at("window_end"), "severity", "n")


@register("k6_stream_windowed_alert_counts", "K6", f"""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') AS window_start, strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') AS window_end,
       {_SEVERITY_SQL} AS severity, count(*) AS n
FROM events WHERE event_type = 'error' GROUP BY ALL""")
def k6(spark, sf_dir):
    return _windowed(spark, sf_dir, size="1 hour")


@register("k6_stream_sliding_alert_counts", "K6", f"""
WITH e AS (SELECT unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS w, {_SEVERITY_SQL} AS severity FROM events WHERE event_type = 'error')
SELECT strftime(w, '%Y-%m-%dT%H:%M:%S') AS window_start, strftime(w + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') AS window_end, severity, count(*) AS n
FROM e GROUP BY ALL""")
def k6_sliding(spark, sf_dir):
    return _windowed(spark, sf_dir, size="2 hours", slide="1 hour")


@register("k6_stream_session_alert_counts", "K6", f"""
WITH e AS (SELECT ts, {_SEVERITY_SQL} AS severity FROM events WHERE event_type = 'error'),
m AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY severity ORDER BY ts) < INTERVAL 20 MINUTE THEN 0 ELSE 1 END AS opens FROM e),
g AS (SELECT *, sum(opens) OVER (PARTITION BY severity ORDER BY ts ROWS UNBOUNDED PRECEDING) AS grp FROM m)
SELECT strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS window_start, strftime(max(ts) + INTERVAL 20 MINUTE, '%Y-%m-%dT%H:%M:%S') AS window_end, severity, count(*) AS n
FROM g GROUP BY severity, grp""")
def k6_session(spark, sf_dir):
    return _windowed(spark, sf_dir, session_gap="20 minutes")


@register("k7_stream_dedup", "K7", "WITH " + Q.TELEMETRY + """
SELECT run_key, sample FROM telemetry""")
def k7(spark, sf_dir):
    base = publish(spark, sf_dir, "k7", copies=2, by_time=True)
    src = os.path.join(base, "in")
    s = st.telemetry_stream(spark, src, files_per_trigger=files_per_trigger(spark, src))
    d = st.dedup_samples(s, watermark="6 days").select("run_key", "sample")
    st.run_to_completion(d, os.path.join(base, "out"), os.path.join(base, "chk"))
    return spark.read.parquet(os.path.join(base, "out"))


@register("k7_stream_dedup_report", "K7", "WITH " + Q.TELEMETRY + """
SELECT run_key, count(*) AS n_samples, 2 * count(*) AS n_copies FROM telemetry GROUP BY run_key""")
def k7_report(spark, sf_dir):
    """Each slice is delivered three times: one arrival of each sample goes on, the two copies are counted."""
    base = publish(spark, sf_dir, "k7r", copies=3, by_time=True)
    src = os.path.join(base, "in")
    heartbeat(spark, src, st.TELEMETRY_STREAM_SCHEMA, run_key="heartbeat", sample=1, ts=datetime.datetime(2200, 1, 1))
    s = st.telemetry_stream(st.stream_session(spark), src, files_per_trigger=files_per_trigger(spark, src))
    st.run_to_completion(st.counted_dedup(s, delay_ms=6 * 86_400_000), os.path.join(base, "out"), os.path.join(base, "chk"))
    r = spark.read.parquet(os.path.join(base, "out")).where("run_key <> 'heartbeat'")
    return r.groupBy("run_key").agg(F.count("sample").alias("n_samples"), F.sum("copies").alias("n_copies"))
