"""Alarm-management queries over the telemetry view (sensor xmeas_13).

Oracles use recursive CTEs for the two recurrences (EWMA and the latch), so
they are independent of the blocked closed-form / state-table scan used on
the Spark side.
"""
from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import ALARM_TUNING_EVENTS
from ..operators import alarms as al
from ..sources.tables import EVENTS_INJECTION, telemetry
from . import sql as Q
from .registry import register

TUNING = al.Tuning.of(ALARM_TUNING_EVENTS)
INJ = EVENTS_INJECTION
SENSOR = "xmeas_13"


def r6(c):
    return F.round(c, 6)


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = telemetry(spark, sf_dir).select("run_key", "faultNumber", "simulationRun", "sample", SENSOR)
    return al.alarm_signals(t, SENSOR, INJ, TUNING)


def latched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.deadband_latch(signals(spark, sf_dir), TUNING)


def _oracle_prefix(t: al.Tuning = TUNING, inj: int = INJ) -> str:
    a, d = t.alpha, 1.0 - t.alpha
    return "WITH RECURSIVE " + Q.TELEMETRY + f""",
ew(run_key, sample, x, z) AS (
  SELECT run_key, sample, xmeas_13, xmeas_13 FROM telemetry WHERE sample = 1
  UNION ALL
  SELECT t.run_key, t.sample, t.xmeas_13, {a} * t.xmeas_13 + {d} * ew.z
  FROM ew JOIN telemetry t ON t.run_key = ew.run_key AND t.sample = ew.sample + 1),
roc AS (
  SELECT run_key, sample, x, z,
         abs(coalesce(z - lag(z) OVER (PARTITION BY run_key ORDER BY sample), 0.0)) AS roc_abs
  FROM ew),
base AS (
  SELECT run_key,
         avg(CASE WHEN sample <= {inj} THEN x END) AS mu_raw,
         avg(CASE WHEN sample <= {inj} THEN z END) AS mu_z,
         stddev_pop(CASE WHEN sample <= {inj} THEN z END) + 1e-12 AS sig_z,
         avg(CASE WHEN sample <= {inj} THEN roc_abs END) AS roc_mu,
         stddev_pop(CASE WHEN sample <= {inj} THEN roc_abs END) + 1e-12 AS roc_sig,
         max(sample) AS t_max
  FROM roc GROUP BY run_key),
band AS (
  SELECT r.*, b.mu_raw, b.mu_z, b.sig_z, b.roc_mu, b.roc_sig, b.roc_mu + {t.roc_mult} * b.roc_sig AS roc_thr, b.t_max,
         b.mu_z + ({t.sigma} + {t.tail} * least(greatest((r.sample - {inj}.0) / greatest(b.t_max - {inj}.0, 1.0), 0.0), 1.0)) * b.sig_z AS hi_t,
         b.mu_z - ({t.sigma} + {t.tail} * least(greatest((r.sample - {inj}.0) / greatest(b.t_max - {inj}.0, 1.0), 0.0), 1.0)) * b.sig_z AS lo_t
  FROM roc r JOIN base b USING (run_key)),
flags AS (
  SELECT *, lo_t - {t.pad} AS lo_pad, hi_t + {t.pad} AS hi_pad,
         (x < 0.9 * mu_raw OR x > 1.1 * mu_raw) AS breach_naive,
         (z < lo_t - {t.pad} OR z > hi_t + {t.pad}) AS breach,
         (z >= lo_t - {t.pad} + {t.hysteresis} AND z <= hi_t + {t.pad} - {t.hysteresis}) AS in_clear,
         (roc_abs > roc_thr AND NOT (z < lo_t - {t.pad} OR z > hi_t + {t.pad})) AS roc_pre
  FROM band),
latch(run_key, sample, cur, on_s, off_s, lock_r, latch_n) AS (
  SELECT DISTINCT run_key, 0, 0, 0, 0, 0, 0 FROM flags
  UNION ALL
  SELECT l.run_key, f.sample,
    CASE WHEN l.cur = 0 THEN
           CASE WHEN (CASE WHEN l.lock_r = 0 AND f.breach THEN l.on_s + 1 ELSE 0 END) >= {t.n_on} THEN 1 ELSE 0 END
         ELSE
           CASE WHEN l.latch_n + 1 >= {t.max_latch}
                  OR (CASE WHEN f.in_clear THEN l.off_s + 1 ELSE 0 END) >= {t.n_off} THEN 0 ELSE 1 END
    END,
    CASE WHEN l.cur = 0 THEN
           CASE WHEN (CASE WHEN l.lock_r = 0 AND f.breach THEN l.on_s + 1 ELSE 0 END) >= {t.n_on} THEN 0
                ELSE (CASE WHEN l.lock_r = 0 AND f.breach THEN l.on_s + 1 ELSE 0 END) END
         ELSE 0 END,
    CASE WHEN l.cur = 0 THEN 0
         WHEN l.latch_n + 1 >= {t.max_latch} THEN 0
         WHEN (CASE WHEN f.in_clear THEN l.off_s + 1 ELSE 0 END) >= {t.n_off} THEN 0
         ELSE (CASE WHEN f.in_clear THEN l.off_s + 1 ELSE 0 END) END,
    CASE WHEN l.cur = 0 THEN (CASE WHEN l.lock_r > 0 THEN l.lock_r - 1 ELSE 0 END)
         WHEN l.latch_n + 1 >= {t.max_latch}
              OR (CASE WHEN f.in_clear THEN l.off_s + 1 ELSE 0 END) >= {t.n_off} THEN {t.lockout}
         ELSE l.lock_r END,
    CASE WHEN l.cur = 0 THEN
           CASE WHEN (CASE WHEN l.lock_r = 0 AND f.breach THEN l.on_s + 1 ELSE 0 END) >= {t.n_on} THEN 1 ELSE 0 END
         WHEN l.latch_n + 1 >= {t.max_latch}
              OR (CASE WHEN f.in_clear THEN l.off_s + 1 ELSE 0 END) >= {t.n_off} THEN 0
         ELSE l.latch_n + 1 END
  FROM latch l JOIN flags f ON f.run_key = l.run_key AND f.sample = l.sample + 1),
alarmed AS (
  SELECT f.*, CAST(l.cur AS INTEGER) AS alarm FROM flags f JOIN latch l USING (run_key, sample))"""


@register("e4_ewma", "E4", _oracle_prefix() + """
SELECT run_key, sample, round(z, 6) AS z FROM ew""")
def e4(spark, sf_dir):
    t = telemetry(spark, sf_dir).select("run_key", "sample", SENSOR)
    return al.ewma(t, SENSOR, "z", TUNING.alpha).select("run_key", "sample", r6("z").alias("z"))


@register("d22_alarm_baselines", "D22", _oracle_prefix() + """
SELECT run_key, round(mu_raw, 6) AS mu_raw, round(mu_z, 6) AS mu_z, round(sig_z, 6) AS sig_z,
       round(roc_mu, 6) AS roc_mu, round(roc_sig, 6) AS roc_sig, round(roc_mu + 3.0 * roc_sig, 6) AS roc_thr, t_max
FROM base""")
def d22(spark, sf_dir):
    s = signals(spark, sf_dir)
    b = s.select("run_key", "mu_raw", "mu_z", "sig_z", "roc_mu", "roc_sig", "roc_thr", "t_max").dropDuplicates(["run_key"])
    return b.select("run_key", *[r6(c).alias(c) for c in ["mu_raw", "mu_z", "sig_z", "roc_mu", "roc_sig", "roc_thr"]],
                    "t_max")


@register("e5_alarm_band_flags", "E3 E5 E6 E7", _oracle_prefix() + """
SELECT run_key, sample, round(roc_abs, 6) AS roc_abs, round(lo_t, 6) AS lo_t, round(hi_t, 6) AS hi_t,
       round(lo_pad, 6) AS lo_pad, round(hi_pad, 6) AS hi_pad,
       breach_naive, breach, in_clear, roc_pre
FROM flags""")
def e5(spark, sf_dir):
    s = signals(spark, sf_dir)
    return s.select("run_key", "sample", *[r6(c).alias(c) for c in ["roc_abs", "lo_t", "hi_t", "lo_pad", "hi_pad"]],
                    "breach_naive", "breach", "in_clear", "roc_pre")


@register("e8_deadband_latch", "E8", _oracle_prefix() + """
SELECT run_key, sample, breach, in_clear, alarm FROM alarmed""")
def e8(spark, sf_dir):
    return latched(spark, sf_dir).select("run_key", "sample", "breach", "in_clear", "alarm")


@register("a16_alarm_series", "A16", _oracle_prefix() + """
SELECT run_key, sample, round(z, 6) AS z, round(lo_t, 6) AS loT, round(hi_t, 6) AS hiT,
       round(lo_pad, 6) AS loPad, round(hi_pad, 6) AS hiPad, alarm,
       CAST(breach AS INTEGER) AS breach, CAST(roc_pre AS INTEGER) AS rocPre, 20 AS inject,
       '""" + ";".join(f"{k}={v}" for k, v in sorted(ALARM_TUNING_EVENTS.items())) + """' AS tuning
FROM alarmed""")
def a16(spark, sf_dir):
    a = latched(spark, sf_dir)
    return a.select("run_key", "sample", r6("z").alias("z"), r6("lo_t").alias("loT"), r6("hi_t").alias("hiT"),
                    r6("lo_pad").alias("loPad"), r6("hi_pad").alias("hiPad"), "alarm",
                    F.col("breach").cast("int").alias("breach"), F.col("roc_pre").cast("int").alias("rocPre"),
                    F.lit(INJ).alias("inject"), F.lit(";".join(f"{k}={v}" for k, v in sorted(asdict(TUNING).items()))).alias("tuning"))


_KPI_SQL = _oracle_prefix() + """,
m AS (
  SELECT run_key, sample, 'naive' AS method, CAST(breach_naive AS INTEGER) AS a FROM alarmed
  UNION ALL SELECT run_key, sample, 'ewma', CAST(breach AS INTEGER) FROM alarmed
  UNION ALL SELECT run_key, sample, 'deadband', alarm FROM alarmed),
d AS (
  SELECT *, CASE WHEN lag(a) OVER (PARTITION BY run_key, method ORDER BY sample) IS NOT NULL
                  AND lag(a) OVER (PARTITION BY run_key, method ORDER BY sample) <> a THEN 1 ELSE 0 END AS tr
  FROM m)
SELECT run_key, method,
       count(*) FILTER (WHERE a = 1 AND sample <= 20) AS false_alarms_pre,
       CAST(sum(tr) AS BIGINT) AS transitions,
       CAST(min(CASE WHEN a = 1 AND sample > 20 THEN sample END) - 21 AS INTEGER) AS ttf_post
FROM d GROUP BY run_key, method"""


@register("d23_alarm_kpis", "D23 E9", _KPI_SQL)
def d23(spark, sf_dir):
    a = latched(spark, sf_dir)
    return al.alarm_kpis(a, {"naive": "breach_naive", "ewma": "breach", "deadband": "alarm"}, INJ, dense=True).select(
        "run_key", "method", "false_alarms_pre", "transitions", "ttf_post")


@register("d24_first_trips", "D24", _oracle_prefix() + """
SELECT run_key,
       CAST(min(CASE WHEN sample > 20 AND roc_pre THEN sample END) - 1 AS INTEGER) AS first_pre_index,
       min(CASE WHEN sample > 20 AND roc_pre THEN sample END) AS first_pre_sample,
       CAST(min(CASE WHEN sample > 20 AND alarm = 1 THEN sample END) - 1 AS INTEGER) AS first_latched_index,
       min(CASE WHEN sample > 20 AND alarm = 1 THEN sample END) AS first_latched_sample
FROM alarmed GROUP BY run_key""")
def d24(spark, sf_dir):
    return al.first_trips(latched(spark, sf_dir), INJ)


@register("e10_alarm_episodes", "E10", _oracle_prefix() + """,
s AS (
  SELECT *, CASE WHEN alarm = 1 AND coalesce(lag(alarm) OVER (PARTITION BY run_key ORDER BY sample), 0) <> 1
                 THEN 1 ELSE 0 END AS st
  FROM alarmed),
g AS (SELECT *, sum(st) OVER (PARTITION BY run_key ORDER BY sample ROWS UNBOUNDED PRECEDING) AS grp FROM s),
e AS (
  SELECT run_key, grp, min(sample) AS s0, max(sample) AS l0, count(*) AS n,
         min(CASE WHEN NOT breach THEN sample END) AS fi
  FROM g WHERE alarm = 1 GROUP BY run_key, grp)
SELECT run_key, CAST(s0 - 1 AS INTEGER) AS start, CAST(l0 AS INTEGER) AS end_exclusive,
       CAST(l0 - 1 AS INTEGER) AS last_on, CAST(fi - 1 AS INTEGER) AS first_ideal,
       CAST(l0 + 1 - coalesce(fi, s0) AS BIGINT) AS linger_samples, CAST(n AS BIGINT) AS total_on_samples,
       round(CAST(l0 + 1 - coalesce(fi, s0) AS DOUBLE) * 3.0, 1) AS linger_minutes
FROM e""")
def e10(spark, sf_dir):
    return al.episodes(latched(spark, sf_dir), dense=True)


@register("d33_display_domain", "D33", _oracle_prefix() + """,
g AS (SELECT run_key, min(z) AS lo, max(z) AS hi FROM ew GROUP BY run_key)
SELECT run_key, round(lo - 0.04 * greatest(hi - lo, 1e-9), 6) AS domain_lo,
       round(hi + 0.04 * greatest(hi - lo, 1e-9), 6) AS domain_hi
FROM g""")
def d33(spark, sf_dir):
    t = telemetry(spark, sf_dir).select("run_key", "sample", SENSOR)
    z = al.ewma(t, SENSOR, "z", TUNING.alpha)
    d = al.display_domain(z, "z")
    return d.select("run_key", r6("domain_lo").alias("domain_lo"), r6("domain_hi").alias("domain_hi"))
