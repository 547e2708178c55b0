"""Queries over the events-derived telemetry view: features and run metrics."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import scalars as S
from ..operators import features as fe
from ..operators import metrics as me
from ..operators import prepare as pr
from ..sources.tables import EVENTS_INJECTION, sensor_matrix, telemetry
from . import sql as Q
from .registry import register

ONSET = EVENTS_INJECTION + 1
SENSORS = ["xmeas_13", "xmeas_9", "xmv_10"]


def scored(spark: SparkSession, sf_dir: str, threshold: float = 0.35) -> DataFrame:
    """Telemetry + H4 score columns + B3 binary label + B4 masked target."""
    t = telemetry(spark, sf_dir)
    return (t.withColumn("is_fault", S.is_fault(F.col("p_fault"), threshold))
            .withColumn("health_score", S.health_score(F.col("p_fault")))
            .withColumn("y_true", S.binary_label(F.col("faultNumber"), F.col("sample"), EVENTS_INJECTION))
            .withColumn("target_fault_label", S.masked_target(F.col("faultNumber"), F.col("sample"),
                                                              EVENTS_INJECTION)))


def r6(c) -> F.Column:
    return F.round(c, 6)


# --------------------------------------------------------------------------
# Flagship: rolling features + scores + run detection metrics, one row per run
# --------------------------------------------------------------------------
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir)
    f = fe.rolling_features(s, ["xmeas_13"], [10, 20], dense=True)
    det = me.run_detection_metrics(f, ONSET)
    extra = f.groupBy("run_key").agg(
        F.min("health_score").alias("min_health"),
        F.max("xmeas_13_roll_mean_10").alias("peak_roll_mean_10"),
        F.max("xmeas_13_roll_std_20").alias("peak_roll_std_20"),
        F.count(F.lit(1)).alias("n_samples"))
    out = det.join(extra, "run_key")
    return out.select("run_key", "faultNumber", "simulationRun", "n_samples", "pre_false_alarms", "first_alert",
                      "delay", r6("max_p_fault").alias("max_p_fault"), r6("multiclass_pct").alias("multiclass_pct"),
                      r6("xmeas_13_delta").alias("xmeas_13_delta"), r6("min_health").alias("min_health"),
                      r6("peak_roll_mean_10").alias("peak_roll_mean_10"),
                      r6("peak_roll_std_20").alias("peak_roll_std_20"))


FLAGSHIP_SQL = "WITH " + Q.SCORED + """,
f AS (
  SELECT *, avg(xmeas_13) OVER (PARTITION BY run_key ORDER BY sample ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS rm10,
         coalesce(stddev_samp(xmeas_13) OVER (PARTITION BY run_key ORDER BY sample ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0.0) AS rs20
  FROM scored)
SELECT run_key, faultNumber, simulationRun, count(*) AS n_samples,
       count(*) FILTER (WHERE is_fault = 1 AND sample < 21) AS pre_false_alarms,
       min(CASE WHEN is_fault = 1 THEN sample END) AS first_alert,
       min(CASE WHEN is_fault = 1 THEN sample END) - 21 AS delay,
       round(max(p_fault), 6) AS max_p_fault,
       round(coalesce(avg(CASE WHEN is_fault = 1 THEN CASE WHEN pred_fault = faultNumber THEN 100.0 ELSE 0.0 END END), 0.0), 6) AS multiclass_pct,
       round(avg(CASE WHEN sample >= 21 THEN xmeas_13 END) - avg(CASE WHEN sample < 21 THEN xmeas_13 END), 6) AS xmeas_13_delta,
       round(min(health_score), 6) AS min_health,
       round(max(rm10), 6) AS peak_roll_mean_10,
       round(max(rs20), 6) AS peak_roll_std_20
FROM f GROUP BY run_key, faultNumber, simulationRun
"""

register("flagship_run_report", "E1 H4 B3 B6 D11", FLAGSHIP_SQL)(flagship)


@register("d11_run_detection_metrics", "D11", "WITH " + Q.SCORED + """
SELECT run_key, faultNumber, simulationRun,
       count(*) FILTER (WHERE is_fault = 1 AND sample < 21) AS pre_false_alarms,
       min(CASE WHEN is_fault = 1 THEN sample END) AS first_alert,
       min(CASE WHEN is_fault = 1 THEN sample END) - 21 AS delay,
       round(max(p_fault), 6) AS max_p_fault,
       round(coalesce(avg(CASE WHEN is_fault = 1 THEN CASE WHEN pred_fault = faultNumber THEN 100.0 ELSE 0.0 END END), 0.0), 6) AS multiclass_pct,
       round(avg(CASE WHEN sample >= 21 THEN xmeas_13 END) - avg(CASE WHEN sample < 21 THEN xmeas_13 END), 6) AS xmeas_13_delta
FROM scored GROUP BY run_key, faultNumber, simulationRun""")
def d11(spark, sf_dir):
    d = me.run_detection_metrics(scored(spark, sf_dir), ONSET)
    return d.select("run_key", "faultNumber", "simulationRun", "pre_false_alarms", "first_alert", "delay",
                    r6("max_p_fault").alias("max_p_fault"), r6("multiclass_pct").alias("multiclass_pct"),
                    r6("xmeas_13_delta").alias("xmeas_13_delta"))


def _rolling_sql() -> str:
    cols = []
    for w in [10, 20, 30, 50, 100]:
        for s in SENSORS:
            frame = f"OVER (PARTITION BY run_key ORDER BY sample ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
            cols.append(f"CAST(avg({s}) {frame} AS FLOAT) AS {s}_roll_mean_{w}")
            cols.append(f"CAST(coalesce(stddev_samp({s}) {frame}, 0.0) AS FLOAT) AS {s}_roll_std_{w}")
    return "WITH " + Q.TELEMETRY + "\nSELECT run_key, sample, " + ",\n".join(cols) + "\nFROM telemetry"


@register("e1_rolling_features", "E1 B11", _rolling_sql())
def e1(spark, sf_dir):
    t = telemetry(spark, sf_dir).select("run_key", "sample", *SENSORS)
    f = fe.rolling_features(t, SENSORS, dense=True)
    names = fe.rolling_names(SENSORS)
    # features are stored as float32, like the model matrix
    return f.select("run_key", "sample", *[F.col(n).cast("float").alias(n) for n in names])


MATRIX_SENSORS = [*K.XMEAS_COLUMNS, *K.XMV_COLUMNS]


def _matrix_sql() -> str:
    frames = {w: f"OVER (PARTITION BY faultNumber ORDER BY sample ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)" for w in K.ROLLING_WINDOWS}
    cols = [f"CAST({s} AS FLOAT) AS {s}" for s in MATRIX_SENSORS]
    for w, frame in frames.items():
        for s in MATRIX_SENSORS:
            cols += [f"CAST(avg({s}) {frame} AS FLOAT) AS {s}_roll_mean_{w}", f"CAST(coalesce(stddev_samp({s}) {frame}, 0.0) AS FLOAT) AS {s}_roll_std_{w}"]
    return "WITH " + Q.SENSOR_MATRIX + "\nSELECT faultNumber, sample, " + ",\n".join(cols) + "\nFROM sensor_matrix"


@register("e1_full_feature_matrix", "E1 B11 B7", _matrix_sql())
def e1_full(spark, sf_dir):
    """52 sensors and 520 rolling features: the 572 model columns, in order; a run is a fault class, ordered by sample."""
    m = sensor_matrix(spark, sf_dir)
    sensors = pr.sensor_columns(m)
    out = fe.rolling_matrix(m, sensors, key="faultNumber")
    return out.select("faultNumber", "sample", *fe.model_feature_columns(sensors))


@register("e2_display_smoothing", "E2", "WITH " + Q.TELEMETRY + """
SELECT run_key, sample, round(avg(xmeas_13) OVER (PARTITION BY run_key ORDER BY sample
       ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS xmeas_13_smooth
FROM telemetry""")
def e2(spark, sf_dir):
    t = telemetry(spark, sf_dir).select("run_key", "sample", "xmeas_13")
    f = fe.rolling_features(t, ["xmeas_13"], [10], dense=True)
    return f.select("run_key", "sample", r6("xmeas_13_roll_mean_10").alias("xmeas_13_smooth"))


@register("e3_first_difference", "E3", "WITH " + Q.TELEMETRY + """
SELECT run_key, sample, round(coalesce(xmeas_13 - lag(xmeas_13) OVER (PARTITION BY run_key ORDER BY sample), 0.0), 6) AS dx
FROM telemetry""")
def e3(spark, sf_dir):
    t = telemetry(spark, sf_dir).select("run_key", "sample", "xmeas_13")
    return fe.first_difference(t, "xmeas_13", "dx", dense=True).select("run_key", "sample", r6("dx").alias("dx"))


# Runs as they come: with missing values, cut at the front, and with every third sample missing.
ROUGH = Q.TELEMETRY + """,
rough AS (
  SELECT 'nulls' AS variant, run_key, sample, CASE WHEN event_id % 17 = 0 THEN NULL ELSE xmeas_13 END AS x FROM telemetry
  UNION ALL SELECT 'trimmed', run_key, sample, xmeas_13 FROM telemetry WHERE sample > 20
  UNION ALL SELECT 'gaps', run_key, sample, xmeas_13 FROM telemetry WHERE sample % 3 <> 0)"""


def rough_runs(spark, sf_dir):
    t = telemetry(spark, sf_dir).select("run_key", "sample", "event_id", "xmeas_13")
    nulls = t.select(F.lit("nulls").alias("variant"), "run_key", "sample", F.when(F.col("event_id") % 17 != 0, F.col("xmeas_13")).alias("x"))
    rest = t.select("run_key", "sample", F.col("xmeas_13").alias("x"))
    return (nulls.unionByName(rest.where("sample > 20").withColumn("variant", F.lit("trimmed")))
            .unionByName(rest.where("sample % 3 <> 0").withColumn("variant", F.lit("gaps")))
            .withColumn("run", F.concat_ws("/", "variant", "run_key")))


@register("e1_rolling_rough_runs", "E1", "WITH " + ROUGH + """
SELECT variant, run_key, sample,
       round(avg(x) OVER (PARTITION BY variant, run_key ORDER BY sample ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS mean_10,
       round(coalesce(stddev_samp(x) OVER (PARTITION BY variant, run_key ORDER BY sample ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 0.0), 6) AS std_10
FROM rough""")
def e1_rough(spark, sf_dir):
    f = fe.rolling_features(rough_runs(spark, sf_dir), ["x"], [10], key="run", block=16)
    return f.select("variant", "run_key", "sample", r6("x_roll_mean_10").alias("mean_10"), r6("x_roll_std_10").alias("std_10"))


@register("e4_ewma_rough_runs", "E4", "WITH RECURSIVE " + ROUGH + """,
n AS (SELECT *, row_number() OVER (PARTITION BY variant, run_key ORDER BY sample) AS rn FROM rough),
ew(variant, run_key, sample, rn, z) AS (
  SELECT variant, run_key, sample, rn, x FROM n WHERE rn = 1
  UNION ALL
  SELECT n.variant, n.run_key, n.sample, n.rn, CASE WHEN n.x IS NULL THEN ew.z WHEN ew.z IS NULL THEN n.x ELSE 0.2 * n.x + 0.8 * ew.z END
  FROM ew JOIN n ON n.variant = ew.variant AND n.run_key = ew.run_key AND n.rn = ew.rn + 1)
SELECT variant, run_key, sample, round(z, 6) AS z FROM ew""")
def e4_rough(spark, sf_dir):
    from ..operators import alarms as al
    z = al.ewma(rough_runs(spark, sf_dir), "x", "z", 0.2, key="run", block=16)
    return z.select("variant", "run_key", "sample", r6("z").alias("z"))


@register("e12_trailing_history", "E12", "WITH " + Q.TELEMETRY + """,
h AS (SELECT run_key, sample,
        list(sample) OVER (PARTITION BY run_key ORDER BY sample ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS samples,
        list(xmeas_13) OVER (PARTITION BY run_key ORDER BY sample ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS xs,
        count(*) OVER (PARTITION BY run_key ORDER BY sample ROWS BETWEEN 71 PRECEDING AND CURRENT ROW) AS n_72
      FROM telemetry)
SELECT run_key, sample, array_to_string(samples, ',') AS samples, array_to_string([printf('%.3f', v) for v in xs], ',') AS points,
       CAST(n_72 AS INTEGER) AS n_72 FROM h""")
def e12(spark, sf_dir):
    """The trailing 48-point history at every sample, and the length of the 72-point one."""
    t = telemetry(spark, sf_dir).select("run_key", "sample", "xmeas_13")
    h = fe.trailing_history(t, ["xmeas_13"], 48, dense=True)
    h = fe.trailing_history(h, ["xmeas_13"], 72, out="history_72", dense=True)
    return h.select("run_key", "sample", F.array_join(F.transform("history", lambda p: p["sample"].cast("string")), ",").alias("samples"),
                    F.array_join(F.transform("history", lambda p: F.format_string("%.3f", p["xmeas_13"])), ",").alias("points"),
                    F.size("history_72").alias("n_72"))


@register("e13_fault_onset", "E13", "WITH " + Q.SCORED + """
SELECT run_key, min(CASE WHEN target_fault_label > 0 THEN sample END) AS onset_sample,
       CAST(min(CASE WHEN target_fault_label > 0 THEN sample END) - 1 AS INTEGER) AS onset_index
FROM scored GROUP BY run_key""")
def e13(spark, sf_dir):
    s = scored(spark, sf_dir)
    o = fe.fault_onset(s, "target_fault_label")
    return o.select("run_key", "onset_sample", (F.col("onset_sample") - 1).cast("int").alias("onset_index"))


@register("h4_health_and_flag", "H4 H8 B3 B4", "WITH " + Q.SCORED + """
SELECT run_key, sample, round(p_fault, 6) AS p_fault, round(health_score, 6) AS health_score, is_fault,
       y_true, target_fault_label, sample * 3 AS minutes
FROM scored""")
def h4(spark, sf_dir):
    s = scored(spark, sf_dir)
    return s.select("run_key", "sample", r6("p_fault").alias("p_fault"), r6("health_score").alias("health_score"),
                    "is_fault", "y_true", "target_fault_label", S.sample_minutes(F.col("sample")).alias("minutes"))
