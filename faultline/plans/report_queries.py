"""Comparison, naming, ingest and report-sink queries."""
from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import scalars as S
from ..operators import compare as cmp
from ..operators import prepare as pr
from ..operators import quality as qa
from ..sources import ingest as ing
from ..sources.tables import sensor_matrix, telemetry, with_class_probabilities
from ..session import ensure_checkpoint_dir
from . import sql as Q
from .alert_queries import _q
from .metric_queries import MODELS_SQL, models
from .prepare_queries import I1_SQL, runs_table
from .registry import register
from .telemetry_queries import scored

SENS3 = ["xmeas_13", "xmeas_9", "xmv_10"]


def r6(c):
    return F.round(c, 6)


NAMES_CTE = "names(tag, plain) AS (VALUES " + ", ".join(f"({_q(k)}, {_q(v)})" for k, v in K.SENSOR_PLAIN_NAMES.items()) + ")"


@register("h16_plain_sensor_names", "H16 D5", "WITH " + Q.SENSOR_MATRIX + ", " + NAMES_CTE + ",\n" + "v AS (" +
          "\nUNION ALL\n".join(f"SELECT '{s}' AS sensor, var_samp({s}) AS variance FROM sensor_matrix"
                               for s in K.SENSOR_COLUMNS) + """)
SELECT v.sensor, coalesce(n.plain, regexp_replace(v.sensor, '^xmeas_', 'Plant sensor ')) AS plain_name,
       round(v.variance, 6) AS variance
FROM v LEFT JOIN names n ON n.tag = v.sensor""")
def h16(spark, sf_dir):
    v = qa.variance_ranking(sensor_matrix(spark, sf_dir), K.SENSOR_COLUMNS)
    return v.select("sensor", S.plain_sensor_name(F.col("sensor")).alias("plain_name"), r6("variance").alias("variance"))


@register("c3_risk_sensor_join", "C3 Q4", "WITH " + Q.SCORED + """,
pw AS (SELECT s.faultNumber, s.simulationRun, s.sample, CAST(1 << CAST((s.event_id * (r.cls + 3)) % 11 AS INTEGER) AS DOUBLE) AS w
       FROM scored s, range(1, 21) AS r(cls)),
risk AS (SELECT faultNumber, simulationRun, sample, 1.0 - max(w) / sum(w) AS risk_proxy FROM pw GROUP BY ALL),
sens AS (SELECT faultNumber, simulationRun, sample, xmeas_13 FROM telemetry
         UNION ALL SELECT (faultNumber + 1) % 21, simulationRun, sample, -xmeas_13 FROM telemetry)
SELECT r.faultNumber, r.simulationRun, r.sample, round(r.risk_proxy, 6) AS risk_proxy, round(s.xmeas_13, 6) AS xmeas_13
FROM risk r LEFT JOIN sens s USING (faultNumber, simulationRun, sample)""")
def c3(spark, sf_dir):
    """The sensor side holds every run id under two fault numbers (as the test
    archive does); joining on the fault as well keeps one row per risk row."""
    s = with_class_probabilities(scored(spark, sf_dir))
    risk = s.select("faultNumber", "simulationRun", "sample", S.risk_proxy(F.col("probs")).alias("risk_proxy"))
    t = telemetry(spark, sf_dir)
    sens = t.select("faultNumber", "simulationRun", "sample", "xmeas_13").unionByName(
        t.select(((F.col("faultNumber") + 1) % 21).cast("int").alias("faultNumber"), "simulationRun", "sample",
                 (-F.col("xmeas_13")).alias("xmeas_13")))
    j = cmp.risk_with_sensors(risk, sens)
    return j.select("faultNumber", "simulationRun", "sample", r6("risk_proxy").alias("risk_proxy"),
                    r6("xmeas_13").alias("xmeas_13"))


@register("c6_d12_fault_vs_normal_deviation", "C6 D12", "WITH " + Q.TELEMETRY + """,
l AS (SELECT faultNumber, sample, 'xmeas_13' AS variable, xmeas_13 AS value FROM telemetry
      UNION ALL SELECT faultNumber, sample, 'xmeas_9', xmeas_9 FROM telemetry
      UNION ALL SELECT faultNumber, sample, 'xmv_10', xmv_10 FROM telemetry),
f AS (SELECT faultNumber, variable, avg(value) AS fault_mean FROM l WHERE faultNumber > 0 AND sample > 20 GROUP BY ALL),
n AS (SELECT variable, avg(value) AS normal_mean FROM l WHERE faultNumber = 0 GROUP BY variable)
SELECT f.faultNumber, f.variable, round(f.fault_mean, 6) AS fault_mean, round(n.normal_mean, 6) AS normal_mean,
       round(CASE WHEN n.normal_mean = 0 THEN 0.0 ELSE (f.fault_mean - n.normal_mean) / n.normal_mean * 100.0 END, 6) AS deviation_pct
FROM f JOIN n USING (variable)""")
def c6(spark, sf_dir):
    d = cmp.fault_vs_normal(telemetry(spark, sf_dir), SENS3, 20)
    return d.select("faultNumber", "variable", r6("fault_mean").alias("fault_mean"),
                    r6("normal_mean").alias("normal_mean"), r6("deviation_pct").alias("deviation_pct")).orderBy(
        F.abs("deviation_pct").desc())


@register("c8_same_sample_two_runs", "C8", "WITH " + Q.TELEMETRY + """,
a AS (SELECT sample, xmeas_13 FROM telemetry WHERE simulationRun = (SELECT min(simulationRun) FROM telemetry WHERE faultNumber = 5)),
b AS (SELECT sample, xmeas_13 FROM telemetry WHERE simulationRun = (SELECT min(simulationRun) FROM telemetry WHERE faultNumber = 0))
SELECT coalesce(a.sample, b.sample) AS sample, a.xmeas_13 AS xmeas_13_fault, b.xmeas_13 AS xmeas_13_normal,
       round(a.xmeas_13 - b.xmeas_13, 6) AS diff
FROM a FULL OUTER JOIN b ON a.sample = b.sample""")
def c8(spark, sf_dir):
    t = telemetry(spark, sf_dir)
    canon = t.groupBy("faultNumber").agg(F.min("simulationRun").alias("simulationRun"))
    runs = {r["faultNumber"]: r["simulationRun"] for r in canon.where(F.col("faultNumber").isin(0, 5)).collect()}
    a = t.where(F.col("simulationRun") == runs[5])
    b = t.where(F.col("simulationRun") == runs[0])
    j = cmp.same_sample(a, b, "xmeas_13", names=("fault", "normal"))
    return j.select("sample", "xmeas_13_fault", "xmeas_13_normal", r6("diff").alias("diff"))


@register("a1_typed_ingest", "A1 A7", "WITH " + Q.TELEMETRY + """
SELECT CAST(faultNumber AS SMALLINT) AS faultNumber, simulationRun, sample,
       CAST(xmeas_13 AS FLOAT) AS xmeas_13, CAST(xmeas_9 AS FLOAT) AS xmeas_9, CAST(xmv_10 AS FLOAT) AS xmv_10
FROM telemetry""")
def a1(spark, sf_dir):
    """Export the telemetry as CSV with padded header names (as raw archives
    arrive), then ingest it: stripped names, int16/int32/float32, parquet
    partitioned by fault."""
    base = os.path.join(ensure_checkpoint_dir(spark), "ingest", uuid.uuid4().hex[:12])
    t = telemetry(spark, sf_dir).select(*[F.col(c).alias(f" {c} ") for c in
                                          ["faultNumber", "simulationRun", "sample", *SENS3]])
    ing.write_report(t, os.path.join(base, "csv"), fmt="csv")
    out = ing.typed_ingest(spark, os.path.join(base, "csv"), os.path.join(base, "parquet"), sensors=SENS3)
    return out.select("faultNumber", "simulationRun", "sample", *SENS3)


@register("a2_cached_ingest", "A2", "WITH " + Q.TELEMETRY + """
SELECT 'test' AS split, faultNumber, simulationRun, sample, CAST(xmeas_13 AS FLOAT) AS xmeas_13 FROM telemetry""")
def a2(spark, sf_dir):
    """A copy built from a first version of the source is built again once the source has changed;
    a source that doesn't exist is skipped."""
    base = os.path.join(ensure_checkpoint_dir(spark), "a2", uuid.uuid4().hex)
    t = telemetry(spark, sf_dir).select("faultNumber", "simulationRun", "sample", "xmeas_13")
    for rows in (t.where("sample = 1"), t):
        rows.write.mode("overwrite").option("header", True).csv(f"{base}/csv")
        out = ing.cached_ingest(spark, {"test": f"{base}/csv", "train": f"{base}/absent"}, f"{base}/cache")
    return out.select("split", F.col("faultNumber").cast("int").alias("faultNumber"), "simulationRun", "sample", "xmeas_13")


@register("a2_rejected_values", "A1 A2", "WITH " + Q.TELEMETRY + """,
bad AS (SELECT CASE WHEN event_id % 7 = 0 THEN 'sample' END AS k, CASE WHEN event_id % 5 = 0 THEN 'xmeas_13' END AS v FROM telemetry)
SELECT 'sample' AS "column", count(*) AS n_values, count(*) AS n_rows_dropped FROM bad WHERE k IS NOT NULL
UNION ALL SELECT 'xmeas_13', count(*), count(k) FROM bad WHERE v IS NOT NULL""")
def a2_rejected(spark, sf_dir):
    """Text that isn't a number in some rows' sample and sensor is counted and doesn't stop the ingest."""
    base = os.path.join(ensure_checkpoint_dir(spark), "a2", uuid.uuid4().hex)
    t = telemetry(spark, sf_dir)
    spoilt = lambda c, k, text: F.when(F.col("event_id") % k == 0, F.lit(text)).otherwise(F.col(c).cast("string")).alias(c)
    t.select("faultNumber", "simulationRun", spoilt("sample", 7, "?"), spoilt("xmeas_13", 5, "1,5e")).write.option("header", True).csv(f"{base}/csv")
    return ing.rejected_values(spark, f"{base}/csv")


A4_FAULTS = (1, 4, 6, 11, 14)


@register("a4_key_filtered_scan", "A4 C1", I1_SQL + f"""
SELECT t.run_key, t.sample FROM telemetry t JOIN r USING (run_key) WHERE rk <= 3 AND r.faultNumber IN {A4_FAULTS}""")
def a4(spark, sf_dir):
    """Three runs of each of some faults, from a copy that is partitioned by fault and clustered by run."""
    path = os.path.join(ensure_checkpoint_dir(spark), "a4", uuid.uuid4().hex)
    t = telemetry(spark, sf_dir).select("faultNumber", "simulationRun", "sample", "run_key")
    ing.write_runs(t, path)
    keys = pr.sample_runs_per_fault(runs_table(spark, sf_dir), 3).where(F.col("faultNumber").isin(*A4_FAULTS))
    return ing.scan_keys(spark.read.schema(t.schema).parquet(path), keys).select("run_key", "sample")


@register("a17_dashboard_bundle", "A17", MODELS_SQL + """,
k AS (SELECT count(*) FILTER (WHERE y_true = 1 AND is_fault = 1) AS tp, count(*) FILTER (WHERE y_true = 1) AS pos,
             count(*) FILTER (WHERE y_true = 0 AND is_fault = 1) AS fp, count(*) FILTER (WHERE y_true = 0) AS neg,
             count(*) FILTER (WHERE faultNumber = 99) AS never FROM scored),
top AS (SELECT model, accuracy, macro_f1 FROM cmp WHERE fold = 'test' ORDER BY macro_f1 DESC, model LIMIT 1),
newest AS (SELECT run_key FROM scored GROUP BY run_key ORDER BY max(ts) DESC, run_key LIMIT 1),
risk AS (SELECT run_key AS risk_run, count(*) AS risk_points, round(max(p_fault), 6) AS risk_max,
                min(CASE WHEN y_true = 1 THEN sample END) - 1 AS fault_onset_index FROM scored JOIN newest USING (run_key) GROUP BY run_key),
watch AS (SELECT count(*) AS n_incidents FROM prf JOIN top USING (model) WHERE fold = 'test' AND r < 0.88)
SELECT 'notebook' AS source, model AS champion, round(accuracy, 4) AS champion_accuracy, round(macro_f1, 4) AS champion_macro_f1,
       3 AS feature_count, risk_run, risk_points, risk_max, coalesce(fault_onset_index, -1) AS fault_onset_index,
       n_incidents, coalesce(nullif(round(CAST(tp AS DOUBLE) / pos, 4), 0), 0.9) AS recall,
       coalesce(nullif(round(CAST(fp AS DOUBLE) / neg, 4), 0), 0.2) AS false_alarm_rate,
       coalesce(nullif(CAST(never AS DOUBLE), 0), 0.35) AS threshold
FROM k, top, risk, watch""")
def a17(spark, sf_dir):
    """Defaults overridden by artefacts computed from the data: the champion with its row of the
    held-out comparison, the newest risk series, incidents of weak classes and the binary
    metrics, of which a zero counts as missing (the threshold artefact here is deliberately absent)."""
    from ..operators import alerts as al
    from ..operators import metrics as me
    s = scored(spark, sf_dir)
    rate = lambda y, name: F.round(F.count_if((F.col("y_true") == y) & (F.col("is_fault") == 1)) / F.count_if(F.col("y_true") == y), 4).alias(name)
    binary = s.agg(rate(1, "recall"), rate(0, "false_alarm_rate"), F.count_if(F.col("faultNumber") == 99).cast("double").alias("threshold"))
    report = me.classification_report(models(spark, sf_dir).where(F.col("fold") == "test"), "y_true_mc", "y_pred", ["model"]).checkpoint()    # a row a model and class
    champion = ing.metrics_manifest(report).where(F.col("model") == F.col("best_model")).select(
        F.col("model").alias("champion"), F.col("accuracy").alias("champion_accuracy"), F.col("macro_f1").alias("champion_macro_f1"))
    newest = s.groupBy("run_key").agg(F.max("ts").alias("last")).orderBy(F.col("last").desc(), "run_key").limit(1).select("run_key")
    risk = s.join(newest, "run_key", "left_semi").agg(F.max("run_key").alias("risk_run"), F.count("*").alias("risk_points"), F.round(F.max("p_fault"), 6).alias("risk_max"),
                                                      F.min(F.when(F.col("y_true") == 1, F.col("sample") - 1)).alias("fault_onset_index"))
    classes = report.join(champion, F.col("model") == F.col("champion"), "left_semi").where(F.col("label").try_cast("int").isNotNull())
    watch = al.recall_watch(classes.select(F.col("label").cast("int").alias("label"), "recall", F.lit(None).cast("string").alias("name"))).agg(F.count("*").alias("n_incidents"))
    features = sum(c.startswith(("xmeas_", "xmv_")) for c in s.columns)
    art = binary.crossJoin(champion).crossJoin(risk).crossJoin(watch)                # one row each
    art = art.withColumns({"source": F.lit("notebook"), "feature_count": F.lit(features)})
    defaults = {"source": "default", "champion": None, "champion_accuracy": None, "champion_macro_f1": None, "feature_count": None, "risk_run": None, "risk_points": None,
                "risk_max": None, "fault_onset_index": -1, "n_incidents": None, "recall": 0.9, "false_alarm_rate": 0.2, "threshold": 0.35}
    return ing.dashboard_bundle(defaults, art, zero_is_missing=["recall", "false_alarm_rate", "threshold"])


@register("a8_metrics_manifest", "A8", MODELS_SQL + """,
w AS (SELECT model, sum(f * support) / sum(support) AS weighted_f1,
             string_agg(c || ':' || printf('%.4f/%.4f/%.4f/%d', round(p, 4), round(r, 4), round(f, 4), CAST(support AS BIGINT)), ' ' ORDER BY CAST(c AS VARCHAR)) AS per_class
      FROM prf WHERE fold = 'test' GROUP BY model)
SELECT model, round(accuracy, 4) AS accuracy, round(macro_f1, 4) AS macro_f1, round(weighted_f1, 4) AS weighted_f1, per_class,
       first_value(model) OVER (ORDER BY macro_f1 DESC, model) AS best_model
FROM cmp JOIN w USING (model) WHERE fold = 'test'""")
def a8(spark, sf_dir):
    """The manifest of both models' held-out reports, written as JSON and read back; the best one is found, not told."""
    from ..operators import metrics as me
    rep = me.classification_report(models(spark, sf_dir).where(F.col("fold") == "test"), "y_true_mc", "y_pred", ["model"])
    path = os.path.join(ensure_checkpoint_dir(spark), "reports", f"manifest-{uuid.uuid4().hex[:12]}")
    ing.write_report(ing.metrics_manifest(rep).coalesce(1), path, fmt="json")     # one small document
    back = spark.read.json(path)
    text = F.transform("per_class", lambda c: F.concat(c["label"], F.lit(":"), F.format_string(
        "%.4f/%.4f/%.4f/%d", c["precision"], c["recall"], c["f1"], c["support"])))
    return back.select("model", "accuracy", "macro_f1", "weighted_f1", F.array_join(text, " ").alias("per_class"), "best_model")


@register("b5_fault_period_after_features", "B5", "WITH " + Q.SCORED + """,
f AS (SELECT run_key, sample, target_fault_label,
             CAST(avg(xmeas_13) OVER (PARTITION BY run_key ORDER BY sample ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS FLOAT) AS xmeas_13_roll_mean_30
      FROM scored)
SELECT run_key, sample, target_fault_label, xmeas_13_roll_mean_30 FROM f WHERE target_fault_label > 0""")
def b5(spark, sf_dir):
    """Windows see the pre-fault rows; the fault-period filter comes after them."""
    from ..operators import features as fe
    f = fe.rolling_features(scored(spark, sf_dir), ["xmeas_13"], [30], dense=True)
    return f.where(F.col("target_fault_label") > 0).select(
        "run_key", "sample", "target_fault_label", F.col("xmeas_13_roll_mean_30").cast("float").alias("xmeas_13_roll_mean_30"))


@register("c7_probability_alignment", "C7", "WITH " + Q.SCORED + """,
pw AS (SELECT s.run_key, s.sample, CAST(r.cls AS INTEGER) AS cls,
              CAST(1 << CAST((s.event_id * (r.cls + 3)) % 11 AS INTEGER) AS DOUBLE) AS w
       FROM scored s, range(1, 21) AS r(cls)),
pp AS (SELECT run_key, sample, cls, w / sum(w) OVER (PARTITION BY run_key, sample) AS p FROM pw)
SELECT run_key, sample, 0.0 AS p_0, round(max(CASE WHEN cls = 1 THEN p END), 6) AS p_1,
       round(max(CASE WHEN cls = 13 THEN p END), 6) AS p_13, 0.0 AS p_21, 22 AS n_labels
FROM pp GROUP BY run_key, sample""")
def c7(spark, sf_dir):
    """Model classes 1..20 aligned to the label list 0..21: absent labels get 0."""
    from ..operators import alerts as ops
    s = with_class_probabilities(scored(spark, sf_dir))
    m = s.withColumn("pm", F.map_from_arrays(F.sequence(F.lit(1), F.lit(20)), F.col("probs")))
    a = m.withColumn("al", ops.align_probabilities(F.col("pm"), list(range(0, 22))))
    return a.select("run_key", "sample", F.col("al")[0].alias("p_0"), r6(F.col("al")[1]).alias("p_1"),
                    r6(F.col("al")[13]).alias("p_13"), F.col("al")[21].alias("p_21"), F.size("al").alias("n_labels"))
