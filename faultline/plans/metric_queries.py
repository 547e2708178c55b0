"""Evaluation queries: confusion, reports, log loss, ROC, threshold sweep and choice."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import metrics as me
from ..sources.tables import with_class_probabilities
from .prepare_queries import _I5, split_rows
from .registry import register


def r6(c):
    return F.round(c, 6)


def cascade(spark, sf_dir):
    """Binary gate then diagnosis; the class is kept even when not faulty."""
    s = split_rows(spark, sf_dir)
    return (s.withColumn("y_pred", F.when(F.col("is_fault") == 1, F.col("pred_fault")).otherwise(F.lit(0)))
             .withColumn("y_true_mc", F.col("target_fault_label")))


# SQL: scored + fold (sf) + cascade prediction
CASCADE = _I5 + """,
cs AS (SELECT *, CASE WHEN is_fault = 1 THEN pred_fault ELSE 0 END AS y_pred, target_fault_label AS y_true_mc FROM sf)"""

CM_SQL = CASCADE + """,
cls AS (SELECT y_true_mc AS c FROM cs UNION SELECT y_pred FROM cs),
cnt AS (SELECT y_true_mc, y_pred, count(*) AS n FROM cs GROUP BY y_true_mc, y_pred),
grid AS (SELECT a.c AS y_true_mc, b.c AS y_pred FROM cls a, cls b),
cm AS (SELECT g.y_true_mc, g.y_pred, CAST(coalesce(c.n, 0) AS BIGINT) AS n
       FROM grid g LEFT JOIN cnt c USING (y_true_mc, y_pred))"""


@register("j15_cascade_prediction", "J15", CASCADE + """
SELECT run_key, sample, is_fault, pred_fault AS fault_type_pred, y_pred AS diagnosis FROM cs""")
def j15(spark, sf_dir):
    c = cascade(spark, sf_dir)
    return c.select("run_key", "sample", "is_fault", F.col("pred_fault").alias("fault_type_pred"),
                    F.col("y_pred").alias("diagnosis"))


@register("d13_confusion_matrix", "D13", CM_SQL + """
SELECT y_true_mc, y_pred, n, round(n / greatest(sum(n) OVER (PARTITION BY y_true_mc), 1), 6) AS rate FROM cm""")
def d13(spark, sf_dir):
    cm = me.confusion_matrix(cascade(spark, sf_dir), "y_true_mc", "y_pred")
    return cm.select("y_true_mc", "y_pred", "n", r6("rate").alias("rate"))


REPORT_SQL = CM_SQL + """,
per AS (
  SELECT l.c AS label,
         (SELECT n FROM cm WHERE y_true_mc = l.c AND y_pred = l.c) AS tp,
         (SELECT sum(n) FROM cm WHERE y_true_mc = l.c) AS support,
         (SELECT sum(n) FROM cm WHERE y_pred = l.c) AS predicted
  FROM cls l),
pr AS (SELECT label, tp, support,
              CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM per),
prf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pr),
report AS (
  SELECT CAST(label AS VARCHAR) AS label, precision, recall, f1, CAST(support AS BIGINT) AS support FROM prf
  UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM prf
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM prf
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM prf)"""


@register("d14_classification_report", "D14 A8", REPORT_SQL + """
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report""")
def d14(spark, sf_dir):
    r = me.classification_report(cascade(spark, sf_dir), "y_true_mc", "y_pred")
    return r.select("label", r6("precision").alias("precision"), r6("recall").alias("recall"), r6("f1").alias("f1"),
                    "support")


@register("d15_accuracy_by_fold", "D15", CASCADE + """
SELECT fold, round(avg(CASE WHEN y_true_mc = y_pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n_rows
FROM cs GROUP BY fold""")
def d15(spark, sf_dir):
    a = me.accuracy_by(cascade(spark, sf_dir), "y_true_mc", "y_pred", ["fold"])
    return a.select("fold", r6("accuracy").alias("accuracy"), "n_rows")


@register("d16_log_loss", "D16 B5", CASCADE + """,
pw AS (SELECT c.run_key, c.sample, c.fold, c.target_fault_label, CAST(r.cls AS INTEGER) AS cls,
              CAST(1 << CAST((c.event_id * (r.cls + 3)) % 11 AS INTEGER) AS DOUBLE) AS w
       FROM cs c, range(1, 21) AS r(cls) WHERE c.target_fault_label > 0),
pt AS (SELECT run_key, sample, fold, sum(w) AS tot, max(CASE WHEN cls = target_fault_label THEN w END) AS wt
       FROM pw GROUP BY run_key, sample, fold)
SELECT fold, round(-avg(ln(greatest(least(wt / tot, 1.0 - 2.220446049250313e-16), 2.220446049250313e-16))), 6) AS log_loss
FROM pt GROUP BY fold""")
def d16(spark, sf_dir):
    c = with_class_probabilities(cascade(spark, sf_dir).where(F.col("target_fault_label") > 0))
    c = c.withColumn("classes", F.sequence(F.lit(1), F.lit(20)))
    ll = me.log_loss(c, "target_fault_label", "probs", "classes", ["fold"])
    return ll.select("fold", r6("log_loss").alias("log_loss"))


ROC_SQL = CASCADE + """,
g AS (SELECT p_fault AS threshold, count(*) FILTER (WHERE y_true = 1) AS pos, count(*) FILTER (WHERE y_true <> 1) AS neg
      FROM cs GROUP BY p_fault),
t AS (SELECT count(*) FILTER (WHERE y_true = 1) AS P, count(*) FILTER (WHERE y_true <> 1) AS N FROM cs),
c AS (SELECT threshold, pos, neg, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp FROM g)"""


@register("d17_roc_curve", "D17", ROC_SQL + """
SELECT round(threshold, 6) AS threshold, round(tp / P, 6) AS tpr, round(fp / N, 6) AS fpr FROM c, t""")
def d17c(spark, sf_dir):
    from .telemetry_queries import scored
    r = me.roc_curve(scored(spark, sf_dir), "y_true", "p_fault")
    return r.select(r6("threshold").alias("threshold"), r6("tpr").alias("tpr"), r6("fpr").alias("fpr"))


@register("d17_roc_auc", "D17", ROC_SQL + """
SELECT round(sum(neg * (2 * (tp - pos) + pos) / 2.0) / (max(P) * max(N)), 6) AS auc FROM c, t""")
def d17a(spark, sf_dir):
    from .telemetry_queries import scored
    return me.roc_auc(scored(spark, sf_dir), "y_true", "p_fault").select(r6("auc").alias("auc"))


SWEEP_SQL = CASCADE + """,
grid AS (SELECT i / 100.0 AS threshold FROM range(10, 95, 2) AS r(i)),
cnt AS (SELECT g.threshold,
          count(*) FILTER (WHERE c.p_fault >= g.threshold AND c.y_true = 1) AS tp,
          count(*) FILTER (WHERE c.p_fault >= g.threshold AND c.y_true <> 1) AS fp,
          count(*) FILTER (WHERE c.p_fault < g.threshold AND c.y_true = 1) AS fn,
          count(*) FILTER (WHERE c.p_fault < g.threshold AND c.y_true <> 1) AS tn
        FROM grid g, cs c GROUP BY g.threshold),
rates AS (SELECT threshold, tp, fp,
          round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 4) AS recall,
          round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 4) AS precision,
          CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r_raw,
          CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p_raw,
          round(CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0.0 END, 4) AS false_alarm_rate,
          round(CASE WHEN fn + tp > 0 THEN fn / (fn + tp) ELSE 0.0 END, 4) AS missed_fault_rate FROM cnt),
sweep AS (SELECT threshold, recall, precision,
          round(CASE WHEN r_raw + p_raw > 0 THEN 2 * r_raw * p_raw / (r_raw + p_raw) ELSE 0.0 END, 4) AS f1,
          false_alarm_rate, missed_fault_rate, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp FROM rates)"""


def sweep_df(spark, sf_dir):
    # the sweep covers every row, so it reads the scored view directly (no fold join)
    from .telemetry_queries import scored
    return me.threshold_sweep(scored(spark, sf_dir), "y_true", "p_fault")


@register("d18_threshold_sweep", "D18 Q12", SWEEP_SQL + "\nSELECT * FROM sweep")
def d18(spark, sf_dir):
    return sweep_df(spark, sf_dir)


@register("d19_threshold_choice", "D19", SWEEP_SQL + """,
ch AS (SELECT coalesce(max(threshold) FILTER (WHERE missed_fault_rate <= 0.1 AND false_alarm_rate <= 0.5),
                       max(threshold) FILTER (WHERE missed_fault_rate <= 0.1),
                       arg_min(threshold, missed_fault_rate * 1000 + threshold)) AS threshold,
              CASE WHEN count(*) FILTER (WHERE missed_fault_rate <= 0.1 AND false_alarm_rate <= 0.5) > 0 THEN 'recall>90% AND FAR<50%'
                   WHEN count(*) FILTER (WHERE missed_fault_rate <= 0.1) > 0 THEN 'recall>90% only'
                   ELSE 'best recall available' END AS strategy FROM sweep)
SELECT s.*, ch.strategy FROM sweep s JOIN ch USING (threshold)""")
def d19(spark, sf_dir):
    return me.choose_threshold(sweep_df(spark, sf_dir))


@register("d20_operating_region", "D20", SWEEP_SQL + """
SELECT min(threshold) AS min_threshold, max(threshold) AS max_threshold,
       arg_min(recall, threshold) AS recall_at_min, arg_max(recall, threshold) AS recall_at_max,
       min(false_alarm_rate) AS far_min, max(false_alarm_rate) AS far_max, count(*) AS n_feasible
FROM sweep WHERE missed_fault_rate <= 0.1 AND false_alarm_rate <= 0.5
HAVING count(*) > 0""")
def d20(spark, sf_dir):
    return me.operating_region(sweep_df(spark, sf_dir))


@register("d21_binary_rates_test", "D21", CASCADE + """
SELECT count(*) FILTER (WHERE y_true = 1 AND is_fault = 1) AS tp, count(*) FILTER (WHERE y_true <> 1 AND is_fault = 1) AS fp,
       count(*) FILTER (WHERE y_true = 1 AND is_fault <> 1) AS fn, count(*) FILTER (WHERE y_true <> 1 AND is_fault <> 1) AS tn,
       round(coalesce(CAST(count(*) FILTER (WHERE y_true <> 1 AND is_fault = 1) AS DOUBLE) / nullif(count(*) FILTER (WHERE y_true <> 1), 0), 0.0), 6) AS false_alarm_rate,
       round(coalesce(CAST(count(*) FILTER (WHERE y_true = 1 AND is_fault <> 1) AS DOUBLE) / nullif(count(*) FILTER (WHERE y_true = 1), 0), 0.0), 6) AS missed_fault_rate,
       round(CAST(count(*) FILTER (WHERE y_true = is_fault) AS DOUBLE) / count(*), 6) AS accuracy
FROM cs WHERE fold = 'test'""")
def d21(spark, sf_dir):
    c = cascade(spark, sf_dir).where(F.col("fold") == "test")
    b = me.binary_rates(c, "y_true", "is_fault")
    return b.select("tp", "fp", "fn", "tn", r6("false_alarm_rate").alias("false_alarm_rate"),
                    r6("missed_fault_rate").alias("missed_fault_rate"), r6("accuracy").alias("accuracy"))


def models(spark, sf_dir):
    """Both models' predictions of a row side by side, spread out by model: one scan for both."""
    c = with_class_probabilities(cascade(spark, sf_dir))
    best = F.array_position("probs", F.array_max("probs")).cast("int")
    both = F.array(F.struct(F.lit("cascade").alias("model"), F.col("y_pred").cast("int").alias("y_pred")),
                   F.struct(F.lit("argmax").alias("model"), F.when(F.col("is_fault") == 1, best).otherwise(F.lit(0)).alias("y_pred")))
    return c.select("fold", "y_true_mc", F.inline(both))


def _comparison(spark, sf_dir):
    rep = me.classification_report(models(spark, sf_dir), "y_true_mc", "y_pred", ["model", "fold"])
    of = lambda label, value, name: F.max(F.when(F.col("label") == label, F.col(value))).alias(name)
    return rep.groupBy("model", "fold").agg(of("accuracy", "f1", "accuracy"), of("macro avg", "precision", "macro_precision"), of("macro avg", "recall", "macro_recall"), of("macro avg", "f1", "macro_f1"))


MODELS_SQL = CASCADE + """,
pw AS (SELECT c.run_key, c.sample, CAST(r.cls AS INTEGER) AS cls,
              CAST(1 << CAST((c.event_id * (r.cls + 3)) % 11 AS INTEGER) AS DOUBLE) AS w
       FROM cs c, range(1, 21) AS r(cls)),
pw2 AS (SELECT *, max(w) OVER (PARTITION BY run_key, sample) AS wmax FROM pw),
pc AS (SELECT run_key, sample, CAST(min(CASE WHEN w = wmax THEN cls END) AS INTEGER) AS pred_class FROM pw2 GROUP BY run_key, sample),
m AS (SELECT fold, y_true_mc, 'cascade' AS model, y_pred FROM cs
      UNION ALL SELECT c.fold, c.y_true_mc, 'argmax', CASE WHEN c.is_fault = 1 THEN p.pred_class ELSE 0 END
      FROM cs c JOIN pc p USING (run_key, sample)),
lab AS (SELECT DISTINCT model, fold, y_true_mc AS c FROM m UNION SELECT DISTINCT model, fold, y_pred FROM m),
per AS (SELECT l.model, l.fold, l.c,
          (SELECT count(*) FROM m WHERE m.model = l.model AND m.fold = l.fold AND y_true_mc = l.c AND y_pred = l.c) AS tp,
          (SELECT count(*) FROM m WHERE m.model = l.model AND m.fold = l.fold AND y_true_mc = l.c) AS support,
          (SELECT count(*) FROM m WHERE m.model = l.model AND m.fold = l.fold AND y_pred = l.c) AS predicted
        FROM lab l),
pr AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p,
                 CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM per),
prf AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM pr),
cmp AS (SELECT model, fold, sum(tp) / sum(support) AS accuracy, avg(p) AS macro_precision, avg(r) AS macro_recall,
               avg(f) AS macro_f1 FROM prf GROUP BY model, fold)"""


@register("d26_model_comparison", "D26 G1", MODELS_SQL + """
SELECT model, fold, round(accuracy, 4) AS accuracy, round(macro_precision, 4) AS macro_precision,
       round(macro_recall, 4) AS macro_recall, round(macro_f1, 4) AS macro_f1 FROM cmp""")
def d26(spark, sf_dir):
    c = _comparison(spark, sf_dir)
    return c.select("model", "fold", *[F.round(x, 4).alias(x) for x in
                                       ["accuracy", "macro_precision", "macro_recall", "macro_f1"]])


@register("f3_best_model", "F3", MODELS_SQL + """
SELECT model, round(macro_recall, 4) AS macro_recall, round(macro_f1, 4) AS macro_f1
FROM cmp WHERE fold = 'test' ORDER BY macro_recall DESC, macro_f1 DESC, model LIMIT 1""")
def f3(spark, sf_dir):
    c = _comparison(spark, sf_dir).where(F.col("fold") == "test")
    best = c.orderBy(F.col("macro_recall").desc(), F.col("macro_f1").desc(), "model").limit(1)
    return best.select("model", F.round("macro_recall", 4).alias("macro_recall"), F.round("macro_f1", 4).alias("macro_f1"))


def per_class_recall(spark, sf_dir):
    rep = me.classification_report(cascade(spark, sf_dir), "y_true_mc", "y_pred")
    return rep.where(~F.col("label").isin("accuracy", "macro avg", "weighted avg")).select(
        F.col("label").try_cast("int").alias("label"), "recall", F.lit(None).cast("string").alias("name"))


@register("d29_hardest_fault", "D29 H15", REPORT_SQL + """,
w AS (SELECT CAST(label AS INTEGER) AS label, recall FROM report WHERE label NOT IN ('accuracy', 'macro avg', 'weighted avg'))
SELECT label, round(recall, 6) AS recall, 'Fault type ' || CAST(label AS VARCHAR) AS name,
       CAST(least(greatest(floor(recall * 10 + 0.5), 1), 10) AS INTEGER) AS caught_of_10
FROM w ORDER BY recall, label LIMIT 1""")
def d29(spark, sf_dir):
    from ..operators.alerts import hardest_fault
    h = hardest_fault(per_class_recall(spark, sf_dir))
    return h.select("label", r6("recall").alias("recall"), "name", "caught_of_10")


@register("d30_recall_watch_incidents", "D30", REPORT_SQL + """,
w AS (SELECT CAST(label AS INTEGER) AS label, recall FROM report WHERE label NOT IN ('accuracy', 'macro avg', 'weighted avg')),
f AS (SELECT *, row_number() OVER (ORDER BY label) AS n FROM w WHERE recall < 0.88)
SELECT 'nb-fault-' || CAST(label AS VARCHAR) || '-' || CAST(n AS VARCHAR) AS id,
       make_timestamp(2026, 3, CAST(least(28, 1 + n) AS BIGINT), 0, 0, 0) AS ts,
       CASE WHEN recall < 0.75 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, 'DCS / Analytics' AS subsystem,
       'Holdout recall watch · TEP fault class ' || CAST(label AS VARCHAR) AS title, label AS faultId, n > 2 AS acknowledged,
       'Class ' || CAST(label AS VARCHAR) || ' recall ' || printf('%.1f', recall * 100) || '%' AS diagnosis,
       coalesce(a.action, '""" + K.UNKNOWN_FAULT_ACTION.replace("'", "''") + """') AS "recommendedAction"
FROM f LEFT JOIN (VALUES """ + ", ".join(f"({row[0]}, '{row[5].replace(chr(39), chr(39) * 2)}')" for row in K.FAULT_CATALOG) + """) AS a(id, action) ON a.id = f.label""")
def d30(spark, sf_dir):
    from ..operators.alerts import recall_watch
    return recall_watch(per_class_recall(spark, sf_dir))
