"""Evaluation metrics: run detection, confusion, reports, ROC, threshold sweep.

All metrics are grouped aggregates (map-side partial aggregation, so hot
groups cost nothing extra) or operate on pre-aggregated tables whose size is
bounded by the number of classes / thresholds / distinct scores.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.constants import MAX_FAR_ALLOWED, MISSED_FAULT_TARGET, SWEEP_GRID_PERCENT
from ..session import ensure_checkpoint_dir
from .blocked import global_prefix


# --------------------------------------------------------------------------
# D11 run detection metrics
# --------------------------------------------------------------------------
def run_detection_metrics(scored: DataFrame, onset: int, fault_col: str = "faultNumber",
                          key: str = "run_key", score: str = "p_fault", is_fault: str = "is_fault",
                          pred: str = "pred_fault", sensor: str = "xmeas_13") -> DataFrame:
    """Per run: pre-onset alarms, first alert, delay (may be negative), max P,
    % of alerts with the right class, post - pre mean of one sensor."""
    alert = F.col(is_fault) == 1
    pre = F.col("sample") < onset
    return scored.groupBy(key, fault_col, "simulationRun").agg(
        F.count_if(alert & pre).alias("pre_false_alarms"),
        F.min(F.when(alert, F.col("sample"))).alias("first_alert"),
        (F.min(F.when(alert, F.col("sample"))) - F.lit(onset)).alias("delay"),
        F.max(score).alias("max_p_fault"),
        F.coalesce(F.avg(F.when(alert, (F.col(pred) == F.col(fault_col)).cast("double") * 100.0)),
                   F.lit(0.0)).alias("multiclass_pct"),
        (F.avg(F.when(~pre, F.col(sensor).cast("double"))) - F.avg(F.when(pre, F.col(sensor).cast("double"))))
        .alias(f"{sensor}_delta"),
    )


# --------------------------------------------------------------------------
# D13-D15 confusion matrix, classification report, accuracy
# --------------------------------------------------------------------------
def cell_counts(df: DataFrame, y: str = "y_true", pred: str = "y_pred", by: Sequence[str] = ()) -> DataFrame:
    """(by, y, pred, n): the only pass over the rows that matrix and report need.

    At most classes^2 rows a group; checkpointed, because several small results read it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.groupBy(*by, y, pred).agg(F.count(F.lit(1)).alias("n")).checkpoint()


def confusion_matrix(df: DataFrame, y: str = "y_true", pred: str = "y_pred",
                     by: Sequence[str] = (), counts: DataFrame | None = None) -> DataFrame:
    """Long-form confusion matrix with zero cells over the union of classes.

    The cells are counted once; the class grid is built from the counts by
    exploding the (bounded) class set twice.
    """
    by = list(by)
    counts = cell_counts(df, y, pred, by) if counts is None else counts
    classes = (counts.select(*by, F.explode(F.array(y, pred)).alias("c"))
               .groupBy(*by).agg(F.array_sort(F.collect_set("c")).alias("cs")))
    grid = (classes.select(*by, F.explode("cs").alias(y), F.col("cs"))
            .select(*by, y, F.explode("cs").alias(pred)))
    cm = grid.join(counts, by + [y, pred], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    row_total = F.sum("n").over(Window.partitionBy(*by, y))
    return cm.withColumn("rate", F.col("n") / F.greatest(row_total, F.lit(1)))


def classification_report(df: DataFrame, y: str = "y_true", pred: str = "y_pred",
                          by: Sequence[str] = ()) -> DataFrame:
    """Per-class precision/recall/F1/support plus accuracy, macro and weighted avg.

    Zero division yields 0.  Classes are the union of true and predicted labels.
    One pass over the rows; the rest works on the table of cells.
    """
    by = list(by)
    counts = cell_counts(df, y, pred, by)
    # a cell adds to its true label's support and to its predicted label's predictions
    per = counts.select(*by, F.inline(F.array(
        F.struct(F.col(y).alias("label"), F.when(F.col(y) == F.col(pred), F.col("n")).otherwise(0).alias("tp"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col(pred).alias("label"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")))))
    per = per.groupBy(*by, "label").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    per = (per
           .withColumn("precision", F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0)))
           .withColumn("recall", F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0)))
           .withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                    2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                       .otherwise(F.lit(0.0))))
    per_out = per.select(*by, F.col("label").cast("string").alias("label"), "precision", "recall", "f1",
                         F.col("support").cast("long").alias("support"))
    tot = per.groupBy(*by).agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("n"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    row = lambda name, *v: F.struct(F.lit(name).alias("label"), *[x.alias(c) for x, c in zip(v, ("precision", "recall", "f1"))], F.col("n").cast("long").alias("support"))
    rate = F.col("tp") / F.col("n")
    averages = tot.select(*by, F.inline(F.array(row("accuracy", rate, rate, rate), row("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
                                                row("weighted avg", F.col("wp"), F.col("wr"), F.col("wf")))))
    return per_out.unionByName(averages)


def accuracy_by(df: DataFrame, y: str = "y_true", pred: str = "y_pred", by: Sequence[str] = ("fold",)) -> DataFrame:
    """Accuracy per fold."""
    return df.groupBy(*by).agg(F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"),
                               F.count(F.lit(1)).alias("n_rows"))


def log_loss(df: DataFrame, y: str, probs: str, classes: str, by: Sequence[str] = (),
             eps: float = 2.220446049250313e-16) -> DataFrame:
    """Multiclass log loss (natural log) after row-normalising the probabilities.

    ``probs`` is an array aligned with the array column ``classes``.
    """
    total = F.aggregate(F.col(probs), F.lit(0.0), lambda acc, p: acc + p)
    p_true = F.element_at(F.col(probs), F.array_position(F.col(classes), F.col(y)).cast("int"))
    p = F.greatest(F.least(p_true / total, F.lit(1.0 - eps)), F.lit(eps))
    return df.groupBy(*by).agg((-F.avg(F.log(p))).alias("log_loss"))


# --------------------------------------------------------------------------
# D17 ROC curve and AUC
# --------------------------------------------------------------------------
ROC_RANGE = 100_000      # distinct scores in a range of the cumulative sums, about


def score_table(df: DataFrame, y: str, score: str) -> tuple[DataFrame, int, int, int]:
    """(score, pos, neg) for every distinct score, from one pass and checkpointed, with the
    totals of both labels and the number of ranges that its size asks for."""
    ensure_checkpoint_dir(df.sparkSession)
    table = df.groupBy(F.col(score).alias("threshold")).agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")).checkpoint()
    t = table.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"), F.count(F.lit(1)).alias("n")).first()
    return table, int(t["P"] or 0), int(t["N"] or 0), max(16, -(-int(t["n"]) // ROC_RANGE))


def roc_curve(df: DataFrame, y: str = "y_true", score: str = "p_fault") -> DataFrame:
    """ROC points at every distinct score (descending).

    The cumulative sums over the descending score order use :func:`global_prefix`,
    which range-buckets the distinct scores so no single task sees all of them.
    """
    table, P, N, ranges = score_table(df, y, score)
    cum = global_prefix(table.withColumn("_neg_thr", -F.col("threshold")), "_neg_thr", ["pos", "neg"], ranges)
    return cum.select(F.col("threshold"), (F.col("pos") / F.lit(P)).alias("tpr"), (F.col("neg") / F.lit(N)).alias("fpr"))


def roc_auc(df: DataFrame, y: str = "y_true", score: str = "p_fault") -> DataFrame:
    """Trapezoid area under the ROC curve over distinct thresholds (exact)."""
    table, P, N, ranges = score_table(df, y, score)
    cum = global_prefix(table.withColumn("_o", -F.col("threshold")), "_o", ["pos", "neg"], ranges)
    # trapezoid between the previous cumulative point and this one:
    # area = neg_s * (2 * tp_before + pos_s) / 2 ; tp_before = tp_cum - pos_s
    part = cum.select((F.col("_d_neg") * (2 * (F.col("pos") - F.col("_d_pos")) + F.col("_d_pos")) / 2.0).alias("a"))
    return part.agg((F.sum("a") / F.lit(float(P) * float(N))).alias("auc"))


# --------------------------------------------------------------------------
# D18-D21 threshold sweep and choice
# --------------------------------------------------------------------------
def threshold_sweep(df: DataFrame, y: str = "y_true", score: str = "p_fault", by: Sequence[str] = ()) -> DataFrame:
    """Recall, precision, F1, false-alarm and missed-fault rates for each grid threshold.

    One scan: every row is reduced to the number of grid thresholds it reaches
    (``bucket``, 0..43) and label counts are pre-aggregated per bucket (map-side
    partial aggregation: at most 44 rows per group leave each task).  Those
    rows are crossed with the 43 grid indexes by an ``explode`` and summed
    once more - two exchanges, no window, no join.
    """
    by = list(by)
    grid = [p / 100.0 for p in SWEEP_GRID_PERCENT]
    arr = F.array(*[F.lit(t) for t in grid])
    # number of grid points <= score (exact: compares with the same doubles as the grid)
    bucket = F.size(F.filter(arr, lambda t: F.col(score) >= t))
    pre = df.groupBy(*by, bucket.alias("bucket")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    ex = pre.select(*by, "bucket", "pos", "neg", F.explode(F.sequence(F.lit(1), F.lit(len(grid)))).alias("gi"))
    hit = F.col("bucket") >= F.col("gi")
    res = ex.groupBy(*by, "gi").agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(F.lit(0))).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(F.lit(0))).alias("fp"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    res = res.withColumn("threshold", F.element_at(arr, F.col("gi").cast("int")))
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("P") - tp, F.col("N") - fp
    recall = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    precision = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    f1 = F.when(recall + precision > 0, 2 * recall * precision / (recall + precision)).otherwise(F.lit(0.0))
    return res.select(
        *by, "threshold",
        F.round(recall, 4).alias("recall"), F.round(precision, 4).alias("precision"), F.round(f1, 4).alias("f1"),
        F.round(F.coalesce(F.try_divide(fp, fp + tn), F.lit(0.0)), 4).alias("false_alarm_rate"),
        F.round(F.coalesce(F.try_divide(fn, fn + tp), F.lit(0.0)), 4).alias("missed_fault_rate"),
        tp.cast("long").alias("tp"), fp.cast("long").alias("fp"))


def choose_threshold(sweep: DataFrame, by: Sequence[str] = (), missed_target: float = MISSED_FAULT_TARGET,
                     max_far: float = MAX_FAR_ALLOWED) -> DataFrame:
    """Largest threshold meeting both targets; else largest meeting the
    missed-fault target; else the lowest missed rate (first threshold on ties).
    Rates are compared after their 4-dp rounding."""
    by = list(by)
    ok_m = F.col("missed_fault_rate") <= missed_target
    ok_f = F.col("false_alarm_rate") <= max_far
    agg = sweep.groupBy(*by).agg(
        F.max(F.when(ok_m & ok_f, F.col("threshold"))).alias("t_both"),
        F.max(F.when(ok_m, F.col("threshold"))).alias("t_recall"),
        F.min_by(F.col("threshold"), F.struct(F.col("missed_fault_rate"), F.col("threshold"))).alias("t_best"))
    chosen = agg.select(
        *by, F.coalesce("t_both", "t_recall", "t_best").alias("threshold"),
        F.when(F.col("t_both").isNotNull(), F.lit(K.STRATEGY_BOTH))
        .when(F.col("t_recall").isNotNull(), F.lit(K.STRATEGY_RECALL))
        .otherwise(F.lit(K.STRATEGY_BEST)).alias("strategy"))
    return chosen.join(sweep, by + ["threshold"])


def operating_region(sweep: DataFrame, by: Sequence[str] = (), missed_target: float = MISSED_FAULT_TARGET,
                     max_far: float = MAX_FAR_ALLOWED) -> DataFrame:
    """Feasible threshold range, recall at both ends, FAR range."""
    ok = (F.col("missed_fault_rate") <= missed_target) & (F.col("false_alarm_rate") <= max_far)
    return sweep.where(ok).groupBy(*by).agg(
        F.min("threshold").alias("min_threshold"), F.max("threshold").alias("max_threshold"),
        F.min_by("recall", "threshold").alias("recall_at_min"), F.max_by("recall", "threshold").alias("recall_at_max"),
        F.min("false_alarm_rate").alias("far_min"), F.max("false_alarm_rate").alias("far_max"),
        F.count(F.lit(1)).alias("n_feasible")).where(F.col("n_feasible") > 0)


def binary_rates(df: DataFrame, y: str = "y_true", pred: str = "y_pred", by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts, FAR = fp/(fp+tn), missed = fn/(fn+tp), 0 when empty."""
    tp = F.count_if((F.col(y) == 1) & (F.col(pred) == 1))
    fp = F.count_if((F.col(y) != 1) & (F.col(pred) == 1))
    fn = F.count_if((F.col(y) == 1) & (F.col(pred) != 1))
    tn = F.count_if((F.col(y) != 1) & (F.col(pred) != 1))
    return df.groupBy(*by).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn")).select(
        *by, "tp", "fp", "fn", "tn",
        F.coalesce(F.try_divide(F.col("fp"), F.col("fp") + F.col("tn")), F.lit(0.0)).alias("false_alarm_rate"),
        F.coalesce(F.try_divide(F.col("fn"), F.col("fn") + F.col("tp")), F.lit(0.0)).alias("missed_fault_rate"),
        F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("accuracy"))
