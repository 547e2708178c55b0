"""Operator semantics on hand-made rows and invariants on the provided tables."""
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from faultline.functions import scalars as S
from faultline.operators import alerts as al
from faultline.operators import features as fe
from faultline.operators import metrics as me
from faultline.operators import prepare as pr
from faultline.operators import quality as qa

from conftest import SF001


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


# --------------------------------------------------------------------------- features
def test_rolling_edge_cases(spark):
    df = rows(spark, [("one", 1, 5.0), ("short", 1, 1.0), ("short", 2, 3.0), ("const", 1, 7.0), ("const", 2, 7.0),
                      ("const", 3, 7.0), ("nulls", 1, None), ("nulls", 2, None)],
              "run_key string, sample int, x double")
    for method in ("prefix", "frame"):
        out = {(r.run_key, r.sample): r for r in fe.rolling_features(df, ["x"], [10], method=method).collect()}
        assert out[("one", 1)].x_roll_std_10 == 0.0 and out[("one", 1)].x_roll_mean_10 == 5.0
        assert out[("short", 2)].x_roll_mean_10 == 2.0
        assert abs(out[("short", 2)].x_roll_std_10 - math.sqrt(2.0)) < 1e-12
        assert out[("const", 3)].x_roll_std_10 == 0.0
        assert out[("nulls", 2)].x_roll_mean_10 is None


def test_e1_plan_has_one_exchange(spark):
    from faultline.sources.tables import telemetry
    t = telemetry(spark, SF001).select("run_key", "sample", "xmeas_13", "xmeas_9")
    plan = fe.rolling_features(t, ["xmeas_13", "xmeas_9"], dense=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


# --------------------------------------------------------------------------- prepare
def test_guards():
    with pytest.raises(ValueError):
        pr.check_no_leakage(["xmeas_1", "fault_flag"])
    pr.check_no_leakage(["xmeas_1", "xmv_2_roll_mean_10"])


def test_check_features(spark):
    df = rows(spark, [(1, "a")], "xmeas_1 int, xmeas_2 string")
    with pytest.raises(ValueError):
        pr.check_features(df, ["xmeas_1", "xmeas_3"])
    with pytest.raises(ValueError):
        pr.check_features(df, ["xmeas_2"])
    pr.check_features(df, ["xmeas_1"])


def test_folds_disjoint_and_complete_runs(spark):
    from faultline.plans.prepare_queries import runs_table, split_rows
    from faultline.plans.telemetry_queries import scored
    s = split_rows(spark, SF001)
    pr.assert_disjoint(s)
    runs = pr.run_sizes(scored(spark, SF001))
    got = pr.complete_runs_until(runs, 400, "n_rows").toPandas().sort_values("_h")
    assert got["n_rows"].sum() >= 400 and got["n_rows"].sum() - got["n_rows"].iloc[-1] < 400


def test_top_k_salted_matches_plain(spark):
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("g"), F.col("id"))
    got = pr.top_k_per_group(df, ["g"], F.md5(F.col("id").cast("string")), 5, salts=16).toPandas()
    pdf = df.toPandas()
    pdf["h"] = [__import__("hashlib").md5(str(i).encode()).hexdigest() for i in pdf["id"]]
    ref = pdf.sort_values("h").groupby("g").head(5)
    assert sorted(got["id"]) == sorted(ref["id"])


# --------------------------------------------------------------------------- metrics
def test_d11_semantics(spark):
    data = []
    for s in range(1, 241):     # alert from 161 on, class right 3 times out of 4
        data.append(("r78", 5, 78, s, 0.9 if s >= 161 else 0.1, 5 if s % 4 else 3, float(s >= 161)))
    for s in range(1, 200):     # early alert at 150 -> negative delay
        data.append(("early", 5, 1, s, 0.9 if s == 150 else 0.1, 5, 0.0))
    for s in range(1, 50):      # never alerts
        data.append(("quiet", 5, 2, s, 0.1, 5, 0.0))
    df = rows(spark, data, "run_key string, faultNumber int, simulationRun int, sample int, p_fault double, "
                           "pred_fault int, xmeas_13 double")
    df = df.withColumn("is_fault", S.is_fault(F.col("p_fault"), 0.35))
    out = {r.run_key: r for r in me.run_detection_metrics(df, 161).collect()}
    assert out["r78"].first_alert == 161 and out["r78"].delay == 0 and out["r78"].pre_false_alarms == 0
    assert abs(out["r78"].multiclass_pct - 75.0) < 1.0 and abs(out["r78"].xmeas_13_delta - 1.0) < 1e-12
    assert out["early"].delay == -11 and out["early"].pre_false_alarms == 1
    assert out["quiet"].first_alert is None and out["quiet"].multiclass_pct == 0.0


def test_confusion_and_report_invariants(spark):
    from faultline.plans.metric_queries import cascade
    c = cascade(spark, SF001)
    cm = me.confusion_matrix(c, "y_true_mc", "y_pred").toPandas()
    assert cm["n"].sum() == c.count()
    sw = me.threshold_sweep(c, "y_true", "p_fault").toPandas()
    assert len(sw) == 43
    assert np.allclose(sw["missed_fault_rate"] + sw["recall"], 1.0, atol=2e-4)


def test_auc_matches_mann_whitney(spark, monkeypatch):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) * 0.5 + y * 0.3, 2)      # ties on purpose
    df = spark.createDataFrame(pd.DataFrame({"y_true": y.astype(int), "p_fault": s}))
    monkeypatch.setattr(me, "ROC_RANGE", 5)
    got = me.roc_auc(df).first()["auc"]
    pos, neg = s[y == 1], s[y == 0]
    ref = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(got - ref) < 1e-12


def test_choose_threshold_fallbacks(spark):
    sweep = rows(spark, [(0.1, 0.2, 0.6), (0.2, 0.15, 0.4), (0.3, 0.15, 0.3)],
                 "threshold double, missed_fault_rate double, false_alarm_rate double")
    r = me.choose_threshold(sweep).first()
    assert r.threshold == 0.2 and r.strategy == "best recall available"
    sweep2 = rows(spark, [(0.1, 0.05, 0.6), (0.2, 0.08, 0.55)],
                  "threshold double, missed_fault_rate double, false_alarm_rate double")
    assert me.choose_threshold(sweep2).first().threshold == 0.2


# --------------------------------------------------------------------------- alerts / scalars
def test_argmax_ties_and_catalog_defaults(spark):
    df = rows(spark, [([0.2, 0.4, 0.4], 99), ([0.5, 0.1, 0.4], 4)], "p array<double>, fid int")
    got = df.select(al.argmax_class(F.col("p")).alias("c")).collect()
    assert [r.c for r in got] == [2, 1]
    cat = {r.fid: r for r in al.with_catalog(df, "fid").collect()}
    assert cat[99].predicted_fault == "Unknown (99)" and cat[99].severity == "MEDIUM"
    assert cat[4].severity == "HIGH"


def test_scalar_ladders(spark):
    df = rows(spark, [(0.75, None), (0.7499, 0.005), (0.5, 0.5), (0.1, 30.0)], "s double, h double")
    out = df.select(S.risk_level(F.col("s")).alias("lvl"), S.relative_time(F.col("h")).alias("t"),
                    S.recall_in_ten(F.col("s")).alias("r10")).collect()
    assert [r.lvl for r in out] == ["HIGH", "MEDIUM", "MEDIUM", "LOW"]
    assert [r.t for r in out] == ["No recent alerts", "Just now", "30m ago", "30h ago"]
    assert out[3].r10 == "1 in 10"
    p = rows(spark, [("7",), ("21",), ("x",), ("3.5",)], "raw string").select(
        S.parse_fault_id(F.col("raw")).alias("f")).collect()
    assert [r.f for r in p] == [7, 1, 1, 1]
    w = rows(spark, [(None,), (-2,), (0,), (5,)], "d int").select(S.case_failure_window(F.col("d")).alias("w")).collect()
    assert [r.w for r in w] == [45, 45, 11, 26]


def test_rising_edge_not_on_first_row(spark):
    df = rows(spark, [("a", 1, 1), ("a", 2, 0), ("a", 3, 1), ("a", 4, 1)], "run_key string, sample int, is_fault int")
    assert [r.sample for r in al.rising_edges(df).collect()] == [3]


def test_checklist_duplicate_id(spark):
    inc = rows(spark, [("i1", False, None)], "id string, acknowledged boolean, checklist array<struct<id:string,label:string>>")
    checked = rows(spark, [("i1", "dcs")], "incident_id string, item_id string")
    r = al.checklist_backlog(inc, checked).first()
    assert r.total_steps == 4 and r.remaining_steps == 2


# --------------------------------------------------------------------------- quality
def test_exact_median_and_population_scale(spark):
    df = rows(spark, [(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    p = qa.fit_preprocessor(df, ["x"]).first()
    assert p.median == 2.5
    assert abs(p.scale - np.std([1, 2, 3, 10])) < 1e-12


def test_correlation_matches_pandas_pairwise(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(2700, 5, 300)
    pdf = pd.DataFrame({"a": a, "b": a * 0.5 + rng.normal(0, 1, 300), "c": rng.normal(0, 1, 300)})
    pdf.loc[::7, "b"] = np.nan
    got = {(r.var_a, r.var_b): r.corr for r in qa.correlation_long(spark.createDataFrame(pdf), ["a", "b", "c"]).collect()}
    ref = pdf.corr()
    for (x, y), v in got.items():
        assert abs(v - ref.loc[x, y]) < 1e-9


def test_outlier_constant_sensor(spark):
    df = rows(spark, [(1.0, float(i)) for i in range(50)] + [(1.0, 1000.0)], "c double, v double")
    out = {r.sensor: r for r in qa.outlier_audit(df, ["c", "v"], 6.0).collect()}
    assert out["c"].n_outliers == 0 and out["v"].n_outliers == 1


def test_scan_runs(spark):
    from faultline.sources.tables import telemetry
    t = telemetry(spark, SF001)
    some = t.select("faultNumber", "simulationRun").first()
    assert pr.scan_runs(t, some.faultNumber, [some.simulationRun]).count() > 0
    with pytest.raises(ValueError):
        pr.scan_runs(t, 5, [-1])


@pytest.mark.parametrize("accuracy", [50, 100_000])
def test_exact_median_long(spark, accuracy):
    rng = np.random.default_rng(11)
    parts = [pd.DataFrame({"g": "big", "value": rng.normal(0, 1, 20001)}),
             pd.DataFrame({"g": "even", "value": rng.normal(5, 2, 1000)}),
             pd.DataFrame({"g": "ties", "value": rng.integers(0, 3, 5000).astype(float)}),
             pd.DataFrame({"g": "one", "value": [4.0]}),
             pd.DataFrame({"g": "nulls", "value": [np.nan, np.nan]})]
    pdf = pd.concat(parts, ignore_index=True)
    df = spark.createDataFrame(pdf).withColumn("value", F.nanvl("value", F.lit(None).cast("double")))
    got = {r.g: r.median for r in qa.exact_median_long(df, ["g"], accuracy=accuracy).collect()}
    for g, part in pdf.groupby("g"):
        ref = part["value"].median()
        if np.isnan(ref):
            assert got[g] is None
        else:
            assert got[g] == ref


def test_plan_shapes(spark):
    """D18 has two exchanges; the alarm baselines read only the pre-injection
    prefix with the filter pushed into the parquet scan."""
    from faultline.plans.alarm_queries import signals
    from faultline.plans.metric_queries import sweep_df
    d18 = sweep_df(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert d18.count("Exchange") <= 2
    e8 = signals(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(sample,20)" in e8.replace(" ", "")


def _plan_counts(df) -> tuple[int, int]:
    """File scans and pandas stages of the plan before it is adapted."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return plan.count("FileScan"), plan.count("MapInPandas")


def test_reports_read_their_rows_once(spark):
    """Matrix and report work on one checkpointed table of cells; KPIs run the latch once."""
    from faultline.plans import alarm_queries as alq
    from faultline.plans.metric_queries import cascade
    rows = cascade(spark, SF001)
    for df in (me.confusion_matrix(rows, "y_true_mc", "y_pred"), me.classification_report(rows, "y_true_mc", "y_pred")):
        assert _plan_counts(df)[0] == 0
    kpis = alq.d23(spark, SF001)
    assert _plan_counts(kpis)[1] == 1


def test_feature_problems_lists_everything(spark):
    df = spark.createDataFrame([(1, [1], "a", 2.0)], "xmeas_1 int, xmeas_2 array<int>, xmeas_3 string, fault_flag double")
    found = pr.feature_problems(df.schema, [*df.columns, *[f"gone_{i}" for i in range(20)]], ("fault",))
    assert set(found) == {"xmeas_2", "xmeas_3", "fault_flag", *[f"gone_{i}" for i in range(20)]}
    assert "array<int>" in found["xmeas_2"] and "target" in found["fault_flag"]


def test_wide_medians_equal_exact_medians(spark):
    rng = np.random.default_rng(3)
    n = 5001
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 3, n).astype(float), "c": np.where(rng.random(n) < 0.5, np.nan, rng.exponential(size=n)), "d": np.full(n, np.nan), "e": np.full(n, 7.0)})
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    for accuracy in (20, 10_000):
        got = qa.wide_medians(df, list(pdf), accuracy=accuracy)
        for c in pdf:
            assert (got[c] is None and c == "d") or got[c] == pdf[c].median()


def test_cluster_without_a_checkpoint_folder_raises():
    from faultline import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_full_compositions_have_all_folds_and_no_small_cap(spark):
    from conftest import SF01
    from faultline.plans import prepare_queries as pq
    from faultline.plans.telemetry_queries import scored
    assert pq.COMPOSITIONS["test_90_10"] == {("test", 0): 450_000, ("test", 1): 50_000}
    got = pq.i7_full(spark, SF01)
    assert {(r[0], r[1]) for r in got.select("composition", "fold").distinct().collect()} == {(c, f) for c, caps in pq.COMPOSITIONS.items() for f, _ in caps}
    every = scored(spark, SF01).where("faultNumber = 0 or sample > 20").count()     # all caps are above what this table has
    assert got.where("composition <> 'imbalanced_90_10'").count() == every
    assert got.groupBy("run_key").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
