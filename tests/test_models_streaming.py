"""Model invariants and batch = stream parity."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.functions.constants import SENSOR_COLUMNS
from faultline.operators import boosting as bo
from faultline.operators import models as mo
from faultline.sources.tables import sensor_matrix

from conftest import SF001

FEATS = SENSOR_COLUMNS[:12]


@pytest.fixture(scope="module")
def matrix(spark):
    m = mo.with_label_text(sensor_matrix(spark, SF001), "faultNumber")
    m = mo.balanced_weights(m, "faultNumber")
    idx = mo.label_indexer("faultNumber").fit(m)
    return idx.transform(m).cache(), idx


def test_balanced_weights(matrix):
    d, _ = matrix
    pdf = d.groupBy("faultNumber").agg(F.count("*").alias("n"), F.first("weight").alias("w")).toPandas()
    n, k = pdf["n"].sum(), len(pdf)
    assert np.allclose(pdf["w"], n / (k * pdf["n"]))


def test_label_encoding_is_numeric_order(matrix):
    _, idx = matrix
    assert [int(x) for x in idx.labels] == sorted(int(x) for x in idx.labels)


def test_ovr_probabilities_sum_to_one(spark, matrix):
    d, _ = matrix
    model = mo.ovr_gbt(FEATS, iters=3, depth=2).fit(d)
    p = mo.ovr_probabilities(model, d).select(F.aggregate("probs", F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert np.allclose([r.s for r in p.collect()], 1.0)


def test_rf_scores_and_persistence(spark, matrix):
    d, _ = matrix
    model = mo.random_forest(FEATS, trees=5, depth=3).fit(d)
    path = mo.save_model(model, spark, "test_rf")
    a = mo.score(model, d).select("sample", "prediction").orderBy("sample").collect()
    b = mo.score(mo.load_model(path), d).select("sample", "prediction").orderBy("sample").collect()
    assert a == b
    s = mo.score(model, d).select(F.aggregate("probs", F.lit(0.0), lambda a, x: a + x).alias("s")).collect()
    assert np.allclose([r.s for r in s], 1.0)
    top = mo.feature_importances(model, FEATS, top=5)
    assert len(top) == 5 and top[0][1] >= top[-1][1]


def test_pca_centred(spark):
    m = sensor_matrix(spark, SF001)
    proj, ev = mo.pca_projection(m, FEATS, 2, keep=["sample"])
    means = proj.agg(F.avg("pc1").alias("a"), F.avg("pc2").alias("b")).first()
    assert abs(means.a) < 1e-9 and abs(means.b) < 1e-9
    assert 0 < ev[1] <= ev[0] <= 1


def test_shapley_runs(spark, matrix):
    d, _ = matrix
    model = mo.random_forest(FEATS, trees=5, depth=3).fit(d)
    rows = d.orderBy("sample").limit(10).select(*FEATS)
    bg = d.orderBy(F.desc("sample")).limit(5).select(*FEATS)
    sh = mo.monte_carlo_shapley(model, rows, bg, FEATS, permutations=2).toPandas()
    assert len(sh) == len(FEATS) and (sh["mean_abs_shap"] >= 0).all()


def test_stream_latch_equals_batch(spark):
    from faultline.plans import alarm_queries as alq
    from faultline.plans import stream_queries as sq
    batch = alq.e8(spark, SF001).select("run_key", "sample", "alarm")
    stream = sq.k3(spark, SF001).select("run_key", "sample", "alarm")
    assert batch.count() == stream.count()
    assert batch.exceptAll(stream).count() == 0


def test_stream_dedup_keeps_each_sample_once(spark):
    from faultline.plans import stream_queries as sq
    from faultline.sources.tables import telemetry
    got = sq.k7(spark, SF001)
    assert got.count() == telemetry(spark, SF001).count()
    assert got.groupBy("run_key", "sample").count().where("count > 1").count() == 0


def test_samples_out_of_order_wait_and_late_ones_are_counted(spark, tmp_path):
    import datetime
    import time

    from faultline.operators import alarms as al
    from faultline.streaming import alarms as st
    t = al.Tuning(alpha=0.5, sigma=1.0, pad=1.0, n_on=1, n_off=1, lockout=0, max_latch=None, hysteresis=0.5)
    params = spark.createDataFrame([("a", 10.0, 1.0, 5.0, 20)], "run_key string, mu_z double, sig_z double, roc_thr double, t_max int").checkpoint()
    batches = [[1, 2, 4, 5], [3, 6], [2, 7, 9], [18], [8, 19]]          # 3 fills a gap; 2 is late; 18 pushes 9 out, so 8 is late
    for k, samples in enumerate(batches):
        rows = [("a", 0, 0, s, float(s), 0.0, 0.0, 0.9 if s > 3 else 0.1, 1, s, datetime.datetime(2026, 1, 1, 0, s)) for s in samples]
        spark.createDataFrame(rows, st.TELEMETRY_STREAM_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(1.1)                                                   # files are read in the order of their times
    s = st.telemetry_stream(st.stream_session(spark, 2), f"{tmp_path}/in")
    st.run_to_completion(st.stateful_alarms(s, params, t, 3, reorder=5), f"{tmp_path}/out", f"{tmp_path}/chk")
    out = spark.read.parquet(f"{tmp_path}/out").orderBy("sample").collect()
    assert [r["sample"] for r in out] == [1, 2, 3, 4, 5, 6, 7, 9]
    z, want = None, []
    for r in out:
        z = r["sample"] if z is None else 0.5 * r["sample"] + 0.5 * z
        want.append(z)
    assert np.allclose([r["z"] for r in out], want)
    assert [r["sample"] for r in out if r["rising_edge"]] == [4]
    assert max(r["late_samples"] for r in out) == 1


FULL_FOREST, FULL_BOOSTING = (250, 25), (200, 6)


@pytest.fixture
def sizes(monkeypatch):
    """Sizes of the models that queries ask for; what they get is small."""
    import inspect
    asked = []
    forest, boost = mo.random_forest, bo.boost
    default = {k: p.default for k, p in inspect.signature(boost).parameters.items()}

    def small_forest(*args, **kwargs):
        pipeline = forest(*args, **kwargs)
        stage = pipeline.getStages()[-1]
        asked.append((stage.getNumTrees(), stage.getMaxDepth()))
        stage._set(numTrees=2, maxDepth=2)
        return pipeline

    def small_boosting(*args, **kwargs):
        asked.append((kwargs.get("rounds", default["rounds"]), kwargs.get("depth", default["depth"])))
        return boost(*args, **kwargs | {"rounds": 2, "depth": 2})

    monkeypatch.setattr(mo, "random_forest", small_forest)
    monkeypatch.setattr(bo, "boost", small_boosting)
    return asked


@pytest.mark.parametrize("name, want, held_out", [
    ("j6_gbt_binary_scores", [FULL_BOOSTING], True), ("j7_boosted_probabilities", [FULL_BOOSTING], True), ("j8_early_stopping_report", [FULL_BOOSTING], False),
    ("j10_probability_tables", [FULL_FOREST, FULL_BOOSTING], True), ("j11_risk_series", [FULL_BOOSTING], False), ("j14_shapley_importance", [FULL_FOREST], False),
    ("j18_model_persistence", [FULL_FOREST], False)])
def test_registered_models_have_the_full_size(spark, sizes, name, want, held_out):
    import __spark_entry__
    out = __spark_entry__.queries()[name](spark, SF001)
    assert sizes == want
    if held_out:
        assert out.count() and out.where("sample % 5 <> 0").count() == 0


def test_rolling_waits_for_samples_out_of_order_and_skips_nulls(spark, tmp_path):
    import datetime
    import time

    import pandas as pd

    from faultline.streaming import alarms as st
    batches = [[1, 2, 4, 5], [3, 6], [2, 7, 9], [18], [8, 19]]          # 3 fills a gap; 2 is late; 18 pushes 9 out, so 8 is late
    for samples in batches:
        rows = [("a", 0, 0, s, None if s in (1, 4) else float(s * s), 0.0, 0.0, 0.1, 1, s, datetime.datetime(2026, 1, 1, 0, s)) for s in samples]
        spark.createDataFrame(rows, st.TELEMETRY_STREAM_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(1.1)                                                   # files are read in the order of their times
    s = st.telemetry_stream(st.stream_session(spark, 2), f"{tmp_path}/in")
    st.run_to_completion(st.stateful_rolling(s, "xmeas_13", (2, 3), reorder=5), f"{tmp_path}/out", f"{tmp_path}/chk")
    out = spark.read.parquet(f"{tmp_path}/out").orderBy("sample").toPandas()
    want = [1, 2, 3, 4, 5, 6, 7, 9]
    assert out["sample"].tolist() == want and out["late_samples"].max() == 1
    x = pd.Series([np.nan if v in (1, 4) else float(v * v) for v in want])
    for w in (2, 3):
        assert np.allclose(out[f"xmeas_13_roll_mean_{w}"], x.rolling(w, min_periods=1).mean(), equal_nan=True)
        assert np.allclose(out[f"xmeas_13_roll_std_{w}"], x.rolling(w, min_periods=2).std().fillna(0.0))
