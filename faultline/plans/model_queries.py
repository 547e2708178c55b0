"""Model queries over ``sensor_matrix`` and the telemetry features.

Model outputs get a rows-only check, and an audit of what must hold for them whose result SQL
can state; class weights and label encoding are plain SQL and get oracles.  All models have the
library's default sizes, which are the upstream ones, and are fitted on the training fold.
"""
from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..functions.constants import SENSOR_COLUMNS
from ..operators import boosting as bo
from ..operators import explain as ex
from ..operators import features as fe
from ..operators import forest as fo
from ..operators import metrics as me
from ..operators import models as mo
from ..operators import prepare as pr
from ..operators import store
from ..session import ensure_checkpoint_dir
from ..sources.tables import sensor_matrix
from . import sql as Q
from .prepare_queries import split_rows
from .registry import register

SENS = SENSOR_COLUMNS


def r6(c):
    return F.round(c, 6)


def labelled_matrix(spark, sf_dir):
    m = mo.with_label_text(sensor_matrix(spark, sf_dir), "faultNumber")
    return mo.balanced_weights(m, "faultNumber")


@register("d32_class_weights", "D32", "WITH " + Q.SENSOR_MATRIX + """,
c AS (SELECT faultNumber, count(*) AS n_c FROM sensor_matrix GROUP BY faultNumber)
SELECT faultNumber, n_c, round(sum(n_c) OVER () / (count(*) OVER () * n_c), 6) AS weight FROM c""")
def d32(spark, sf_dir):
    m = mo.balanced_weights(sensor_matrix(spark, sf_dir), "faultNumber")
    return m.groupBy("faultNumber").agg(F.count(F.lit(1)).alias("n_c"), r6(F.first("weight")).alias("weight"))


@register("j4_label_encoding", "J4", "WITH " + Q.SENSOR_MATRIX + """
SELECT DISTINCT faultNumber, CAST(dense_rank() OVER (ORDER BY faultNumber) - 1 AS DOUBLE) AS label_idx FROM sensor_matrix""")
def j4(spark, sf_dir):
    m = mo.with_label_text(sensor_matrix(spark, sf_dir), "faultNumber")
    idx = mo.label_indexer("faultNumber").fit(m)
    return idx.transform(m).select("faultNumber", "label_idx").distinct()


def with_fold(m):
    """A fifth of the samples is held out, another fifth validates.  The matrix has one
    run for each fault, so folds by run would leave classes out of training."""
    part = F.pmod(F.col("sample"), F.lit(5))
    return m.withColumn("fold", F.when(part == 0, "test").when(part == 1, "val").otherwise("train"))


def _folds(spark, sf_dir):
    """Labelled matrix with encoded labels and folds."""
    m = with_fold(labelled_matrix(spark, sf_dir))
    idx = mo.label_indexer("faultNumber").fit(m)
    return idx, idx.transform(m)


def _binary_folds(spark, sf_dir):
    """Matrix with folds and y: 1 for any fault."""
    return with_fold(sensor_matrix(spark, sf_dir)).withColumn("y", (F.col("faultNumber") > 0).cast("double"))


def _rf(spark, sf_dir):
    """Forest of the upstream size, fitted on the training fold."""
    idx, d = _folds(spark, sf_dir)
    model = fo.fit(mo.random_forest(SENS), d.where(F.col("fold") == "train"), SENS, len(idx.labels))
    return model, idx, d


def _boosted(spark, sf_dir, **kwargs):
    """Boosted trees of all classes, fitted on the training fold."""
    idx, d = _folds(spark, sf_dir)
    return bo.boost(d.where(F.col("fold") == "train"), SENS, "label_idx", classes=len(idx.labels), weight="weight", **kwargs), idx, d


TEST_ROWS = "WITH " + Q.SENSOR_MATRIX + """
SELECT sample, faultNumber{} FROM sensor_matrix WHERE sample % 5 = 0"""


def _total(probs="probs"):
    return F.aggregate(probs, F.lit(0.0), lambda a, x: a + x)


def _is_distribution(probs="probs"):
    """All probabilities in 0..1, and 1 in all."""
    return (F.abs(_total(probs) - 1) < 1e-9) & F.forall(probs, lambda p: (p >= 0) & (p <= 1))


@register("j5_random_forest_scores", "J5 J9 J4")
def j5(spark, sf_dir):
    """Held-out scores."""
    model, idx, d = _rf(spark, sf_dir)
    s = model.score(d.where(F.col("fold") == "test"))
    s = mo.decode_labels(idx, "prediction", "pred_txt").transform(s)
    return s.select("sample", "faultNumber", F.col("pred_txt").cast("int").alias("pred_fault"),
                    r6(F.array_max("probs")).alias("max_prob"))


@register("j9_score_audit", "J5 J9 J4", TEST_ROWS.format(", TRUE AS is_distribution, TRUE AS predicts_largest, TRUE AS label_decodes"))
def j9_audit(spark, sf_dir):
    """Each held-out row's probabilities are a distribution, the prediction is its largest, and labels decode to themselves."""
    model, idx, d = _rf(spark, sf_dir)
    s = model.score(d.where(F.col("fold") == "test"))
    s = mo.decode_labels(idx, "label_idx", "label_again").transform(s)
    return s.select("sample", "faultNumber", _is_distribution().alias("is_distribution"),
                    (F.get("probs", F.col("prediction").cast("int")) == F.array_max("probs")).alias("predicts_largest"),
                    (F.col("label_again").cast("int") == F.col("faultNumber")).alias("label_decodes"))


@register("j6_gbt_binary_scores", "J6")
def j6(spark, sf_dir):
    """Held-out scores after all rounds (j8 stops early)."""
    m = _binary_folds(spark, sf_dir)
    model = bo.boost(mo.balanced_weights(m.where(F.col("fold") == "train"), "y"), SENS, "y", classes=1, weight="weight")
    s = model.score(m.where(F.col("fold") == "test"))
    return s.select("sample", "y", r6(F.col("probs")[1]).alias("p_fault"))


@register("j6_fitted_separation", "J6", "SELECT TRUE AS is_distribution, TRUE AS learns")
def j6_audit(spark, sf_dir):
    """Probabilities of all rows are distributions, and the fitted rows lose less than by the rate of faults alone."""
    m = mo.balanced_weights(_binary_folds(spark, sf_dir), "y")
    s = bo.boost(m.where(F.col("fold") == "train"), SENS, "y", classes=1, weight="weight").score(m)
    loss = F.avg(F.when(F.col("fold") == "train", -F.log(F.get("probs", F.col("y").cast("int"))) * F.col("weight")))
    return s.agg(F.bool_and(_is_distribution()).alias("is_distribution"), (loss < F.log(F.lit(2.0))).alias("learns"))


@register("j7_boosted_probabilities", "J7")
def j7(spark, sf_dir):
    """Held-out probabilities of all classes."""
    model, idx, d = _boosted(spark, sf_dir)
    p = model.score(d.where(F.col("fold") == "test"))
    best = F.array_position("probs", F.array_max("probs")).cast("int")
    return p.select("sample", "faultNumber", F.element_at(F.array(*[F.lit(int(x)) for x in idx.labels]), best).alias("pred_fault"), r6(F.array_max("probs")).alias("max_prob"))


@register("j7_boosted_audit", "J7", TEST_ROWS.format(", TRUE AS is_distribution, TRUE AS in_labels, TRUE AS all_rounds"))
def j7_audit(spark, sf_dir):
    """Each held-out row's probabilities are a distribution over the labels, after all rounds."""
    model, idx, d = _boosted(spark, sf_dir)
    p = model.score(d.where(F.col("fold") == "test"))
    return p.select("sample", "faultNumber", _is_distribution().alias("is_distribution"), (F.size("probs") == len(idx.labels)).alias("in_labels"), F.lit(model.rounds == 200).alias("all_rounds"))


def _probability_tables(spark, sf_dir, candidates):
    """Held-out probabilities of some models (name -> fitting, which gives the scoring of rows) under their own
    names, and again as the champion those of the one that is right more often on the validation fold;
    probabilities aligned to the label list."""
    idx, d = _folds(spark, sf_dir)
    labels = [int(x) for x in idx.labels]
    named = {name: fit(d.where(F.col("fold") == "train"), len(labels)) for name, fit in candidates.items()}
    best = F.array_position("probs", F.array_max("probs")).cast("int")
    right = {name: probs(d.where(F.col("fold") == "val")).agg(F.avg((best - 1 == F.col("label_idx")).cast("double"))).first()[0] or 0.0 for name, probs in named.items()}
    champion = max(sorted(right), key=right.get)
    names = F.array(*[F.lit(x) for x in labels])
    out = None
    for name, probs in [*named.items(), ("champion", named[champion])]:
        s = probs(d.where(F.col("fold") == "test"))
        s = s.select("sample", "faultNumber", F.lit(name).alias("model"), F.array_max("probs").alias("max_prob"),
                     F.element_at(names, best).alias("pred_fault"),
                     *[F.col("probs")[i].alias(f"prob_fault_{x}") for i, x in enumerate(labels)])
        s = s.withColumn("risk_proxy", F.lit(1.0) - F.col("max_prob"))
        out = s if out is None else out.unionByName(s)
    return out


def _probability_audit(t):
    """What every probability table must satisfy: a row per held-out sample and model, class
    probabilities that sum to 1, and the reported one the largest."""
    probs = [c for c in t.columns if c.startswith("prob_fault_")]
    return t.groupBy("model").agg(F.count(F.lit(1)).alias("n_rows"), F.bool_and(F.abs(sum(F.col(c) for c in probs) - 1) < 1e-9).alias("sums_to_one"),
                                  F.bool_and(F.col("max_prob") == F.greatest(*probs)).alias("is_largest"))


def _fitted_forest(train, classes):
    return fo.fit(mo.random_forest(SENS), train, SENS, classes).score


def _fitted_boosted(train, classes):
    return bo.boost(train, SENS, "label_idx", classes=classes, weight="weight").score


@register("j10_probability_tables", "J10 C7 H5 G1")
def j10(spark, sf_dir):
    """The forest and the boosted trees, both of the upstream size, compete for champion."""
    return _probability_tables(spark, sf_dir, {"random_forest": _fitted_forest, "boosted": _fitted_boosted})


@register("j10_probability_tables_audit", "J10", "WITH " + Q.SENSOR_MATRIX + """
SELECT m.model, count(*) AS n_rows, TRUE AS sums_to_one, TRUE AS is_largest FROM sensor_matrix, (VALUES ('champion'), ('random_forest'), ('boosted')) AS m(model)
WHERE sample % 5 = 0 GROUP BY m.model""")
def j10_tables_audit(spark, sf_dir):
    return _probability_audit(j10(spark, sf_dir))


def _risk_scores(spark, sf_dir):
    """Probabilities of the longest held-out run, from boosted trees of the full size fitted on the training
    runs, with each run's onset; and the labels in the order of the probabilities."""
    rows = split_rows(spark, sf_dir)
    feats = ["xmeas_13", "xmeas_9", "xmv_10"]
    f = fe.rolling_features(rows, ["xmeas_13"], [10, 20], dense=True)
    cols = feats + ["xmeas_13_roll_mean_10", "xmeas_13_roll_std_10", "xmeas_13_roll_mean_20", "xmeas_13_roll_std_20"]
    f = mo.with_label_text(f, "target_fault_label")
    idx = mo.label_indexer("target_fault_label").fit(f)
    model = bo.boost(idx.transform(f.where(F.col("fold") == "train")), cols, "label_idx", classes=len(idx.labels))
    rep = pr.longest_run(pr.run_extent(f.where(F.col("fold") == "test"), 20)).select("run_key")
    run = f.join(F.broadcast(rep), "run_key", "left_semi")
    onset = fe.fault_onset(run, "target_fault_label")          # one row (grouped, partial aggregation)
    return model.score(run).join(F.broadcast(onset), "run_key"), [int(x) for x in idx.labels]


@register("j11_risk_series", "J11 D9 E13")
def j11(spark, sf_dir):
    s, labels = _risk_scores(spark, sf_dir)
    best = F.array_position("probs", F.array_max("probs")).cast("int")
    return s.select(
        "run_key", "simulationRun", "sample", F.col("faultNumber").alias("original_fault_label"), "target_fault_label",
        F.element_at(F.array(*[F.lit(x) for x in labels]), best).alias("pred_fault"), r6(F.array_max("probs")).alias("max_prob"),
        r6(F.lit(1.0) - F.array_max("probs")).alias("risk_proxy"), "onset_sample")


@register("j12_pca_projection", "J12")
def j12(spark, sf_dir):
    m = sensor_matrix(spark, sf_dir)
    proj, ev = mo.pca_projection(m, SENS, 2, keep=["sample", "faultNumber"])
    return proj.select("sample", "faultNumber", r6("pc1").alias("pc1"), r6("pc2").alias("pc2"),
                       F.lit(round(float(ev[0]), 6)).alias("explained_1"), F.lit(round(float(ev[1]), 6)).alias("explained_2"))


@register("j13_feature_importances", "J13 F2")
def j13(spark, sf_dir):
    model, _, _ = _rf(spark, sf_dir)
    top = model.importances(top=25)
    # the top-n list of a fitted model is bounded by the feature count
    imp = spark.createDataFrame([(f, float(v), i + 1) for i, (f, v) in enumerate(top)],
                                "feature string, importance double, rank int")
    return imp.select("feature", r6("importance").alias("importance"), "rank")


@register("j12_pca_audit", "J12", "SELECT TRUE AS centred, TRUE AS uncorrelated, TRUE AS variance_is_explained")
def j12_audit(spark, sf_dir):
    """Components have mean 0, no correlation, and the share of the whole variance that is reported for them."""
    m = sensor_matrix(spark, sf_dir)
    proj, ev = mo.pca_projection(m, SENS, 2, keep=["sample"])
    whole = m.agg(sum(F.var_pop(c) for c in SENS).alias("v")).first()["v"]
    a = proj.agg(F.avg("pc1").alias("m1"), F.avg("pc2").alias("m2"), F.var_pop("pc1").alias("v1"), F.var_pop("pc2").alias("v2"), F.covar_pop("pc1", "pc2").alias("c"))
    return a.select(((F.abs("m1") < 1e-9) & (F.abs("m2") < 1e-9)).alias("centred"), (F.abs("c") < 1e-9 * F.col("v1")).alias("uncorrelated"),
                    ((F.abs(F.col("v1") / whole - float(ev[0])) < 1e-9) & (F.abs(F.col("v2") / whole - float(ev[1])) < 1e-9)).alias("variance_is_explained"))


@register("j13_importance_audit", "J13 F2", "SELECT 52 AS n_features, TRUE AS sums_to_one, TRUE AS none_negative, TRUE AS highest_first")
def j13_audit(spark, sf_dir):
    """Importances of forest and boosted trees: one a sensor, none negative, 1 in all, highest first."""
    forest, _, _ = _rf(spark, sf_dir)
    tables = [forest.importances(), _boosted(spark, sf_dir)[0].importances()]
    values = [[float(v) for _, v in t] for t in tables]
    return spark.createDataFrame([(len({f for t in tables for f, _ in t}), all(abs(sum(v) - 1) < 1e-9 for v in values), all(min(v) >= 0 for v in values), all(v == sorted(v, reverse=True) for v in values))],
                                 "n_features int, sums_to_one boolean, none_negative boolean, highest_first boolean")


def _explained_forest(spark, sf_dir):
    """Held-out rows with Shapley values and probabilities of the forest, its scores, and the value of no feature."""
    model, _, d = _rf(spark, sf_dir)
    rows = model.score(d.where(F.col("fold") == "test")).select("sample", "faultNumber", "probs", *SENS)
    return model.explain(rows), model.base_value(spark)


@register("j14_shapley_importance", "J14")
def j14(spark, sf_dir):
    """Every held-out row is explained exactly."""
    found, _ = _explained_forest(spark, sf_dir)
    return ex.mean_abs_shap(found, SENS).orderBy(F.col("mean_abs_shap").desc()).limit(20).select("feature", r6("mean_abs_shap").alias("mean_abs_shap"))


def _adds_up(base, outputs):
    """Whether the Shapley values of each output sum to it less its base value."""
    classes = F.sequence(F.lit(0), F.lit(len(base) - 1))
    bases = F.array(*[F.lit(float(b)) for b in base])
    gap = lambda c: F.aggregate("shap", F.lit(0.0), lambda a, f: a + f[c]) + bases[c] - F.get(outputs, c)
    return F.forall(classes, lambda c: F.abs(gap(c)) < 1e-8)


@register("j14_shapley_audit", "J14", TEST_ROWS.format(", TRUE AS explains_the_score, TRUE AS same_score"))
def j14_audit(spark, sf_dir):
    """For every held-out row and class the values sum to the forest's probability less the base value."""
    found, base = _explained_forest(spark, sf_dir)
    return found.select("sample", "faultNumber", _adds_up(base, F.col("probs")).alias("explains_the_score"),
                        F.forall(F.zip_with("probs", "predicted", lambda a, b: F.abs(a - b)), lambda g: g < 1e-9).alias("same_score"))


@register("j14_boosted_shapley_audit", "J14 J7", TEST_ROWS.format(", TRUE AS explains_the_margin"))
def j14_boosted_audit(spark, sf_dir):
    """The same for the margins of the boosted trees."""
    model, _, d = _boosted(spark, sf_dir)
    leaves = ex.leaves_of_boosted(model)
    found = ex.explain(d.where(F.col("fold") == "test").select("sample", "faultNumber", *SENS), leaves, SENS)
    return found.select("sample", "faultNumber", _adds_up(ex.base_value(leaves), F.col("predicted")).alias("explains_the_margin"))


@register("j18_model_persistence", "J18", "WITH " + Q.SENSOR_MATRIX + """
SELECT sample, TRUE AS same_prediction FROM sensor_matrix""")
def j18(spark, sf_dir):
    model, idx, d = _rf(spark, sf_dir)
    path = os.path.join(ensure_checkpoint_dir(spark), "models", f"rf_{uuid.uuid4().hex}")
    model.save(spark, path)
    back = fo.Forest.load(spark, path)
    a = model.score(d).select("sample", F.col("prediction").alias("p1"))
    b = back.score(d).select("sample", F.col("prediction").alias("p2"))
    return a.join(b, "sample").select("sample", (F.col("p1") == F.col("p2")).alias("same_prediction"))


@register("j18_best_model", "J18 J1 J2 J3 F3", TEST_ROWS.format(", TRUE AS same_scores, TRUE AS is_best"))
def j18_best(spark, sf_dir):
    """Forest and boosted trees, each stored with the preprocessing it was fitted behind and its
    held-out report; the better one is loaded and scores the held-out rows as before it was stored."""
    idx, d = _folds(spark, sf_dir)
    train, test = d.where(F.col("fold") == "train"), d.where(F.col("fold") == "test").select("sample", "faultNumber", *SENS)
    labels = [str(int(x)) for x in idx.labels]
    fits = {"boosted": lambda rows: bo.boost(rows, SENS, "label_idx", classes=len(labels), weight="weight"), "random_forest": lambda rows: fo.fit(mo.random_forest(SENS), rows, SENS, len(labels))}
    root = os.path.join(ensure_checkpoint_dir(spark), "models", uuid.uuid4().hex)
    both, fitted = None, {}
    for name, fit in fits.items():
        fitted[name] = store.fit_behind_preprocessor(train, SENS, labels, fit)
        scored = fitted[name].score(test).select(F.lit(name).alias("model"), "sample", "faultNumber", "probs", fitted[name].predicted().cast("int").alias("y_pred"))
        both = scored if both is None else both.unionByName(scored)
    both = both.checkpoint()
    found = store.report_metrics(me.classification_report(both, "faultNumber", "y_pred", ["model"]))
    for name, model in fitted.items():
        store.save(spark, root, name, model, found[name])
    best, model = store.load_best(spark, root)
    is_best = all(found[best]["macro_f1"] >= m["macro_f1"] for m in found.values())
    again = model.score(test).select("sample", F.col("probs").alias("again"))
    return both.where(F.col("model") == best).join(again, "sample").select("sample", "faultNumber", (F.col("probs") == F.col("again")).alias("same_scores"), F.lit(is_best).alias("is_best"))


def _stopped(spark, sf_dir):
    """Boosted trees that stop 20 rounds after the least loss on the validation fold, and the rows."""
    idx, d = _folds(spark, sf_dir)
    d = d.where(F.col("fold") != "test").withColumn("is_val", F.col("fold") == "val")
    return bo.boost(d, SENS, "label_idx", classes=len(idx.labels), validation="is_val", patience=20), d


@register("j8_early_stopping_report", "J8")
def j8(spark, sf_dir):
    """Validation log-loss after every round, the best and the final one marked."""
    model, _ = _stopped(spark, sf_dir)
    rows = [(i, float(v), i == model.best_round, i == model.rounds) for i, v in enumerate(model.losses, 1)]       # one row a round
    return spark.createDataFrame(rows, "iteration int, validation_loss double, is_best boolean, is_final boolean")


@register("j8_early_stopping_audit", "J8", "SELECT TRUE AS stops_in_time, TRUE AS best_is_least, TRUE AS losses_replay")
def j8_audit(spark, sf_dir):
    """Fitting ended 20 rounds after the best (or with all rounds), and scoring the validation rows
    with the trees of the best and of all rounds gives the reported losses."""
    model, d = _stopped(spark, sf_dir)
    val = d.where("is_val")
    replay = [m.score(val).agg(F.avg(-F.log(F.get("probs", F.col("label_idx").cast("int"))))).first()[0] for m in (model.upto(model.best_round), model)]
    told = [model.losses[model.best_round - 1], model.losses[-1]]
    row = (model.rounds == min(200, model.best_round + 20), min(model.losses) == told[0], all(abs(a - b) < 1e-9 for a, b in zip(replay, told, strict=True)))
    return spark.createDataFrame([row], "stops_in_time boolean, best_is_least boolean, losses_replay boolean")
