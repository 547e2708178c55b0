"""Model training, scoring and explanation on Spark ML.

Estimators are Spark ML's distributed ones (RandomForest, GBT, OneVsRest,
PCA); boosting for all classes at once is in :mod:`boosting`, exact explanations in :mod:`explain`.  Where Spark ML's definition differs from the upstream one, the
difference is made explicit here: imputation is an exact median, scaling uses
the population std (J1/J2 in :mod:`quality`), PCA input is centred, and the
one-vs-rest ensemble's per-class probabilities are renormalised to sum to 1.
"""
from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import IndexToString, PCA, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .blocked import ordinal_within


# --------------------------------------------------------------------------
# D32 class weights, J4 label encoding
# --------------------------------------------------------------------------
def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Sample weight n / (k * n_c).  Counts come from a grouped aggregate;
    the per-class table (bounded by the class count) is broadcast back."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    everything = Window.partitionBy()
    w = counts.select(label, (F.sum("_nc").over(everything) /
                              (F.count(F.lit(1)).over(everything) * F.col("_nc"))).alias(out))
    return df.join(F.broadcast(w), label)


def label_indexer(label: str, out: str = "label_idx") -> StringIndexer:
    """Encode labels in ascending order of their zero-padded text (= numeric order)."""
    return StringIndexer(inputCol=f"{label}_txt", outputCol=out, stringOrderType="alphabetAsc")


def with_label_text(df: DataFrame, label: str, width: int = 4) -> DataFrame:
    return df.withColumn(f"{label}_txt", F.lpad(F.col(label).cast("string"), width, "0"))


# --------------------------------------------------------------------------
# J5-J9 pipelines and scoring
# --------------------------------------------------------------------------
def assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def random_forest(features: Sequence[str], label: str = "label_idx", weight: str | None = "weight",
                  trees: int = 250, depth: int = 25, min_leaf: int = 2, seed: int = 42) -> Pipeline:
    """Random forest (Spark caps depth at 30).

    Each row's nodes are kept beside it, so that deep forests aren't sent to the tasks at every level, and
    room for the statistics of many nodes saves passes."""
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=min(depth, 30),
                                minInstancesPerNode=min_leaf, seed=seed, cacheNodeIds=True, maxMemoryInMB=1024)
    if weight:
        rf.setWeightCol(weight)
    return Pipeline(stages=[assembler(features), rf])


def fit(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    """Fit on rows that are dealt over all cores and kept while the estimator passes over them."""
    rows = df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions())).persist()
    try:
        return pipeline.fit(rows)
    finally:
        rows.unpersist()


def gbt_binary(features: Sequence[str], label: str = "y", weight: str | None = "weight", iters: int = 200,
               lr: float = 0.05, depth: int = 6, seed: int = 42, validation: str | None = None) -> Pipeline:
    """J6 (and J8 when ``validation`` names a boolean column: early stopping on validation loss)."""
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=iters, stepSize=lr, maxDepth=depth, seed=seed)
    if weight:
        gbt.setWeightCol(weight)
    if validation:
        gbt.setValidationIndicatorCol(validation)
    return Pipeline(stages=[assembler(features), gbt])


def ovr_gbt(features: Sequence[str], label: str = "label_idx", iters: int = 200, lr: float = 0.05, depth: int = 6,
            subsample: float = 0.9, columns: float = 0.9, seed: int = 42) -> Pipeline:
    """Multiclass boosting as one-vs-rest GBT with row and column subsampling (columns are drawn for each node)."""
    gbt = GBTClassifier(maxIter=iters, stepSize=lr, maxDepth=depth, subsamplingRate=subsample, featureSubsetStrategy=str(columns), seed=seed)
    ovr = OneVsRest(classifier=gbt, featuresCol="features", labelCol=label)
    return Pipeline(stages=[assembler(features), ovr])


def ovr_probabilities(model: PipelineModel, df: DataFrame, out: str = "probs") -> DataFrame:
    """Per-class probabilities of a fitted one-vs-rest pipeline.

    OneVsRest emits no probability column, so every binary sub-model's
    P(class) is taken and the vector is renormalised to sum to 1."""
    feats = model.stages[0].transform(df)
    ovr = model.stages[-1]
    cols = []
    for i, m in enumerate(ovr.models):
        m = m.copy()
        m.setProbabilityCol(f"_p{i}").setRawPredictionCol(f"_r{i}").setPredictionCol(f"_y{i}")
        feats = m.transform(feats).withColumn(f"_q{i}", vector_to_array(f"_p{i}")[1]).drop(f"_p{i}", f"_r{i}", f"_y{i}")
        cols.append(f"_q{i}")
    arr = F.array(*[F.col(c) for c in cols])
    tot = F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)
    return feats.withColumn(out, F.transform(arr, lambda x: x / tot)).drop(*cols)


def score(model: PipelineModel, df: DataFrame, probs: str = "probs") -> DataFrame:
    """Predictions plus the probability vector as an array column."""
    return model.transform(df).withColumn(probs, vector_to_array("probability"))


def decode_labels(indexer_model, col: str, out: str) -> IndexToString:
    return IndexToString(inputCol=col, outputCol=out, labels=indexer_model.labels)


# --------------------------------------------------------------------------
# J12 PCA, J13 importances, J14 Monte-Carlo Shapley, J18 persistence
# --------------------------------------------------------------------------
def pca_projection(df: DataFrame, features: Sequence[str], k: int = 2, keep: Sequence[str] = ()) -> tuple[DataFrame, list]:
    """2-D projection of centred data plus explained-variance ratios.
    Spark's PCA does not centre, so the column means are subtracted first."""
    means = df.agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in features]).first()
    centred = df.select(*keep, *[(F.col(f).cast("double") - F.lit(means[f] or 0.0)).alias(f) for f in features])
    vec = assembler(features).transform(centred)
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(vec)
    proj = model.transform(vec).select(*keep, vector_to_array("pc").alias("pc"))
    return proj.select(*keep, *[F.col("pc")[i].alias(f"pc{i + 1}") for i in range(k)]), \
        list(model.explainedVariance.toArray())


def feature_importances(model: PipelineModel, features: Sequence[str], top: int | None = None) -> list[tuple[str, float]]:
    """The model's impurity importances, highest first."""
    imp = model.stages[-1].featureImportances.toArray()
    pairs = sorted(zip(features, imp), key=lambda t: (-t[1], t[0]))
    return pairs[:top] if top else pairs


def monte_carlo_shapley(model: PipelineModel, rows: DataFrame, background: DataFrame, features: Sequence[str],
                        permutations: int = 8, seed: int = 42, probs: str = "probability") -> DataFrame:
    """Mean |Shapley value| per feature, averaged over classes
    (sampling estimator of Strumbelj & Kononenko, 2014).

    For every (row, permutation, feature j) two points are built from the row
    ``x`` and a background row ``z``: features ranked before j in the
    permutation come from ``x``, the rest from ``z``; the ``with`` point also
    takes j from ``x``.  All points are scored by ONE ``transform``.  The
    Shapley value of (row, j, class) is the mean signed difference over the
    permutations; its absolute value is averaged over rows and then classes
    with grouped aggregates.  Every (row, permutation) draws its own row of the
    whole ``background``, which may have any size, by an equi-join on the rows' numbers.
    """
    features = list(features)
    k = len(features)
    r = rows.select(F.monotonically_increasing_id().alias("_rid"), *[F.col(f).alias(f"x_{f}") for f in features])
    ensure_checkpoint_dir(rows.sparkSession)
    bg = ordinal_within(background.select(F.lit(0).alias("_all"), *[F.col(f).alias(f"z_{f}") for f in features]), "_all", [f"z_{f}" for f in features], out="_bid").drop("_all")
    nb = bg.count()
    rp = r.select("*", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))).alias("_perm"))
    rp = rp.withColumn("_bid", (F.pmod(F.xxhash64("_rid", "_perm", F.lit(seed)), F.lit(nb)) + 1))
    rp = rp.join(bg, "_bid").checkpoint(eager=True)              # both points of a pair are built from the same draw
    rp = rp.withColumn("_rank", F.array(*[F.xxhash64("_rid", "_perm", F.lit(i), F.lit(seed)) for i in range(k)]))
    pts = rp.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    rank_j = F.element_at("_rank", F.col("_j") + 1)
    cols_with, cols_wo = [], []
    for i, f in enumerate(features):
        before = F.col("_rank")[i] < rank_j
        cols_with.append(F.when(before | (F.col("_j") == i), F.col(f"x_{f}")).otherwise(F.col(f"z_{f}")).alias(f))
        cols_wo.append(F.when(before, F.col(f"x_{f}")).otherwise(F.col(f"z_{f}")).alias(f))
    base = [F.col("_rid"), F.col("_perm"), F.col("_j")]
    pair = pts.select(*base, F.lit(1.0).alias("_sg"), *cols_with).unionByName(
        pts.select(*base, F.lit(-1.0).alias("_sg"), *cols_wo))
    scored = model.transform(pair).select("_rid", "_j", "_sg", F.posexplode(vector_to_array(probs)).alias("_c", "_v"))
    phi = scored.groupBy("_rid", "_j", "_c").agg((F.sum(F.col("_sg") * F.col("_v")) / permutations).alias("_phi"))
    per_class = phi.groupBy("_j", "_c").agg(F.avg(F.abs("_phi")).alias("_m"))
    names = F.array(*[F.lit(f) for f in features])
    return per_class.groupBy("_j").agg(F.avg("_m").alias("mean_abs_shap")).select(
        F.element_at(names, F.col("_j") + 1).alias("feature"), "mean_abs_shap")


def save_model(model: PipelineModel, spark, name: str) -> str:
    """Persist under the cluster's checkpoint folder (shared storage)."""
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, "models", name)
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
