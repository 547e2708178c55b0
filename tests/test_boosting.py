"""Boosted trees and exact explanations against plain numpy."""
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.functions.constants import SENSOR_COLUMNS
from faultline.operators import boosting as bo
from faultline.operators import explain as ex
from faultline.operators import models as mo

FEATURES = ["a", "b", "c", "d"]


def table(spark, n=240, classes=3, missing=0.0, seed=1):
    """Three classes by where (a, b) lies; c and d are noise; the mark is that of validation rows."""
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 3)
    y = (x[:, 0] > 0.2).astype(int) + ((x[:, 1] > 0) & (x[:, 0] > 0.2)) * (classes - 2)
    rows = [(*[None if rng.random() < missing else float(v) for v in r], int(k), float(rng.integers(1, 4)), i % 4 == 0, i) for i, (r, k) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y int, w double, held boolean, id long")


def same(a, b):
    return all(np.array_equal(x, y) for x, y in zip(a.trees, b.trees, strict=True))


@pytest.mark.parametrize("classes, missing", [(3, 0.0), (3, 0.2), (1, 0.1)])
def test_trees_dont_depend_on_how_rows_are_dealt_out(spark, classes, missing):
    df = table(spark, classes=2 if classes == 1 else 3, missing=missing)
    kwargs = dict(classes=classes, weight="w", validation="held", rounds=4, depth=3, rate=0.3, least_hessian=0.5, bins=16)
    one = bo.boost(df, FEATURES, "y", **kwargs)
    many = bo.boost(df.repartition(5, "id"), FEATURES, "y", block_rows=17, task_rows=60, keep_every=2, **kwargs)
    assert same(one, many) and (one.trees.feature >= 0).sum() > 8
    assert np.allclose(one.losses, many.losses)


def test_going_on_from_a_round_is_one_run(spark):
    df = table(spark)
    kwargs = dict(classes=3, validation="held", depth=2, rate=0.3, least_hessian=0.5)
    whole, part = bo.boost(df, FEATURES, "y", rounds=6, **kwargs), bo.boost(df, FEATURES, "y", rounds=2, **kwargs)
    assert same(whole, bo.boost(df, FEATURES, "y", rounds=6, model=part, **kwargs)) and same(part, whole.upto(2))
    more = bo.boost(df, FEATURES, "y", rounds=6, model=part, block_rows=50, task_rows=90, **kwargs)
    assert same(whole, more) and np.allclose(more.losses, whole.losses)


def test_root_split_is_the_best_of_all(spark):
    """Without sampling, the first tree's root has the largest gain over all features and edges."""
    df = table(spark, n=90)
    model = bo.boost(df, FEATURES, "y", classes=3, rounds=1, depth=1, rows_share=1.0, columns_share=1.0, bins=32, least_hessian=1.0)
    pdf = df.toPandas()
    for k in range(3):
        g, h = 1 / 3 - (pdf["y"] == k).to_numpy(), np.full(len(pdf), 2 * (1 / 3) * (2 / 3))
        best = (0.0, None)
        for f, edges in enumerate(model.edges):
            for e in edges:
                left = (pdf[FEATURES[f]] <= e).to_numpy()
                gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[~left].sum(), h[~left].sum()
                if min(hl, hr) >= 1:
                    gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, e, -0.05 * gl / (hl + 1), -0.05 * gr / (hr + 1)))
        f = int(model.trees.feature[0, k, 0])
        got = (f, model.edges[f][model.trees.bin[0, k, 0] - 1], *model.trees.value[0, k, 1:3])
        assert np.allclose(got, best[1], atol=1e-6) and abs(model.trees.gain[0, k, 0] - best[0]) < 1e-6


def test_learns_and_stops(spark):
    df = table(spark, n=600)
    model = bo.boost(df, FEATURES, "y", classes=3, validation="held", rounds=200, depth=3, rate=0.5, patience=5)
    assert model.rounds == min(200, model.best_round + 5) and min(model.losses) == model.losses[model.best_round - 1]
    scored = model.score(df.where("held"))
    right = scored.agg(F.avg((F.array_position("probs", F.array_max("probs")) - 1 == F.col("y")).cast("double"))).first()[0]
    assert right > 0.9
    replay = scored.agg(F.avg(-F.log(F.get("probs", "y")))).first()[0]
    assert abs(replay - model.losses[-1]) < 1e-9
    assert bo.stops([3, 2, 2.5, 2.6], 2) and not bo.stops([3, 2, 2.5, 2.6], 3) and not bo.stops([], 1) and not bo.stops([math.nan] * 9, 2)


def test_saved_and_read(spark, tmp_path):
    df = table(spark, missing=0.1)
    model = bo.boost(df, FEATURES, "y", classes=3, validation="held", rounds=3, depth=2)
    model.save(spark, f"{tmp_path}/m")
    back = bo.Boosted.load(spark, f"{tmp_path}/m")
    assert same(model, back) and back.losses == model.losses and back.settings == model.settings
    assert model.score(df).exceptAll(back.score(df)).count() == 0
    assert abs(sum(v for _, v in model.importances()) - 1) < 1e-9 and model.importances(2)[0][0] in ("a", "b")


def test_rows_without_label_and_bad_labels(spark):
    df = table(spark, n=60)
    kwargs = dict(classes=3, rounds=2, depth=2, rows_share=1.0)
    nulls = df.withColumn("y", F.lit(None).cast("int"))
    assert same(bo.boost(df, FEATURES, "y", **kwargs), bo.boost(df.unionByName(nulls), FEATURES, "y", **kwargs))
    with pytest.raises(Exception, match="class indices"):
        bo.boost(df, FEATURES, "y", classes=2, rounds=1)
    none = bo.boost(df.limit(0), FEATURES, "y", **kwargs)
    assert none.rounds == 2 and np.allclose(none.margins_of(np.zeros((2, 4))), 0)


def brute_force(x, trees, features):
    """Shapley values from the value of every subset of features (paths of unknown features by cover)."""
    def value(tree, at, known):
        node = tree(at)
        if node.feature < 0:
            return node.value
        if node.feature in known:
            v = x[node.feature]
            left = node.missing_left if np.isnan(v) else v <= node.threshold
            return value(tree, node.left if left else node.right, known)
        return sum(tree(c).cover / node.cover * value(tree, c, known) for c in (node.left, node.right))

    game = {s: sum(value(t, 0, s) for t in trees) for n in range(features + 1) for s in map(frozenset, itertools.combinations(range(features), n))}
    out = []
    for f in range(features):
        out.append(sum(math.factorial(len(s)) * math.factorial(features - len(s) - 1) / math.factorial(features) * (game[s | {f}] - game[s]) for s in game if f not in s))
    return np.array(out), game[frozenset()], game[frozenset(range(features))]


def test_shapley_values_are_those_of_all_subsets():
    rng = np.random.default_rng(4)
    trees = []
    for _ in range(6):                                     # depth 3, features repeat on paths
        nodes = {}
        def grow(i, depth, cover):
            if depth == 3 or rng.random() < 0.1:
                nodes[i] = ex.Node(-1, 0.0, False, 0, 0, cover, rng.normal(size=2))
                return
            part = rng.uniform(0.1, 0.9)
            nodes[i] = ex.Node(int(rng.integers(0, 4)), float(rng.normal()), bool(rng.random() < 0.5), 2 * i + 1, 2 * i + 2, cover, np.zeros(2))
            grow(2 * i + 1, depth + 1, cover * part)
            grow(2 * i + 2, depth + 1, cover * (1 - part))
        grow(0, 0, 10.0)
        trees.append(nodes.__getitem__)
    tables = ex.leaves_of(trees)
    x = rng.normal(size=(40, 4))
    x[rng.random(x.shape) < 0.15] = np.nan
    phi = ex.shapley(x, tables, 4, room=50)
    for row, got, predicted in zip(x, phi, ex.predict(x, tables), strict=True):
        want, base, whole = brute_force(row, trees, 4)
        assert np.allclose(got, want) and np.allclose(ex.base_value(tables), base) and np.allclose(predicted, whole)


def test_models_are_explained_as_they_score(spark, tmp_path):
    df = table(spark, missing=0.0).withColumn("shap", F.lit("x"))
    boosted = bo.boost(df, FEATURES, "y", classes=3, rounds=4, depth=3, rate=0.4)
    forest = mo.fit(mo.random_forest(FEATURES, label="y", weight="w", trees=7, depth=4), df)
    pdf = df.toPandas()[FEATURES].to_numpy()
    leaves = ex.leaves_of_boosted(boosted)
    assert np.allclose(ex.predict(pdf, leaves), boosted.margins_of(pdf))
    leaves = ex.leaves_of_forest(spark, forest, f"{tmp_path}/forest")
    rows = ex.explain(mo.score(forest, df), leaves, FEATURES).collect()
    assert len(rows) == 240
    for r in rows:
        assert np.allclose(r["predicted"], r["probs"]) and np.allclose(np.sum(r["shap"], axis=0) + ex.base_value(leaves), r["probs"])
    top = ex.mean_abs_shap(ex.explain(df, leaves, FEATURES), FEATURES).orderBy(F.desc("mean_abs_shap")).collect()
    assert {r["feature"] for r in top} == set(FEATURES) and {top[0]["feature"], top[1]["feature"]} == {"a", "b"}
    assert ex.explain(df.limit(0), leaves, FEATURES).count() == 0


def test_full_width_matches_spark_scores(spark):
    """Scoring through DataFrames is scoring of the matrix, whatever other columns there are."""
    df = table(spark, missing=0.3).withColumn("probs", F.lit(0))
    model = bo.boost(df, FEATURES, "y", classes=3, rounds=2, depth=2)
    got = {r["id"]: r["probs"] for r in model.score(df).collect()}
    pdf = df.toPandas()
    want = bo.probabilities(model.margins_of(pdf[FEATURES].to_numpy(dtype=float)))
    assert all(np.allclose(got[i], p) for i, p in zip(pdf["id"], want, strict=True)) and len(SENSOR_COLUMNS) == 52


def test_blocks_are_filled_however_rows_come():
    import pyarrow as pa
    batches = [pa.RecordBatch.from_pydict({"v": list(range(a, b))}) for a, b in ((0, 7), (7, 7), (7, 8), (8, 30))]
    got = [t.column("v").to_pylist() for t in bo._filled(batches, 8)]
    assert got == [list(range(a, min(a + 8, 30))) for a in range(0, 30, 8)] and list(bo._filled([], 8)) == []


def test_rows_of_many_blocks_are_dealt_over_the_cores(spark):
    """A level of many blocks is one job of two stages on rows that stay in memory, not one task's pass over all of them."""
    sc, df = spark.sparkContext, table(spark, n=1000)
    sc.setJobGroup("dealt", "dealt")
    try:
        model = bo.boost(df, FEATURES, "y", classes=3, rounds=3, depth=2, block_rows=100)
        stages = [sc.statusTracker().getStageInfo(s) for j in sc.statusTracker().getJobIdsForGroup("dealt") for s in sc.statusTracker().getJobInfo(j).stageIds]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    level = [s.numTasks for s in stages if s and "partitionBy" in s.name]
    assert model.rounds == 3 and len(level) == 3 * 2 and set(level) == {min(10, sc.defaultParallelism)}


def test_a_round_is_one_job_if_there_is_a_class_for_every_core(spark):
    """Blocks that a task can hold together are sent once; the tasks grow whole trees, the same ones as level by level."""
    sc, rng = spark.sparkContext, np.random.default_rng(7)
    k = sc.defaultParallelism + 1
    x = np.round(rng.normal(size=(900, 4)), 3)
    x[rng.random(x.shape) < 0.1] = np.nan
    y = rng.integers(0, k, 900)
    y[x[:, 0] > 0.5], y[x[:, 1] > 0.8] = 1, 2
    rows = [(*[None if np.isnan(v) else float(v) for v in r], int(c), float(rng.integers(1, 4)), i % 5 == 0) for i, (r, c) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y int, w double, held boolean").checkpoint()
    kwargs = dict(classes=k, weight="w", validation="held", rounds=4, depth=3, rate=0.3, least_hessian=0.2, bins=16)
    one = bo.boost(df, FEATURES, "y", **kwargs)
    levels = bo.boost(df, FEATURES, "y", block_rows=70, task_bytes=0, **kwargs)
    sc.setJobGroup("by class", "by class")
    try:
        trees = bo.boost(df, FEATURES, "y", block_rows=70, keep_every=2, **kwargs)
        stages = {i for j in sc.statusTracker().getJobIdsForGroup("by class") for i in sc.statusTracker().getJobInfo(j).stageIds}
        dealt = [s.numTasks for s in map(sc.statusTracker().getStageInfo, stages) if s and "partitionBy" in s.name and s.numCompletedTasks]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert same(one, levels) and same(one, trees) and np.allclose(one.losses, trees.losses) and (one.trees.feature >= 0).sum() > 20
    assert len(dealt) == 4 + 1
    part = bo.boost(df, FEATURES, "y", **kwargs | {"rounds": 2})
    assert same(one, bo.boost(df, FEATURES, "y", model=part, block_rows=70, **kwargs))


def test_memory_of_explained_rows_does_not_grow_with_the_leaves():
    """Rows meet some leaves at a time, in the outputs as in the Shapley values."""
    import tracemalloc
    rng = np.random.default_rng(3)
    x, most = rng.normal(size=(64, 6)), {}
    for n in (2_000, 40_000):
        feature = np.argsort(rng.random((n, 6)), axis=1)[:, :5]
        t = ex.Leaves(feature, rng.normal(size=(n, 5)) - 1, rng.normal(size=(n, 5)) + 1, np.ones((n, 5), bool), rng.uniform(0.1, 0.9, (n, 5)), rng.normal(size=(n, 2)))
        for f in (lambda: ex.predict(x, [t], room=1 << 16), lambda: ex.shapley(x, [t], 6, room=1 << 16)):
            tracemalloc.start()
            f()
            most.setdefault(n, []).append(tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()
        assert np.allclose(ex.predict(x, [t], room=1 << 12), ex.reached(x, t).all(axis=2).astype(float) @ t.value)
    assert all(many < 1.5 * few + 2**20 for few, many in zip(most[2_000], most[40_000], strict=True))


def test_outputs_come_with_the_shapley_values():
    """One pass over the leaves gives both, with missing values and a leaf that all rows reach."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(30, 5))
    x[rng.random(x.shape) < 0.2] = np.nan
    feature = np.argsort(rng.random((200, 5)), axis=1)[:, :3]
    t = ex.Leaves(feature, rng.normal(size=(200, 3)) - 1, rng.normal(size=(200, 3)) + 1, rng.random((200, 3)) < 0.5, rng.uniform(0.1, 0.9, (200, 3)), rng.normal(size=(200, 2)))
    none = ex.Leaves(np.zeros((1, 0), int), *[np.zeros((1, 0))] * 4, np.array([[0.25, 0.5]]))
    phi, outputs = ex.explained(x, [none, t], 5, room=100)
    assert np.allclose(outputs, ex.predict(x, [none, t])) and np.allclose(phi.sum(axis=1) + ex.base_value([none, t]), outputs)
