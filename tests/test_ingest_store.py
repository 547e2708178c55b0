"""Typed ingest, the build-once cache, key-filtered scans and the model store."""
from __future__ import annotations

import os
import re

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from faultline.operators import boosting as bo
from faultline.operators import models as mo
from faultline.operators import quality as qa
from faultline.operators import store
from faultline.sources import ingest as ing

HEADER = " faultNumber ,simulationRun,sample, xmeas_13,xmeas_9"


def write_csv(folder, name, lines, header=HEADER):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")
    return str(folder)


def rows(df):
    return sorted(tuple(r) for r in df.select("split", "faultNumber", "simulationRun", "sample", "xmeas_13").collect())


def test_malformed_values_are_counted(spark, tmp_path):
    csv = write_csv(tmp_path / "csv", "a.csv", ["1,1,1,2.5,NaN", "1,1,2,x,1", "1,1,?,3,1", ",1,4,y,1", "1,1,5,,1", "70000,1,6,1,1"])
    out = ing.typed_ingest(spark, csv, str(tmp_path / "out"))
    assert dict(out.dtypes) | {} == {"faultNumber": "smallint", "simulationRun": "int", "sample": "int", "xmeas_13": "float", "xmeas_9": "float"}
    assert sorted((r["sample"], r["xmeas_13"], r["xmeas_9"]) for r in out.collect()) == [(1, 2.5, None), (2, None, 1.0), (5, None, 1.0)]
    found = {r["column"]: (r["n_values"], r["n_rows_dropped"]) for r in ing.rejected_values(spark, csv).collect()}
    assert found == {"faultNumber": (2, 2), "sample": (1, 1), "xmeas_13": (2, 1)}


def test_cache_follows_its_sources(spark, tmp_path):
    csv, out = write_csv(tmp_path / "csv", "a.csv", ["1,1,1,2.5,1"]), str(tmp_path / "cache")
    assert ing.cached_ingest(spark, {"train": str(tmp_path / "absent")}, out) is None
    sources = {"train": csv, "test": str(tmp_path / "absent")}
    builds = lambda: spark.read.parquet(f"{out}/manifest").count()
    first = ing.cached_ingest(spark, sources, out)
    assert rows(first) == [("train", 1, 1, 1, 2.5)]
    ing.cached_ingest(spark, sources, out)
    assert builds() == 1
    write_csv(tmp_path / "csv", "b.csv", ["2,1,1,NaN,1"])                     # one more file
    second = ing.cached_ingest(spark, sources, out)
    assert builds() == 2 and rows(second) == [("train", 1, 1, 1, 2.5), ("train", 2, 1, 1, None)]
    assert rows(first) == [("train", 1, 1, 1, 2.5)]                           # readers of the old build aren't disturbed
    ing.cached_ingest(spark, sources, out, force=True)
    assert builds() == 3
    assert "xmeas_9" not in ing.cached_ingest(spark, sources, out, sensors=["xmeas_13"]).columns       # other columns: built again
    assert builds() == 4
    # the source goes: its last copy is used; a second split is built alone
    other = write_csv(tmp_path / "other", "c.csv", ["3,1,1,1,1"])
    both = ing.cached_ingest(spark, {"train": str(tmp_path / "absent"), "test": other}, out, sensors=["xmeas_13"])
    assert builds() == 5 and rows(both) == [("test", 3, 1, 1, 1.0), ("train", 1, 1, 1, 2.5), ("train", 2, 1, 1, None)]


def test_a_killed_build_is_done_again(spark, tmp_path, monkeypatch):
    csv, out = write_csv(tmp_path / "csv", "a.csv", ["1,1,1,2.5,1", "1,1,2,3.5,1"]), str(tmp_path / "cache")
    whole = ing.write_runs

    def killed(typed, path, *args):
        whole(typed.limit(1), path, *args)
        raise RuntimeError("killed")
    monkeypatch.setattr(ing, "write_runs", killed)
    with pytest.raises(RuntimeError):
        ing.cached_ingest(spark, {"train": csv}, out)
    monkeypatch.setattr(ing, "write_runs", whole)
    assert len(os.listdir(f"{out}/data")) == 1
    assert len(rows(ing.cached_ingest(spark, {"train": csv}, out))) == 2


def test_key_filtered_scan_prunes(spark, tmp_path):
    runs = spark.range(4000).select((F.col("id") % 5).cast("smallint").alias("faultNumber"), (F.col("id") % 40).cast("int").alias("simulationRun"), F.col("id").cast("int").alias("sample"))
    ing.write_runs(runs, str(tmp_path / "runs"))
    ing.write_runs(runs.groupBy("faultNumber", "simulationRun").agg(F.min("sample").alias("sample")), str(tmp_path / "keys"), parts=("simulationRun",))
    stored, keys = spark.read.schema(runs.schema).parquet(str(tmp_path / "runs")), spark.read.parquet(str(tmp_path / "keys"))
    found = ing.scan_keys(stored, keys.where("sample < 12 AND faultNumber IN (1, 3)"))
    plan = found._jdf.queryExecution().toString()
    assert "dynamicpruningexpression(faultNumber" in plan
    expected = [i for i in range(4000) if i % 40 < 12 and i % 5 in (1, 3)]
    assert sorted(r["sample"] for r in found.collect()) == expected
    assert ing.scan_keys(stored, keys.limit(0)).count() == 0
    one = stored.where("faultNumber = 3 AND simulationRun = 8")._jdf.queryExecution().toString()
    assert "EqualTo(simulationRun,8)" in one and re.search(r"PartitionFilters: \[[^]]*faultNumber#\d+ = 3", one)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    data = [(int(i % 3), None if i % 11 == 0 else float(i % 3 + rng.normal(0, 0.1)), float(rng.normal(5, 2)), "keep") for i in range(240)]
    return spark.createDataFrame(data, "label_idx int, a double, b double, other string").checkpoint()


def test_preprocessor_stage(spark, labelled, tmp_path):
    fitted = Pipeline(stages=[store.Preprocessor(sensors=["a", "b"]), mo.assembler(["a", "b"])]).fit(labelled)
    fitted.write().overwrite().save(str(tmp_path / "p"))
    back = type(fitted).load(str(tmp_path / "p"))
    expected = qa.apply_preprocessor(labelled, qa.fit_preprocessor(labelled, ["a", "b"]), ["a", "b"], keep=["label_idx"]).collect()
    for model in (fitted, back):
        got = model.transform(labelled).collect()
        assert got[0]["other"] == "keep"
        assert np.allclose([(r["a"], r["b"]) for r in got], [(r["a"], r["b"]) for r in expected], atol=1e-12)
    assert back.stages[0].getSensors() == ["a", "b"]
    empty = store.Preprocessor(sensors=["a"]).fit(labelled.limit(0))
    assert empty.transform(labelled.where("a IS NOT NULL").limit(1)).first()["a"] == labelled.where("a IS NOT NULL").first()["a"]


def test_store_keeps_models_and_finds_the_best(spark, labelled, tmp_path):
    root = str(tmp_path / "models")
    with pytest.raises(ValueError):
        store.load_best(spark, root)
    fits = {"forest": lambda d: mo.fit(mo.random_forest(["a", "b"], weight=None, trees=5, depth=3), d),
            "boosted": lambda d: bo.boost(d, ["a", "b"], "label_idx", classes=3, rounds=5, depth=2)}
    before = {}
    for (name, fit), f1 in zip(fits.items(), (0.7, 0.9), strict=True):
        one = store.fit_behind_preprocessor(labelled, ["a", "b"], ["x", "y", "z"], fit)
        scored = one.score(labelled).withColumn("said", one.predicted())
        before[name] = [(r["a"], r["other"], r["probs"], r["said"]) for r in scored.collect()]
        store.save(spark, root, name, one, {"macro_f1": f1})
    for name in fits:
        one, metrics = store.load(spark, root, name)
        assert [(r["a"], r["other"], r["probs"], r["said"]) for r in one.score(labelled).withColumn("said", one.predicted()).collect()] == before[name]
        assert set(metrics) == {"macro_f1"}
    assert store.load_best(spark, root)[0] == "boosted"
    assert store.load_best(spark, root, "accuracy")[0] == "boosted"           # no model has it: the first name
    with pytest.raises(ValueError):
        store.load(spark, root, "absent")
