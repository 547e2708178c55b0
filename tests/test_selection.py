"""Selection by rank against sorting, with ties, null groups and every rank."""
import random

import pytest
from pyspark.sql import functions as F

from faultline.operators import prepare as pr
from faultline.operators import selection as se


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(spark, groups, seed=3):
    rng = random.Random(seed)
    rows = [(g, f"k{i}", i) for i, g in enumerate(groups)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "g string, k string, i long").repartition(4)


@pytest.mark.parametrize("digits", [1, 3])
def test_first_of_each_group(spark, digits):
    rng = random.Random(1)
    df = rows_of(spark, [rng.choice(["a", "a", "a", "b", None]) for _ in range(400)] + ["alone"])
    order = pr.seeded_hash("k")
    got = se.among_first(df, F.col("g"), order, lambda g, n: [n // 3, n, 0, 5, n + 9], ["third", "all", "none", "five", "more"], digits=digits).withColumn("h", order).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["h"]):
        by.setdefault(r["g"], []).append(r)
    assert len(got) == 401 and len(by) == 4
    for rows in by.values():
        n = len(rows)
        for k, r in enumerate(rows):
            assert (r["third"], r["all"], r["none"], r["five"], r["more"]) == (k < n // 3, True, False, k < 5, True)


def test_repeated_rows_are_split_exactly(spark):
    df = spark.createDataFrame([("a", "same", 0)] * 50 + [("a", "other", 1)] * 7 + [(None, "same", 0)] * 9, "g string, k string, i long").repartition(3)
    for want in (0, 1, 6, 7, 8, 30, 50, 57):
        got = se.among_first(df, F.col("g"), pr.seeded_hash("k"), lambda g, n, want=want: [want], ["yes"])
        assert got.count() == 66
        assert {r["g"]: r["n"] for r in got.groupBy("g").agg(F.count_if("yes").alias("n")).collect()} == {"a": want, None: min(want, 9)}


def test_no_sort_and_no_shuffle_of_rows(spark):
    df = rows_of(spark, ["a", "b"] * 200)
    for selected in (pr.stratified_row_split(df, "g", ["k"]), pr.exact_sample(df, 50, ["k"]), pr.capped_composition(df.withColumn("c", F.lit(1)), "c", {1: 20}, ["k"]),
                     pr.stratified_run_split(df, label="g", key="k")):
        text = plan(selected)
        assert "rangepartitioning" not in text and "Sort " not in text and "hashpartitioning" not in text and "Window" not in text


def test_samples_and_splits(spark):
    df = rows_of(spark, ["a"] * 60 + ["b"] * 40)
    assert pr.exact_sample(df, 33, ["k"]).count() == 33 and pr.exact_sample(df, 100, ["k"]).count() == 100
    with pytest.raises(ValueError):
        pr.exact_sample(df, 101, ["k"])
    split = {(r["g"], r["fold"]): r["count"] for r in pr.stratified_row_split(df, "g", ["k"]).groupBy("g", "fold").count().collect()}
    assert split == {("a", "train"): 42, ("a", "val"): 9, ("a", "test"): 9, ("b", "train"): 28, ("b", "val"): 6, ("b", "test"): 6}
    assert pr.stratified_row_split(df.limit(0), "g", ["k"]).count() == 0
    runs = pr.stratified_run_split(rows_of(spark, ["a", "b", "b", "b"]), label="g", key="k").groupBy("g", "fold").count().collect()
    assert {(r["g"], r["fold"]): r["count"] for r in runs} == {("a", "train"): 1, ("b", "test"): 1, ("b", "train"): 2}


def test_compositions_at_once_are_those_one_by_one(spark):
    df = rows_of(spark, ["x"] * 300).withColumn("c", (F.col("i") % 3).cast("int")).withColumn("fold", F.when(F.col("i") % 2 == 0, "train").otherwise("val"))
    caps = {"even": {("train", 0): 10, ("train", 1): 10, ("val", 0): 400}, "odd": {("train", 1): 25}}
    got = pr.capped_compositions(df, "c", "fold", caps, ["k"])
    assert "rangepartitioning" not in plan(got)
    for name, by in caps.items():
        for fold in ("train", "val"):
            want = pr.capped_composition(df.where(F.col("fold") == fold), "c", {c: n for (f, c), n in by.items() if f == fold}, ["k"]).select("i")
            have = got.where((F.col("composition") == name) & (F.col("fold") == fold)).select("i")
            assert have.exceptAll(want).isEmpty() and want.exceptAll(have).isEmpty()
