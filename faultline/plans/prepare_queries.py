"""Preparation queries: filters, keys, schema alignment, splits, sampling, audits."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prepare as pr
from ..sources.tables import EVENTS_INJECTION, telemetry
from . import sql as Q
from .registry import register
from .telemetry_queries import scored

MD5 = "md5(run_key || '|42')"


def runs_table(spark, sf_dir):
    return pr.distinct_runs(telemetry(spark, sf_dir))


@register("b1_trim_pre_injection", "B1", "WITH " + Q.TELEMETRY + """
SELECT run_key, sample, faultNumber FROM telemetry WHERE faultNumber = 0 OR sample > 20""")
def b1(spark, sf_dir):
    return pr.trim_pre_injection(telemetry(spark, sf_dir), EVENTS_INJECTION).select("run_key", "sample", "faultNumber")


@register("b2_active_fault_subset", "B2", "WITH " + Q.TELEMETRY + """
SELECT run_key, sample, faultNumber FROM telemetry WHERE faultNumber > 0 AND faultNumber IN (1, 4, 6, 11, 14)""")
def b2(spark, sf_dir):
    return pr.active_faults(telemetry(spark, sf_dir), [1, 4, 6, 11, 14]).select("run_key", "sample", "faultNumber")


@register("g2_distinct_runs", "B6 G2", "WITH " + Q.TELEMETRY + """
SELECT DISTINCT run_key, faultNumber, simulationRun FROM telemetry""")
def g2(spark, sf_dir):
    t = telemetry(spark, sf_dir).drop("run_key")
    return pr.distinct_runs(pr.with_run_key(t, "EVENTS"))


@register("b8_schema_alignment", "B8", "WITH " + Q.TELEMETRY + """
SELECT run_key, sample, xmeas_9, round(xmeas_13, 6) AS xmeas_13, CAST(NULL AS DOUBLE) AS xmeas_22, xmv_10
FROM telemetry""")
def b8(spark, sf_dir):
    t = telemetry(spark, sf_dir)
    a = pr.align_schema(t, ["xmeas_9", "xmeas_13", "xmeas_22", "xmv_10"], keep=["run_key", "sample"])
    return a.withColumn("xmeas_13", F.round("xmeas_13", 6))


@register("b12_every_kth_row", "B12", "WITH " + Q.TELEMETRY + """
SELECT run_key, sample FROM telemetry WHERE (sample - 1) % 5 = 0""")
def b12(spark, sf_dir):
    return pr.every_kth(telemetry(spark, sf_dir), 5).select("run_key", "sample")


@register("b13_zoom_window", "B13", "WITH " + Q.TELEMETRY + """
SELECT run_key, sample, round(xmeas_13, 6) AS xmeas_13 FROM telemetry WHERE sample BETWEEN 25 AND 130""")
def b13(spark, sf_dir):
    z = pr.zoom(telemetry(spark, sf_dir), onset=50)
    return z.select("run_key", "sample", F.round("xmeas_13", 6).alias("xmeas_13"))


I1_SQL = "WITH " + Q.TELEMETRY + f""",
runs AS (SELECT DISTINCT run_key, faultNumber, simulationRun FROM telemetry),
r AS (SELECT *, row_number() OVER (PARTITION BY faultNumber ORDER BY {MD5}) AS rk FROM runs)"""


@register("i1_sample_runs_per_fault", "I1 I2 I3", I1_SQL + """
SELECT run_key, faultNumber, simulationRun, CAST(rk AS INTEGER) AS rank FROM r WHERE rk <= 3""")
def i1(spark, sf_dir):
    s = pr.sample_runs_per_fault(runs_table(spark, sf_dir), 3)
    return s.select("run_key", "faultNumber", "simulationRun", F.col("rank").cast("int").alias("rank"))


@register("c1_semi_join_runs", "C1 A4", I1_SQL + """
SELECT t.run_key, t.sample FROM telemetry t WHERE t.run_key IN (SELECT run_key FROM r WHERE rk <= 3)""")
def c1(spark, sf_dir):
    keys = pr.sample_runs_per_fault(runs_table(spark, sf_dir), 3).select("run_key")
    # the chosen keys are bounded by k x #faults: a broadcast semi join
    return telemetry(spark, sf_dir).join(F.broadcast(keys), "run_key", "left_semi").select("run_key", "sample")


_I5 = "WITH " + Q.SCORED + f""",
runs AS (SELECT DISTINCT run_key, faultNumber, simulationRun FROM telemetry),
rr AS (SELECT *, row_number() OVER (PARTITION BY faultNumber ORDER BY {MD5}) AS rk,
              count(*) OVER (PARTITION BY faultNumber) AS n FROM runs),
folds AS (SELECT run_key, faultNumber, simulationRun,
                 CASE WHEN rk <= least(ceil(n * 20 / 100), n - 1) THEN 'test' ELSE 'train' END AS fold FROM rr),
sf AS (SELECT s.*, f.fold FROM scored s JOIN folds f USING (run_key, faultNumber, simulationRun))"""


_FOLDS: dict[tuple, object] = {}


def run_folds(spark, sf_dir):
    """I5 folds (one row per run), materialised once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FOLDS:
        _FOLDS[key] = pr.stratified_run_split(runs_table(spark, sf_dir)).select("run_key", "fold").checkpoint(eager=True)
    return _FOLDS[key]


def split_rows(spark, sf_dir):
    return scored(spark, sf_dir).join(run_folds(spark, sf_dir), "run_key")


@register("i5_run_level_split", "I5", _I5 + """
SELECT run_key, faultNumber, fold FROM folds""")
def i5(spark, sf_dir):
    return pr.stratified_run_split(runs_table(spark, sf_dir)).select("run_key", "faultNumber", "fold")


@register("c4_fold_disjointness", "C4 G3", _I5 + """,
o AS (SELECT run_key, count(DISTINCT fold) AS n_folds FROM sf GROUP BY run_key)
SELECT count(*) AS n_runs, count(*) FILTER (WHERE n_folds > 1) AS n_shared FROM o""")
def c4(spark, sf_dir):
    s = split_rows(spark, sf_dir)
    o = s.groupBy("run_key").agg(F.count_distinct("fold").alias("n_folds"))
    return o.agg(F.count(F.lit(1)).alias("n_runs"), F.count_if(F.col("n_folds") > 1).alias("n_shared"))


@register("c5_class_counts_by_fold", "C5 D1", _I5 + """
SELECT target_fault_label, count(*) FILTER (WHERE fold = 'train') AS train,
       count(*) FILTER (WHERE fold = 'test') AS test
FROM sf GROUP BY target_fault_label""")
def c5(spark, sf_dir):
    return pr.class_counts(split_rows(spark, sf_dir), "target_fault_label", ["train", "test"])


@register("d2_dataset_summary", "D2", _I5 + """
SELECT count(*) FILTER (WHERE fold = 'train') AS n_train, count(*) FILTER (WHERE fold = 'test') AS n_test,
       (SELECT count(*) FROM (SELECT unnest(json_keys(to_json(one))) AS c FROM (SELECT * FROM scored LIMIT 1) one) WHERE starts_with(c, 'xmeas_') OR starts_with(c, 'xmv_')) AS n_features,
       count(DISTINCT target_fault_label) AS n_classes
FROM sf""")
def d2(spark, sf_dir):
    s = split_rows(spark, sf_dir)
    return s.agg(F.count_if(F.col("fold") == "train").alias("n_train"), F.count_if(F.col("fold") == "test").alias("n_test"),
                 F.lit(sum(c.startswith(("xmeas_", "xmv_")) for c in s.columns)).alias("n_features"), F.count_distinct("target_fault_label").alias("n_classes"))


@register("d8_run_sizes", "D8", "WITH " + Q.SCORED + """
SELECT run_key, count(*) AS n_rows, CAST(sum(y_true) AS BIGINT) AS n_fault_rows FROM scored GROUP BY run_key""")
def d8(spark, sf_dir):
    return pr.run_sizes(scored(spark, sf_dir))


@register("d10_split_report", "D10", _I5 + """
SELECT fold, count(*) AS n_rows, count(*) FILTER (WHERE y_true = 0) AS n_normal,
       count(*) FILTER (WHERE y_true = 1) AS n_fault, round(avg(CAST(y_true AS DOUBLE)), 6) AS fault_ratio,
       count(DISTINCT run_key) AS n_runs
FROM sf GROUP BY fold""")
def d10(spark, sf_dir):
    r = pr.split_report(split_rows(spark, sf_dir))
    return r.withColumn("fault_ratio", F.round("fault_ratio", 6))


@register("d9_run_extent_longest", "D9", "WITH " + Q.TELEMETRY + """,
e AS (SELECT run_key, min(sample) AS min_sample, max(sample) AS max_sample,
             arg_min(faultNumber, sample) AS fault_label FROM telemetry GROUP BY run_key)
SELECT run_key, min_sample, max_sample, fault_label, max_sample - min_sample + 1 AS n_samples
FROM e WHERE fault_label > 0 AND min_sample <= 20
ORDER BY max_sample DESC, min_sample, run_key LIMIT 1""")
def d9(spark, sf_dir):
    return pr.longest_run(pr.run_extent(telemetry(spark, sf_dir), 20)).select(
        "run_key", "min_sample", "max_sample", "fault_label", "n_samples")


@register("i4_row_level_split", "I4", "WITH " + Q.SCORED + """,
h AS (SELECT run_key, sample, target_fault_label,
             row_number() OVER (PARTITION BY target_fault_label ORDER BY md5(run_key || '|' || CAST(sample AS VARCHAR) || '|42')) AS rk,
             count(*) OVER (PARTITION BY target_fault_label) AS n FROM scored)
SELECT run_key, sample, CASE WHEN rk <= floor(n * 70 / 100) THEN 'train' WHEN rk <= floor(n * 85 / 100) THEN 'val'
                             ELSE 'test' END AS fold
FROM h""")
def i4(spark, sf_dir):
    s = pr.stratified_row_split(scored(spark, sf_dir), "target_fault_label", ["run_key", "sample"])
    return s.select("run_key", "sample", "fold")


@register("i6_exact_row_sample", "I6", "WITH " + Q.TELEMETRY + """
SELECT run_key, sample FROM telemetry ORDER BY md5(run_key || '|' || CAST(sample AS VARCHAR) || '|42') LIMIT 500""")
def i6(spark, sf_dir):
    return pr.exact_sample(telemetry(spark, sf_dir), 500, ["run_key", "sample"]).select("run_key", "sample")


# upstream's caps of each composition, as (fold, class) -> rows.
COMPOSITIONS = {"balanced_50_50": {("train", 0): 200_000, ("train", 1): 200_000, ("val", 0): 50_000, ("val", 1): 50_000},
                "imbalanced_90_10": {("train", 0): 450_000, ("train", 1): 50_000, ("val", 0): 50_000, ("val", 1): 50_000},
                "test_90_10": {("test", 0): 450_000, ("test", 1): 50_000}}


@register("i7_full_compositions", "I7", "WITH " + Q.SCORED + f""",
runs AS (SELECT DISTINCT run_key FROM scored),
folds AS (SELECT run_key, CASE WHEN ('0x' || substr({MD5}, 1, 7))::BIGINT % 20 < 14 THEN 'train'
                               WHEN ('0x' || substr({MD5}, 1, 7))::BIGINT % 20 < 17 THEN 'val' ELSE 'test' END AS fold FROM runs),
pool AS (SELECT run_key, sample, fold, 0 AS class FROM scored JOIN folds USING (run_key) WHERE faultNumber = 0
         UNION ALL SELECT run_key, sample, fold, 1 FROM scored JOIN folds USING (run_key) WHERE faultNumber > 0 AND sample > 20),
h AS (SELECT *, row_number() OVER (PARTITION BY fold, class ORDER BY md5(run_key || '|' || CAST(sample AS VARCHAR) || '|42')) AS rk FROM pool),
caps(composition, fold, class, cap) AS (VALUES {", ".join(str((name, *key, cap)) for name, caps in COMPOSITIONS.items() for key, cap in caps.items())})
SELECT composition, fold, run_key, sample, class FROM h JOIN caps USING (fold, class) WHERE rk <= cap""")
def i7_full(spark, sf_dir):
    """The three class compositions with upstream's caps, shrunk to what exists in each fold of runs (70/15/15 by hash)."""
    part = F.conv(F.substring(pr.seeded_hash("run_key"), 1, 7), 16, 10).cast("long") % 20
    pool = scored(spark, sf_dir).withColumn("class", pr.composition_class()).withColumn("fold", F.when(part < 14, "train").when(part < 17, "val").otherwise("test"))
    rows = pr.capped_compositions(pool, "class", "fold", COMPOSITIONS, ["run_key", "sample"])
    return rows.select("composition", "fold", "run_key", "sample", "class")


@register("i2_pooled_run_sample", "I2", "WITH " + Q.TELEMETRY + """,
runs AS (SELECT DISTINCT faultNumber, simulationRun,
                CASE WHEN simulationRun % 2 = 0 THEN 'A' ELSE 'B' END || '_fault_' || CAST(faultNumber AS VARCHAR) || '_run_' || CAST(simulationRun AS VARCHAR) AS run_key
         FROM telemetry),
h AS (SELECT *, row_number() OVER (PARTITION BY faultNumber ORDER BY md5(run_key || '|42')) AS rk FROM runs)
SELECT run_key, faultNumber, simulationRun FROM h WHERE rk <= 3""")
def i2(spark, sf_dir):
    """Three runs a fault from two archives (runs with an even and an odd number) pooled under (source, run) keys."""
    t = telemetry(spark, sf_dir).select("faultNumber", "simulationRun")
    archives = [pr.with_run_key(t.where(F.col("simulationRun") % 2 == k), source) for k, source in enumerate("AB")]
    runs = pr.distinct_runs(archives[0].unionByName(archives[1]))
    return pr.sample_runs_per_fault(runs, 3).select("run_key", "faultNumber", "simulationRun")


@register("i3_fault_run_sample", "I3", "WITH " + Q.TELEMETRY + """,
runs AS (SELECT DISTINCT faultNumber, run_key FROM telemetry WHERE faultNumber > 0),
h AS (SELECT *, row_number() OVER (PARTITION BY faultNumber ORDER BY md5(run_key || '|42')) AS rk FROM runs)
SELECT run_key, faultNumber FROM h WHERE rk <= 2""")
def i3(spark, sf_dir):
    """Two runs of each non-zero label."""
    runs = pr.distinct_runs(pr.active_faults(telemetry(spark, sf_dir)))
    return pr.sample_runs_per_fault(runs, 2).select("run_key", "faultNumber")


_E14 = "WITH " + Q.SCORED + f""",
runs AS (SELECT run_key, count(*) AS n_rows, CAST(sum(y_true) AS BIGINT) AS n_fault_rows FROM scored GROUP BY run_key)"""


@register("e14_complete_runs_until_target", "E14", _E14 + f""",
c AS (SELECT run_key, n_rows, sum(n_rows) OVER (ORDER BY {MD5} ROWS UNBOUNDED PRECEDING) AS cum_rows FROM runs)
SELECT run_key, n_rows, CAST(cum_rows AS BIGINT) AS cum_rows FROM c WHERE cum_rows - n_rows < 3000""")
def e14(spark, sf_dir):
    runs = pr.run_sizes(scored(spark, sf_dir))
    return pr.complete_runs_until(runs, 3000, "n_rows").select("run_key", "n_rows",
                                                               F.col("cum_rows").cast("long").alias("cum_rows"))


@register("e15_complete_fault_runs_until_target", "E15", _E14 + f""",
c AS (SELECT run_key, n_fault_rows, sum(n_fault_rows) OVER (ORDER BY {MD5} ROWS UNBOUNDED PRECEDING) AS cum_rows
      FROM runs WHERE n_fault_rows > 0)
SELECT run_key, n_fault_rows, CAST(cum_rows AS BIGINT) AS cum_rows FROM c WHERE cum_rows - n_fault_rows < 2000""")
def e15(spark, sf_dir):
    runs = pr.run_sizes(scored(spark, sf_dir)).where(F.col("n_fault_rows") > 0)
    return pr.complete_runs_until(runs, 2000, "n_fault_rows").select(
        "run_key", "n_fault_rows", F.col("cum_rows").cast("long").alias("cum_rows"))


@register("a6_labelled_union", "A6 G1", "WITH " + Q.TELEMETRY + """
SELECT run_key, sample, 0 AS label FROM telemetry WHERE faultNumber = 0
UNION ALL
SELECT run_key, sample, faultNumber AS label FROM telemetry WHERE faultNumber > 0""")
def a6(spark, sf_dir):
    t = telemetry(spark, sf_dir)
    free = t.where(F.col("faultNumber") == 0).select("run_key", "sample", F.lit(0).alias("label"))
    faulty = t.where(F.col("faultNumber") > 0).select("run_key", "sample", F.col("faultNumber").alias("label"))
    return free.unionByName(faulty)


@register("g4_fault_ids_either_archive", "G4", "WITH " + Q.TELEMETRY + """
SELECT faultNumber FROM telemetry WHERE simulationRun % 2 = 0
UNION
SELECT faultNumber FROM telemetry WHERE simulationRun % 2 = 1""")
def g4(spark, sf_dir):
    """Fault ids present in either of two archives, the runs with an even and an odd number."""
    t = telemetry(spark, sf_dir)
    a = t.where(F.col("simulationRun") % 2 == 0).select("faultNumber")
    b = t.where(F.col("simulationRun") % 2 == 1).select("faultNumber")
    return a.union(b).distinct()


@register("a10_canonical_run", "A10", "WITH " + Q.TELEMETRY + """
SELECT faultNumber, min(simulationRun) AS simulationRun FROM telemetry GROUP BY faultNumber""")
def a10(spark, sf_dir):
    return telemetry(spark, sf_dir).groupBy("faultNumber").agg(F.min("simulationRun").alias("simulationRun"))


@register("a9_run_source", "A9 A5 A3", "WITH " + Q.TELEMETRY + """,
c AS (SELECT min(simulationRun) AS r FROM telemetry WHERE faultNumber = 5)
SELECT faultNumber, simulationRun, sample, round(xmeas_13, 6) AS xmeas_13
FROM telemetry WHERE faultNumber = 5 AND simulationRun = (SELECT r FROM c)""")
def a9(spark, sf_dir):
    t = telemetry(spark, sf_dir)
    meta = t.select("faultNumber", "simulationRun")          # A3: metadata-only scan
    canon = meta.where(F.col("faultNumber") == 5).agg(F.min("simulationRun")).first()[0]
    run = pr.scan_runs(t, 5, [canon])
    return run.orderBy("sample").select("faultNumber", "simulationRun", "sample",
                                        F.round("xmeas_13", 6).alias("xmeas_13"))
