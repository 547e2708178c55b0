"""Data-quality audits, exploratory statistics and train-fitted preprocessing.

Wide-table audits use ONE aggregate over all sensor columns (no 52x row
blow-up) and unpivot only the one-row result.  Fitted parameters (medians,
means, stds) are one row per sensor: they are joined back in long form or
inlined as literals (bounded by the number of sensors, not by the data).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import OUTLIER_Z


def _unpivot_one_row(row_df: DataFrame, names: Sequence[str], value: str, prefix: str) -> DataFrame:
    cols = [f"{prefix}{n}" for n in names]
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("sensor"), F.col(c).alias(value))
                                  for n, c in zip(names, cols)]))
    return row_df.select(stacked.alias("_s")).select("_s.sensor", f"_s.{value}")


def missing_rates(df: DataFrame, sensors: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """D3: share of nulls per sensor (and group), highest first."""
    aggs = [F.avg(F.col(s).isNull().cast("double")).alias(f"m_{s}") for s in sensors]
    if not by:
        return _unpivot_one_row(df.agg(*aggs), sensors, "missing_rate", "m_")
    g = df.groupBy(*by).agg(*aggs)
    stacked = F.explode(F.array(*[F.struct(F.lit(s).alias("sensor"), F.col(f"m_{s}").alias("missing_rate"))
                                  for s in sensors]))
    return g.select(*by, stacked.alias("_s")).select(*by, "_s.sensor", "_s.missing_rate")


def sensor_stats(df: DataFrame, sensors: Sequence[str]) -> dict[str, tuple]:
    """(mean, sample std, count, non-null count) per sensor; one aggregate action
    whose result size is bounded by the number of sensors."""
    aggs = []
    for s in sensors:
        x = F.col(s).cast("double")
        aggs += [F.avg(x).alias(f"mu_{s}"), F.stddev_samp(x).alias(f"sd_{s}")]
    aggs.append(F.count(F.lit(1)).alias("_n"))
    row = df.agg(*aggs).first()
    return {s: (row[f"mu_{s}"], row[f"sd_{s}"], row["_n"]) for s in sensors}


def outlier_audit(df: DataFrame, sensors: Sequence[str], z: float = OUTLIER_Z) -> DataFrame:
    """Count and rate of |x - mean| / std > z (sample std; std 0 or null
    -> nothing flagged; the rate's denominator counts null rows too; 5 dp)."""
    st = sensor_stats(df, sensors)
    aggs = []
    for s in sensors:
        mu, sd, _ = st[s]
        if sd is None or sd == 0 or mu is None:
            aggs.append(F.lit(0).cast("long").alias(f"o_{s}"))
        else:
            aggs.append(F.count_if(F.abs((F.col(s).cast("double") - F.lit(mu)) / F.lit(sd)) > z).alias(f"o_{s}"))
    aggs.append(F.count(F.lit(1)).alias("_n"))
    g = df.agg(*aggs)
    stacked = F.explode(F.array(*[F.struct(F.lit(s).alias("sensor"), F.col(f"o_{s}").alias("n_outliers"))
                                  for s in sensors]))
    return g.select(stacked.alias("_s"), "_n").select(
        "_s.sensor", "_s.n_outliers", F.round(F.col("_s.n_outliers") / F.col("_n"), 5).alias("outlier_rate"))


def variance_ranking(df: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """Sample variance per sensor, highest first."""
    g = df.agg(*[F.var_samp(F.col(s).cast("double")).alias(f"v_{s}") for s in sensors])
    return _unpivot_one_row(g, sensors, "variance", "v_")


def correlation_long(df: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation for every sensor pair (a < b in
    list order), long form.

    Each task reduces its rows to the sufficient statistics of every pair
    (masked matrix products: pair counts, sums, sums of squares, cross
    products) and a grouped sum over (i, j) adds them up - one pass, any
    number of rows, no pair explosion and no giant generated aggregate.
    Values are centred on the column means first (one small aggregate) so the
    single-pass formula does not cancel for offset signals.
    """
    import numpy as np
    import pandas as pd
    from pyspark.sql import types as T

    sensors = list(sensors)
    k = len(sensors)
    means_row = df.agg(*[F.avg(F.col(s).cast("double")).alias(s) for s in sensors]).first()
    means = np.array([means_row[s] if means_row[s] is not None else 0.0 for s in sensors], dtype=float)
    iu, ju = np.triu_indices(k, 1)

    def partial(batches):
        n = np.zeros((k, k)); sx = np.zeros((k, k)); sxx = np.zeros((k, k)); sxy = np.zeros((k, k))
        for pdf in batches:
            x = pdf[sensors].to_numpy(dtype=float) - means
            m = ~np.isnan(x)
            mf = m.astype(float)
            x0 = np.where(m, x, 0.0)
            n += mf.T @ mf
            sx += x0.T @ mf
            sxx += (x0 * x0).T @ mf
            sxy += x0.T @ x0
        yield pd.DataFrame({"i": iu.astype("int32"), "j": ju.astype("int32"), "n": n[iu, ju], "sx": sx[iu, ju],
                            "sy": sx[ju, iu], "sxx": sxx[iu, ju], "syy": sxx[ju, iu], "sxy": sxy[iu, ju]})

    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType())] +
                          [T.StructField(c, T.DoubleType()) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    parts = df.select(*[F.col(s).cast("double").alias(s) for s in sensors]).mapInPandas(partial, schema)
    tot = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    cov = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    vx = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    names = F.array(*[F.lit(s) for s in sensors])
    return tot.select(F.element_at(names, F.col("i") + 1).alias("var_a"), F.element_at(names, F.col("j") + 1).alias("var_b"),
                      F.when((vx > 0) & (vy > 0), cov / F.sqrt(vx * vy)).alias("corr"))


def median_trajectory(df: DataFrame, sensors: Sequence[str], by: Sequence[str] = ("faultNumber", "sample")) -> DataFrame:
    """Exact median per (fault, sample) for the chosen sensors (bracketed,
    so a fault holding most rows is not gathered in one task)."""
    by = list(by)
    long = df.select(*by, *[F.col(s).cast("double").alias(s) for s in sensors]).unpivot(by, list(sensors), "sensor", "value")
    med = exact_median_long(long, by + ["sensor"])
    return med.groupBy(*by).pivot("sensor", list(sensors)).agg(F.first("median")).select(
        *by, *[F.col(s).alias(f"{s}_median") for s in sensors])


# --------------------------------------------------------------------------
# J1-J3 preprocessing fitted on the training fold
# --------------------------------------------------------------------------
def wide_medians(df: DataFrame, sensors: Sequence[str], accuracy: int = 10_000) -> dict[str, float | None]:
    """Exact median of every sensor in three narrow passes over the wide table.

    1. One aggregate: counts, and a bracket round the middle from a sketch.
    2. One aggregate: how many values lie below each bracket.
    3. Only the values inside the brackets (about 4 / accuracy of them) are spread
       out, reduced to (sensor, value, multiplicity), and ranked by a running count.
    A sensor whose bracket misses (not expected) is taken by Spark's ``median``."""
    sensors = list(sensors)
    x = {s: F.col(s).cast("double") for s in sensors}
    eps = 2.0 / accuracy
    one = df.agg(*[c for s in sensors for c in (F.count(x[s]).alias(f"n_{s}"), F.percentile_approx(x[s], [0.5 - eps, 0.5 + eps], accuracy).alias(f"b_{s}"))]).first()
    known = [s for s in sensors if one[f"n_{s}"]]
    if not known:
        return dict.fromkeys(sensors)
    bracket = {s: (F.lit(one[f"b_{s}"][0]), F.lit(one[f"b_{s}"][1])) for s in known}
    below = df.agg(*[F.count_if(x[s] < bracket[s][0]).alias(s) for s in known]).first()
    inside = F.array_compact(F.array(*[F.when(x[s].between(*bracket[s]), F.struct(F.lit(s).alias("sensor"), x[s].alias("value"))) for s in known]))
    band = df.select(F.inline(inside)).groupBy("sensor", "value").agg(F.count(F.lit(1)).alias("m"))
    up_to = F.sum("m").over(Window.partitionBy("sensor").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    ranks = F.create_map(*[v for s in known for v in (F.lit(s), F.array(*[F.lit((one[f"n_{s}"] - 1) // 2 + 1 - below[s]), F.lit(one[f"n_{s}"] // 2 + 1 - below[s])]))])
    picks = band.withColumn("up_to", up_to).withColumn("k", F.element_at(ranks, F.col("sensor"))).groupBy("sensor").agg(
        *[F.min(F.when(F.col("up_to") >= F.col("k")[i], F.col("value"))).alias(f"v{i}") for i in (0, 1)], F.min(F.col("k")[0]).alias("k")).collect()    # one row a sensor
    out: dict[str, float | None] = {r["sensor"]: (r["v0"] + r["v1"]) / 2 for r in picks if r["k"] >= 1 and r["v1"] is not None}
    missed = [s for s in known if s not in out]
    if missed:
        out |= df.agg(*[F.median(x[s]).alias(s) for s in missed]).first().asDict()
    return {s: out.get(s) for s in sensors}


def fit_preprocessor(train: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """J1/J2 parameters, one row per sensor: exact median (imputation; all-null
    -> 0), mean and population std of the imputed values (std 0 -> 1)."""
    meds = {s: 0.0 if m is None else m for s, m in wide_medians(train, sensors).items()}          # all-missing sensor -> 0
    imputed = train.select(*[F.coalesce(F.col(s).cast("double"), F.lit(meds[s])).alias(s) for s in sensors])
    mom = imputed.agg(*[x for s in sensors for x in (F.avg(s).alias(f"mu_{s}"), F.stddev_pop(s).alias(f"sd_{s}"))])
    stacked = F.explode(F.array(*[F.struct(F.lit(s).alias("sensor"), F.lit(meds[s]).alias("median"),
                                           F.col(f"mu_{s}").alias("mean"),
                                           F.when(F.col(f"sd_{s}") == 0, F.lit(1.0)).otherwise(F.col(f"sd_{s}"))
                                           .alias("scale")) for s in sensors]))
    return mom.select(stacked.alias("_p")).select("_p.*")


def apply_preprocessor(df: DataFrame, params: DataFrame, sensors: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Impute with the train medians, then standardise with the train mean/scale."""
    p = {r["sensor"]: (r["median"], r["mean"], r["scale"]) for r in params.collect()}   # bounded by #sensors
    cols: list[Column] = []
    for s in sensors:
        med, mu, sc = p[s]
        cols.append(((F.coalesce(F.col(s).cast("double"), F.lit(med)) - F.lit(mu)) / F.lit(sc)).alias(s))
    return df.select(*keep, *cols)


def exact_median_long(long: DataFrame, by: Sequence[str], value: str = "value", accuracy: int = 100_000) -> DataFrame:
    """Exact median of ``value`` per group (even counts: mean of the two middle
    values), without gathering a group's values in one task.

    1. One aggregate per group: count and an approximate bracket
       [q(0.5 - 2/A), q(0.5 + 2/A)] from ``percentile_approx`` (rank error <= n/A),
       which therefore contains both middle ranks.
    2. Rows below the bracket are only counted; rows inside are reduced to
       (value, multiplicity) pairs - about 4n/A rows per group, ties collapsed.
    3. A cumulative count over the in-bracket values (a window over that small
       table) finds the values at the middle ranks.
    Groups whose bracket would miss (not expected) fall back to ``median``.
    """
    by = list(by)
    eps = 2.0 / accuracy
    v = F.col(value).cast("double")
    stats = long.groupBy(*by).agg(
        F.count(v).alias("_n"),
        F.percentile_approx(v, [max(0.0, 0.5 - eps), min(1.0, 0.5 + eps)], accuracy).alias("_br"))
    stats = stats.select(*by, "_n", F.col("_br")[0].alias("_lo"), F.col("_br")[1].alias("_hi"),
                         (F.floor((F.col("_n") - 1) / 2) + 1).alias("_k1"), (F.floor(F.col("_n") / 2) + 1).alias("_k2"))
    j = long.select(*by, v.alias("_v")).where(F.col("_v").isNotNull()).join(stats, by)
    below = j.groupBy(*by).agg(F.count_if(F.col("_v") < F.col("_lo")).alias("_below"))
    band = (j.where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
            .groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_m")))
    w = Window.partitionBy(*by).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    band = band.join(below, by).join(stats.select(*by, "_k1", "_k2"), by)
    band = band.withColumn("_cum", F.col("_below") + F.sum("_m").over(w))
    picks = band.groupBy(*by).agg(
        F.min(F.when(F.col("_cum") >= F.col("_k1"), F.col("_v"))).alias("_v1"),
        F.min(F.when(F.col("_cum") >= F.col("_k2"), F.col("_v"))).alias("_v2"),
        F.first("_below").alias("_below"), F.max("_cum").alias("_top"), F.first("_k1").alias("_k1"),
        F.first("_k2").alias("_k2"))
    ok = (F.col("_below") < F.col("_k1")) & (F.col("_top") >= F.col("_k2"))
    res = stats.select(*by, "_n").join(picks, by, "left").select(
        *by, F.when(ok, (F.col("_v1") + F.col("_v2")) / 2.0).alias("median"), "_n", ok.alias("_ok"))
    good = res.where(F.col("_ok") | (F.col("_n") == 0)).select(*by, "median")
    bad_keys = res.where(~F.coalesce(F.col("_ok"), F.lit(False)) & (F.col("_n") > 0)).select(*by)
    fallback = long.join(bad_keys, by, "left_semi").groupBy(*by).agg(F.median(v).alias("median"))
    return good.unionByName(fallback)
