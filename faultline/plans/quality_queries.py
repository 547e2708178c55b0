"""Audit, exploratory and preprocessing queries over ``sensor_matrix``."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.constants import SENSOR_COLUMNS
from ..operators import quality as qa
from ..sources.tables import sensor_matrix, telemetry
from . import sql as Q
from .registry import register

SENS = SENSOR_COLUMNS


def gappy_matrix(spark, sf_dir):
    """sensor_matrix with deterministic gaps: sensor k is null where (7*sample + k) % 23 = 0;
    xmv_11 is entirely null (all-missing sensor fixture)."""
    m = sensor_matrix(spark, sf_dir)
    cols = []
    for k, s in enumerate(SENS, start=1):
        if s == "xmv_11":
            cols.append(F.lit(None).cast("double").alias(s))
        else:
            cols.append(F.when((F.col("sample") * 7 + k) % 23 == 0, F.lit(None).cast("double"))
                        .otherwise(F.col(s)).alias(s))
    fold = (F.when(F.col("sample") % 20 < 14, "train").when(F.col("sample") % 20 < 17, "val").otherwise("test"))
    return m.select("faultNumber", "sample", fold.alias("fold"), *cols)


def _gappy_sql() -> str:
    cols = []
    for k, s in enumerate(SENS, start=1):
        if s == "xmv_11":
            cols.append(f"CAST(NULL AS DOUBLE) AS {s}")
        else:
            cols.append(f"CASE WHEN (sample * 7 + {k}) % 23 = 0 THEN NULL ELSE {s} END AS {s}")
    return "WITH " + Q.SENSOR_MATRIX + """,
gm AS (SELECT faultNumber, sample,
  CASE WHEN sample % 20 < 14 THEN 'train' WHEN sample % 20 < 17 THEN 'val' ELSE 'test' END AS fold,
  """ + ",\n  ".join(cols) + "\n  FROM sensor_matrix)"


GAPPY = _gappy_sql()


def r6(c):
    return F.round(c, 6)


@register("d3_missing_rate_audit", "D3 Q14", GAPPY + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{s}' AS sensor, round(avg(CASE WHEN {s} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_rate FROM gm"
    for s in SENS))
def d3(spark, sf_dir):
    m = qa.missing_rates(gappy_matrix(spark, sf_dir), SENS)
    return m.select("sensor", r6("missing_rate").alias("missing_rate"))


def _outlier_sql(z: float) -> str:
    stats = ", ".join(f"avg({s}) AS mu_{s}, stddev_samp({s}) AS sd_{s}" for s in SENS)
    parts = [f"""SELECT '{s}' AS sensor,
  count(*) FILTER (WHERE sd_{s} > 0 AND abs(({s} - mu_{s}) / sd_{s}) > {z}) AS n_outliers,
  round(CAST(count(*) FILTER (WHERE sd_{s} > 0 AND abs(({s} - mu_{s}) / sd_{s}) > {z}) AS DOUBLE) / count(*), 5) AS outlier_rate
FROM sensor_matrix, st""" for s in SENS]
    return "WITH " + Q.SENSOR_MATRIX + f",\nst AS (SELECT {stats} FROM sensor_matrix)\n" + "\nUNION ALL\n".join(parts)


@register("d4_outlier_audit", "D4", _outlier_sql(6.0))
def d4(spark, sf_dir):
    return qa.outlier_audit(sensor_matrix(spark, sf_dir), SENS, 6.0)


@register("d4_outlier_audit_z3", "D4", _outlier_sql(3.0))
def d4_z3(spark, sf_dir):
    return qa.outlier_audit(sensor_matrix(spark, sf_dir), SENS, 3.0)


@register("d5_variance_ranking", "D5", "WITH " + Q.SENSOR_MATRIX + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{s}' AS sensor, round(var_samp({s}), 6) AS variance FROM sensor_matrix" for s in SENS))
def d5(spark, sf_dir):
    v = qa.variance_ranking(sensor_matrix(spark, sf_dir), SENS)
    return v.select("sensor", r6("variance").alias("variance")).orderBy(F.col("variance").desc())


def _corr_sql() -> str:
    pairs = [(a, b) for i, a in enumerate(SENS) for b in SENS[i + 1:]]
    agg = ", ".join(f"corr({a}, {b}) AS \"{a}|{b}\"" for a, b in pairs)
    return "WITH " + Q.SENSOR_MATRIX + f""",
c AS (SELECT {agg} FROM gm0),
u AS (UNPIVOT c ON COLUMNS(*) INTO NAME pair VALUE corr)
SELECT split_part(pair, '|', 1) AS var_a, split_part(pair, '|', 2) AS var_b, round(corr, 6) AS corr FROM u"""


@register("d6_correlation_matrix", "D6", _corr_sql().replace("FROM gm0", "FROM sensor_matrix"))
def d6(spark, sf_dir):
    c = qa.correlation_long(sensor_matrix(spark, sf_dir), SENS)
    return c.select("var_a", "var_b", r6("corr").alias("corr"))


@register("d7_median_trajectory", "D7", "WITH " + Q.TELEMETRY + """
SELECT faultNumber, sample, round(median(xmeas_13), 6) AS xmeas_13_median, round(median(xmeas_9), 6) AS xmeas_9_median
FROM telemetry GROUP BY faultNumber, sample""")
def d7(spark, sf_dir):
    m = qa.median_trajectory(telemetry(spark, sf_dir), ["xmeas_13", "xmeas_9"])
    return m.select("faultNumber", "sample", r6("xmeas_13_median").alias("xmeas_13_median"),
                    r6("xmeas_9_median").alias("xmeas_9_median"))


def _params_sql() -> str:
    # a map per row keeps missing values in the long form, which UNPIVOT would drop
    cols = ", ".join(f"'{s}': {s}" for s in SENS)
    return GAPPY + f""",
long AS (SELECT unnest(map_entries(MAP {{{cols}}})) AS e FROM gm WHERE fold = 'train'),
lv AS (SELECT e.key AS sensor, e.value AS v FROM long),
med AS (SELECT sensor, coalesce(median(v), 0.0) AS median FROM lv GROUP BY sensor),
mom AS (SELECT sensor, avg(coalesce(v, median)) AS mean, stddev_pop(coalesce(v, median)) AS sd FROM lv JOIN med USING (sensor) GROUP BY sensor),
params AS (SELECT m.sensor, m.median, o.mean, CASE WHEN o.sd = 0 THEN 1.0 ELSE o.sd END AS scale
           FROM med m JOIN mom o USING (sensor))"""


PARAMS_SQL = _params_sql()


@register("j1_j2_preprocessor_params", "J1 J2", PARAMS_SQL + """
SELECT sensor, round(median, 6) AS median, round(mean, 6) AS mean, round(scale, 6) AS scale FROM params""")
def j12(spark, sf_dir):
    g = gappy_matrix(spark, sf_dir)
    p = qa.fit_preprocessor(g.where(F.col("fold") == "train"), SENS)
    return p.select("sensor", r6("median").alias("median"), r6("mean").alias("mean"), r6("scale").alias("scale"))


def _j3_sql() -> str:
    parts = "\nUNION ALL\n".join(
        f"SELECT fold, '{s}' AS sensor, {s} AS raw, (coalesce({s}, p.median) - p.mean) / p.scale AS z "
        f"FROM gm, params p WHERE p.sensor = '{s}'" for s in SENS)
    return PARAMS_SQL + f""",
t AS ({parts})
SELECT fold, sensor, round(avg(z), 6) AS mean_z, round(avg(CASE WHEN raw IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_rate,
       count(*) AS n_rows
FROM t GROUP BY fold, sensor"""


@register("j3_fit_apply_audit", "J3", _j3_sql())
def j3(spark, sf_dir):
    g = gappy_matrix(spark, sf_dir)
    p = qa.fit_preprocessor(g.where(F.col("fold") == "train"), SENS)
    z = qa.apply_preprocessor(g, p, SENS, keep=["fold"])
    zs = z.groupBy("fold").agg(*[F.avg(s).alias(f"z_{s}") for s in SENS])
    miss = qa.missing_rates(g, SENS, by=["fold"])
    stacked = F.explode(F.array(*[F.struct(F.lit(s).alias("sensor"), F.col(f"z_{s}").alias("mean_z")) for s in SENS]))
    zl = zs.select("fold", stacked.alias("_s")).select("fold", "_s.sensor", "_s.mean_z")
    n = g.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"))
    out = zl.join(miss, ["fold", "sensor"]).join(n, "fold")
    return out.select("fold", "sensor", r6("mean_z").alias("mean_z"), r6("missing_rate").alias("missing_rate"), "n_rows")
