"""Comparisons between runs, classes and variables."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_sensors(df: DataFrame, ids: Sequence[str], sensors: Sequence[str]) -> DataFrame:
    """Long form (ids..., variable, value)."""
    return df.unpivot(list(ids), list(sensors), "variable", "value")


def risk_with_sensors(risk: DataFrame, sensors: DataFrame, keys: Sequence[str] = ("faultNumber", "simulationRun", "sample")
                      ) -> DataFrame:
    """Risk series left-joined to sensor rows on (fault, run, sample).
    The fault is part of the key, so a run id reused under several faults
    cannot fan the join out."""
    return risk.join(sensors, list(keys), "left")


def fault_vs_normal(df: DataFrame, sensors: Sequence[str], onset: int, fault: str = "faultNumber",
                    pos: str = "sample") -> DataFrame:
    """Per fault class and variable, the post-onset mean in fault runs,
    the mean in normal runs, and the % deviation (0 when the normal mean is 0),
    largest |deviation| first.  One wide aggregate by fault class; only its rows are
    unpivoted (classes x variables)."""
    counts_in = (F.col(fault) == 0) | (F.col(pos) > onset)
    means = df.where(F.col(fault) >= 0).groupBy(fault).agg(*[F.avg(F.when(counts_in, F.col(s))).alias(s) for s in sensors],
                                                           F.count_if(counts_in).alias("_rows")).where("_rows > 0")
    long = unpivot_sensors(means.select(fault, *sensors), [fault], sensors)
    normal = long.where(F.col(fault) == 0).select("variable", F.col("value").alias("normal_mean"))
    j = long.where(F.col(fault) > 0).withColumnRenamed("value", "fault_mean").join(normal, "variable")
    dev = F.when(F.col("normal_mean") == 0, F.lit(0.0)).otherwise(
        (F.col("fault_mean") - F.col("normal_mean")) / F.col("normal_mean") * 100.0)
    return j.withColumn("deviation_pct", dev)


def same_sample(a: DataFrame, b: DataFrame, value: str, pos: str = "sample",
                names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Two runs side by side on the sample index (full outer join)."""
    x = a.select(pos, F.col(value).alias(f"{value}_{names[0]}"))
    y = b.select(pos, F.col(value).alias(f"{value}_{names[1]}"))
    j = x.join(y, pos, "full_outer")
    return j.withColumn("diff", F.col(f"{value}_{names[0]}") - F.col(f"{value}_{names[1]}"))
