"""Typed ingest (A1), build-once cache (A2), key-filtered scans (A4) and report sinks."""
from __future__ import annotations

import json
import logging
import os
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.constants import SENSOR_COLUMNS

META = {"faultNumber": "smallint", "simulationRun": "int", "sample": "int"}
MANIFEST = "cached_split string, build string, built_at timestamp, n_files long, bytes long, newest timestamp, digest decimal(38,0), columns string"


def _read_raw(spark: SparkSession, csv_path: str) -> DataFrame:
    """CSV as text (no schema inference), column names stripped."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(csv_path)
    return raw.toDF(*[c.strip() for c in raw.columns])


def _parsed(raw: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """The typed columns, and unread: the names of columns whose text isn't a value of their type.

    A missing sensor reading (empty, or NaN) is null and no error; a missing key of a row is one."""
    present = [s for s in sensors if s in raw.columns]
    keys = [F.col(c).try_cast(t).alias(c) for c, t in META.items()]
    values = [F.nanvl(F.col(s).try_cast("float"), F.lit(None).cast("float")).alias(s) for s in present]
    bad = [F.when(F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in META.items()]
    bad += [F.when(F.col(s).try_cast("float").isNull() & (F.trim(s) != ""), F.lit(s)) for s in present]
    return raw.select(*keys, *values, F.array_compact(F.array(*bad)).alias("unread"))


def _usable() -> F.Column:
    return ~F.arrays_overlap("unread", F.array(*[F.lit(c) for c in META]))


def rejected_values(spark: SparkSession, csv_path: str, sensors: Sequence[str] = SENSOR_COLUMNS) -> DataFrame:
    """One row for each column with text that couldn't be read: column, n_values, n_rows_dropped.

    A row without a readable fault, run or sample is dropped by the ingest; a sensor reading becomes null."""
    rows = _parsed(_read_raw(spark, csv_path), sensors)
    return (rows.select(F.explode("unread").alias("column"), (~_usable()).cast("long").alias("dropped"))
            .groupBy("column").agg(F.count(F.lit(1)).alias("n_values"), F.sum("dropped").alias("n_rows_dropped")))


def write_runs(typed: DataFrame, path: str, parts: Sequence[str] = ("faultNumber",), mode: str = "errorifexists") -> None:
    """Columnar copy partitioned by ``parts`` and clustered by run.

    Rows are dealt out by ranges of (parts, run, sample), so that a run of any size is split, every file holds
    few runs, and filters on the fault skip folders and those on the run skip row groups."""
    order = [*parts, "simulationRun", "sample"]
    typed.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).partitionBy(*parts).parquet(path)


def typed_ingest(spark: SparkSession, csv_path: str, out_path: str, sensors: Sequence[str] = SENSOR_COLUMNS,
                 split: str | None = None, mode: str = "errorifexists") -> DataFrame:
    """A1: read CSV (everything as text), strip the column names, cast meta to int16/int32 and
    sensors to float32 (NaN -> null), and write a columnar copy partitioned by split and fault.

    One malformed value doesn't fail the ingest: see :func:`rejected_values`."""
    typed = _parsed(_read_raw(spark, csv_path), sensors).where(_usable()).drop("unread")
    parts = ["faultNumber"]
    if split is not None:
        typed, parts = typed.withColumn("split", F.lit(split)), ["split", *parts]
    write_runs(typed, out_path, parts, mode)
    return spark.read.schema(typed.schema).parquet(out_path)


def source_version(spark: SparkSession, path: str) -> tuple | None:
    """(files, bytes, newest time, digest of all names, sizes and times) of a source; None where there is none.

    Only the listing is read, not the contents; one aggregated row comes back."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
        one = files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime"),
                        F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")).cast("decimal(38,0)")).first()
    except AnalysisException:
        return None
    return tuple(one) if one[0] else None


def _latest_builds(spark: SparkSession, out_path: str) -> dict:
    """The manifest's last row for each split (a split has one row a build)."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(os.path.join(out_path, "manifest"))
    except AnalysisException:
        return {}
    last = rows.groupBy("cached_split").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "cached_split"]), F.struct("built_at", "build")).alias("last"))
    return {r["cached_split"]: r["last"] for r in last.collect()}


def cached_ingest(spark: SparkSession, sources: dict[str, str], out_path: str, force: bool = False,
                  sensors: Sequence[str] = SENSOR_COLUMNS) -> DataFrame | None:
    """A2: typed, partitioned copies of ``sources`` ({split: CSV path}), built once.

    A split is built again if its files (names, sizes, times) or the wanted columns differ from those of its
    last build, or with ``force``.  Every build has a folder of its own and counts only from the moment its
    row of the manifest is written, after the data: what a killed build leaves is never read, and readers of the
    last build aren't disturbed.  A source that doesn't exist is skipped with a warning; if it was built before,
    that copy is used.  None if no split has a copy."""
    known = _latest_builds(spark, out_path)
    for split, path in sources.items():
        version = source_version(spark, path)
        if version is None:
            logging.getLogger(__name__).warning("skipping missing source %s", path)
            continue
        raw = _read_raw(spark, path)
        typed = _parsed(raw, sensors).where(_usable()).drop("unread")
        columns = typed.schema.json()
        last = known.get(split)
        if force or last is None or (last["n_files"], last["bytes"], last["newest"], last["digest"], last["columns"]) != (*version, columns):
            build = uuid.uuid4().hex
            write_runs(typed, os.path.join(out_path, "data", f"build={build}", f"split={split}"))
            row = spark.range(1).select(F.lit(split).alias("cached_split"), F.lit(build).alias("build"), F.current_timestamp().alias("built_at"),
                                        F.lit(version[0]).cast("long").alias("n_files"), F.lit(version[1]).cast("long").alias("bytes"),
                                        F.lit(version[2]).alias("newest"), F.lit(version[3]).cast("decimal(38,0)").alias("digest"), F.lit(columns).alias("columns"))
            row.coalesce(1).write.mode("append").parquet(os.path.join(out_path, "manifest"))
    parts = [spark.read.schema(StructType.fromJson(json.loads(last["columns"])))
             .parquet(os.path.join(out_path, "data", f"build={last['build']}", f"split={split}")).withColumn("split", F.lit(split))
             for split, last in _latest_builds(spark, out_path).items() if split in sources]
    if not parts:
        return None
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    return whole


def scan_keys(stored_runs: DataFrame, keys: DataFrame) -> DataFrame:
    """A4: the rows of ``stored_runs`` (see :func:`write_runs`) whose fault and run are in ``keys``.

    The fault is the partition column, so that a filtered ``keys`` table prunes folders at run time; Spark
    broadcasts it only if its size allows, and else may filter by a bloom filter before the shuffle."""
    return stored_runs.join(keys.select("faultNumber", "simulationRun").distinct(), ["faultNumber", "simulationRun"], "left_semi")


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Tabular report sink (parquet, csv or json)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def metrics_manifest(report: DataFrame, best_by: str = "macro_f1") -> DataFrame:
    """One row a ``model`` of the report: summary (accuracy, macro and weighted F1), per-class metrics
    rounded to 4 dp (a list bounded by the class count), and best_model, the name of the one with the
    highest ``best_by`` (the first name of equal ones)."""
    per_class = ~F.col("label").isin("accuracy", "macro avg", "weighted avg")
    cls = F.struct("label", F.round("precision", 4).alias("precision"), F.round("recall", 4).alias("recall"),
                   F.round("f1", 4).alias("f1"), "support")
    of = lambda label: F.max(F.when(F.col("label") == label, F.col("f1")))
    models = report.groupBy("model").agg(
        of("accuracy").alias("accuracy"), of("macro avg").alias("macro_f1"), of("weighted avg").alias("weighted_f1"),
        F.array_sort(F.collect_list(F.when(per_class, cls))).alias("per_class"))
    best = F.first("model").over(Window.orderBy(F.col(best_by).desc(), "model"))              # a row a model
    return models.withColumn("best_model", best).withColumns({c: F.round(c, 4) for c in ("accuracy", "macro_f1", "weighted_f1")})


def dashboard_bundle(defaults: dict, artefacts: DataFrame, zero_is_missing: Sequence[str] = ()) -> DataFrame:
    """One-row bundle; every value present in ``artefacts`` overrides its default (None: none),
    and a zero metric of ``zero_is_missing`` counts as missing."""
    cols = []
    for c, v in defaults.items():
        a = F.nullif(F.col(c), F.lit(0)) if c in zero_is_missing else F.col(c)
        cols.append((a if v is None else F.coalesce(a, F.lit(v))).alias(c))
    return artefacts.select(*cols)
