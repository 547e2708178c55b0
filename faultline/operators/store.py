"""Models stored together with the preprocessing they were fitted behind, and the choice of the best one."""
from __future__ import annotations

import json
import os
from collections.abc import Callable, Sequence

from pyspark import keyword_only
from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import models as mo
from .boosting import Boosted
from .forest import Forest
from .quality import fit_preprocessor

ABOUT = "name string, kind string, features array<string>, labels array<string>, metrics string, saved_at timestamp"
OWN = {"boosted": Boosted, "forest": Forest}


class _Sensors(Params):
    sensors = Param(Params._dummy(), "sensors", "columns to impute and scale, in order", typeConverter=TypeConverters.toListString)

    def getSensors(self) -> list[str]:
        return self.getOrDefault(self.sensors)


class PreprocessorModel(Model, _Sensors, DefaultParamsReadable, DefaultParamsWritable):
    """Imputes the sensors with the fitted medians and standardises them in place (J3); other columns pass through."""
    medians = Param(Params._dummy(), "medians", "exact medians", typeConverter=TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "means of the imputed values", typeConverter=TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "population standard deviations, 1 for 0", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, sensors=None, medians=None, means=None, scales=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fitted = zip(self.getSensors(), *(self.getOrDefault(p) for p in (self.medians, self.means, self.scales)), strict=True)
        return df.withColumns({s: (F.coalesce(F.col(s).cast("double"), F.lit(median)) - F.lit(mean)) / F.lit(scale) for s, median, mean, scale in fitted})


class Preprocessor(Estimator, _Sensors, DefaultParamsReadable, DefaultParamsWritable):
    """Fits J1 and J2 (exact medians, mean and population deviation) as a stage of a Spark ML pipeline.

    Without rows every parameter is neutral: median 0, mean 0, scale 1."""

    @keyword_only
    def __init__(self, *, sensors=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PreprocessorModel:
        rows = {r["sensor"]: r for r in fit_preprocessor(df, self.getSensors()).collect()}       # one row a sensor
        column = lambda name, missing: [float(missing if rows[s][name] is None else rows[s][name]) for s in self.getSensors()]
        return PreprocessorModel(sensors=self.getSensors(), medians=column("median", 0), means=column("mean", 0), scales=column("scale", 1))


class Stored:
    """A classifier behind its preprocessing: ``before`` is a pipeline model, ``model`` a further one, boosted trees or a forest."""

    def __init__(self, before: PipelineModel, model: PipelineModel | Boosted | Forest, features: Sequence[str], labels: Sequence[str]):
        self.before, self.model, self.features, self.labels = before, model, list(features), [str(x) for x in labels]

    def score(self, df: DataFrame, out: str = "probs") -> DataFrame:
        """df with the array of probabilities, in the order of ``labels``; the features come out as they went in."""
        kept = {f"raw_{f}": F.col(f) for f in self.features}
        rows = self.before.transform(df.withColumns(kept))
        rows = self.model.score(rows, out).drop("prediction") if isinstance(self.model, Boosted | Forest) else mo.score(self.model, rows, out).drop("features", "rawPrediction", "probability", "prediction")
        return rows.withColumns({f: F.col(f"raw_{f}") for f in self.features}).drop(*kept)

    def predicted(self, probs: str = "probs") -> F.Column:
        """The label with the largest probability (the first of equal ones)."""
        return F.element_at(F.array(*[F.lit(x) for x in self.labels]), F.array_position(probs, F.array_max(probs)).cast("int"))


def fit_behind_preprocessor(train: DataFrame, features: Sequence[str], labels: Sequence[str], fit: Callable[[DataFrame], PipelineModel | Boosted | Forest]) -> Stored:
    """Fit the preprocessing on ``train``, then ``fit`` on what comes out of it."""
    before = PipelineModel([Preprocessor(sensors=list(features)).fit(train)])
    return Stored(before, fit(before.transform(train)), features, labels)


def save(spark: SparkSession, root: str, name: str, stored: Stored, metrics: dict[str, float]) -> None:
    """Preprocessing, classifier and, last, a row that says what they are: without it a model counts as absent."""
    path = os.path.join(root, name)
    stored.before.write().overwrite().save(os.path.join(path, "before"))
    if isinstance(stored.model, Boosted | Forest):
        stored.model.save(spark, os.path.join(path, "model"))
    else:
        stored.model.write().overwrite().save(os.path.join(path, "model"))
    kind = next((kind for kind, of in OWN.items() if isinstance(stored.model, of)), "pipeline")
    about = spark.createDataFrame([(name, kind, stored.features, stored.labels, json.dumps(metrics))], ABOUT.removesuffix(", saved_at timestamp"))
    about.withColumn("saved_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").json(os.path.join(path, "about"))


def load(spark: SparkSession, root: str, name: str) -> tuple[Stored, dict[str, float]]:
    """A stored model and its metrics; ValueError where there is none of that name."""
    path = os.path.join(root, name)
    try:
        about = spark.read.schema(ABOUT).json(os.path.join(path, "about")).first()
    except AnalysisException:
        about = None
    if about is None:
        raise ValueError(f"no stored model {name} under {root}")
    part = os.path.join(path, "model")
    model = OWN[about["kind"]].load(spark, part) if about["kind"] in OWN else PipelineModel.load(part)
    return Stored(PipelineModel.load(os.path.join(path, "before")), model, about["features"], about["labels"]), json.loads(about["metrics"])


def load_best(spark: SparkSession, root: str, metric: str = "macro_f1") -> tuple[str, Stored]:
    """The stored model with the highest ``metric`` (models without it last, of equal ones the first name)."""
    try:
        rows = spark.read.schema(ABOUT).json(os.path.join(root, "*", "about")).select("name", F.get_json_object("metrics", f"$.{metric}").cast("double").alias("value"))
    except AnalysisException:
        raise ValueError(f"no stored model under {root}") from None
    best = rows.orderBy(F.col("value").desc_nulls_last(), "name").first()
    if best is None:
        raise ValueError(f"no stored model under {root}")
    return best["name"], load(spark, root, best["name"])[0]


def report_metrics(report: DataFrame, by: str = "model") -> dict[str, dict[str, float]]:
    """Accuracy and macro averages of each model, from a classification report by model (a row a model)."""
    of = lambda label, value: F.max(F.when(F.col("label") == label, F.col(value)))
    rows = report.groupBy(by).agg(of("accuracy", "f1").alias("accuracy"), of("macro avg", "recall").alias("macro_recall"), of("macro avg", "f1").alias("macro_f1")).collect()
    return {r[by]: {k: r[k] for k in ("accuracy", "macro_recall", "macro_f1")} for r in rows}
