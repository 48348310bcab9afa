"""Lead model: train, judge, predict, scale."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldpan.functions.text import logistic_scale


@dataclass(frozen=True)
class LeadModel:
    pipeline: PipelineModel
    features: tuple[str, ...]
    metrics: dict[str, float]


def stratified_split(df: DataFrame, target: str, share: float = 0.2, seed: int = 7) -> DataFrame:
    """Adds ``held_out``: the rows of each class whose hash falls into the lowest ``share``, the same in every run. Nothing is sorted or shuffled."""
    key = F.xxhash64(F.lit(seed), F.col(target), *[F.col(c) for c in df.columns if c != target])
    return df.withColumn("held_out", F.pmod(key, F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))


def train(df: DataFrame, target: str, features: list[str], *, seed: int = 7, held_out: float = 0.2, thresholds: dict[str, float] | None = None) -> LeadModel:
    """Logistic regression on rows without nulls; ROC-AUC, precision and recall at one half on the rows held out.

    Features that are null or constant everywhere aren't used. A metric below its threshold is an error.
    """
    clean = df.select(target, *features).dropna(subset=[target])
    spread = clean.agg(*[F.count_distinct(F.col(f)).alias(f) for f in features]).first()
    used = [f for f in features if spread[f] > 1]
    if not used:
        raise ValueError("no usable feature")
    split = stratified_split(clean.select(F.col(target).cast("double").alias(target), *[F.col(f).cast("double").alias(f) for f in used]).dropna(), target, held_out, seed)
    stages = [VectorAssembler(inputCols=used, outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_features", withMean=True), LogisticRegression(featuresCol="_features", labelCol=target, maxIter=100)]
    model = Pipeline(stages=stages).fit(split.filter(~F.col("held_out")))
    judged = model.transform(split.filter("held_out"))
    counts = judged.agg(F.count_if((F.col("prediction") == 1) & (F.col(target) == 1)).alias("tp"), F.count_if((F.col("prediction") == 1) & (F.col(target) == 0)).alias("fp"), F.count_if((F.col("prediction") == 0) & (F.col(target) == 1)).alias("fn")).first()
    metrics = {
        "roc_auc": BinaryClassificationEvaluator(labelCol=target).evaluate(judged),
        "precision": counts.tp / max(1, counts.tp + counts.fp), "recall": counts.tp / max(1, counts.tp + counts.fn),
    }
    for name, least in (thresholds or {}).items():
        if metrics[name] < least:
            raise ValueError(f"{name} {metrics[name]:.3f} is below {least}")
    return LeadModel(model, tuple(used), metrics)


def predict(model: LeadModel, df: DataFrame) -> DataFrame:
    """Adds ``probability``; nulls count as 0, a missing feature is an error."""
    missing = [f for f in model.features if f not in df.columns]
    if missing:
        raise ValueError(f"missing features: {', '.join(missing)}")
    own = df.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in model.features})
    out = model.pipeline.transform(own.withColumnsRenamed({"probability": "_before"}))
    return out.withColumn("probability", F.least(F.greatest(vector_to_array("probability")[1], F.lit(0.0)), F.lit(1.0))).drop("_raw", "_features", "rawPrediction", "prediction")


def score(model: LeadModel, df: DataFrame) -> DataFrame:
    return predict(model, df).withColumn("lead_score", logistic_scale("probability"))


@dataclass(frozen=True)
class Weights:
    """A model as numbers: standardised features times coefficients, and the intercept."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    coefficients: tuple[float, ...]
    intercept: float


def weights(model: LeadModel) -> Weights:
    _, scaler, regression = model.pipeline.stages
    plain = lambda values: tuple(float(v) for v in values)
    return Weights(model.features, plain(scaler.mean), plain(scaler.std), plain(regression.coefficients), float(regression.intercept))


def weighted(df: DataFrame, w: Weights) -> DataFrame:
    """Adds ``probability`` and ``lead_score`` as plain expressions, so that a stored model scores batches and streams without a pipeline; nulls count as 0."""
    missing = [f for f in w.features if f not in df.columns]
    if missing:
        raise ValueError(f"missing features: {', '.join(missing)}")
    total = F.lit(w.intercept)
    for f, mean, deviation, c in zip(w.features, w.means, w.deviations, w.coefficients):
        total = total + F.lit(c) * ((F.coalesce(F.col(f).cast("double"), F.lit(0.0)) - mean) / deviation if deviation else F.lit(0.0))
    return df.withColumn("probability", 1 / (1 + F.exp(-total))).withColumn("lead_score", logistic_scale("probability"))
