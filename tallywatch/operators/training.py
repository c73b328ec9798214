"""Candidate classifiers on the feature columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.operators.evaluate import class_weights
from tallywatch.operators.features import FEATURE_COLS
from tallywatch.session import shared_folder

LOGISTIC = "logreg_baseline"
BOOSTED = "gradient_boosting"


@dataclass(frozen=True)
class TrainingPlan:
    logistic_iterations: int = 1000
    inverse_penalty: float = 1.0
    boosting_iterations: int = 300
    learning_rate: float = 0.1
    depth: int = 6
    validation_share: float = 0.15
    seed: int = 42


def model_inputs(features: DataFrame) -> DataFrame:
    """Feature columns as doubles without nulls, for training and scoring alike."""
    return features.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURE_COLS}
    )


def score_with(model: PipelineModel):
    """A scorer that adds ``fraud_score``, the probability of fraud."""

    def scorer(features: DataFrame) -> DataFrame:
        scored = model.transform(model_inputs(features))
        return scored.withColumn("fraud_score", vector_to_array("probability")[1])

    return scorer


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURE_COLS, outputCol="raw_features")


def class_counts(train: DataFrame) -> tuple[int, int]:
    counts = train.agg(F.count("*").alias("n"), F.sum("is_fraud").alias("pos")).first()
    if not counts["pos"] or counts["pos"] == counts["n"]:
        raise ValueError("training rows must hold both classes")
    return counts["n"], counts["pos"]


def balanced_weight(rows: int, positives: int) -> Column:
    """Weight of a row that gives both classes the same total."""
    return F.when(F.col("is_fraud") == 1, rows / (2.0 * positives)).otherwise(rows / (2.0 * (rows - positives)))


def logistic_gradient(model: PipelineModel, train: DataFrame) -> DataFrame:
    """Gradient of the penalised, weighted loss at the model's coefficients: a row per input and one for the intercept.

    It is computed from rows, coefficients and the logistic function alone, and is near
    zero where the learner has found the optimum; ``start`` is the gradient of the loss
    at all-zero coefficients, to compare with.
    """
    fitted = model.stages[-1]
    rows, positives = class_counts(train)
    scaled = model_inputs(train).withColumn("weight", balanced_weight(rows, positives))
    for stage in model.stages[:-1]:
        scaled = stage.transform(scaled)
    x = [vector_to_array("features")[i] for i in range(len(FEATURE_COLS))]
    margin = F.lit(float(fitted.intercept))
    for value, beta in zip(x, fitted.coefficients, strict=True):
        margin = margin + value * float(beta)
    label, weight = F.col("is_fraud").cast("double"), F.col("weight")
    error, blank = 1 / (1 + F.exp(-margin)) - label, F.lit(0.5) - label
    terms = [*zip(FEATURE_COLS, x, fitted.coefficients, strict=True), ("intercept", F.lit(1.0), 0.0)]
    found = [
        F.struct(
            F.lit(name).alias("term"),
            (F.sum(weight * error * value) / F.sum(weight) + fitted.getRegParam() * float(beta)).alias("gradient"),
            (F.sum(weight * blank * value) / F.sum(weight)).alias("start"),
        )
        for name, value, beta in terms
    ]
    return scaled.agg(F.array(*found).alias("terms")).select(F.inline("terms"), F.lit(rows).cast("long").alias("train_rows"), F.lit(positives).cast("long").alias("positives"))


def fit_logistic(train: DataFrame, plan: TrainingPlan = TrainingPlan()) -> PipelineModel:
    """Standardised, class-balanced logistic regression.

    Balanced weights sum to the row count, so the penalty per row is 1 / (C n).
    """
    rows, positives = class_counts(train)
    balanced = balanced_weight(rows, positives)
    stages = [
        _assembler(),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(
            labelCol="is_fraud",
            weightCol="weight",
            maxIter=plan.logistic_iterations,
            regParam=1.0 / (plan.inverse_penalty * rows),
            standardization=False,
        ),
    ]
    return Pipeline(stages=stages).fit(model_inputs(train).withColumn("weight", balanced))


def fit_boosted(train: DataFrame, plan: TrainingPlan = TrainingPlan()) -> PipelineModel:
    """Boosted trees with rare positives weighted up and early stopping.

    The validation rows are chosen by a hash of the id, so a recomputed
    partition chooses the same ones.
    """
    shared_folder(train.sparkSession)  # tree lineage is cut at checkpoints
    share = F.pmod(F.xxhash64(F.col("transaction_id"), F.lit(plan.seed)), F.lit(10_000))
    rows = class_weights(model_inputs(train)).withColumn(
        "held_out", share < int(plan.validation_share * 10_000)
    )
    trees = GBTClassifier(
        labelCol="is_fraud",
        featuresCol="raw_features",
        weightCol="weight",
        maxIter=plan.boosting_iterations,
        stepSize=plan.learning_rate,
        maxDepth=plan.depth,
        validationIndicatorCol="held_out",
        seed=plan.seed,
        checkpointInterval=10,
    )
    return Pipeline(stages=[_assembler(), trees]).fit(rows)


def fit_candidates(train: DataFrame, plan: TrainingPlan = TrainingPlan()) -> dict[str, PipelineModel]:
    """Both candidates on the same rows. ``train`` is read many times; give it a table."""
    return {LOGISTIC: fit_logistic(train, plan), BOOSTED: fit_boosted(train, plan)}
