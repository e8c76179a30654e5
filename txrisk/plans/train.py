"""Pipelines, tuning and scoring with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame

from txrisk.operators import evaluate, mlprep
from txrisk.schema import LABEL, MESSAGE_FIELDS

#: grid of the linear model (fixed values)
REG_PARAMS = (0.001, 0.01, 0.1, 1.0, 10.0)
ELASTIC_NET_PARAMS = (0.0, 0.25, 0.5, 0.75, 1.0)


def linear(label: str = LABEL) -> LinearRegression:
    return LinearRegression(featuresCol="features", labelCol=label)


def linear_pipeline(
    use_scenario: bool = False, label: str = LABEL, columns: Sequence[str] = mlprep.BASELINE_COLUMNS
) -> Pipeline:
    """Amount and time (optionally the encoded scenario), assembled, and a linear regression."""
    return Pipeline(stages=[*mlprep.scenario_stages(use_scenario, columns), linear(label)])


def prep_pipeline(columns: Sequence[str] = MESSAGE_FIELDS) -> Pipeline:
    """Assemble and scale, unfitted; the scaler is saved with the model that uses it."""
    return Pipeline(stages=[mlprep.assembler(columns), mlprep.scaler()])


def logistic(label: str = LABEL, features: str = "features", max_iter: int = 10) -> LogisticRegression:
    return LogisticRegression(maxIter=max_iter, featuresCol=features, labelCol=label)


def logistic_pipeline(label: str = LABEL, max_iter: int = 10) -> Pipeline:
    """Assemble, scale and logistic regression, as one pipeline to save and serve."""
    return Pipeline(stages=[mlprep.assembler(), mlprep.scaler(), logistic(label, max_iter=max_iter)])


def linear_grid(
    estimator: LinearRegression,
    reg: Sequence[float] = REG_PARAMS,
    elastic: Sequence[float] = ELASTIC_NET_PARAMS,
    intercept: Sequence[bool] = (True, False),
) -> list:
    return (
        ParamGridBuilder()
        .addGrid(estimator.fitIntercept, list(intercept))
        .addGrid(estimator.regParam, list(reg))
        .addGrid(estimator.elasticNetParam, list(elastic))
        .build()
    )


def logistic_grid(estimator: LogisticRegression, n_reg: int = 1, n_elastic: int = 1) -> list:
    """Evenly spaced values in 0..1 for either penalty."""
    return (
        ParamGridBuilder()
        .addGrid(estimator.regParam, evaluate.thresholds(n_reg))
        .addGrid(estimator.elasticNetParam, evaluate.thresholds(n_elastic))
        .build()
    )


def f1_evaluator(label: str = LABEL) -> Evaluator:
    """Class F1 weighted by class frequency."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="f1")


def accuracy_evaluator(label: str = LABEL) -> Evaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy")


def rmse_evaluator(label: str = LABEL) -> Evaluator:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")


def tune_split(
    data: DataFrame, estimator, grid: list, evaluator: Evaluator, train_ratio: float = 0.8, parallelism: int = 4, seed: int = 47
):
    """The best model of a grid by one train/validation split."""
    tuning = TrainValidationSplit(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=evaluator,
        trainRatio=train_ratio,
        parallelism=parallelism,
        seed=seed,
    )
    return tuning.fit(data)


def tune_cv(
    data: DataFrame, estimator, grid: list, evaluator: Evaluator, folds: int = 3, parallelism: int = 1, seed: int = 47, fold_column: str = ""
):
    """The best model of a grid by cross-validation.

    With ``fold_column`` (numbers from 0 to ``folds - 1``, as :func:`txrisk.operators.sampling.folds` gives) the folds do not depend on
    the layout; without, Spark draws them per partition.
    """
    tuning = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=evaluator,
        numFolds=folds,
        parallelism=parallelism,
        seed=seed,
        foldCol=fold_column,
    )
    return tuning.fit(data)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Apply a model, to a table or to a stream."""
    return model.transform(df)


def best_params(df: DataFrame, model, names: Sequence[str] = ("regParam", "elasticNetParam", "fitIntercept")) -> DataFrame:
    """Parameters of the last stage of a fitted model, as rows ``(param, value)``; names begin with ``optimal_`` (fixed)."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    rows = [(f"optimal_{n}", str(last.getOrDefault(n))) for n in names if last.hasParam(n)]
    return df.sparkSession.createDataFrame(rows, "param string, value string")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
