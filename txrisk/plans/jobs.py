"""The composite jobs: clean, build features, train, train with validation, score a stream."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txrisk.operators import evaluate, features, mlprep, quality, sampling
from txrisk.plans import train
from txrisk.schema import FEATURES, IQR_COLUMNS, LABEL
from txrisk.session import settle
from txrisk.streaming import messages, scoring

SEED = 47


def clean(
    raw: DataFrame,
    iqr_columns: Sequence[str] = IQR_COLUMNS,
    k: float = 1.5,
    mode: str = "sequential",
    exact: bool = False,
    staged: bool = True,
) -> DataFrame:
    """De-duplicate, drop invalid rows, parse dates and drop outliers.

    A date that does not parse is NULL in the result.  ``staged`` writes the valid rows
    once, so that neither the passes for the fences, which then read single Parquet columns, nor
    the result repeat the de-duplication.
    """
    valid = quality.drop_invalid(quality.dedup(raw, ["transaction_id"]))
    if staged:
        valid = settle(valid, "valid")
    inside = quality.within(quality.fences(valid.select(*iqr_columns), iqr_columns, k, mode=mode, exact=exact))
    return quality.parse_datetime(valid.filter(inside))


def build_features(clean_tx: DataFrame, frames_by: str = "rows", hot_rows: int | None = features.HOT_ROWS) -> DataFrame:
    """The feature table of clean transactions, read from where they were written."""
    return features.feature_table(clean_tx, frames_by=frames_by, hot_rows=hot_rows)


@dataclass
class Trained:
    """A fitted pipeline with its parameters and metrics as DataFrames."""

    model: PipelineModel
    params: DataFrame
    metrics: DataFrame
    sweep: DataFrame | None = None


def train_baseline(
    clean_tx: DataFrame,
    grid: list | None = None,
    use_scenario: bool = False,
    parallelism: int = 4,
    run_id: str = "baseline",
) -> Trained:
    """Linear regression on amount and time, tuned over a grid by RMSE.

    Preparation is fitted once and kept; only the regression is fitted per grid
    point.  Class metrics are taken after a cut at 0.5.
    """
    prep = Pipeline(stages=mlprep.scenario_stages(use_scenario)).fit(clean_tx)
    prepared = prep.transform(clean_tx).select(LABEL, "features").persist()
    estimator = train.linear()
    tuned = train.tune_split(
        prepared, estimator, grid or train.linear_grid(estimator), train.rmse_evaluator(), parallelism=parallelism
    )
    model = PipelineModel(stages=[*prep.stages, tuned.bestModel])
    predicted = tuned.bestModel.transform(prepared).withColumn("class", (F.col("prediction") >= 0.5).cast("int"))
    error = F.col("prediction") - F.col(LABEL)
    metrics = predicted.agg(
        F.lit("linear").alias("model"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg((F.col("class") == F.col(LABEL)).cast("double")).alias("accuracy"),
    )
    metrics = settle(evaluate.metric_rows(metrics, run_id, {"rmse": "rmse", "accuracy": "accuracy"}), "metrics")
    prepared.unpersist()
    return Trained(model, train.best_params(clean_tx, tuned.bestModel), metrics)


def train_validated(
    feature_tx: DataFrame,
    fraction: float = 0.1,
    weights: Sequence[float] = (0.8, 0.2),
    previous: PipelineModel | None = None,
    folds: int = 3,
    seed: int = SEED,
    run_id: str = "lrmodel",
) -> Trained:
    """Sample, split, balance the training part, cross-validate, and judge on the held-out part.

    The held-out part is neither balanced nor seen in training.  A previous model,
    if there is one, is judged on the same rows.
    """
    keyed = feature_tx.withColumn("_row", F.xxhash64(*FEATURES.names))
    chosen = sampling.sample(keyed, fraction, seed, key="_row")
    training, held_out = sampling.split(chosen, weights, f"{seed}-split", key="_row")
    # copies of a row share its fold, so no row is judged by a model that has seen a copy of it
    balanced = sampling.oversample(settle(sampling.folds(training, folds, f"{seed}-fold", "_row"), "training"))
    prep = train.prep_pipeline().fit(balanced)
    prepared = prep.transform(balanced).select(LABEL, "features", "fold").persist()
    estimator = train.logistic()
    tuned = train.tune_cv(prepared, estimator, train.logistic_grid(estimator), train.f1_evaluator(), folds, seed=seed, fold_column="fold")
    prepared.unpersist()
    model = PipelineModel(stages=[*prep.stages, tuned.bestModel])

    judged, models = held_out.drop("_row"), {}
    for name, m in {"new": model, "old": previous}.items():
        if m is not None:
            models[name] = (f"score_{name}", f"prediction_{name}")
            judged = _scored(m, judged, *models[name])
    judged = settle(judged.select(LABEL, *[c for pair in models.values() for c in pair]), "judged")
    compared = evaluate.compare_models(judged, models)
    sweep = evaluate.threshold_sweep(evaluate.stack_models(judged, models), by=["model"])
    metrics = evaluate.metric_rows(compared, run_id).unionByName(evaluate.sweep_rows(sweep, run_id))
    return Trained(model, train.best_params(feature_tx, tuned.bestModel), metrics, sweep)


def _scored(model: PipelineModel, df: DataFrame, score: str, prediction: str) -> DataFrame:
    """Add score and prediction of a model, and none of the columns it makes on the way."""
    predicted = evaluate.scores(train.score(model, df), output=score)
    return predicted.select(*df.columns, score, F.col("prediction").alias(prediction))


def score_stream(
    source: DataFrame,
    model: PipelineModel,
    sink_format: str,
    sink_options: dict[str, str],
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Score a stream of messages and answer each, rejects too; restartable from ``checkpoint``.

    Counts of predictions, positives and rejects come with the progress of the query.
    """
    replies = scoring.score_stream(source, model)
    return messages.write_messages(replies, sink_format, sink_options, checkpoint, available_now=available_now)
