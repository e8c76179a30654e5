"""Evaluation of binary predictions: counts, ratios, curves, sweeps and model comparison.

All metrics are aggregates over a table of labels, scores and predictions; none of
them brings rows to the driver.  ``by`` columns (a model name, a run) give one
result per group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import exp, factorial
from operator import add

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions import ratio
from txrisk.operators.ordered import running_totals
from txrisk.schema import LABEL
from txrisk.session import settle

#: goals a model must meet (fixed values)
MIN_RECALL = 0.98
MAX_FALSE_ALARMS = 0.05

#: names metrics are logged under (fixed values)
METRIC_NAMES = {"f1": "avg_F1_Score", "roc_auc": "avg_ROC_AUC"}
SWEEP_NAMES = {"precision": "avg_Precision_Threshold_%.2f", "recall": "avg_Recall_Threshold_%.2f"}


def thresholds(n: int = 10) -> list[float]:
    """``n`` evenly spaced thresholds from 0 to 1."""
    return [i / (n - 1) for i in range(n)] if n > 1 else [0.0]


def scores(df: DataFrame, kind: str = "probability", output: str = "score") -> DataFrame:
    """Add the score of the positive class of a Spark ML classifier.

    ``kind="probability"`` lies in 0..1, as thresholds do; ``kind="raw"`` is the margin.
    """
    vector = {"probability": "probability", "raw": "rawPrediction"}[kind]
    return df.withColumn(output, vector_to_array(vector)[1].cast("double"))


# -- counts and ratios --------------------------------------------------------


def confusion(df: DataFrame, label: str = LABEL, prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """``tp, fp, fn, tn`` in one pass."""

    def cell(a: int, b: int) -> Column:
        return F.count_if((F.col(label) == a) & (F.col(prediction) == b))

    return df.groupBy(*by).agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn")
    )


def prf(counts: DataFrame) -> DataFrame:
    """Add precision, recall and F1 of the positive class; 0 where undefined."""
    return counts.withColumns(
        {"precision": ratio("tp", F.col("tp") + F.col("fp")), "recall": ratio("tp", F.col("tp") + F.col("fn"))}
    ).withColumn(
        "f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )


def accuracy(df: DataFrame, label: str = LABEL, prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    same = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    return df.groupBy(*by).agg(F.avg(same).alias("accuracy"))


def weighted_f1(df: DataFrame, label: str = LABEL, prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """F1 of each class, weighted by how often the class occurs.

    Rows are first counted per (label, prediction), so what follows is tiny.
    """
    cells = df.groupBy(*by, F.col(label).alias("_label"), F.col(prediction).cast("int").alias("_pred")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    sides = F.array(F.struct(F.col("_label").alias("c"), F.lit(1).alias("s")), F.struct(F.col("_pred").alias("c"), F.lit(0).alias("s")))
    per_class = (
        cells.withColumn("_side", F.explode(sides))
        .groupBy(*by, F.col("_side.c").alias("_class"))
        .agg(
            F.sum(F.when((F.col("_side.s") == 1) & (F.col("_label") == F.col("_pred")), F.col("_n")).otherwise(0)).alias("_hit"),
            F.sum(F.when(F.col("_side.s") == 1, F.col("_n")).otherwise(0)).alias("_actual"),
            F.sum("_n").alias("_both"),
        )
    )
    # f1 = 2 tp / (2 tp + fp + fn), and actual + predicted = 2 tp + fp + fn
    f1 = ratio(2 * F.col("_hit"), "_both")
    return per_class.groupBy(*by).agg(
        ratio(F.sum(F.col("_actual") * f1), F.sum("_actual")).alias("weighted_f1")
    )


def meets_goals(
    counts: DataFrame, min_recall: float = MIN_RECALL, max_false_alarms: float = MAX_FALSE_ALARMS
) -> DataFrame:
    """Add recall, the share of correct transactions flagged, and whether both goals are met."""
    return counts.withColumns(
        {
            "recall": ratio("tp", F.col("tp") + F.col("fn")),
            "false_alarm_rate": ratio("fp", F.col("fp") + F.col("tn")),
        }
    ).withColumn(
        "meets_goals", (F.col("recall") >= min_recall) & (F.col("false_alarm_rate") <= max_false_alarms)
    )


# -- curves -------------------------------------------------------------------


def score_steps(df: DataFrame, label: str = LABEL, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score, from high to low: its positives and negatives, and those at or above it.

    Rows ``(by, score, pos, neg, tp, fp)``.  Equal scores are added up before the
    shuffle, so a score that most rows share costs one row per task.
    """
    grouped = df.filter(F.col(score).isNotNull()).groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    steps = running_totals(grouped, by, -F.col("score"), ["pos", "neg"])
    return steps.withColumnsRenamed({"pos_upto": "tp", "neg_upto": "fp"})


def _auc_of_steps(steps: DataFrame, by: Sequence[str]) -> DataFrame:
    above = F.col("tp") - F.col("pos")
    area = F.sum(F.col("neg").cast("double") * (above + F.col("pos") / 2.0))
    return steps.groupBy(*by).agg(
        F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("roc_auc")
    )


def roc_auc(df: DataFrame, label: str = LABEL, score: str = "score", by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """Area under the ROC curve; NULL if a class is missing.

    The exact form counts, per score, the negatives at it against the positives
    above it, ties as one half.  ``exact=False`` is Spark ML's estimate from
    1000 bins, for a table with one group.
    """
    if not exact:
        if by:
            raise ValueError("the estimate takes one group; filter first")
        value = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score).evaluate(
            df.withColumn(score, F.col(score).cast("double"))
        )
        return df.sparkSession.createDataFrame([(value,)], "roc_auc double")
    return _auc_of_steps(score_steps(df, label, score, by), by)


def pr_curve(df: DataFrame, label: str = LABEL, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall when everything at or above a score is flagged, per distinct score."""
    return _pr_of_steps(score_steps(df, label, score, by), by)


def _pr_of_steps(steps: DataFrame, by: Sequence[str]) -> DataFrame:
    totals = steps.groupBy(*by).agg(F.sum("pos").alias("_positives"))
    if by:
        named = totals.withColumnsRenamed({c: f"_total_{c}" for c in by})
        for i, c in enumerate(by):
            match = F.col(c).eqNullSafe(F.col(f"_total_{c}"))
            condition = match if i == 0 else condition & match
        steps = steps.join(named, condition).drop(*[f"_total_{c}" for c in by])
    else:
        steps = steps.withColumn("_positives", totals.scalar())
    return steps.withColumns(
        {"precision": ratio("tp", F.col("tp") + F.col("fp")), "recall": ratio("tp", "_positives")}
    ).drop("_positives")


def pr_auc(df: DataFrame, label: str = LABEL, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Area under the precision-recall curve by trapezoids, from recall 0 at the first precision."""
    curve = pr_curve(df, label, score, by)
    # the point before a step follows from the step itself; the first has none before it
    tp, fp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    first = (tp + fp) == 0
    before = F.when(first, F.col("precision")).otherwise(ratio(tp, tp + fp))
    width = F.when(F.col("tp") > 0, F.col("recall") * F.col("pos") / F.col("tp")).otherwise(0.0)
    return curve.groupBy(*by).agg(F.sum(width * (F.col("precision") + before) / 2).alias("pr_auc"))


def threshold_sweep(
    df: DataFrame,
    at: Sequence[float] | None = None,
    label: str = LABEL,
    score: str = "score",
    by: Sequence[str] = (),
) -> DataFrame:
    """Counts, precision and recall when ``score >= threshold`` is flagged, per threshold.

    Each row is counted once, under the number of thresholds it reaches; a
    threshold's counts are the totals from there up, over a table as long as the
    list of thresholds.
    """
    at = sorted(thresholds() if at is None else at)
    reached = sum(((F.col(score) >= t).cast("int") for t in at), F.lit(0))
    cells = (
        df.filter(F.col(score).isNotNull())
        .groupBy(*by, reached.alias("_reached"))
        .agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))
    )
    if not by:  # a table without rows has a row per threshold too
        none = [F.lit(0).alias(c) for c in ("_reached", "_pos", "_neg")]
        cells = cells.unionByName(df.sparkSession.range(1).select(*none))
    grid = F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(t).alias("t")) for i, t in enumerate(at)])
    flagged = F.col("_reached") >= F.col("_at.i")
    counts = (
        cells.withColumn("_at", F.explode(grid))
        .groupBy(*by, F.col("_at.t").alias("threshold"))
        .agg(
            F.sum(F.when(flagged, F.col("_pos")).otherwise(0)).alias("tp"),
            F.sum(F.when(flagged, F.col("_neg")).otherwise(0)).alias("fp"),
            F.sum(F.when(flagged, 0).otherwise(F.col("_pos"))).alias("fn"),
        )
    )
    return prf(counts).drop("f1")


# -- comparing models ---------------------------------------------------------


def stack_models(df: DataFrame, models: Mapping[str, tuple[str, str]], label: str = LABEL) -> DataFrame:
    """One row ``(model, label, score, prediction)`` per row and model.

    ``models`` maps a model name to its score and prediction columns.
    """
    sides = [
        F.struct(
            F.lit(name).alias("model"),
            F.col(score).cast("double").alias("score"),
            F.col(prediction).cast("int").alias("prediction"),
        )
        for name, (score, prediction) in models.items()
    ]
    return df.select(label, F.inline(F.array(*sides))).select("model", label, "score", "prediction")


def join_predictions(
    new: DataFrame, old: DataFrame, key: str = "transaction_id", columns: Sequence[str] = ("score", "prediction")
) -> DataFrame:
    """Put the scores of a model that was applied separately next to another's, by key."""
    renamed = old.select(key, *[F.col(c).alias(f"{c}_old") for c in columns])
    return new.join(renamed, key)


def compare_models(df: DataFrame, models: Mapping[str, tuple[str, str]], label: str = LABEL) -> DataFrame:
    """Counts, precision, recall, F1 and ROC AUC, one row per model.

    One confusion aggregation and one curve serve all models.
    """
    long = stack_models(df, models, label)
    counts = prf(confusion(long, label, by=["model"]))
    return counts.join(roc_auc(long, label, by=["model"]), "model")


def metric_rows(metrics: DataFrame, run_id: str, names: Mapping[str, str] | None = None, model: str = "model") -> DataFrame:
    """Metrics of one run in long form: ``(run_id, model, metric, value)``.

    ``names`` maps metric columns to the names they are logged under.
    """
    names = (names or METRIC_NAMES).items()
    values = [F.struct(F.lit(n).alias("metric"), F.col(c).cast("double").alias("value")) for c, n in names]
    return metrics.select(F.lit(run_id).alias("run_id"), model, F.inline(F.array(*values)))


def sweep_rows(sweep: DataFrame, run_id: str, model: str = "model") -> DataFrame:
    """A threshold sweep in long form, as ``avg_Precision_Threshold_0.11`` and so on."""
    values = [
        F.struct(F.format_string(name, "threshold").alias("metric"), F.col(c).alias("value"))
        for c, name in SWEEP_NAMES.items()
    ]
    return sweep.select(F.lit(run_id).alias("run_id"), model, F.inline(F.array(*values)))


#: chances of at most 0, 1, ... copies of a row in a repeat drawn with replacement (Poisson with mean 1), of 2**60
_AT_MOST = [round(sum(exp(-1) / factorial(i) for i in range(k + 1)) * 2**60) for k in range(12)]


def bootstrap(
    df: DataFrame, models: Mapping[str, tuple[str, str]], key: str, reps: int = 100, seed: int | str = 47, label: str = LABEL, level: float = 0.95
) -> DataFrame:
    """Precision, recall and F1 over repeats drawn with replacement: ``(model, metric, mean, low, high)``.

    How often a row is in a repeat follows from the hash of its key and the repeat's number, so all repeats and models are one
    pass, on any layout, and the models are judged on the same draws: rows ``a - b`` hold the interval of the
    paired difference of two models.  A row is hashed once per repeat, and what leaves a task is one row per repeat.
    """
    cells = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    named = list(enumerate(models.items()))
    says = [F.col(prediction).cast("int").alias(f"said{i}") for i, (_, (_, prediction)) in named]
    repeats = df.select(F.col(key).alias("key"), F.col(label).alias("label"), *says, F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("rep"))
    # a column of its own, so a draw is hashed once and not once per comparison
    drawn = repeats.withColumn("chance", _chance("key", seed, F.col("rep"))).withColumn("w", _times("chance"))

    def cell(i: int, a: int, b: int) -> Column:
        return F.sum(F.when((F.col("label") == a) & (F.col(f"said{i}") == b), F.col("w")).otherwise(0))

    wide = drawn.groupBy("rep").agg(*[cell(i, a, b).alias(f"{c}{i}") for i, _ in named for c, (a, b) in cells.items()])
    sides = [F.struct(F.lit(name).alias("model"), *[F.col(f"{c}{i}").alias(c) for c in cells]) for i, (name, _) in named]
    counts = wide.select("rep", F.inline(F.array(*sides)))
    names = ("precision", "recall", "f1")
    values = prf(counts).select("rep", "model", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in names])))
    values = settle(values, "repeats")
    first, second = (values.select("rep", "metric", F.col("model").alias(f"{s}_model"), F.col("value").alias(s)) for s in ("a", "b"))
    order = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("a_model")) < F.array_position(F.array(*[F.lit(m) for m in models]), F.col("b_model"))
    pairs = first.join(second, ["rep", "metric"]).filter(order)
    paired = pairs.select("rep", F.concat("a_model", F.lit(" - "), "b_model").alias("model"), "metric", (F.col("a") - F.col("b")).alias("value"))
    tail = (1 - level) / 2
    return values.unionByName(paired).groupBy("model", "metric").agg(
        F.avg("value").alias("mean"),
        F.expr(f"percentile_disc({tail}) WITHIN GROUP (ORDER BY value)").alias("low"),
        F.expr(f"percentile_disc({1 - tail}) WITHIN GROUP (ORDER BY value)").alias("high"),
    )


def _chance(key: str, seed: int | str, rep: Column) -> Column:
    """The draw of a row in a repeat, of 2**60."""
    head = F.substring(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)), rep.cast("string"))), 1, 15)
    return F.conv(head, 16, 10).cast("long")


def _times(chance: str) -> Column:
    """How often a row is in a repeat, by its draw."""
    return reduce(add, [(F.col(chance) >= k).cast("int") for k in _AT_MOST])


def average_runs(rows: DataFrame) -> DataFrame:
    """Mean of every metric over the repeats in a long metric table."""
    return rows.groupBy("model", "metric").agg(F.avg("value").alias("value"))


def log_metrics(rows: DataFrame, path: str) -> None:
    """Append the metric rows of a run to the log at ``path``, with the time of logging."""
    rows.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


def latest_run(log: DataFrame) -> DataFrame:
    """The rows of the run that was logged last, per model; of runs logged at one moment the larger id."""
    newest = log.groupBy("model").agg(F.max(F.struct("logged_at", "run_id")).alias("_newest"))
    newest = newest.select("model", F.col("_newest.run_id").alias("run_id"))
    return log.join(newest, ["model", "run_id"], "left_semi").drop("logged_at")
