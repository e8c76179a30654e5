import hashlib

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from txrisk import evaluate, mlprep
from txrisk.sources import scored, transactions


def frame(spark, rows):
    return spark.createDataFrame(rows, "tx_fraud int, score double, prediction int")


def counts(spark, tp, fp, fn, tn=1):
    return spark.createDataFrame([(tp, fp, fn, tn)], "tp long, fp long, fn long, tn long")


@pytest.mark.parametrize(
    "cells,want", [((0, 2, 3), (0, 0, 0)), ((4, 0, 4), (1, 0.5, 2 / 3)), ((4, 4, 0), (0.5, 1, 2 / 3)), ((0, 0, 0), (0, 0, 0))]
)
def test_ratios(spark, cells, want):
    got = evaluate.prf(counts(spark, *cells)).select("precision", "recall", "f1").first()
    assert tuple(got) == pytest.approx(want)


def test_ties_count_half(spark):
    tied = frame(spark, [(1, 0.5, 1), (0, 0.5, 1)])
    assert evaluate.roc_auc(tied).first()[0] == 0.5
    mixed = frame(spark, [(1, 0.9, 1), (0, 0.5, 1), (1, 0.5, 1), (0, 0.1, 0)])
    assert evaluate.roc_auc(mixed).first()[0] == 0.875
    one_class = frame(spark, [(1, 0.9, 1), (1, 0.5, 1)])
    assert evaluate.roc_auc(one_class).first()[0] is None


def test_agrees_with_spark_ml(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("prediction", F.col("prediction").cast("double"))

    def binary(metric):
        e = BinaryClassificationEvaluator(labelCol="tx_fraud", rawPredictionCol="score", metricName=metric, numBins=0)
        return e.evaluate(df)

    def multi(metric):
        e = MulticlassClassificationEvaluator(labelCol="tx_fraud", predictionCol="prediction", metricName=metric)
        return e.evaluate(df)

    assert evaluate.roc_auc(df).first()[0] == pytest.approx(binary("areaUnderROC"), abs=1e-12)
    assert evaluate.pr_auc(df).first()[0] == pytest.approx(binary("areaUnderPR"), abs=1e-12)
    assert evaluate.accuracy(df).first()[0] == pytest.approx(multi("accuracy"), abs=1e-12)
    assert evaluate.weighted_f1(df).first()[0] == pytest.approx(multi("f1"), abs=1e-12)
    assert evaluate.roc_auc(df, exact=False).first()[0] == pytest.approx(binary("areaUnderROC"), abs=1e-2)


def test_curve_per_group_equals_curve_of_group(spark, sf_dir):
    long = evaluate.stack_models(scored(spark, sf_dir), {"new": ("score", "prediction"), "old": ("score_old", "prediction_old")})
    whole = {r.model: r.pr_auc for r in evaluate.pr_auc(long, by=["model"]).collect()}
    for m in ("new", "old"):
        assert whole[m] == pytest.approx(evaluate.pr_auc(long.filter(F.col("model") == m)).first()[0], abs=1e-12)
    total = evaluate.score_steps(long, by=["model"]).groupBy("model").agg(F.max("tp"), F.max("fp"), F.sum("pos"), F.sum("neg"))
    for r in total.collect():
        assert (r[1], r[2]) == (r[3], r[4])


def test_curve_never_gathers_all_rows(spark, sf_dir):
    plan = evaluate.score_steps(scored(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert any("_part" in w.split("windowspecdefinition(")[1][:12] for w in windows)


def test_sweep(spark):
    df = frame(spark, [(1, 0.0, 0), (0, 0.5, 0), (1, 1.0, 1), (0, None, 0)])
    got = {r.threshold: (r.tp, r.fp, r.fn) for r in evaluate.threshold_sweep(df, [0.0, 0.5, 1.0, 2.0]).collect()}
    assert got == {0.0: (2, 1, 0), 0.5: (1, 1, 1), 1.0: (1, 0, 1), 2.0: (0, 0, 2)}
    assert evaluate.thresholds(10)[3] == pytest.approx(1 / 3)


def test_goals(spark):
    assert evaluate.meets_goals(counts(spark, 98, 5, 2, 95)).first()["meets_goals"]
    assert not evaluate.meets_goals(counts(spark, 97, 5, 3, 95)).first()["meets_goals"]
    assert not evaluate.meets_goals(counts(spark, 98, 6, 2, 94)).first()["meets_goals"]


def test_metric_names(spark):
    sweep = evaluate.threshold_sweep(frame(spark, [(1, 0.4, 0), (0, 0.2, 0)])).withColumn("model", F.lit("new"))
    names = {r.metric for r in evaluate.sweep_rows(sweep, "r").collect()}
    assert len(names) == 20 and "avg_Precision_Threshold_0.11" in names and "avg_Recall_Threshold_1.00" in names


def test_constant_column_scales_to_half(spark):
    df = spark.createDataFrame([(1.0, 3), (1.0, 5)], "a double, b int")
    assert [tuple(r) for r in mlprep.minmax_scale(df, ["a", "b"]).select("a_scaled", "b_scaled").collect()] == [(0.5, 0.0), (0.5, 1.0)]


def test_scaling_agrees_with_spark_ml(spark, sf_dir):
    columns = ["tx_amount", "tx_time_seconds"]
    df = transactions(spark, sf_dir)
    vectors = mlprep.assembler(columns).transform(df)
    fitted = mlprep.scaler().fit(vectors).transform(vectors)
    ours = mlprep.minmax_scale(fitted, columns)
    for r in ours.select("scaledFeatures", *[f"{c}_scaled" for c in columns]).limit(50).collect():
        assert list(r[0]) == pytest.approx([r[1], r[2]], abs=1e-12)


def test_categories_by_frequency(spark):
    df = spark.createDataFrame([(v,) for v in [0, 0, 0, 1, 1, 3, 2]], "tx_fraud_scenario int")
    assert {r[0]: r["index"] for r in mlprep.index_categories(df).collect()} == {0: 0, 1: 1, 2: 2, 3: 3}
    encoded = mlprep.onehot(mlprep.encode_categories(df), "tx_fraud_scenario_index", 4)
    last = encoded.filter("tx_fraud_scenario = 3").first()
    assert [last[f"tx_fraud_scenario_index_{i}"] for i in range(3)] == [0, 0, 0]


def test_any_number_of_categories_is_numbered(spark):
    df = spark.range(120_000).select(F.col("id").alias("c")).unionByName(spark.range(1).select(F.lit(77).cast("long").alias("c")))
    table = mlprep.index_categories(df, "c")
    assert table.agg(F.count("c"), F.sum("n"), F.countDistinct("index"), F.max("index")).first()[:] == (120_000, 120_001, 120_000, 119_999)
    assert table.filter("index = 0").first().c == 77
    assert mlprep.encode_categories(df, "c").filter("c_index is null").count() == 0


def test_sweep_of_an_empty_table_has_every_threshold(spark):
    swept = evaluate.threshold_sweep(spark.createDataFrame([], "score double, tx_fraud int")).collect()
    assert len(swept) == 10 and all((r.tp, r.fp, r.fn, r.precision, r.recall) == (0, 0, 0, 0.0, 0.0) for r in swept)


def test_bootstrap_hashes_a_draw_once(spark, monkeypatch):
    plans, kept = [], evaluate.settle

    def settle(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return kept(df, name)

    monkeypatch.setattr(evaluate, "settle", settle)
    # (key, label, new, old); keys repeat, and a key, a label and a prediction are missing
    rows = [(i % 30, int(i % 3 == 0), float(i % 2), float(i % 5 == 0)) for i in range(60)] + [(None, 1, 1.0, 0.0), (7, None, 1.0, 1.0), (8, 1, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, tx_fraud int, new double, old double")
    out = evaluate.bootstrap(df, {"new": ("x", "new"), "old": ("x", "old")}, "id", reps=5, seed=3).collect()
    assert plans[0].count("md5(") == 1

    def times(key, rep):
        text = "|".join(str(x) for x in (key, 3, rep) if x is not None)
        chance = int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
        return sum(chance >= k for k in evaluate._AT_MOST)

    expected = {"new": [], "old": []}
    for rep in range(5):
        for at, name in ((2, "new"), (3, "old")):
            said = [(r[1], r[at], times(r[0], rep)) for r in rows]
            tp, fp = (sum(w for a, b, w in said if (a, b) == (x, 1)) for x in (1, 0))
            expected[name].append(tp / (tp + fp))
    means = {r["model"]: r["mean"] for r in out if r["metric"] == "precision"}
    assert means["new"] == pytest.approx(sum(expected["new"]) / 5)
    assert means["old"] == pytest.approx(sum(expected["old"]) / 5)
    assert means["new - old"] == pytest.approx(sum(a - b for a, b in zip(expected["new"], expected["old"], strict=True)) / 5)
