import pytest

from txrisk import evaluate, jobs, sampling, sources, train
from txrisk.sources import scored, transactions


def test_grids(spark):
    assert len(train.linear_grid(train.linear())) == 50
    assert len(train.logistic_grid(train.logistic())) == 1
    assert len(train.logistic_grid(train.logistic(), 3, 2)) == 6


def test_saved_model_scores_alike(spark, sf_dir, tmp_path):
    table = sources.keyed_features(spark, sf_dir)
    model = train.logistic_pipeline().fit(table)
    train.save_model(model, str(tmp_path / "m"))
    loaded = train.load_model(str(tmp_path / "m"))
    a, b = (sorted(map(str, train.score(m, table).select("transaction_id", "probability").collect())) for m in (model, loaded))
    assert a == b


@pytest.mark.parametrize("kind", ["probability", "raw"])
def test_scores(spark, sf_dir, kind):
    table = sources.keyed_features(spark, sf_dir)
    scored = evaluate.scores(train.score(train.logistic_pipeline().fit(table), table), kind)
    low, high = scored.selectExpr("min(score)", "max(score)").first()
    assert low < high
    assert kind == "raw" or (low >= 0 and high <= 1)


def test_scenario_pipeline_finds_fraud(spark, sf_dir):
    """The scenario gives the label away, so the linear fit with it is perfect."""
    tx = transactions(spark, sf_dir)
    predicted = train.score(train.linear_pipeline(use_scenario=True).fit(tx), tx)
    assert predicted.selectExpr("max(abs(prediction - tx_fraud))").first()[0] < 1e-6


def test_baseline(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    est = train.linear()
    trained = jobs.train_baseline(tx, grid=train.linear_grid(est, [0.01], [0.0]))
    assert {r.param for r in trained.params.collect()} == {"optimal_regParam", "optimal_elasticNetParam", "optimal_fitIntercept"}
    metrics = {r.metric: r.value for r in trained.metrics.collect()}
    assert set(metrics) == {"rmse", "accuracy"} and 0 < metrics["rmse"] < 1
    assert trained.model.transform(tx).count() == tx.count()


def test_validated_without_a_previous_model(spark, sf_dir):
    table = jobs.build_features(transactions(spark, sf_dir))
    trained = jobs.train_validated(table, fraction=0.8, folds=2)
    metrics = trained.metrics.collect()
    assert {r.model for r in metrics} == {"new"} and len(metrics) == 22
    again = jobs.train_validated(table.repartition(5), fraction=0.8, folds=2, previous=trained.model)
    assert {r.model for r in again.metrics.collect()} == {"new", "old"}
    assert again.sweep.filter("threshold = 0").selectExpr("min(recall)").first()[0] == 1.0


def test_folds_do_not_depend_on_the_layout(spark, sf_dir):
    """Copies share a fold, and cross-validation gives the same model on one and on eight partitions."""
    tx = transactions(spark, sf_dir)
    plain = {r.transaction_id: r.fold for r in sampling.folds(tx, 3, 47, "transaction_id").collect()}
    copies = sampling.folds(sampling.replicate(tx.repartition(7), 2), 3, 47, "transaction_id")
    assert set(plain.values()) == {0, 1, 2} and all(plain[r.transaction_id] == r.fold for r in copies.collect())
    table = jobs.build_features(tx)
    found = []
    for parts in (1, 8):
        metrics = jobs.train_validated(table.repartition(parts), fraction=1.0, folds=2).metrics
        found.append(sorted((r.metric, round(r.value, 6)) for r in metrics.collect()))
    assert found[0] == found[1]


def test_bootstrap_of_equal_models(spark, sf_dir):
    """A model does not differ from itself in any draw, and intervals hold the plain value."""
    df = scored(spark, sf_dir)
    found = evaluate.bootstrap(df, {"a": ("score", "prediction"), "b": ("score", "prediction")}, "transaction_id", reps=40)
    rows = {(r.model, r.metric): r for r in found.collect()}
    assert len(rows) == 9 and all(r.mean == r.low == r.high == 0 for (m, _), r in rows.items() if m == "a - b")
    plain = evaluate.prf(evaluate.confusion(df)).first()
    for metric in ("precision", "recall", "f1"):
        assert rows["a", metric].low <= plain[metric] <= rows["a", metric].high
    again = evaluate.bootstrap(df.repartition(5), {"a": ("score", "prediction")}, "transaction_id", reps=40).filter("model = 'a'")
    assert {r.metric: r.low for r in again.collect()} == {m: rows["a", m].low for m in ("precision", "recall", "f1")}
