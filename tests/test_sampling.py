import pytest
from pyspark.sql import functions as F

from txrisk import sampling
from txrisk.sources import transactions


def ids(df):
    return sorted(r[0] for r in df.select("transaction_id").collect())


def labelled(spark, n0, n1):
    rows = [(i, 0) for i in range(n0)] + [(100 + i, 1) for i in range(n1)]
    return spark.createDataFrame(rows, "transaction_id long, tx_fraud int")


def test_zero_copies_give_no_rows(spark):
    df = spark.range(3)
    assert sampling.replicate(df, 0).count() == 0
    assert sampling.replicate(df, 4).count() == 12


@pytest.mark.parametrize("n0,n1,factor,strict", [(10, 3, 3, 3), (3, 10, 1, 0), (5, 0, 1, None)])
def test_oversampling_factor(spark, n0, n1, factor, strict):
    df = labelled(spark, n0, n1)
    assert tuple(sampling.class_ratio(df).first()) == (n0, n1, factor)
    assert tuple(sampling.class_ratio(df, strict=True).first()) == (n0, n1, strict)
    assert sampling.oversample(df).count() == n0 + n1 * factor
    if strict is None:
        with pytest.raises(Exception, match="no positive rows"):
            sampling.oversample(df, strict=True).collect()
    else:
        assert sampling.oversample(df, strict=True).count() == n0 + n1 * strict


def test_layout_does_not_change_samples(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    other = tx.repartition(7).select("transaction_id", "tx_fraud")
    assert ids(sampling.sample(tx, 0.3, 1, "transaction_id")) == ids(sampling.sample(other, 0.3, 1, "transaction_id"))
    assert ids(sampling.random_rows(tx, 9, 1, "transaction_id")) == ids(sampling.random_rows(other, 9, 1, "transaction_id"))
    assert ids(sampling.random_rows(tx, 9, 1, "transaction_id")) != ids(sampling.random_rows(tx, 9, 2, "transaction_id"))


def test_parts_are_disjoint_and_whole(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    parts = [ids(p) for p in sampling.split(tx, [0.5, 0.3, 0.2], 3, "transaction_id")]
    assert sorted(sum(parts, [])) == ids(tx)
    doubled = sampling.replicate(tx, 2)
    first, second = sampling.split(doubled, [0.8, 0.2], 3, "transaction_id")
    assert not set(ids(first)) & set(ids(second))
    with pytest.raises(ValueError):
        sampling.split(tx, [0.8, 0.3], 3, "transaction_id")
    assert sum(p.count() for p in sampling.split(tx, [0.8, 0.2], 3)) == tx.count()
    assert 0 < sampling.sample(tx, 0.5, 3).count() < tx.count()


def test_top_k_is_one_scan(spark, sf_dir):
    plan = sampling.random_rows(transactions(spark, sf_dir), 5, 1, "transaction_id")
    assert "TakeOrderedAndProject" in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.agg(F.count(F.lit(1))).first()[0] == 5


def test_tiny_shares_have_rows(spark):
    kept = sampling.sample(spark.range(10_000_000), 4e-7 * 100, 3, key="id").count()
    assert 330 < kept < 470
    assert sampling.sample(spark.range(1_000_000), 4e-7, 3, key="id").count() < 5
