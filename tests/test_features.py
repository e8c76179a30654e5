"""Rolling features against plain windows, with and without hot keys."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from txrisk import features, schema
from txrisk.sources import transactions


def plain(df, by):
    for key, prefix in (("customer_id", "avg_transaction_"), ("terminal_id", "avg_transaction_terminal_id_")):
        for n in (1, 7, 30):
            w = Window.partitionBy(key)
            if by == "rows":
                w = w.orderBy("tx_datetime", "transaction_id").rowsBetween(-n, 0)
            else:
                w = w.orderBy(F.unix_timestamp("tx_datetime")).rangeBetween(-n * 86400, 0)
            df = df.withColumn(f"{prefix}count_{n}", F.count("transaction_id").over(w).cast("float"))
            if key == "customer_id":
                df = df.withColumn(f"{prefix}mean_{n}", F.avg("tx_amount").over(w))
    return df


def rows(df):
    p = df.toPandas().sort_values("transaction_id").reset_index(drop=True)
    return p[sorted(p.columns)]


@pytest.fixture(scope="module")
def skewed(spark, sf_dir):
    """One terminal and the NULL customer hold very many rows, half of them at one moment."""
    i = F.col("transaction_id")
    return transactions(spark, sf_dir).withColumns(
        {
            "customer_id": F.when(i % 3 > 0, F.col("customer_id")),
            "terminal_id": F.when(i % 3 < 2, 7).otherwise(F.col("terminal_id")),
            "tx_datetime": F.when(i % 2 == 0, F.expr("timestamp_ntz'2024-01-15 00:00:00'"))
            .when(i % 11 == 0, F.lit(None).cast("timestamp_ntz"))
            .otherwise(F.col("tx_datetime")),
        }
    )


@pytest.mark.parametrize("by", ["rows", "days"])
@pytest.mark.parametrize("hot_rows", [None, 30, 200])
def test_hot_keys_do_not_change_results(spark, skewed, by, hot_rows):
    got = rows(features.rolling_features(skewed, frames_by=by, hot_rows=hot_rows))
    pd.testing.assert_frame_equal(got, rows(plain(skewed, by)), check_dtype=False)


@pytest.mark.parametrize("by", ["rows", "days"])
def test_layout_does_not_change_results(spark, sf_dir, by):
    tx = transactions(spark, sf_dir)
    a = rows(features.rolling_features(tx, frames_by=by))
    b = rows(features.rolling_features(tx.repartition(7), frames_by=by, hot_rows=40))
    pd.testing.assert_frame_equal(a, b)


def test_hot_slices_stay_small(spark, skewed):
    """No slice of the hot terminal holds more than the limit, also where half its rows share a moment."""
    from txrisk.operators.hotkeys import apply_slices, hot_slices, slice_names

    df = skewed.withColumn("_at", features._position())
    cuts = hot_slices(df, "terminal_id", "_at", "transaction_id", limit=50)
    names = slice_names("terminal_id", len(cuts))
    sliced = apply_slices(df, "terminal_id", "_at", "transaction_id", cuts)
    assert df.filter("terminal_id = 7").count() > 500
    assert sliced.groupBy("terminal_id", *names).count().agg(F.max("count")).first()[0] <= 50


def test_no_hot_key_leaves_a_plain_window(spark, sf_dir):
    plan = features.rolling_features(transactions(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 2
    assert plan.count("Exchange") == 2
    assert "Join" not in plan and "Union" not in plan


def test_day_frames_take_few_exchanges(spark, sf_dir):
    """Per key: seconds, spans, and the join with the rows; both uses of the spans share one."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = features.rolling_features(transactions(spark, sf_dir), frames_by="days")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("- Exchange hashpartitioning") == 8
    assert plan.count("FileScan") == 3
    assert plan.count("ReusedExchange") == 2


def test_rows_without_time_or_key_in_day_frames(spark):
    """Rows without a time share a frame, also beside rows of the same key that have one; a null key is a key."""
    tx = spark.createDataFrame([(1, 5, None, 1.0), (2, 5, None, 2.0), (3, 5, 40, 4.0), (4, 5, 12, 8.0), (5, None, 12, 16.0), (6, None, 3, 32.0)], "transaction_id long, customer_id long, day int, tx_amount double")
    tx = tx.selectExpr("transaction_id", "customer_id", "customer_id AS terminal_id", "tx_amount", "CAST(timestamp_seconds(86400L * day) AS timestamp_ntz) AS tx_datetime")
    got = {r.transaction_id: r for r in features.rolling_features(tx, frames_by="days").collect()}
    assert [got[i].avg_transaction_mean_30 for i in range(1, 7)] == [1.5, 1.5, 6.0, 8.0, 24.0, 32.0]
    assert [got[i].avg_transaction_mean_7 for i in range(1, 7)] == [1.5, 1.5, 4.0, 8.0, 16.0, 32.0]
    assert [got[i].avg_transaction_terminal_id_count_30 for i in range(1, 7)] == [2.0, 2.0, 2.0, 1.0, 2.0, 1.0]


def test_earlier_rows_count_in_frames(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    cut = F.col("tx_time_days") < 12
    before, after = tx.filter(cut), tx.filter(~cut)
    earlier = {k: features.last_rows(before, k, 30) for k in ("customer_id", "terminal_id")}
    want = rows(features.rolling_features(tx).filter(~cut))
    for hot_rows in (None, 20):
        got = rows(features.rolling_features(after, earlier=earlier, hot_rows=hot_rows))
        pd.testing.assert_frame_equal(got, want)


def test_feature_table_schema(spark, sf_dir):
    table = features.feature_table(transactions(spark, sf_dir))
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in schema.FEATURES]


def test_day_means_keep_their_digits(spark):
    """Amounts of any size, infinite or not a number, count in their own frames only."""
    amounts = [(1, 0, 1e17), (1, 10, 1.0), (2, 12, 2.0), (2, 14, 3.0), (4, 0, float("nan")), (4, 1, 5.0), (6, 0, float("inf")), (8, 0, 7.0), (20, 0, 8.0)]
    tx = spark.createDataFrame([(i, d, h, a) for i, (d, h, a) in enumerate(amounts)], "transaction_id long, d int, h int, tx_amount double")
    tx = tx.selectExpr("*", "1L AS customer_id", "2L AS terminal_id", "make_timestamp_ntz(2024, 1, d, h, 0, 0) AS tx_datetime").drop("d", "h")
    got, want = rows(features.rolling_features(tx, frames_by="days")), rows(plain(tx, "days"))
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=0, atol=0)


def test_days_of_a_hot_key_lie_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(features, "TASK_SECONDS", 20)
    monkeypatch.setattr(features, "_frames_by_second", lambda *a, kept=features._frames_by_second: held.append(kept(*a)) or held[-1])
    held = []
    start = dt.datetime(2024, 1, 1)
    times = [start + dt.timedelta(hours=5 * (i // 2)) for i in range(300)] + [None]
    rows = [(i, t, 1, i % 3, float(i)) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "transaction_id long, tx_datetime timestamp_ntz, customer_id int, terminal_id int, tx_amount double")
    got = {r["transaction_id"]: r for r in features.rolling_features(df, frames_by="days").collect()}
    for n in (1, 7, 30):
        for i, at, _, _, _ in rows:
            frame = [r[4] for r in rows if (r[1] is None if at is None else r[1] is not None and at - dt.timedelta(days=n) <= r[1] <= at)]
            assert got[i][f"avg_transaction_count_{n}"] == len(frame)
            assert got[i][f"avg_transaction_mean_{n}"] == pytest.approx(sum(frame) / len(frame))
    per_task = held[0].groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 3 and max(r["count"] for r in per_task) < 100
