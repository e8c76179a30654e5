"""Time to answer, from sketches."""

import math

import pytest

from txrisk.streaming import answer_timed, latency_sketch, latency_summary, merge_sketches


@pytest.fixture
def answers(spark):
    """All but a tenth of the messages are in one window."""
    us = "CAST(pow(id * 7919 % 9973, 2) AS LONG) - 3"
    return spark.range(2000).selectExpr("timestamp_seconds(IF(id % 10 = 0, 4000, 100)) AS ts", f"timestamp_micros(IF(id % 10 = 0, 4000, 100) * 1000000L + {us}) AS answered", f"{us} AS us")


def test_quantiles_are_within_the_accuracy(answers):
    taken = sorted(r.us for r in answers.select("us").collect())
    got = latency_summary(latency_sketch(answers), (0.001, 0.5, 0.999), by=()).first()
    assert (got.messages, got.total_ms, got.least_ms, got.most_ms) == (2000, sum(taken) / 1000, taken[0] / 1000, taken[-1] / 1000)
    for q, name in ((0.001, "p0_1_ms"), (0.5, "p50_ms"), (0.999, "p99_9_ms")):
        exact = max(0, taken[max(1, math.ceil(q * 2000)) - 1])
        assert abs(got[name] * 1000 - exact) <= 0.01 * exact + 1e-6


def test_sketches_of_parts_merge_to_the_sketch_of_all(answers):
    low, high = answers.where("us < 1000000"), answers.where("us >= 1000000")
    merged = merge_sketches(latency_sketch(low).unionByName(latency_sketch(high)))
    whole = latency_sketch(answers)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.select(*merged.columns).collect()))
    assert whole.groupBy("window_start").count().count() == 2


def test_times_that_are_missing_do_not_count(spark):
    df = spark.createDataFrame([(None, None)], "ts timestamp, answered timestamp")
    assert latency_sketch(df).isEmpty() and latency_summary(latency_sketch(df)).isEmpty()


def test_a_stream_counts_each_message_once(spark, tmp_path, answers):
    """Two runs on one checkpoint, and a micro-batch whose files are there already."""
    inbox, out, log, checkpoint = (str(tmp_path / n) for n in ("in", "out", "log", "checkpoint"))
    answers.limit(1).write.parquet(f"{out}/batch=1")
    latency_sketch(answers).write.parquet(f"{log}/batch=1")
    for part in ("us < 1000000", "us >= 1000000"):
        answers.where(part).coalesce(1).write.mode("append").parquet(inbox)
        answer_timed(spark.readStream.schema(answers.schema).parquet(inbox), out, log, checkpoint, answered="answered").awaitTermination()
    assert spark.read.parquet(out).count() == 2000
    got = latency_summary(spark.read.parquet(log)).orderBy("window_start").collect()
    assert got == latency_summary(latency_sketch(answers)).orderBy("window_start").collect()
    assert [r.messages for r in got] == [1800, 200]


def test_without_a_time_of_answer_the_clock_counts(spark, tmp_path, answers):
    inbox, out, log, checkpoint = (str(tmp_path / n) for n in ("in", "out", "log", "checkpoint"))
    answers.selectExpr("current_timestamp() AS ts", "us").coalesce(1).write.parquet(inbox)
    answer_timed(spark.readStream.schema("ts timestamp, us long").parquet(inbox), out, log, checkpoint).awaitTermination()
    got = latency_summary(spark.read.parquet(log), by=()).first()
    assert got.messages == 2000 and 0 < got.least_ms < 600_000
