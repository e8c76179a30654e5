import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txrisk import features, jobs, schema, stream, train
from txrisk import sources
from txrisk.sources import transactions
from txrisk.streaming.messages import KEY_VALUE

BODY = {name: 7 + 3 * i for i, name in enumerate(schema.MESSAGE.names)}


def values(df):
    return sorted(map(str, df.collect()))


def messages(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], KEY_VALUE)


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return train.logistic_pipeline().fit(sources.keyed_features(spark, sf_dir))


def test_body_decodes(spark):
    good, bad = stream.decode(messages(spark, json.dumps(BODY)))
    assert bad.count() == 0
    row = good.first().asDict()
    assert row.pop("key") == "0"
    assert row == BODY


def test_faults_are_named(spark):
    lacking = {k: v for k, v in BODY.items() if k != "tx_amount"}
    texted = {**BODY, "tx_time_days": "many"}
    good, bad = stream.decode(messages(spark, "no json", json.dumps(lacking), json.dumps(texted), json.dumps(BODY), None))
    assert good.count() == 1
    faults = {r.key: r.rejected for r in bad.collect()}
    assert faults == {
        "0": ",".join(schema.MESSAGE_FIELDS),
        "1": "tx_amount",
        "2": "tx_time_days",
        "4": ",".join(schema.MESSAGE_FIELDS),
    }


def test_messages_round_trip(spark, sf_dir):
    table = sources.keyed_features(spark, sf_dir).withColumns(
        {n: F.col(n).cast("double") for n in schema.MESSAGE_FIELDS if "_count_" in n}
    )
    good, _ = stream.decode(stream.to_messages(table, key="transaction_id"))
    assert values(good.select(*schema.MESSAGE_FIELDS)) == values(table.select(*schema.MESSAGE_FIELDS))
    assert stream.replay(table, 5, seed=1).count() == 5
    assert stream.to_messages(table).first().key == str(table.first().tx_datetime)


def test_metadata_is_kept(spark, tmp_path):
    rows = messages(spark, json.dumps(BODY)).selectExpr(
        "*", "'test' AS topic", "3 AS partition", "7L AS offset", "timestamp'2024-01-01' AS timestamp"
    )
    rows.write.parquet(str(tmp_path / "in"))
    source = stream.read_messages(spark, "parquet", {"path": str(tmp_path / "in")}, keep_metadata=True)
    good, _ = stream.decode(source)
    q = good.select("topic", "partition", "offset", "tx_amount").writeStream.format("memory").queryName("kept").start()
    q.processAllAvailable()
    q.stop()
    assert tuple(spark.table("kept").first()) == ("test", 3, 7, BODY["tx_amount"])


def test_stream_scores_like_batch_after_a_restart(spark, sf_dir, tmp_path, model):
    """Two runs on one checkpoint, one file per micro-batch: every message answered once."""
    inbox, outbox, checkpoint, saved = (str(tmp_path / n) for n in ("in", "out", "checkpoint", "model"))
    train.save_model(model, saved)
    loaded = train.load_model(saved)
    every = sources.messages(spark, sf_dir)
    halves = [every.filter("cast(key AS long) % 2 = 0"), every.filter("cast(key AS long) % 2 = 1")]
    for half in halves:
        stream.write_messages(half.repartition(3), "parquet", {"path": inbox})
        source = stream.read_messages(spark, "parquet", {"path": inbox, "maxFilesPerTrigger": "1"})
        q = jobs.score_stream(source, loaded, "parquet", {"path": outbox}, checkpoint, available_now=True)
        q.awaitTermination()
        progress = stream.progress_rows(spark, q).filter("input_rows > 0")
        assert progress.count() == 3
    replies = spark.read.schema(KEY_VALUE).parquet(outbox)
    assert values(replies) == values(stream.score_stream(every, model))
    assert set(json.loads(replies.first().value)) == {"prediction"}


def test_counts_on_a_stream(spark, sf_dir, tmp_path):
    tx = transactions(spark, sf_dir).select(
        F.timestamp_seconds(F.unix_timestamp("tx_datetime")).alias("ts"), F.col("tx_fraud").alias("prediction")
    )
    tx.repartition(3).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(tx.schema).parquet(str(tmp_path / "in"))
    counts = stream.prediction_counts(source, window="1 day")
    q = counts.writeStream.outputMode("complete").format("memory").queryName("counted").start()
    q.processAllAvailable()
    q.stop()
    assert values(spark.table("counted")) == values(stream.prediction_counts(tx, window="1 day"))


def test_replies_on_streams(spark, tmp_path):
    """Two requests of one key, a stale reply, replies out of order and late, over restarts: as in batch."""
    schema_ = "key string, value string, ts timestamp"
    runs = [
        {
            "requests": [("a", "r1", 0), ("a", "r2", 20), ("b", "r", 10), ("c", "r", 5), ("a", "r1", 0), (None, "r", 3)],
            "replies": [("a", "second", 9), ("a", "first", 5), ("b", "stale", 2), ("x", "other", 3), (None, "none", 4)],
        },
        {"requests": [("d", "r", 50), ("a", "r3", 40)], "replies": [("a", "later", 25), ("b", "late", 71), ("d", "b", 60), ("d", "a", 60)]},
        {"requests": [("e", "r", 900)], "replies": [("a", "much later", 99), ("e", "early", 899)]},
        {"requests": [("end", "r", 9000)], "replies": [("end", "r", 9000)]},
    ]
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for rows in runs:
        for name, side in rows.items():
            df = spark.createDataFrame(side, "key string, value string, t long").selectExpr("key", "value", "timestamp_seconds(1700000000 + t) AS ts")
            df.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        live = [spark.readStream.schema(schema_).parquet(str(tmp_path / n)) for n in ("requests", "replies")]
        matched = stream.match_replies(*live)
        stream.write_messages(matched, "parquet", {"path": out}, checkpoint, available_now=True).awaitTermination()
    batch = stream.match_replies(*[spark.read.schema(schema_).parquet(str(tmp_path / n)) for n in ("requests", "replies")])
    batch = batch.filter("key IS NULL OR key <> 'end'")
    found = {(r.key, r.value): r.reply for r in batch.collect()}
    assert found == {
        ("a", "r1"): "first", ("a", "r2"): "later", ("a", "r3"): "much later", ("b", "r"): None,
        ("c", "r"): None, ("d", "r"): "a", ("e", "r"): None, (None, "r"): None,
    }
    assert values(spark.read.parquet(out).select(*batch.columns)) == values(batch)


def test_a_stale_reply_does_not_hide_the_right_one(spark):
    at = "key string, value string, t long"
    ask, told = (
        spark.createDataFrame(rows, at).selectExpr("key", "value", "timestamp_seconds(1700000000 + t) AS ts")
        for rows in ([("a", "?", 100)], [("a", "stale", 50), ("a", "right", 110), ("a", "later", 120)])
    )
    assert [r.reply for r in stream.match_replies(ask, told).collect()] == ["right"]


def test_keyed_state_equals_batch_windows(spark, sf_dir, tmp_path):
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    tx = transactions(spark, sf_dir)
    for part in range(4):
        rows = tx.filter(F.floor(F.col("tx_time_days") * 4 / 30) == part)
        rows.repartition(2).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(tx.schema).parquet(inbox)
        rolled = stream.rolling_features_stream(source)
        stream.write_messages(rolled, "parquet", {"path": out}, checkpoint, available_now=True).awaitTermination()
    got = spark.read.parquet(out).drop("at").toPandas().sort_values("transaction_id").reset_index(drop=True)
    want = features.rolling_mean(features.rolling_count(tx, "customer_id"), "customer_id")
    want = want.select(*got.columns).toPandas().sort_values("transaction_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_held_rows_come_out_in_order(spark, sf_dir, tmp_path):
    """Days arrive in disorder, at most two days late; what the watermark has passed is as in batch."""
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    out = str(tmp_path / "out")
    tx = transactions(spark, sf_dir)
    order = [1, 0, 3, 2, 5, 4, 7, 6, 9, 8]
    last = None
    for day in order:
        rows = tx.filter(F.col("tx_time_days") == day)
        rows.coalesce(1).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(tx.schema).parquet(inbox)
        rolled = stream.rolling_features_stream(source, "terminal_id", features.TERMINAL_COUNT, None, hold="3 days")
        last = stream.write_messages(rolled, "parquet", {"path": out}, checkpoint, available_now=True)
        last.awaitTermination()
    got = spark.read.parquet(out).drop("at").toPandas().sort_values("transaction_id").reset_index(drop=True)
    assert len(got) > 100 and got.transaction_id.is_unique
    want = features.rolling_count(tx, "terminal_id", features.TERMINAL_COUNT).select(*got.columns).toPandas()
    want = want[want.transaction_id.isin(got.transaction_id)].sort_values("transaction_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_window_batches_equal_batch(spark, sf_dir, tmp_path):
    """Four micro-batches in four runs, with hot keys cut in each."""
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    tx = transactions(spark, sf_dir)
    for part in range(4):
        tx.filter(F.floor(F.col("tx_time_days") * 4 / 30) == part).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(tx.schema).parquet(inbox)
        stream.rolling_features_batches(source, out, checkpoint, hot_rows=10).awaitTermination()
    want = features.rolling_features(tx)
    got = spark.read.parquet(out).select(*want.columns)
    a, b = (d.toPandas().sort_values("transaction_id").reset_index(drop=True) for d in (got, want))
    pd.testing.assert_frame_equal(a, b)


def test_state_per_key_equals_batch_windows(spark, sf_dir, tmp_path):
    """Four runs on one checkpoint; all columns are kept, and a run touches the state of its own keys only."""
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    tx = transactions(spark, sf_dir).withColumn("channel", F.lit("web"))
    first = F.col("tx_time_days") < 20
    few = tx.filter(~first).orderBy("tx_datetime").limit(5)
    early = tx.filter(first).orderBy("tx_datetime").limit(1)
    touched = []
    for part in (tx.filter(first & (F.col("tx_time_days") < 10)), tx.filter(first & (F.col("tx_time_days") >= 10)), few, early):
        part.coalesce(2).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(tx.schema).parquet(inbox)
        query = stream.rolling_features_state(source, out, checkpoint)
        query.awaitTermination()
        touched.append(sum(stream.state_reads(query)))
    got = spark.read.parquet(out)
    rolled = features.rolling_features(tx.filter(first).unionByName(few))
    assert values(got.filter("not late").select(*rolled.columns)) == values(rolled)
    again = got.filter("late")
    assert [r.transaction_id for r in again.collect()] == [early.first().transaction_id]
    assert again.filter("avg_transaction_count_1 IS NOT NULL OR avg_transaction_terminal_id_count_1 IS NOT NULL").isEmpty()
    # five rows have five customers and five terminals at most, each with a list of 31 rows, whatever was there before
    assert touched[2] <= 2 * 5 * 31 and touched[3] <= 2 * 31


def test_late_rows_are_returned(spark, sf_dir, tmp_path):
    """A row older than what its keys had before goes to the late table; the others are as in batch."""
    inbox, out, checkpoint, late = (str(tmp_path / n) for n in ("in", "out", "checkpoint", "late"))
    tx = transactions(spark, sf_dir).withColumn("terminal_id", F.col("customer_id"))
    one, first = tx.first().customer_id, F.col("tx_time_days") < 20
    mine = tx.filter(F.col("customer_id") == one)
    held = mine.filter(first).orderBy("tx_datetime").first().transaction_id
    early = F.col("transaction_id") == held
    parts = [tx.filter(first & ~early), tx.filter(~first).limit(10).unionByName(tx.filter(early))]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(tx.schema).parquet(inbox)
        stream.rolling_features_batches(source, out, checkpoint, late=late).awaitTermination()
    assert [r.transaction_id for r in spark.read.parquet(late).collect()] == [held]
    done = spark.read.parquet(out).drop("batch")
    want = features.rolling_features(parts[0].unionByName(parts[1].filter(~early)))
    assert values(done.select(*want.columns)) == values(want)
    # the second micro-batch keeps rows of its own keys only
    assert spark.read.parquet(f"{checkpoint}/last-rows/customer_id/1").count() <= 10


def test_tables_of_last_rows_are_merged(spark, sf_dir, tmp_path, monkeypatch):
    from txrisk.streaming import rolling

    monkeypatch.setattr(rolling, "MERGE_EVERY", 2)
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    tx = transactions(spark, sf_dir)
    for part in range(6):
        tx.filter(F.floor(F.col("tx_time_days") * 6 / 30) == part).coalesce(1).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(tx.schema).parquet(inbox)
        stream.rolling_features_batches(source, out, checkpoint).awaitTermination()
    want = features.rolling_features(tx)
    assert values(spark.read.parquet(out).select(*want.columns)) == values(want)
    left = {p.name for p in (tmp_path / "checkpoint" / "last-rows" / "customer_id").iterdir()}
    assert left == {"upto-2", "upto-4", "2", "3", "4", "5"}


def test_frames_skip_missing_amounts():
    import numpy as np

    from txrisk.streaming.rolling import frame_values

    counts, means = frame_values([float("nan")], np.array([1.0, 2.0, 3.0]), 1)
    assert counts.tolist() == [2, 2, 2] and means.tolist() == [1.0, 1.5, 2.5]
    assert frame_values([1e17, 1.0], np.array([2.0, 3.0]), 1)[1].tolist() == [1.5, 2.5]
    assert np.isnan(frame_values([], np.array([float("nan")]), 7)[1][0])


def test_every_message_is_answered(spark, tmp_path, model):
    sent = messages(spark, json.dumps(BODY), "no json", json.dumps({**BODY, "tx_amount": None}))
    got = {r.key: json.loads(r.value) for r in stream.score_stream(sent, model).collect()}
    assert set(got["0"]) == {"prediction"}
    assert got["1"] == {"rejected": ",".join(schema.MESSAGE_FIELDS)} and got["2"] == {"rejected": "tx_amount"}
    sent.coalesce(1).write.parquet(str(tmp_path / "in"))
    log = stream.ProgressLog(spark, str(tmp_path / "log"), every=1)
    spark.streams.addListener(log)
    source = stream.read_messages(spark, "parquet", {"path": str(tmp_path / "in")})
    q = jobs.score_stream(source, model, "parquet", {"path": str(tmp_path / "out")}, str(tmp_path / "c"), available_now=True)
    q.awaitTermination()
    row = stream.progress_rows(spark, q).filter("input_rows > 0").first()
    assert (row.scored, row.rejects) == (1, 2)
    log.flush()
    spark.streams.removeListener(log)


def test_ledger_of_a_hot_partition(spark):
    """Ranges that cross blocks are one; order, copies and layout do not matter."""
    offsets = [*range(0, 25), *range(27, 30), 31, 31, 31, *range(40, 81)]
    rows = [("t", 0, o) for o in offsets] + [("t", 1, 5), ("u", 0, 7), ("u", 0, 7)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long").repartition(5)
    want = [("t", 0, 0, 24, 25, 0, 0), ("t", 0, 27, 29, 3, 0, 2), ("t", 0, 31, 31, 1, 2, 1), ("t", 0, 40, 80, 41, 0, 8), ("t", 1, 5, 5, 1, 0, 0), ("u", 0, 7, 7, 1, 1, 0)]
    for block in (1, 10, 1_000_000):
        assert sorted(map(tuple, stream.ledger(df, block).collect())) == want
    assert stream.ledger(df.limit(0)).count() == 0


def test_replay_takes_every_row(spark, sf_dir):
    table = transactions(spark, sf_dir).limit(20)
    table = table.withColumns({c: F.lit(1.0) for c in schema.MESSAGE_FIELDS if c not in table.columns})
    rows = stream.numbered_messages(table, 3)
    assert sorted(r["index"] for r in rows.collect()) == list(range(20))
    numbers = spark.range(400).select(F.col("id").alias("value"))
    sent = stream.replay_stream(numbers, rows, 3)
    assert sent.count() == 400 and sent.select("key").distinct().count() == 20
    assert values(sent) == values(stream.replay_stream(numbers.repartition(3), rows.repartition(2), 3))


@pytest.mark.parametrize("passed", [None, 2_500])
def test_a_key_costs_one_table_of_pandas(spark, monkeypatch, passed):
    """Rows of a micro-batch of one key, in two batches: put in order, kept as state, and one table made of them."""
    from txrisk.streaming import rolling

    taken = {}

    class Rows:
        schema = spark.range(0).selectExpr("1 AS customer_id").schema

        def select(self, *_):
            return self

        withWatermark = groupBy = select  # noqa: N815

        def applyInPandasWithState(self, f, *_):  # noqa: N802
            taken["f"] = f

    class State:
        exists = False

        def getCurrentWatermarkMs(self):  # noqa: N802
            return passed

        def update(self, value):
            self.get, self.exists = value, True

        def setTimeoutTimestamp(self, at):  # noqa: N802
            self.due = at

    rolling.rolling_features_stream(Rows(), frames=(1, 2), hold="1 second" if passed else None)
    batches = [pd.DataFrame({"at": at, "transaction_id": ids, "tx_amount": x}) for at, ids, x in (([2_000_000, 1_000_000], [2, 1], [4.0, 2.0]), ([3_000_000, 2_000_000], [4, 3], [None, 6.0]))]
    made = []
    for name in ("DataFrame", "concat"):
        monkeypatch.setattr(rolling.pd, name, lambda *a, kept=getattr(pd, name), **k: made.append(1) or kept(*a, **k))
    state = State()
    (out,) = taken["f"]((7,), iter(batches), state)
    assert len(made) == 1
    n = 3 if passed else 4
    assert out["transaction_id"].tolist() == [1, 2, 3, 4][:n] and out["customer_id"].tolist() == [7] * n
    assert out["avg_transaction_mean_1"].tolist() == [2.0, 3.0, 5.0, 6.0][:n]
    assert out["avg_transaction_count_2"].tolist() == [1, 2, 3, 3][:n]
    assert state.get[0] == pytest.approx([4.0, 6.0] if passed else [6.0, float("nan")], nan_ok=True)
    assert state.get[1:3] == (([3_000_000], [4]) if passed else ([], []))


def test_many_waiting_requests_are_few_rows_of_state():
    """A key with 2,500 requests that wait, one without a value; all come out once their time is over."""
    from txrisk.streaming.replies import Pending

    class State:
        rows = ()

        def get(self):
            return iter(self.rows)

        def put(self, rows):
            self.rows = rows

        def clear(self):
            self.rows = ()

    class Handle:
        def getListState(self, *_):  # noqa: N802
            return State()

        def registerTimer(self, _):  # noqa: N802
            pass

    class Times:
        watermark = 0

        def getCurrentWatermarkInMs(self):  # noqa: N802
            return self.watermark

    pending, times = Pending(1_000_000), Times()
    pending.init(Handle())
    at = [*range(0, 2_499_000, 1000), 0]
    rows = pd.DataFrame({"asks": [True] * 2500 + [False], "at": [*at, 2_000_000], "value": [*(f"r{i}" for i in range(2499)), None, "told"]})
    assert not list(pending.handleInputRows(("k",), iter([rows]), times))
    assert len(pending.requests.rows) <= 3 and len(pending.replies.rows) == 1
    times.watermark = 10_000_000
    (out,) = pending.handleExpiredTimer(("k",), times, None)
    assert out["at"].tolist() == sorted(at) and out["value"].tolist()[:3] == [None, "r0", "r1"]
    assert [i for i, r in zip(out["at"], out["reply"], strict=True) if r == "told"] == list(range(1_000_000, 2_001_000, 1000))
    assert not pending.requests.rows and not pending.replies.rows


def test_keys_of_a_slot_share_a_call():
    """Two micro-batches of 40 keys, one of them null: one table each, a read and a write of state per key, values as key by key."""
    from txrisk.streaming.keyed import LastRows
    from txrisk.streaming.rolling import frame_values

    class State(dict):
        reads = writes = 0

        def getValue(self, key):  # noqa: N802
            self.reads += 1
            return self.get(key)

        def updateValue(self, key, value):  # noqa: N802
            self.writes += 1
            self[key] = value

    class Handle:
        def getMapState(self, *_):  # noqa: N802
            return State()

    rows = [(i * 37 % 200, i, f"k{i % 40}" if i % 40 else None, float("nan") if i % 9 == 0 else i * 0.1, False) for i in range(200)]
    first, second = (pd.DataFrame(part, columns=["at_micros", "transaction_id", "state_key", "tx_amount", "late"]) for part in (
        [r for r in rows if r[0] < 100], [r for r in rows if r[0] >= 100] + [(0, 900, "k1", 1.0, False), (199, 901, "new", 1.0, True)]))
    processor = LastRows({1: ("count_1", "mean_1"), 3: ("count_3", None)}, ["transaction_id", "late", "count_1", "mean_1", "count_3"], None)
    processor.init(Handle())
    out = []
    for part in (first, second):
        part["state_id"] = part["transaction_id"]
        (made,) = processor.handleInputRows((5,), iter([part.iloc[::2], part.iloc[1::2]]), None)
        out.append(made)
    out = pd.concat(out).set_index("transaction_id")
    assert processor.last.reads == first["state_key"].nunique(dropna=False) + second["state_key"].nunique(dropna=False)
    assert processor.last.writes <= processor.last.reads and max(len(v[0]) for v in processor.last.values()) == 3
    assert out.loc[[900, 901], "late"].all() and out["late"].sum() == 2 and out.loc[[900, 901]].drop(columns="late").isna().all(axis=None)
    for key in {r[2] for r in rows}:
        own = sorted(r for r in rows if r[2] == key)
        for n, names in {1: ["count_1", "mean_1"], 3: ["count_3"]}.items():
            for name, want in zip(names, frame_values([], np.array([r[3] for r in own]), n), strict=False):
                assert out.loc[[r[1] for r in own], name].tolist() == pytest.approx(want.tolist(), nan_ok=True, abs=0)
