"""Every operator applied to the test tables, one named query each.

A query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole table.
Numbers are rounded to six places and times are given as text or epoch seconds, so
that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk import sources
from txrisk.functions import epoch_seconds
from txrisk.operators import anonymity, evaluate, features, mlprep, quality, sampling
from txrisk.plans import jobs, train
from txrisk.schema import FRAMES, LABEL, MESSAGE_FIELDS
from txrisk.session import new_path, settle
from txrisk.sources import raw_transactions, scored, transactions
from txrisk.streaming import (
    answer_timed,
    decode,
    latency_summary as summary_of_latency,
    ledger,
    mark,
    match_replies,
    numbered_messages,
    prediction_counts,
    predictions,
    read_messages,
    replay_stream,
    rolling_features_batches,
    rolling_features_state,
    rolling_features_stream,
    to_messages,
    write_messages,
)
from txrisk.streaming.keyed import PROVIDER, ROCKSDB, setting

Query = Callable[[SparkSession, str], DataFrame]

SEED = 47
SALT = "txrisk"
#: quasi-identifiers and the least group
QUASI, K = ["customer_id", "terminal_id", "tx_time_days"], 25
#: fences that remove something in the test tables
FENCED = ["tx_amount", "terminal_id", "customer_id"]
CLEAN_FENCES = ["customer_id", "terminal_id", "tx_time_seconds", "transaction_id", "tx_time_days", "tx_amount"]
MODELS = {"new": ("score", "prediction"), "old": ("score_old", "prediction_old")}

_REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    _REGISTRY[f.__name__.rstrip("_")] = f
    return f


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def tidy(df: DataFrame) -> DataFrame:
    """Round doubles to six places and give timestamps as text to the second."""
    out = []
    for name, dtype in df.dtypes:
        c = F.col(name)
        if dtype == "double":
            c = F.round(c, 6)
        elif dtype.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(name))
    return df.select(*out)


# -- sources and sinks --------------------------------------------------------


@query
def scan_transactions(spark, sf_dir):
    return tidy(transactions(spark, sf_dir))


@query
def csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "csv")
    sources.write_csv(raw_transactions(spark, sf_dir), path)
    return tidy(sources.read_raw_csv(spark, path))


@query
def parquet_roundtrip(spark, sf_dir):
    path = new_path(spark, "parquet")
    sources.write_table(transactions(spark, sf_dir), path, sort_by=["tx_datetime", "customer_id"])
    return tidy(sources.read_table(spark, path))


# -- data quality -------------------------------------------------------------


@query
def dedup_transactions(spark, sf_dir):
    return tidy(quality.dedup(raw_transactions(spark, sf_dir), ["transaction_id"]))


@query
def dedup_lineitem(spark, sf_dir):
    """Copies of a key that differ: the survivor is the first by all other columns."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return tidy(quality.dedup(lines, ["l_orderkey", "l_linenumber"]))


@query
def valid_rows(spark, sf_dir):
    return tidy(quality.drop_invalid(raw_transactions(spark, sf_dir)))


@query
def valid_datetimes(spark, sf_dir):
    parsed = quality.parse_datetime(raw_transactions(spark, sf_dir))
    return tidy(quality.require_not_null(parsed, "tx_datetime"))


@query
def parse_datetime(spark, sf_dir):
    return tidy(quality.parse_datetime(raw_transactions(spark, sf_dir)).select("transaction_id", "tx_datetime"))


@query
def bad_datetimes(spark, sf_dir):
    return tidy(quality.bad_datetimes(raw_transactions(spark, sf_dir)))


@query
def removed_duplicates(spark, sf_dir):
    return tidy(quality.duplicates(raw_transactions(spark, sf_dir), ["transaction_id"]))


@query
def removed_invalid(spark, sf_dir):
    return tidy(quality.invalid_rows(raw_transactions(spark, sf_dir)))


@query
def removed_outliers(spark, sf_dir):
    return tidy(quality.outliers(transactions(spark, sf_dir), FENCED, exact=True))


@query
def quantile_bounds(spark, sf_dir):
    return tidy(quality.quantiles(transactions(spark, sf_dir), FENCED, (0.25, 0.5, 0.75), exact=True))


@query
def iqr_bounds(spark, sf_dir):
    return tidy(quality.iqr_bounds(transactions(spark, sf_dir), FENCED, exact=True))


@query
def iqr_filter(spark, sf_dir):
    return tidy(quality.iqr_filter(transactions(spark, sf_dir), FENCED, exact=True))


@query
def iqr_filter_joint(spark, sf_dir):
    return tidy(quality.iqr_filter(transactions(spark, sf_dir), FENCED, mode="joint", exact=True))


@query
def pseudonymised(spark, sf_dir):
    return tidy(quality.pseudonymise(raw_transactions(spark, sf_dir), ["customer_id", "terminal_id"], SALT))


@query
def k_anonymous(spark, sf_dir):
    """Ranges of three quasi-identifiers that at least ``K`` transactions share."""
    table = transactions(spark, sf_dir).select("transaction_id", "tx_amount", *QUASI)
    return tidy(anonymity.k_anonymous(table, QUASI, K, accuracy=1_000_000))


@query
def latest_per_customer(spark, sf_dir):
    return tidy(quality.latest_by(transactions(spark, sf_dir), ["customer_id"], ["tx_datetime", "transaction_id"]))


@query
def quality_report(spark, sf_dir):
    return quality.report(raw_transactions(spark, sf_dir), iqr_columns=CLEAN_FENCES, exact=True)


@query
def clean_transactions(spark, sf_dir):
    return tidy(jobs.clean(raw_transactions(spark, sf_dir), CLEAN_FENCES, exact=True, staged=True))


@query
def clean_transactions_approx(spark, sf_dir):
    """Cleaning as it runs on large tables: approximate fences, one pass per column."""
    return tidy(jobs.clean(raw_transactions(spark, sf_dir)))


# -- rolling features ---------------------------------------------------------

_IDS = ["transaction_id", "customer_id", "terminal_id"]


@query
def rolling_customer_count(spark, sf_dir):
    rolled = features.rolling_count(transactions(spark, sf_dir), "customer_id", features.CUSTOMER_COUNT)
    return tidy(rolled.select(*_IDS, *[features.CUSTOMER_COUNT.format(n) for n in FRAMES]))


@query
def rolling_customer_mean(spark, sf_dir):
    rolled = features.rolling_mean(transactions(spark, sf_dir), "customer_id", features.CUSTOMER_MEAN)
    return tidy(rolled.select(*_IDS, *[features.CUSTOMER_MEAN.format(n) for n in FRAMES]))


@query
def rolling_terminal_count(spark, sf_dir):
    rolled = features.rolling_count(transactions(spark, sf_dir), "terminal_id", features.TERMINAL_COUNT)
    return tidy(rolled.select(*_IDS, *[features.TERMINAL_COUNT.format(n) for n in FRAMES]))


@query
def rolling_features(spark, sf_dir):
    return tidy(features.rolling_features(transactions(spark, sf_dir)).select(*_IDS, *MESSAGE_FIELDS[4:]))


@query
def rolling_features_days(spark, sf_dir):
    rolled = features.rolling_features(transactions(spark, sf_dir), frames_by="days")
    means = [features.CUSTOMER_MEAN.format(n) for n in FRAMES]
    # half a unit in the sixth place is possible (a frame of 32 rows); both sides lift it off the edge
    lifted = rolled.withColumns({m: F.col(m) + 1e-9 for m in means})
    return tidy(lifted.select(*_IDS, *MESSAGE_FIELDS[4:]))


@query
def feature_table(spark, sf_dir):
    return tidy(jobs.build_features(transactions(spark, sf_dir)))


# -- sorting, sampling, balancing ---------------------------------------------


@query
def sorted_topn(spark, sf_dir):
    return tidy(transactions(spark, sf_dir).orderBy(F.col("tx_amount").desc(), "transaction_id").limit(100))


@query
def random_rows(spark, sf_dir):
    return tidy(sampling.random_rows(transactions(spark, sf_dir), 100, SEED, "transaction_id"))


@query
def hash_sample(spark, sf_dir):
    return tidy(sampling.sample(transactions(spark, sf_dir), 0.1, SEED, key="transaction_id"))


@query
def hash_split(spark, sf_dir):
    ids = transactions(spark, sf_dir).select("transaction_id", LABEL)
    first, second = sampling.split(ids, [0.8, 0.2], SEED, key="transaction_id")
    return first.withColumn("part", F.lit("train")).unionByName(second.withColumn("part", F.lit("test")))


@query
def class_counts(spark, sf_dir):
    return sampling.class_ratio(transactions(spark, sf_dir))


@query
def oversample(spark, sf_dir):
    return tidy(sampling.oversample(transactions(spark, sf_dir)))


# -- model preparation --------------------------------------------------------


@query
def minmax_bounds(spark, sf_dir):
    return tidy(mlprep.minmax_bounds(transactions(spark, sf_dir), ["tx_amount", "tx_time_seconds", "tx_time_days"]))


@query
def minmax_scaled(spark, sf_dir):
    table = sources.keyed_features(spark, sf_dir)
    scaled = mlprep.minmax_scale(table, MESSAGE_FIELDS)
    return tidy(scaled.select("transaction_id", *[f"{c}_scaled" for c in MESSAGE_FIELDS]))


@query
def category_index(spark, sf_dir):
    return mlprep.index_categories(transactions(spark, sf_dir))


@query
def category_onehot(spark, sf_dir):
    indexed = mlprep.encode_categories(transactions(spark, sf_dir))
    encoded = mlprep.onehot(indexed, "tx_fraud_scenario_index", 4, prefix="scenario")
    return encoded.select("transaction_id", "tx_fraud_scenario_index", "scenario_0", "scenario_1", "scenario_2")


# -- evaluation ---------------------------------------------------------------


@query
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion(scored(spark, sf_dir))


@query
def precision_recall_f1(spark, sf_dir):
    return tidy(evaluate.prf(evaluate.confusion(scored(spark, sf_dir))))


@query
def accuracy(spark, sf_dir):
    return tidy(evaluate.accuracy(scored(spark, sf_dir)))


@query
def weighted_f1(spark, sf_dir):
    return tidy(evaluate.weighted_f1(scored(spark, sf_dir)))


@query
def roc_auc(spark, sf_dir):
    return tidy(evaluate.roc_auc(scored(spark, sf_dir)))


@query
def pr_curve(spark, sf_dir):
    return tidy(evaluate.pr_curve(scored(spark, sf_dir)))


@query
def pr_auc(spark, sf_dir):
    return tidy(evaluate.pr_auc(scored(spark, sf_dir)))


@query
def threshold_sweep(spark, sf_dir):
    return tidy(evaluate.threshold_sweep(scored(spark, sf_dir)))


@query
def compare_models(spark, sf_dir):
    return tidy(evaluate.compare_models(scored(spark, sf_dir), MODELS))


@query
def joined_predictions(spark, sf_dir):
    """Two models scored separately, joined by transaction, where they disagree."""
    both = scored(spark, sf_dir)
    new = both.select("transaction_id", LABEL, "score", "prediction")
    old = both.select("transaction_id", F.col("score_old").alias("score"), F.col("prediction_old").alias("prediction"))
    return tidy(evaluate.join_predictions(new, old).filter("prediction <> prediction_old"))


@query
def meets_goals(spark, sf_dir):
    long = evaluate.stack_models(scored(spark, sf_dir), MODELS)
    return tidy(evaluate.meets_goals(evaluate.confusion(long, by=["model"])))


@query
def metric_rows(spark, sf_dir):
    both = scored(spark, sf_dir)
    compared = evaluate.metric_rows(evaluate.compare_models(both, MODELS), "run-1")
    sweep = evaluate.threshold_sweep(evaluate.stack_models(both, MODELS), by=["model"])
    return tidy(compared.unionByName(evaluate.sweep_rows(sweep, "run-1")))


@query
def metric_log(spark, sf_dir):
    """The last of two logged runs."""
    rows, path = settle(metric_rows(spark, sf_dir), "metrics"), new_path(spark, "metric-log")
    for run in ("run-1", "run-2"):
        evaluate.log_metrics(rows.withColumn("run_id", F.lit(run)), path)
    return evaluate.latest_run(spark.read.parquet(path))


@query
def metric_averages(spark, sf_dir):
    """Three repeats, a third of the transactions each."""
    table = scored(spark, sf_dir)
    sides = F.array(
        F.struct(F.lit("new").alias("model"), F.col("prediction").alias("said")),
        F.struct(F.lit("old").alias("model"), F.col("prediction_old").alias("said")),
    )
    long = table.select(LABEL, (F.col("transaction_id") % 3).alias("rep"), F.inline(sides))
    per_rep = evaluate.prf(evaluate.confusion(long, prediction="said", by=["model", "rep"]))
    names = {"precision": "precision", "recall": "recall", "f1": "f1"}
    return tidy(evaluate.average_runs(evaluate.metric_rows(per_rep, "run-1", names)))


# -- training -----------------------------------------------------------------


def _logistic(spark, sf_dir):
    """A stored feature table and a model fitted to it; fitting reads the table several times."""
    table = settle(sources.keyed_features(spark, sf_dir), "features")
    return table, train.logistic_pipeline().fit(table)


@query
def linear_fit(spark, sf_dir):
    table = transactions(spark, sf_dir)
    model = train.linear_pipeline().fit(table)
    return tidy(train.score(model, table).select("transaction_id", LABEL, "prediction"))


@query
def linear_fit_amount(spark, sf_dir):
    """The same pipeline on one column, where the fit has a closed form in SQL."""
    table = transactions(spark, sf_dir)
    model = train.linear_pipeline(columns=["tx_amount"]).fit(table)
    return tidy(train.score(model, table).select("transaction_id", LABEL, "prediction"))


@query
def logistic_fit(spark, sf_dir):
    table, model = _logistic(spark, sf_dir)
    return tidy(evaluate.scores(train.score(model, table)).select("transaction_id", LABEL, "score", "prediction"))


def _amount_model(spark, table):
    """A model of one column, saved and loaded again; its predictions have a closed form in SQL."""
    path = new_path(spark, "model")
    train.save_model(train.linear_pipeline(columns=["tx_amount"]).fit(table), path)
    return train.load_model(path)


@query
def batch_score(spark, sf_dir):
    """Save a model, load it and score the table with it."""
    table = transactions(spark, sf_dir)
    return tidy(train.score(_amount_model(spark, table), table).select("transaction_id", LABEL, "prediction"))


@query
def batch_score_logistic(spark, sf_dir):
    table, model = _logistic(spark, sf_dir)
    path = new_path(spark, "model")
    train.save_model(model, path)
    loaded = train.load_model(path)
    return tidy(evaluate.scores(train.score(loaded, table)).select("transaction_id", LABEL, "score", "prediction"))


@query
def model_stages(spark, sf_dir):
    """Index, one-hot and assemble the scenario with Spark ML, and scale the result."""
    stages = [*mlprep.scenario_stages(use_scenario=True), mlprep.scaler()]
    table = transactions(spark, sf_dir)
    prepared = Pipeline(stages=stages).fit(table).transform(table)
    vector = vector_to_array("scaledFeatures")
    names = ["amount", "seconds", "days", *[f"scenario_{i}" for i in range(3)]]
    columns = [vector[i].alias(n) for i, n in enumerate(names)]
    return tidy(prepared.select("transaction_id", "tx_fraud_scenario_index", *columns))


@query
def baseline_training(spark, sf_dir):
    trained = jobs.train_baseline(transactions(spark, sf_dir))
    return tidy(trained.metrics)


@query
def cv_metrics(spark, sf_dir):
    """Training with validation, judged against an earlier model."""
    table = settle(jobs.build_features(transactions(spark, sf_dir)), "features")
    earlier = train.logistic_pipeline(max_iter=1).fit(table)
    return tidy(jobs.train_validated(table, fraction=1.0, previous=earlier).metrics)


@query
def cv_folds(spark, sf_dir):
    """How many rows of either class each fold holds out."""
    return sampling.folds(transactions(spark, sf_dir), 3, SEED, "transaction_id").groupBy("fold", LABEL).agg(F.count(F.lit(1)).alias("rows"))


@query
def bootstrap_metrics(spark, sf_dir):
    """Two models compared over repeats drawn with replacement, all in one pass."""
    return tidy(evaluate.bootstrap(scored(spark, sf_dir), MODELS, "transaction_id", reps=25, seed=SEED))


# -- messages and streams -----------------------------------------------------


@query
def encode_messages(spark, sf_dir):
    """Messages decoded again: field values, not the text, are compared."""
    good, _ = decode(sources.messages(spark, sf_dir))
    return tidy(good)


@query
def decode_rejects(spark, sf_dir):
    return mark(sources.faulty_messages(spark, sf_dir)).filter(F.col("rejected") != "").select("key", "rejected")


def _run(spark, rows: DataFrame, name: str) -> DataFrame:
    """Run a stream over all there is and read what it wrote."""
    path, checkpoint = new_path(spark, name), new_path(spark, f"{name}-checkpoint")
    write_messages(rows, "parquet", {"path": path}, checkpoint, available_now=True).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


@query
def stream_decode(spark, sf_dir):
    inbox = new_path(spark, "messages")
    sources.messages(spark, sf_dir).write.parquet(inbox)
    good, _ = decode(read_messages(spark, "parquet", {"path": inbox}))
    return tidy(_run(spark, good, "decoded"))


@query
def stream_replay(spark, sf_dir):
    """Messages 0 to 1999 of an endless producer, in two runs on one checkpoint."""
    table = settle(sources.keyed_features(spark, sf_dir), "features")
    rows = numbered_messages(table, SEED, key="transaction_id")
    inbox, out, checkpoint = (new_path(spark, n) for n in ("numbers", "replayed", "replayed-checkpoint"))
    for first in (0, 1000):
        spark.range(first, first + 1000).select(F.col("id").alias("value")).write.mode("append").parquet(inbox)
        numbers = spark.readStream.schema("value long").parquet(inbox)
        write_messages(replay_stream(numbers, rows, SEED), "parquet", {"path": out}, checkpoint, available_now=True).awaitTermination()
    sent = spark.read.schema("number long, key string, value string").parquet(out)
    good, _ = decode(sent)
    return tidy(good.select("number", "key", "tx_time_seconds", "tx_amount"))


@query
def delivery_ledger(spark, sf_dir):
    """What a topic delivered, with planted gaps and repeats."""
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    at = F.col("event_id")
    sent = table.select(
        F.concat(F.lit("topic "), (at % 2).cast("string")).alias("topic"),
        (F.floor(at / 2) % 3).cast("int").alias("partition"),
        F.floor(at / 6).cast("long").alias("offset"),
        F.when(at % 10 == 0, 2).otherwise(1).alias("copies"),
    ).where((at % 11 != 0) & (F.floor(at / 500) % 3 != 1))
    return ledger(sent.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))), block=64)


@query
def latency_summary(spark, sf_dir):
    """Time to answer per day, from the sketches of several micro-batches; delays are planted by rule, some negative."""
    inbox, out, log, checkpoint = (new_path(spark, n) for n in ("asked", "answered", "latency", "latency-checkpoint"))
    table = transactions(spark, sf_dir).select("transaction_id", epoch_seconds("tx_datetime").alias("sent"))
    delay = F.pow(F.col("transaction_id") * 7919 % 9973, 2).cast("long") + 1
    delay = F.when(F.col("transaction_id") % 50 == 0, F.lit(-5).cast("long")).otherwise(delay)
    asked = table.select("transaction_id", F.timestamp_seconds("sent").alias("ts"), F.timestamp_micros(F.col("sent") * 1_000_000 + delay).alias("answered"))
    asked.repartition(3, "transaction_id").write.parquet(inbox)
    stream = spark.readStream.schema(asked.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    answer_timed(stream, out, log, checkpoint, answered="answered", window="1 day").awaitTermination()
    days = summary_of_latency(spark.read.parquet(log))
    return tidy(days.withColumn("window_start", F.unix_timestamp("window_start")))


def _scored_stream(spark, messages, model, name):
    inbox = new_path(spark, "messages")
    messages.write.parquet(inbox)
    return _run(spark, predictions(read_messages(spark, "parquet", {"path": inbox}), model), name)


@query
def stream_score(spark, sf_dir):
    table = settle(sources.keyed_features(spark, sf_dir), "features")
    model = _amount_model(spark, transactions(spark, sf_dir))
    scored_ = _scored_stream(spark, to_messages(table, key="transaction_id"), model, "predictions")
    return tidy(scored_.select("key", "prediction"))


@query
def stream_score_logistic(spark, sf_dir):
    table, model = _logistic(spark, sf_dir)
    scored_ = _scored_stream(spark, to_messages(table, key="transaction_id"), model, "predictions")
    return tidy(scored_.select("key", "prediction"))


@query
def stream_rejects(spark, sf_dir):
    """Messages that a scoring stream answers with the fields at fault."""
    model = _amount_model(spark, transactions(spark, sf_dir))
    scored_ = _scored_stream(spark, sources.faulty_messages(spark, sf_dir), model, "predictions")
    return scored_.filter((F.col("rejected") != "") & F.col("prediction").isNull()).select("key", "rejected")


@query
def stream_prediction_counts(spark, sf_dir):
    """Counts of the windows that the watermark has closed, in append mode."""
    inbox = new_path(spark, "scored")
    table = scored(spark, sf_dir).select(F.timestamp_seconds(F.unix_timestamp("tx_datetime")).alias("ts"), "prediction")
    table.write.parquet(inbox)
    counts = prediction_counts(spark.readStream.schema(table.schema).parquet(inbox), window="1 hour")
    return _run(spark, counts, "counts").withColumn("window_start", F.unix_timestamp("window_start"))


def _halves(spark, sf_dir):
    """The transactions in two parts of time."""
    table = transactions(spark, sf_dir)
    middle = table.agg(((F.min("tx_time_seconds") + F.max("tx_time_seconds")) / 2).cast("long")).scalar()
    early = F.col("tx_time_seconds") <= middle
    return table.filter(early), table.filter(~early)


@query
def stream_rolling_features(spark, sf_dir):
    """Rolling features of a stream that arrives in two parts, the second after a restart."""
    inbox, out, checkpoint = (new_path(spark, n) for n in ("inbox", "rolled", "rolled-checkpoint"))
    for part in _halves(spark, sf_dir):
        part.write.mode("append").parquet(inbox)
        source = spark.readStream.schema(part.schema).parquet(inbox)
        rolling_features_batches(source, out, checkpoint).awaitTermination()
    rolled = spark.read.parquet(out)
    return tidy(rolled.select(*_IDS, *MESSAGE_FIELDS[4:]))


@query
def stream_rolling_customers(spark, sf_dir):
    """The same for customers, with keyed state."""
    inbox, out, checkpoint = (new_path(spark, n) for n in ("inbox", "rolled", "rolled-checkpoint"))
    for part in _halves(spark, sf_dir):
        part.write.mode("append").parquet(inbox)
        rolled = rolling_features_stream(spark.readStream.schema(part.schema).parquet(inbox))
        write_messages(rolled, "parquet", {"path": out}, checkpoint, available_now=True).awaitTermination()
    names = [f"avg_transaction_{s}_{n}" for s in ("count", "mean") for n in FRAMES]
    return tidy(spark.read.schema(rolled.schema).parquet(out).select("transaction_id", "customer_id", *names))


@query
def stream_rolling_state(spark, sf_dir):
    """The same from state per customer and terminal, with all columns of a transaction."""
    inbox, out, checkpoint = (new_path(spark, n) for n in ("inbox", "rolled", "rolled-checkpoint"))
    for part in _halves(spark, sf_dir):
        part.write.mode("append").parquet(inbox)
        source = spark.readStream.schema(part.schema).parquet(inbox)
        rolling_features_state(source, out, checkpoint).awaitTermination()
    rolled = spark.read.parquet(out)
    return tidy(rolled.select(*_IDS, "tx_datetime", "tx_amount", LABEL, *MESSAGE_FIELDS[4:], "late"))


@query
def prediction_counts_(spark, sf_dir):
    table = scored(spark, sf_dir).withColumn("ts", F.timestamp_seconds(F.unix_timestamp("tx_datetime")))
    counts = prediction_counts(table, window="1 hour")
    return counts.withColumn("window_start", F.unix_timestamp("window_start"))


def _asked_and_told(spark, sf_dir):
    """Requests, of which some get a reply, some two and some one that is too late."""
    table = transactions(spark, sf_dir)
    every = lambda n: F.col("transaction_id") % n == 0
    ts = F.timestamp_seconds(F.unix_timestamp("tx_datetime"))
    key = F.col("transaction_id").cast("string").alias("key")
    requests = table.select(key, F.lit("request").alias("value"), ts.alias("ts"))
    delays = F.array_compact(F.array(F.when(every(7), 120), F.when(every(2), 5), F.when(every(5), 20)))
    replies = table.select(key, ts.alias("sent"), F.explode(delays).alias("delay")).select(
        "key",
        F.concat(F.lit("reply after "), F.col("delay").cast("string")).alias("value"),
        F.timestamp_seconds(F.unix_timestamp("sent") + F.col("delay")).alias("ts"),
    )
    return requests, replies


def _shared_keys(spark, sf_dir):
    """The same requests and replies, with one of 97 keys by the second of the request: many share a key."""
    requests, replies = _asked_and_told(spark, sf_dir)
    asked = requests.select("key", F.col("ts").alias("asked"))
    shared = F.concat(F.lit("k"), (F.unix_timestamp("asked") % 97).cast("string")).alias("key")
    named = F.concat("value", F.lit(" "), "key").alias("value")
    told = replies.join(asked, "key").select(shared, named, "ts")
    return requests.select(F.concat(F.lit("k"), (F.unix_timestamp("ts") % 97).cast("string")).alias("key"), named, "ts"), told


def _match_run(spark, paths, schema_, out, checkpoint):
    matched = match_replies(*[spark.readStream.schema(schema_).parquet(p) for p in paths], within="1 minute")
    with setting(spark, PROVIDER, ROCKSDB):
        query_ = write_messages(matched, "parquet", {"path": out}, checkpoint, available_now=True)
    query_.awaitTermination()


def _matched(matched):
    return matched.select(
        "key", "value", F.unix_timestamp("ts").alias("ts"), "reply", F.unix_timestamp("reply_ts").alias("reply_ts")
    )


@query
def match_replies_(spark, sf_dir):
    return _matched(match_replies(*_asked_and_told(spark, sf_dir), within="1 minute"))


@query
def stream_match_replies(spark, sf_dir):
    """The same on streams that arrive in two parts of time, with keys that many requests share."""
    sides = [settle(side, "side") for side in _shared_keys(spark, sf_dir)]
    middle, newest = sides[0].agg(F.percentile_approx("ts", 0.5), F.max("ts")).first()
    paths = [new_path(spark, "side") for _ in sides]
    out, checkpoint = new_path(spark, "matched"), new_path(spark, "matched-checkpoint")
    schema_ = "key string, value string, ts timestamp"
    # a last row of either side, much later, lets the watermark pass all others
    end = F.lit(newest) + F.expr("INTERVAL 1 DAY")
    closing = spark.range(1).select(F.lit("end").alias("key"), F.lit("end").alias("value"), end.alias("ts"))
    for part in (F.col("ts") <= F.lit(middle), F.col("ts") > F.lit(middle)):
        for side, path in zip(sides, paths, strict=True):
            side.filter(part).write.mode("append").parquet(path)
        _match_run(spark, paths, schema_, out, checkpoint)
    for path in paths:
        closing.write.mode("append").parquet(path)
    _match_run(spark, paths, schema_, out, checkpoint)
    return _matched(spark.read.schema("key string, value string, ts timestamp, reply string, reply_ts timestamp").parquet(out).filter("key <> 'end'"))
