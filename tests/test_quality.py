import pytest
from pyspark.sql import functions as F

from txrisk import jobs, quality, schema, sources
from txrisk.sources import raw_transactions, transactions


def values(df):
    return sorted(map(str, df.collect()))


def test_only_the_exact_form_is_a_date(spark):
    texts = ["2020-01-01 10:00:00", "2020-02-30 00:00:00", "2020-01-01 24:00:00", "bad", "2020-01-01 1:2:3", None, "2020-01-01"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, tx_datetime string")
    parsed = quality.parse_datetime(df).filter("tx_datetime IS NOT NULL").collect()
    assert [r.i for r in parsed] == [0]
    assert {r.i for r in quality.bad_datetimes(df).collect()} == {1, 2, 3, 4, 6}


def test_csv_is_read_leniently(spark, tmp_path):
    (tmp_path / "tx.csv").write_text(
        "#transaction_id,tx_datetime,customer_id,terminal_id,tx_amount,tx_time_seconds,tx_time_days,tx_fraud,tx_fraud_scenario\n"
        "1,2020-01-01 10:00:00,5,6,7.5,8,9,1,2\n"
        "2,2020-01-01 10:00:00,five,6,7.5,8,9,1,2\n"
        "3,2020-01-01 10:00:00,5\n"
        "4,,5,6,7.5,8,9,1,2\n"
    )
    rows = {r.transaction_id: r for r in sources.read_raw_csv(spark, str(tmp_path)).collect()}
    assert set(rows) == {1, 2, 3, 4}
    assert tuple(rows[1]) == (1, "2020-01-01 10:00:00", 5, 6, 7.5, 8, 9, 1, 2)
    assert rows[2].customer_id is None and rows[2].terminal_id == 6
    assert rows[3].customer_id == 5 and rows[3].tx_amount is None
    assert rows[4].tx_datetime is None


def test_null_is_not_valid(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, -1), (0, 0)], "a int, b int")
    assert values(quality.drop_invalid(df, ["a", "b"])) == ["Row(a=0, b=0)", "Row(a=1, b=2)"]
    assert quality.invalid_rows(df, ["a", "b"]).count() == 2


def test_dedup_keeps_the_same_row_on_any_layout(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    keys = ["l_orderkey", "l_linenumber"]
    a, b = quality.dedup(lines, keys), quality.dedup(lines.repartition(7), keys)
    assert values(a) == values(b)
    assert a.count() == lines.dropDuplicates(keys).count() == quality.dedup(lines, keys, keep="any").count()
    last = quality.latest_by(lines, keys, ["l_partkey"])
    assert values(last.groupBy().agg(F.sum("l_partkey"))) == values(
        lines.groupBy(*keys).agg(F.max("l_partkey").alias("p")).groupBy().agg(F.sum("p").alias("sum(l_partkey)"))
    )


def test_dedup_cuts_copies_before_the_shuffle(spark, sf_dir):
    plan = quality.dedup(raw_transactions(spark, sf_dir), ["transaction_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_diff_is_except_all(spark, monkeypatch):
    monkeypatch.setattr(quality, "COPIES_PER_TASK", 10)
    df = spark.range(300).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).alias("a"), F.lit("x").alias("b"))
    df = df.unionAll(spark.createDataFrame([(None, "x"), (None, "x")], df.schema))
    kept = df.dropDuplicates()
    assert values(quality.diff_removed(df, kept)) == values(df.exceptAll(kept))
    assert values(quality.duplicates(df, ["a"])) == values(df.exceptAll(quality.dedup(df, ["a"])))


@pytest.mark.parametrize("column", ["tx_amount", "transaction_id", "terminal_id", "flag", "tied", "spread"])
def test_exact_quantiles_of_many_rows(spark, sf_dir, monkeypatch, column):
    df = transactions(spark, sf_dir).withColumns(
        {
            "flag": (F.col("transaction_id") % 4 == 0).cast("int"),
            "tied": F.when(F.col("transaction_id") % 3 > 0, 5.5).otherwise(F.col("tx_amount")),
            "spread": F.exp(F.col("tx_amount")),
        }
    )
    qs = [0.01, 0.25, 0.5, 0.75, 0.99]
    want = df.agg(*[F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {column})") for q in qs]).first()
    plain = {r.q: r["value"] for r in quality.quantiles(df, [column], qs, exact=True).collect()}
    monkeypatch.setattr(quality, "EXACT_ROWS", 20)
    narrowed = {r.q: r["value"] for r in quality.quantiles(df, [column], qs, exact=True).collect()}
    assert plain == narrowed == dict(zip(qs, want))


def test_halving_finds_every_rank(spark):
    for values_, kind in (([3, -9, 3, 4, 10**15], "long"), ([0.5, 0.25, 1e300, -2.0, 0.5], "double")):
        df = spark.createDataFrame([(v,) for v in values_], f"v {kind}")
        searches = [quality._Search("v", r, min(values_), max(values_), 5) for r in range(1, 6)]
        while open_ := [s for s in searches if s.low != s.high]:
            quality._halve(df, open_)
        assert [s.low for s in searches] == sorted(values_)


def test_quantiles_of_many_columns_take_the_same_passes(spark, sf_dir, monkeypatch):
    """Passes are counted: one column and one share need as many as six columns and five shares."""
    monkeypatch.setattr(quality, "EXACT_ROWS", 20)
    calls = []
    plain = quality._one
    monkeypatch.setattr(quality, "_one", lambda df, columns: calls.append(len(columns)) or plain(df, columns))
    df = transactions(spark, sf_dir).withColumns({f"a{i}": F.col("tx_amount") * (i + 1) for i in range(6)})
    quality.quantiles(df, ["a0"], [0.3], exact=True)
    single = len(calls)
    calls.clear()
    found = quality.quantiles(df, [f"a{i}" for i in range(6)], [0.1, 0.3, 0.5, 0.7, 0.9], exact=True)
    assert single >= 4 and len(calls) <= single + 2
    base = {r.q: r["value"] for r in found.filter("column = 'a0'").collect()}
    assert all(r["value"] == base[r.q] * (int(r.column[1:]) + 1) for r in found.collect())


def test_quantiles_of_infinite_values(spark, monkeypatch):
    inf, nan = float("inf"), float("nan")
    values_ = [-inf, -inf, -1e308, 0.0, 1.0, 1e308, inf, nan]
    df = spark.createDataFrame([(v, None) for v in values_] + [(None, None)], "v double, none int")
    qs = [0.125 * i for i in range(1, 9)]
    for limit in (1_000_000, 1):
        monkeypatch.setattr(quality, "EXACT_ROWS", limit)
        found = {(r.column, r.q): r["value"] for r in quality.quantiles(df, ["v", "none"], qs, exact=True).collect()}
        assert [found["v", q] for q in qs[:7]] == values_[:7] and found["v", 1.0] != found["v", 1.0]
        assert {found["none", q] for q in qs} == {None}


def test_approximate_quantiles_and_empty_columns(spark):
    df = spark.range(1, 1001).select(F.col("id").alias("a"), F.lit(None).cast("double").alias("e"))
    got = {(r.column, r.q): r["value"] for r in quality.quantiles(df, ["a", "e"]).collect()}
    assert got == {("a", 0.25): 250.0, ("a", 0.75): 750.0, ("e", 0.25): None, ("e", 0.75): None}
    assert quality.quantiles(df, ["e"], exact=True).filter("value IS NOT NULL").count() == 0


def test_sequential_and_joint_fences_differ(spark):
    df = spark.createDataFrame([(i, i) for i in range(8)] + [(1000, 2), (1001, 3), (3, 500)], "a int, b int")
    both = [quality.iqr_filter(df, ["a", "b"], mode=m, exact=True).count() for m in ("sequential", "joint")]
    assert both == [8, 8]
    assert quality.outliers(df, ["a", "b"], exact=True).count() == 3
    with pytest.raises(ValueError):
        quality.fences(df, ["a"], mode="other")


def test_pseudonyms(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "customer_id int")
    got = [r[0] for r in quality.pseudonymise(df, ["customer_id"], "s").collect()]
    assert got[0] == got[1] != got[2] and got[3] is None and len(got[0]) == 64
    assert got[0] != quality.pseudonymise(df, ["customer_id"], "t").first()[0]


def test_clean_ignores_staging_and_layout(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir)
    fences = [*schema.IQR_COLUMNS, "tx_amount"]
    a = values(jobs.clean(raw, fences, exact=True, staged=True))
    b = values(jobs.clean(raw.repartition(5), fences, exact=True, staged=False))
    assert a == b
    approx = jobs.clean(raw, mode="joint")
    assert approx.dtypes == [(f.name, f.dataType.simpleString()) for f in schema.CLEAN_TX]


def test_written_table_is_in_order(spark, sf_dir, tmp_path):
    tx = transactions(spark, sf_dir)
    path = str(tmp_path / "sorted")
    sources.write_table(tx, path, n_files=4, sort_by=["tx_datetime", "customer_id"])
    back = sources.read_table(spark, path)
    assert values(back) == values(tx)
    ranges = (
        back.groupBy(F.input_file_name().alias("f")).agg(F.min("tx_datetime").alias("lo"), F.max("tx_datetime").alias("hi"))
    ).orderBy("lo").collect()
    assert len(ranges) == 4
    assert all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:]))
    sources.write_table(tx, str(tmp_path / "parts"), partition_by=["tx_fraud"], n_files=2)
    assert {r.tx_fraud for r in sources.read_table(spark, str(tmp_path / "parts")).select("tx_fraud").distinct().collect()} == {0, 1}


def test_shared_folder_is_the_one_the_session_names(spark):
    from txrisk.session import new_path, settle, shared_dir

    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == folder
    assert new_path(spark, "x").startswith(folder) and new_path(spark, "x") != new_path(spark, "x")
    df = spark.range(5).withColumn("part", F.spark_partition_id())
    kept = settle(df)
    assert values(kept) == values(df) and folder in kept.inputFiles()[0]


def test_report_counts_add_up(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir)
    got = {r.rule: (r.rows_in, r.rows_removed) for r in quality.report(raw, exact=True).collect()}
    unique = quality.dedup(raw, ["transaction_id"])
    assert got["duplicates"] == (raw.count(), quality.duplicates(raw, ["transaction_id"]).count())
    assert got["invalid"] == (unique.count(), quality.invalid_rows(unique).count())
    valid = quality.drop_invalid(unique)
    assert got["bad_datetimes"] == (valid.count(), quality.bad_datetimes(valid).count())
    assert got["outliers"] == (valid.count(), quality.outliers(valid, exact=True).count())


def test_epoch_does_not_depend_on_the_zone(spark):
    from txrisk.functions import epoch_micros, epoch_seconds

    texts = ["1970-01-01 00:00:00.25", "2024-03-10 02:30:00.5", "2024-03-10 03:00:00", "2024-11-03 01:30:00.000001"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("cast(t AS timestamp_ntz) AS ts")
    want = [250_000, 1_710_037_800_500_000, 1_710_039_600_000_000, 1_730_597_400_000_001]
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = df.select(epoch_micros("ts"), epoch_seconds("ts")).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert [r[0] for r in got] == want
        assert [r[1] for r in got] == [w // 1_000_000 for w in want]
