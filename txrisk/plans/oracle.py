"""The same queries in plain SQL, for an independent engine on the same tables."""

from __future__ import annotations

from txrisk.operators.evaluate import _AT_MOST
from txrisk.plans.queries import CLEAN_FENCES, FENCED, QUASI, SALT, SEED, K
from txrisk.schema import FRAMES, IQR_COLUMNS, MESSAGE_FIELDS, NON_NEGATIVE, RAW_TX

_TX = """
tx AS (
  SELECT event_id AS transaction_id, ts AS tx_datetime, user_id::INTEGER AS customer_id,
         json_extract_string(props, '$.k')::INTEGER AS terminal_id, value AS tx_amount,
         floor(epoch(ts))::BIGINT - 1704067200 AS tx_time_seconds,
         floor((floor(epoch(ts))::BIGINT - 1704067200) / 86400)::BIGINT AS tx_time_days,
         (event_type = 'error')::INTEGER AS tx_fraud,
         (CASE WHEN event_type = 'error' THEN 1 + event_id % 3 ELSE 0 END)::INTEGER AS tx_fraud_scenario
  FROM events)"""

_RAW = (
    _TX
    + """,
raw AS (
  SELECT transaction_id,
         CASE WHEN transaction_id % 29 = 0 THEN 'bad-date'
              WHEN transaction_id % 23 = 0 THEN '2024-02-30 00:00:00'
              ELSE strftime(tx_datetime, '%Y-%m-%d %H:%M:%S') END AS tx_datetime,
         customer_id,
         CASE WHEN transaction_id % 19 <> 0 THEN terminal_id END AS terminal_id,
         (CASE WHEN transaction_id % 17 = 0 THEN -tx_amount ELSE tx_amount END)
           * (CASE WHEN transaction_id % 31 = 0 THEN 100.0::DOUBLE ELSE 1.0::DOUBLE END) AS tx_amount,
         tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario
  FROM tx CROSS JOIN unnest(range(0, CASE WHEN transaction_id % 10 = 0 THEN 2 ELSE 1 END)) AS copies(c)),
parsed AS (
  SELECT * REPLACE (strftime(try_strptime(tx_datetime, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS tx_datetime)
  FROM raw),
deduped AS (SELECT DISTINCT * FROM raw),
valid AS (SELECT * FROM deduped WHERE """
    + " AND ".join(f"{c} >= 0" for c in NON_NEGATIVE)
    + ")"
)

_SCORED = (
    _TX
    + """,
scored AS (
  SELECT *, least(1.0::DOUBLE, tx_amount / 200.0::DOUBLE) AS score,
         1.0::DOUBLE - least(1.0::DOUBLE, tx_amount / 200.0::DOUBLE) AS score_old,
         (least(1.0::DOUBLE, tx_amount / 200.0::DOUBLE) >= 0.5)::INTEGER AS prediction,
         (1.0::DOUBLE - least(1.0::DOUBLE, tx_amount / 200.0::DOUBLE) >= 0.5)::INTEGER AS prediction_old
  FROM tx),
stacked AS (
  SELECT transaction_id, 'new' AS model, tx_fraud, score, prediction FROM scored
  UNION ALL
  SELECT transaction_id, 'old', tx_fraud, score_old, prediction_old FROM scored)"""
)

_CELLS = """count(*) FILTER (WHERE tx_fraud = 1 AND prediction = 1) AS tp,
       count(*) FILTER (WHERE tx_fraud = 0 AND prediction = 1) AS fp,
       count(*) FILTER (WHERE tx_fraud = 1 AND prediction = 0) AS fn,
       count(*) FILTER (WHERE tx_fraud = 0 AND prediction = 0) AS tn"""

#: counts -> precision, recall, f1
_RATIOS = """
prf AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM (SELECT *, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0.0) AS precision,
               coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0.0) AS recall FROM counts))"""

_AUC = """
auc AS (
  SELECT model, (sum(r) FILTER (WHERE tx_fraud = 1) - n1 * (n1 + 1) / 2.0) / (n1 * n0::DOUBLE) AS roc_auc
  FROM (
    SELECT model, tx_fraud,
           rank() OVER (PARTITION BY model ORDER BY score) + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS r,
           count(*) FILTER (WHERE tx_fraud = 1) OVER (PARTITION BY model) AS n1,
           count(*) FILTER (WHERE tx_fraud = 0) OVER (PARTITION BY model) AS n0
    FROM stacked)
  GROUP BY model, n1, n0)"""

_SWEEP = """
sweep AS (
  SELECT *, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0.0) AS precision,
         coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0.0) AS recall
  FROM (
    SELECT model, threshold, count(*) FILTER (WHERE tx_fraud = 1 AND score >= threshold) AS tp,
           count(*) FILTER (WHERE tx_fraud = 0 AND score >= threshold) AS fp,
           count(*) FILTER (WHERE tx_fraud = 1 AND score < threshold) AS fn
    FROM stacked CROSS JOIN (SELECT unnest(range(0, 10)) / 9.0::DOUBLE AS threshold)
    GROUP BY model, threshold))"""

_STEPS = """
steps AS (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS positives
  FROM (SELECT score, count(*) FILTER (WHERE tx_fraud = 1) AS pos, count(*) FILTER (WHERE tx_fraud = 0) AS neg
        FROM scored GROUP BY score)
  WINDOW w AS (ORDER BY score DESC)),
curve AS (
  SELECT score, pos, neg, tp::BIGINT AS tp, fp::BIGINT AS fp, tp / (tp + fp)::DOUBLE AS precision,
         tp / positives::DOUBLE AS recall FROM steps)"""


def _frames(by: str) -> str:
    cols = []
    for key, prefix, mean in (
        ("customer_id", "avg_transaction_{}_{}", True),
        ("terminal_id", "avg_transaction_terminal_id_{}_{}", False),
    ):
        for n in FRAMES:
            if by == "rows":
                frame = f"(PARTITION BY {key} ORDER BY tx_datetime, transaction_id ROWS {n} PRECEDING)"
            else:
                frame = f"(PARTITION BY {key} ORDER BY floor(epoch(tx_datetime))::BIGINT RANGE {n * 86400} PRECEDING)"
            cols.append(f"(count(transaction_id) OVER {frame})::FLOAT AS {prefix.format('count', n)}")
            if mean:
                cols.append(f"avg(tx_amount) OVER {frame} AS {prefix.format('mean', n)}")
    return _TX + ",\nrolled AS (SELECT *, " + ",\n  ".join(cols) + " FROM tx)"


def _anonymous(rounds: int = 24) -> str:
    """Recursive median cuts, so many rounds one after the other; a group that cannot be cut stays as it is."""
    cols = list(enumerate(QUASI))
    ends = ", ".join(f"(max({c}) - min({c}))::DOUBLE AS s{i}" for i, c in cols)
    parts = [f"ends AS (SELECT {ends} FROM tx)", f"r0 AS MATERIALIZED (SELECT transaction_id, tx_amount, {', '.join(QUASI)}, '' AS g FROM tx)"]
    good = {i: f"(le{i} >= {K} AND n - le{i} >= {K})" for i, _ in cols}
    also = {i: f"(lt{i} >= {K} AND n - lt{i} >= {K})" for i, _ in cols}
    for r in range(rounds):
        medians = ", ".join(f"list_sort(list({c}))[(count(*) + 1) // 2] AS m{i}, (max({c}) - min({c}))::DOUBLE AS w{i}" for i, c in cols)
        sides = ", ".join(f"count(*) FILTER ({c} <= m{i}) AS le{i}, count(*) FILTER ({c} < m{i}) AS lt{i}" for i, c in cols)
        widths = ", ".join(f"CASE WHEN {good[i]} OR {also[i]} THEN w{i} / s{i} END AS x{i}" for i, _ in cols)
        widest = "greatest(" + ", ".join(f"x{i}" for i, _ in cols) + ")"
        low = " ".join(f"WHEN x{i} = {widest} THEN CASE WHEN {good[i]} THEN {c} <= m{i} ELSE {c} < m{i} END" for i, c in cols)
        parts += [
            f"m{r} AS MATERIALIZED (SELECT g, count(*) AS n, {medians} FROM r{r} GROUP BY g)",
            f"t{r} AS MATERIALIZED (SELECT *, {widths} FROM (SELECT g, any_value(COLUMNS('^(n|[mw][0-9])$')), {sides} FROM r{r} JOIN m{r} USING (g) GROUP BY g), ends)",
            f"""r{r + 1} AS MATERIALIZED (SELECT transaction_id, tx_amount, {', '.join(QUASI)},
              g || coalesce(CASE CASE {low} END WHEN true THEN 'l' WHEN false THEN 'h' END, '') AS g FROM r{r} JOIN t{r} USING (g))""",
        ]
    ranges = ", ".join(f"min({c}) OVER w AS {c}_low, max({c}) OVER w AS {c}_high" for c in QUASI)
    return (
        f"WITH {_TX.strip()}, " + ",\n".join(parts)
        + f" SELECT transaction_id, round(tx_amount, 6) AS tx_amount, {ranges}, count(*) OVER w AS group_size FROM r{rounds} WINDOW w AS (PARTITION BY g)"
    )


_ROWS = _frames("rows")
_DAYS = _frames("days")
_DOUBLES = {"tx_amount", "score", "score_old"} | {f"avg_transaction_mean_{n}" for n in FRAMES}


def _pick(*names: str, text_time: bool = False) -> str:
    """A select list with doubles rounded."""
    out = []
    for n in names:
        if n in _DOUBLES:
            out.append(f"round({n}, 6) AS {n}")
        elif n == "tx_datetime" and text_time:
            out.append("strftime(tx_datetime, '%Y-%m-%d %H:%M:%S') AS tx_datetime")
        else:
            out.append(n)
    return ", ".join(out)


_COLS = _pick(*RAW_TX.names)
_TEXTED = _pick(*RAW_TX.names, text_time=True)
_IDS = ["transaction_id", "customer_id", "terminal_id"]
_ROLLED = _pick(*_IDS, *MESSAGE_FIELDS[4:])


def _fence_chain(source: str, columns: list[str], joint: bool = False) -> tuple[str, str]:
    """CTEs ``f0, f1, ...`` with fences and ``k1, k2, ...`` with the rows they keep; the name of the last."""
    ctes, kept = [], source
    for i, c in enumerate(columns):
        basis = source if joint else kept
        ctes.append(
            f"f{i} AS (SELECT q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (SELECT"
            f" quantile_disc({c}, 0.25)::DOUBLE AS q1, quantile_disc({c}, 0.75)::DOUBLE AS q3 FROM {basis}))"
        )
        ctes.append(f"k{i} AS (SELECT {kept}.* FROM {kept}, f{i} WHERE {c} BETWEEN lower AND upper)")
        kept = f"k{i}"
    return ",\n".join(ctes), kept


def _hash(key: str) -> str:
    return f"md5(concat_ws('|', {key}::VARCHAR, '{SEED}'))"


def _bucket(key: str) -> str:
    return f"('0x' || substr({_hash(key)}, 1, 15))::BIGINT"


def statements() -> dict[str, str]:
    """SQL per query name; queries that fit a model have none."""
    tx, raw, sc = f"WITH {_TX}", f"WITH {_RAW}", f"WITH {_SCORED}"
    fenced, kept = _fence_chain("tx", FENCED)
    joint, kept_joint = _fence_chain("tx", FENCED, joint=True)
    cleaned, kept_clean = _fence_chain("valid", CLEAN_FENCES)
    # approximate quartiles are exact on tables this small
    cleaned_approx, kept_approx = _fence_chain("valid", IQR_COLUMNS)
    scaled = ", ".join(
        f"round(CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 0.5 ELSE ({c}::DOUBLE - min({c}::DOUBLE) OVER ())"
        f" / (max({c}::DOUBLE) OVER () - min({c}::DOUBLE) OVER ()) END, 6) AS {c}_scaled"
        for c in MESSAGE_FIELDS
    )
    epoch_rolled = "SELECT * REPLACE (floor(epoch(tx_datetime))::BIGINT AS tx_datetime) FROM rolled"
    counts = f"counts AS (SELECT {_CELLS} FROM scored)"
    model_counts = f"counts AS (SELECT model, {_CELLS} FROM stacked GROUP BY model)"
    message = ", ".join(
        f"round({n}::DOUBLE, 6) AS {n}" if n not in ("tx_datetime", "tx_time_seconds", "tx_time_days") else n
        for n in MESSAGE_FIELDS
    )
    decoded = f"WITH {_ROWS} SELECT transaction_id::VARCHAR AS key, {message} FROM ({epoch_rolled})"
    valid = " AND ".join(f"{c} >= 0" for c in NON_NEGATIVE)
    fitted = f"""{tx} SELECT {{}}, round(tx_amount * slope + base, 6) AS prediction
        FROM tx, (SELECT regr_slope(tx_fraud, tx_amount) AS slope, regr_intercept(tx_fraud, tx_amount) AS base FROM tx)"""
    logged = f"""{sc}, {model_counts}, {_RATIOS}, {_AUC}, {_SWEEP}
        SELECT 'run-{{}}' AS run_id, model, metric, round(value, 6) AS value FROM (
          SELECT model, 'avg_F1_Score' AS metric, f1 AS value FROM prf
          UNION ALL SELECT model, 'avg_ROC_AUC', roc_auc FROM auc
          UNION ALL SELECT model, printf('avg_Precision_Threshold_%.2f', threshold), precision FROM sweep
          UNION ALL SELECT model, printf('avg_Recall_Threshold_%.2f', threshold), recall FROM sweep)"""
    rejects = f"""{tx} SELECT transaction_id::VARCHAR AS key,
        CASE WHEN transaction_id % 7 = 0 THEN '{",".join(MESSAGE_FIELDS)}' ELSE 'tx_amount' END AS rejected
        FROM tx WHERE transaction_id % 7 = 0 OR transaction_id % 11 = 0 OR transaction_id % 13 = 0"""
    windows = """SELECT (floor(epoch(tx_datetime))::BIGINT // 3600) * 3600 AS window_start,
        count(*) AS predictions, count(*) FILTER (WHERE prediction = 1) AS positives FROM scored GROUP BY 1"""
    return {
        # sources and sinks
        "scan_transactions": f"{tx} SELECT {_TEXTED} FROM tx",
        "csv_roundtrip": f"{raw} SELECT {_COLS} FROM raw",
        "parquet_roundtrip": f"{tx} SELECT {_TEXTED} FROM tx",
        # data quality
        "dedup_transactions": f"{raw} SELECT {_COLS} FROM deduped",
        "dedup_lineitem": """SELECT * EXCLUDE (rn)
            REPLACE (round(l_quantity, 6) AS l_quantity, round(l_extendedprice, 6) AS l_extendedprice,
              round(l_discount, 6) AS l_discount, round(l_tax, 6) AS l_tax,
              strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate)
            FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                  ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                    l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem) WHERE rn = 1""",
        "valid_rows": f"{raw} SELECT {_COLS} FROM raw WHERE {valid}",
        "valid_datetimes": f"{raw} SELECT {_COLS} FROM parsed WHERE tx_datetime IS NOT NULL",
        "parse_datetime": f"{raw} SELECT transaction_id, tx_datetime FROM parsed",
        "bad_datetimes": f"""{raw} SELECT {_COLS} FROM raw WHERE tx_datetime IS NOT NULL
            AND try_strptime(tx_datetime, '%Y-%m-%d %H:%M:%S') IS NULL""",
        "removed_duplicates": f"{raw} SELECT {_COLS} FROM (SELECT * FROM raw EXCEPT ALL SELECT * FROM deduped)",
        "removed_invalid": f"{raw} SELECT {_COLS} FROM (SELECT * FROM raw EXCEPT ALL SELECT * FROM raw WHERE {valid})",
        "removed_outliers": f"{tx}, {fenced} SELECT {_TEXTED} FROM (SELECT * FROM tx EXCEPT ALL SELECT * FROM {kept})",
        "quantile_bounds": f"{tx} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {q}::DOUBLE AS q, round(quantile_disc({c}, {q})::DOUBLE, 6) AS value FROM tx"
            for c in FENCED
            for q in (0.25, 0.5, 0.75)
        ),
        "iqr_bounds": f"{tx}, {fenced} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", round(lower, 6) AS lower, round(upper, 6) AS upper FROM f{i}"
            for i, c in enumerate(FENCED)
        ),
        "iqr_filter": f"{tx}, {fenced} SELECT {_TEXTED} FROM {kept}",
        "iqr_filter_joint": f"{tx}, {joint} SELECT {_TEXTED} FROM {kept_joint}",
        "pseudonymised": f"""{raw} SELECT {_COLS} FROM (SELECT * REPLACE (
            sha256('{SALT}:' || customer_id::VARCHAR) AS customer_id,
            sha256('{SALT}:' || terminal_id::VARCHAR) AS terminal_id) FROM raw)""",
        "k_anonymous": _anonymous(),
        "latency_summary": f"""{tx}, d AS (SELECT floor(epoch(tx_datetime) / 86400)::BIGINT * 86400 AS window_start,
              CASE WHEN transaction_id % 50 = 0 THEN -5 ELSE (transaction_id * 7919 % 9973) * (transaction_id * 7919 % 9973) + 1 END AS us FROM tx),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY us) AS rn, count(*) OVER (PARTITION BY window_start) AS n,
              CASE WHEN us <= 0 THEN 0 ELSE 2 * pow(1.01::DOUBLE / 0.99, ceil(ln(us) / ln(1.01::DOUBLE / 0.99))) / (1.01::DOUBLE / 0.99 + 1) END / 1000 AS near FROM d)
            SELECT window_start, count(*) AS messages, round(sum(us)::DOUBLE / 1000, 6) AS total_ms, round(min(us)::DOUBLE / 1000, 6) AS least_ms,
              round(max(us)::DOUBLE / 1000, 6) AS most_ms,
              {", ".join(f"round(max(near) FILTER (rn = greatest(1, ceil(n * {q}::DOUBLE))), 6) AS p{p}_ms" for q, p in ((0.5, 50), (0.95, 95), (0.99, 99)))}
            FROM ranked GROUP BY window_start""",
        "latest_per_customer": f"""{tx} SELECT {_TEXTED} FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
            ORDER BY tx_datetime DESC, transaction_id DESC) AS rn FROM tx) WHERE rn = 1""",
        "quality_report": f"""{raw}, {cleaned}, n AS (SELECT (SELECT count(*) FROM raw) AS raw_n,
            (SELECT count(*) FROM deduped) AS unique_n, (SELECT count(*) FROM valid) AS valid_n,
            (SELECT count(*) FROM valid WHERE tx_datetime IS NOT NULL
               AND try_strptime(tx_datetime, '%Y-%m-%d %H:%M:%S') IS NULL) AS bad_n,
            (SELECT count(*) FROM {kept_clean}) AS kept_n)
            SELECT 1::INTEGER AS step, 'duplicates' AS rule, raw_n AS rows_in, raw_n - unique_n AS rows_removed FROM n
            UNION ALL SELECT 2, 'invalid', unique_n, unique_n - valid_n FROM n
            UNION ALL SELECT 3, 'bad_datetimes', valid_n, bad_n FROM n
            UNION ALL SELECT 4, 'outliers', valid_n, valid_n - kept_n FROM n""",
        "clean_transactions": f"""{raw}, {cleaned} SELECT {_COLS} FROM (SELECT * REPLACE (
            strftime(try_strptime(tx_datetime, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS tx_datetime)
            FROM {kept_clean})""",
        "clean_transactions_approx": f"""{raw}, {cleaned_approx} SELECT {_COLS} FROM (SELECT * REPLACE (
            strftime(try_strptime(tx_datetime, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS tx_datetime)
            FROM {kept_approx})""",
        # rolling features
        "rolling_customer_count": f"WITH {_ROWS} SELECT "
        + _pick(*_IDS, *[f"avg_transaction_count_{n}" for n in FRAMES])
        + " FROM rolled",
        "rolling_customer_mean": f"WITH {_ROWS} SELECT "
        + _pick(*_IDS, *[f"avg_transaction_mean_{n}" for n in FRAMES])
        + " FROM rolled",
        "rolling_terminal_count": f"WITH {_ROWS} SELECT "
        + _pick(*_IDS, *[f"avg_transaction_terminal_id_count_{n}" for n in FRAMES])
        + " FROM rolled",
        "rolling_features": f"WITH {_ROWS} SELECT {_ROLLED} FROM rolled",
        # half a unit in the sixth place is possible (a frame of 32 rows); both sides lift it off the edge
        "rolling_features_days": f"""WITH {_DAYS} SELECT {_ROLLED} FROM (SELECT * REPLACE (
            {", ".join(f"avg_transaction_mean_{n} + 1e-9 AS avg_transaction_mean_{n}" for n in FRAMES)}) FROM rolled)""",
        "feature_table": f"WITH {_ROWS} SELECT {_pick(*MESSAGE_FIELDS[:4], 'tx_fraud', *MESSAGE_FIELDS[4:])} FROM ({epoch_rolled})",
        # sorting, sampling, balancing
        "sorted_topn": f"{tx} SELECT {_TEXTED} FROM (SELECT * FROM tx ORDER BY tx_amount DESC, transaction_id LIMIT 100)",
        "random_rows": f"""{tx} SELECT {_TEXTED} FROM
            (SELECT * FROM tx ORDER BY {_hash('transaction_id')}, transaction_id LIMIT 100)""",
        "hash_sample": f"{tx} SELECT {_TEXTED} FROM tx WHERE {_bucket('transaction_id')} < {round(0.1 * 2**60)}",
        "hash_split": f"""{tx} SELECT transaction_id, tx_fraud,
            CASE WHEN {_bucket('transaction_id')} < {round(0.8 * 2**60)} THEN 'train' ELSE 'test' END AS part FROM tx""",
        "class_counts": f"""{tx} SELECT *, greatest(1, floor(n0 / n1))::INTEGER AS factor FROM (
            SELECT count(*) FILTER (WHERE tx_fraud = 0) AS n0, count(*) FILTER (WHERE tx_fraud = 1) AS n1 FROM tx)""",
        "oversample": f"""{tx}, k AS (SELECT greatest(1, floor(count(*) FILTER (WHERE tx_fraud = 0)
              / count(*) FILTER (WHERE tx_fraud = 1)))::BIGINT AS k FROM tx)
            SELECT {_TEXTED} FROM (SELECT * FROM tx WHERE tx_fraud = 0
              UNION ALL SELECT tx.* FROM tx, k, unnest(range(0, k)) AS copies(c) WHERE tx_fraud = 1)""",
        # model preparation
        "minmax_bounds": f"""{tx} SELECT round(min(tx_amount), 6) AS min_tx_amount,
            min(tx_time_seconds) AS min_tx_time_seconds, min(tx_time_days) AS min_tx_time_days,
            round(max(tx_amount), 6) AS max_tx_amount, max(tx_time_seconds) AS max_tx_time_seconds,
            max(tx_time_days) AS max_tx_time_days FROM tx""",
        "minmax_scaled": f"WITH {_ROWS} SELECT transaction_id, {scaled} FROM ({epoch_rolled})",
        "category_index": f"""{tx} SELECT tx_fraud_scenario, n,
            (row_number() OVER (ORDER BY n DESC, tx_fraud_scenario::VARCHAR) - 1)::BIGINT AS "index"
            FROM (SELECT tx_fraud_scenario, count(*) AS n FROM tx GROUP BY tx_fraud_scenario)""",
        "category_onehot": f"""{tx}, cats AS (SELECT tx_fraud_scenario AS category,
              (row_number() OVER (ORDER BY count(*) DESC, tx_fraud_scenario::VARCHAR) - 1)::BIGINT AS i
              FROM tx GROUP BY tx_fraud_scenario)
            SELECT transaction_id, i AS tx_fraud_scenario_index, (i = 0)::INTEGER AS scenario_0,
                   (i = 1)::INTEGER AS scenario_1, (i = 2)::INTEGER AS scenario_2
            FROM tx JOIN cats ON tx_fraud_scenario = category""",
        "model_stages": f"""{tx}, cats AS (SELECT tx_fraud_scenario AS category,
              (row_number() OVER (ORDER BY count(*) DESC, tx_fraud_scenario::VARCHAR) - 1)::DOUBLE AS i
              FROM tx GROUP BY tx_fraud_scenario)
            SELECT transaction_id, i AS tx_fraud_scenario_index, {", ".join(
                f"round(({c}::DOUBLE - min({c}::DOUBLE) OVER ()) / (max({c}::DOUBLE) OVER () - min({c}::DOUBLE) OVER ()), 6) AS {n}"
                for c, n in (("tx_amount", "amount"), ("tx_time_seconds", "seconds"), ("tx_time_days", "days"))
            )}, {", ".join(f"(i = {i})::INTEGER::DOUBLE AS scenario_{i}" for i in range(3))}
            FROM tx JOIN cats ON tx_fraud_scenario = category""",
        # training
        "linear_fit_amount": fitted.format("transaction_id, tx_fraud"),
        "batch_score": fitted.format("transaction_id, tx_fraud"),
        "stream_score": fitted.format("transaction_id::VARCHAR AS key"),
        # evaluation
        "confusion_matrix": f"{sc} SELECT {_CELLS} FROM scored",
        "precision_recall_f1": f"""{sc}, {counts}, {_RATIOS} SELECT tp, fp, fn, tn, round(precision, 6) AS precision,
            round(recall, 6) AS recall, round(f1, 6) AS f1 FROM prf""",
        "accuracy": f"{sc} SELECT round(avg((tx_fraud = prediction)::INTEGER::DOUBLE), 6) AS accuracy FROM scored",
        "weighted_f1": f"""{sc}, c AS (SELECT c, count(*) FILTER (WHERE tx_fraud = c AND prediction = c) AS hit,
              count(*) FILTER (WHERE tx_fraud = c) AS actual, count(*) FILTER (WHERE prediction = c) AS said
              FROM scored CROSS JOIN (VALUES (0), (1)) AS classes(c) GROUP BY c)
            SELECT round(sum(actual * coalesce(2.0 * hit / nullif(actual + said, 0), 0.0)) / sum(actual), 6) AS weighted_f1
            FROM c""",
        "roc_auc": f"{sc}, {_AUC} SELECT round(roc_auc, 6) AS roc_auc FROM auc WHERE model = 'new'",
        "pr_curve": f"""{sc}, {_STEPS} SELECT round(score, 6) AS score, pos, neg, tp, fp,
            round(precision, 6) AS precision, round(recall, 6) AS recall FROM curve""",
        "pr_auc": f"""{sc}, {_STEPS} SELECT round(sum((recall - coalesce(r0, 0.0)) * (precision + coalesce(p0, precision)) / 2), 6)
            AS pr_auc FROM (SELECT *, lag(recall) OVER (ORDER BY score DESC) AS r0,
                                   lag(precision) OVER (ORDER BY score DESC) AS p0 FROM curve)""",
        "threshold_sweep": f"""{sc}, {_SWEEP} SELECT round(threshold, 6) AS threshold, tp, fp, fn,
            round(precision, 6) AS precision, round(recall, 6) AS recall FROM sweep WHERE model = 'new'""",
        "compare_models": f"""{sc}, {model_counts}, {_RATIOS}, {_AUC} SELECT model, tp, fp, fn, tn,
            round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
            round(roc_auc, 6) AS roc_auc FROM prf JOIN auc USING (model)""",
        "joined_predictions": f"""{sc} SELECT transaction_id, tx_fraud, round(score, 6) AS score, prediction,
            round(score_old, 6) AS score_old, prediction_old FROM scored WHERE prediction <> prediction_old""",
        "meets_goals": f"""{sc}, {model_counts} SELECT model, tp, fp, fn, tn, round(recall, 6) AS recall,
            round(far, 6) AS false_alarm_rate, recall >= 0.98 AND far <= 0.05 AS meets_goals
            FROM (SELECT *, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0.0) AS recall,
                         coalesce(fp::DOUBLE / nullif(fp + tn, 0), 0.0) AS far FROM counts)""",
        "metric_rows": logged.format(1),
        "metric_log": logged.format(2),
        "metric_averages": f"""{sc}, counts AS (SELECT model, transaction_id % 3 AS rep, {_CELLS} FROM stacked
              GROUP BY model, rep), {_RATIOS}
            SELECT model, metric, round(avg(value), 6) AS value FROM (
              SELECT model, 'precision' AS metric, precision AS value FROM prf
              UNION ALL SELECT model, 'recall', recall FROM prf
              UNION ALL SELECT model, 'f1', f1 FROM prf) GROUP BY model, metric""",
        # messages and streams
        "encode_messages": decoded,
        "stream_decode": decoded,
        "decode_rejects": rejects,
        "stream_rejects": rejects,
        "stream_rolling_customers": f"WITH {_ROWS} SELECT "
        + _pick("transaction_id", "customer_id", *[f"avg_transaction_{s}_{n}" for s in ("count", "mean") for n in FRAMES])
        + " FROM rolled",
        "stream_prediction_counts": f"""{sc}, per AS ({windows})
            SELECT * FROM per WHERE window_start + 3600 <= (SELECT floor(max(epoch(tx_datetime)))::BIGINT - 600 FROM scored)""",
        "stream_rolling_features": f"WITH {_ROWS} SELECT {_ROLLED} FROM rolled",
        "stream_rolling_state": f"WITH {_ROWS} SELECT {_ROLLED}, strftime(tx_datetime, '%Y-%m-%d %H:%M:%S') AS tx_datetime,"
        " round(tx_amount, 6) AS tx_amount, tx_fraud, false AS late FROM rolled",
        "prediction_counts": f"{sc} {windows}",
        "cv_folds": f"""{tx} SELECT ({_bucket('transaction_id')} % 3)::INTEGER AS fold, tx_fraud, count(*) AS rows
            FROM tx GROUP BY ALL""",
        "bootstrap_metrics": f"""{sc}, draws AS (
              SELECT model, tx_fraud, prediction, rep, {" + ".join(f"(h >= {k})::INTEGER" for k in _AT_MOST)} AS w
              FROM (SELECT *, ('0x' || substr(md5(transaction_id::VARCHAR || '|{SEED}|' || rep::VARCHAR), 1, 15))::BIGINT AS h
                    FROM stacked CROSS JOIN unnest(range(0, 25)) AS reps(rep))),
            sums AS (SELECT rep, model, {", ".join(f"sum(CASE WHEN tx_fraud = {a} AND prediction = {b} THEN w ELSE 0 END)::DOUBLE AS {c}"
                     for c, a, b in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0)))} FROM draws GROUP BY rep, model),
            shares AS (SELECT rep, model, coalesce(tp / nullif(tp + fp, 0), 0.0) AS p, coalesce(tp / nullif(tp + fn, 0), 0.0) AS r FROM sums),
            vals AS (
              SELECT rep, model, 'precision' AS metric, p AS value FROM shares UNION ALL SELECT rep, model, 'recall', r FROM shares
              UNION ALL SELECT rep, model, 'f1', coalesce(2 * p * r / nullif(p + r, 0), 0.0) FROM shares),
            both_ AS (SELECT * FROM vals UNION ALL SELECT rep, 'new - old', metric, a.value - b.value
              FROM vals a JOIN vals b USING (rep, metric) WHERE a.model = 'new' AND b.model = 'old')
            SELECT model, metric, round(avg(value), 6) AS mean, round(quantile_disc(value, 0.025), 6) AS low,
              round(quantile_disc(value, 0.975), 6) AS high FROM both_ GROUP BY model, metric""",
        "stream_replay": f"""{tx}, numbered AS (
              SELECT *, row_number() OVER (ORDER BY {_hash('transaction_id')} || '|' || transaction_id::VARCHAR) - 1 AS i FROM tx)
            SELECT number, transaction_id::VARCHAR AS key, tx_time_seconds, round(tx_amount, 6) AS tx_amount
            FROM unnest(range(0, 2000)) AS numbers(number) JOIN numbered
              ON i = {_bucket('number')} % (SELECT count(*) FROM tx)""",
        "delivery_ledger": """WITH sent AS (
              SELECT 'topic ' || (event_id % 2)::VARCHAR AS topic, (floor(event_id / 2) % 3)::INTEGER AS part,
                floor(event_id / 6)::BIGINT AS pos, sum(CASE WHEN event_id % 10 = 0 THEN 2 ELSE 1 END) AS times
              FROM events WHERE event_id % 11 <> 0 AND floor(event_id / 500) % 3 <> 1 GROUP BY ALL),
            marked AS (SELECT *, pos - row_number() OVER (PARTITION BY topic, part ORDER BY pos) AS island FROM sent),
            ranges AS (SELECT topic, part, min(pos) AS first, max(pos) AS last, sum(times - 1)::BIGINT AS repeats
              FROM marked GROUP BY topic, part, island)
            SELECT topic, part AS partition, first, last, last - first + 1 AS messages, repeats,
              coalesce(first - lag(last) OVER (PARTITION BY topic, part ORDER BY first) - 1, 0) AS missing_before FROM ranges""",
        "stream_match_replies": f"""{tx}, asked AS (
              SELECT transaction_id, floor(epoch(tx_datetime))::BIGINT AS sent,
                'k' || (floor(epoch(tx_datetime))::BIGINT % 97)::VARCHAR AS key FROM tx),
            told AS (
              SELECT key, sent + d AS told_at, 'reply after ' || d::VARCHAR || ' ' || transaction_id::VARCHAR AS reply
              FROM asked CROSS JOIN (VALUES (7, 120), (2, 5), (5, 20)) AS delays(m, d) WHERE transaction_id % m = 0)
            SELECT a.key, 'request ' || transaction_id::VARCHAR AS value, sent AS ts, reply, told_at AS reply_ts
            FROM asked a LEFT JOIN told t ON t.key = a.key AND told_at BETWEEN sent AND sent + 60
            QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY told_at, reply) = 1""",
        "match_replies": f"""{tx} SELECT transaction_id::VARCHAR AS key, 'request' AS value, sent AS ts,
            CASE WHEN d <= 60 THEN 'reply after ' || d::VARCHAR END AS reply,
            CASE WHEN d <= 60 THEN sent + d END AS reply_ts
            FROM (SELECT transaction_id, floor(epoch(tx_datetime))::BIGINT AS sent,
                         CASE WHEN transaction_id % 2 = 0 THEN 5 WHEN transaction_id % 5 = 0 THEN 20
                              WHEN transaction_id % 7 = 0 THEN 120 END AS d FROM tx)""",
    }
