"""Table and message schemas (fixed values)."""

from pyspark.sql import types as T

RAW_TX = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("tx_datetime", T.StringType()),
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("terminal_id", T.IntegerType()),
        T.StructField("tx_amount", T.DoubleType()),
        T.StructField("tx_time_seconds", T.LongType()),
        T.StructField("tx_time_days", T.LongType()),
        T.StructField("tx_fraud", T.IntegerType()),
        T.StructField("tx_fraud_scenario", T.IntegerType()),
    ]
)

DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

CLEAN_TX = T.StructType(
    [T.StructField(f.name, T.TimestampType() if f.name == "tx_datetime" else f.dataType) for f in RAW_TX]
)

#: columns that must be present and non-negative in a valid transaction
NON_NEGATIVE = [f.name for f in RAW_TX if f.name != "tx_datetime"]

#: columns whose interquartile fences are applied, in this order
IQR_COLUMNS = ["customer_id", "terminal_id", "tx_time_seconds", "transaction_id", "tx_time_days"]

#: rows (or days) before the current one in each rolling frame
FRAMES = (1, 7, 30)

#: identifiers and the fraud scenario never reach the feature table
FEATURE_DROPS = ["transaction_id", "customer_id", "terminal_id", "tx_fraud_scenario"]

LABEL = "tx_fraud"

MESSAGE_FIELDS = [
    "tx_datetime",
    "tx_amount",
    "tx_time_seconds",
    "tx_time_days",
    "avg_transaction_count_1",
    "avg_transaction_mean_1",
    "avg_transaction_count_7",
    "avg_transaction_mean_7",
    "avg_transaction_count_30",
    "avg_transaction_mean_30",
    "avg_transaction_terminal_id_count_1",
    "avg_transaction_terminal_id_count_7",
    "avg_transaction_terminal_id_count_30",
]

_MESSAGE_LONGS = {"tx_datetime", "tx_time_seconds", "tx_time_days"}

#: counts are read as DOUBLE, so that 5 and 5.0 both decode
MESSAGE = T.StructType(
    [T.StructField(n, T.LongType() if n in _MESSAGE_LONGS else T.DoubleType()) for n in MESSAGE_FIELDS]
)

_FEATURE_TYPES = {
    "tx_datetime": T.LongType(),
    "tx_time_seconds": T.LongType(),
    "tx_time_days": T.LongType(),
}


def _feature_type(name: str) -> T.DataType:
    if name in _FEATURE_TYPES:
        return _FEATURE_TYPES[name]
    return T.FloatType() if "_count_" in name else T.DoubleType()


FEATURES = T.StructType(
    [T.StructField(n, _feature_type(n)) for n in MESSAGE_FIELDS[:4]]
    + [T.StructField(LABEL, T.IntegerType())]
    + [T.StructField(n, _feature_type(n)) for n in MESSAGE_FIELDS[4:]]
)
