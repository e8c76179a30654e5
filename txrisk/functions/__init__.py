"""Column expressions shared by the operators."""

from txrisk.functions.columns import (
    epoch_micros,
    epoch_seconds,
    hash_bucket,
    hash_order,
    parse_datetime,
    pseudonym,
    ratio,
)

__all__ = [
    "epoch_micros",
    "epoch_seconds",
    "hash_bucket",
    "hash_order",
    "parse_datetime",
    "pseudonym",
    "ratio",
]
