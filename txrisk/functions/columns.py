"""Column expressions shared by the operators; all stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txrisk.schema import DATETIME_FORMAT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_datetime(text: Column | str, fmt: str = DATETIME_FORMAT) -> Column:
    """Text to timestamp; NULL where the text is not exactly in ``fmt``."""
    return F.try_to_timestamp(_col(text), F.lit(fmt))


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a timestamp."""
    return F.unix_timestamp(_col(ts))


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970, ordered like the timestamp itself (from 1970 on).

    Whole seconds do not depend on the session time zone, and the part below a second
    is the same in every zone, so neither does the sum.
    """
    below = F.pmod(F.unix_micros(_col(ts).cast("timestamp")), F.lit(1_000_000))
    return epoch_seconds(ts) * 1_000_000 + below


def ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b`` as a double, 0 where ``b`` is 0."""
    return F.coalesce(F.try_divide(_col(a).cast("double"), _col(b).cast("double")), F.lit(0.0))


def hash_order(key: Column | str, seed: int | str) -> Column:
    """A text to sort by for a seeded random order that no layout changes."""
    return F.md5(F.concat_ws("|", _col(key).cast("string"), F.lit(str(seed))))


def hash_bucket(key: Column | str, seed: int | str, buckets: int) -> Column:
    """A seeded bucket in ``0 .. buckets-1`` (60 bits at most); equal keys share a bucket."""
    head = F.substring(hash_order(key, seed), 1, 15)
    return F.conv(head, 16, 10).cast("long") % buckets


def pseudonym(value: Column | str, salt: str) -> Column:
    """A salted SHA-256 of an identifier; NULL stays NULL."""
    value = _col(value).cast("string")
    return F.when(value.isNotNull(), F.sha2(F.concat_ws(":", F.lit(salt), value), 256))
