"""Zone-free instant arithmetic.

Instants in this library are naive UTC (``TIMESTAMP_NTZ``).  These helpers
never go through the session time zone, so bucket edges, cooldown distances
and parsed message times are the same on every cluster whatever its zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _epoch() -> Column:
    return F.lit(EPOCH).cast("timestamp_ntz")


def epoch_micros(ts) -> Column:
    """Micros since the epoch of a naive-UTC instant."""
    return F.timestamp_diff("MICROSECOND", _epoch(), _c(ts))


def from_epoch_micros(us) -> Column:
    """Naive-UTC instant from micros since the epoch."""
    return F.timestamp_add("MICROSECOND", _c(us), _epoch())


def naive_utc(instant) -> Column:
    """A zoned instant (``TIMESTAMP``) as naive UTC."""
    return from_epoch_micros(F.unix_micros(_c(instant)))


def zoned(ts) -> Column:
    """A naive-UTC instant as a zoned ``TIMESTAMP`` (watermarks need one)."""
    return F.timestamp_micros(epoch_micros(ts))


def now_utc() -> Column:
    return naive_utc(F.current_timestamp())
