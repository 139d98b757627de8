"""Date and time expressions.

All of them work on ``TIMESTAMP_NTZ`` (the driver tables load that way)
and on session-UTC ``TIMESTAMP`` alike, without depending on the session
time zone: epoch offsets are computed with ``timestamp_diff`` against the
NTZ epoch instead of ``unix_micros``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .contract import ColumnOrName, col

MICROS_PER_MINUTE = 60 * 1_000_000


def parse_ts(c: ColumnOrName, fmt: str | None = None) -> Column:
    """String -> timestamp (NTZ, so no zone shift)."""
    return F.to_timestamp_ntz(col(c), F.lit(fmt)) if fmt else F.to_timestamp_ntz(col(c))


def to_date(c: ColumnOrName) -> Column:
    """Timestamp -> date."""
    return F.to_date(col(c))


def month(c: ColumnOrName) -> Column:
    return F.month(col(c))


def hour(c: ColumnOrName) -> Column:
    return F.hour(col(c))


def dow_monday0(c: ColumnOrName) -> Column:
    """Day of week with Monday = 0 (pandas ``dt.dayofweek``, C14)."""
    return F.weekday(col(c))


def hour_of_week(c: ColumnOrName) -> Column:
    """``dayofweek * 24 + hour``."""
    return dow_monday0(c) * 24 + hour(c)


def parse_yyyymmdd(c: ColumnOrName) -> Column:
    """``'%Y%m%d'`` string -> date."""
    return F.to_date(col(c), "yyyyMMdd")


def as_ntz(c: ColumnOrName) -> Column:
    return col(c).cast("timestamp_ntz")


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_micros(c: ColumnOrName) -> Column:
    """Microseconds since 1970-01-01 00:00 of the wall-clock value."""
    return F.timestamp_diff("MICROSECOND", _epoch(), as_ntz(c))


def from_epoch_micros(c: ColumnOrName) -> Column:
    """Inverse of ``epoch_micros``; returns TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", col(c), _epoch())


def round_to_minutes(c: ColumnOrName, minutes: int) -> Column:
    """Round to the nearest ``minutes`` bucket, ties to even.

    ``rint`` is IEEE round-half-even, the rule pandas ``dt.round`` uses.
    """
    step = minutes * MICROS_PER_MINUTE
    return from_epoch_micros((F.rint(epoch_micros(c) / F.lit(float(step))) * step).cast("long"))


def floor_to_minutes(c: ColumnOrName, minutes: int) -> Column:
    """Start of the tumbling ``minutes`` bucket holding the timestamp."""
    step = minutes * MICROS_PER_MINUTE
    return from_epoch_micros(F.floor(epoch_micros(c) / F.lit(step)) * step)
