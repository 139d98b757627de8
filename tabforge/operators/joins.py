"""Joins of small fitted tables onto large frames.

Statistics frames (one row per key combination), fitted encodings and
bucket labels are usually tiny, but their size depends on the data, so
they are never broadcast on faith.  ``join_measured`` writes the small side
once to the shared folder (it has to be computed anyway), measures what was
written, and broadcasts it only when that is under the session's
``spark.sql.autoBroadcastJoinThreshold``; otherwise it falls back to a
shuffle join (sort-merge with AQE skew splitting).

Doing the measurement *before* planning the join matters at scale: left
to AQE alone, the large side's shuffle stage runs concurrently with the
small side's aggregation, so the fact table is shuffled once before AQE
switches to a broadcast join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
          T.LongType: 8, T.DoubleType: 8, T.FloatType: 4, T.TimestampType: 8, T.TimestampNTZType: 8}


def row_width(df: DataFrame) -> int:
    """Rough bytes per row in a broadcast hash relation, texts not counted."""
    return 16 + sum(_WIDTH.get(type(f.dataType), 32) for f in df.schema.fields)


def text_bytes(df: DataFrame):
    """Aggregate: bytes in all string columns (0 without any)."""
    total = F.lit(0)
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            total = total + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
    return F.coalesce(F.sum(total.cast("long")), F.lit(0))


def broadcast_limit(df: DataFrame) -> int:
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    raw = raw.strip().lower()
    mult = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(mult, key=len, reverse=True):
        if raw.endswith(suffix):
            return int(float(raw[: -len(suffix)]) * mult[suffix])
    return int(raw)


def measured(small: DataFrame) -> tuple[DataFrame, bool]:
    """The small side, written once, and whether it fits a broadcast: rows
    times fixed width plus the bytes of its texts."""
    limit = broadcast_limit(small)
    if limit < 0:
        return small, False
    small = written(small, "measured")
    size = small.agg(F.count(F.lit(1)).alias("n"), text_bytes(small).alias("b")).first()
    return small, size["n"] * row_width(small) + size["b"] <= limit


def join_measured(large: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "left") -> DataFrame:
    """``large.join(small, on, how)`` with the small side broadcast only
    after its measured size is under the broadcast threshold."""
    small, fits = measured(small)
    return large.join(F.broadcast(small) if fits else small, on=on, how=how)
