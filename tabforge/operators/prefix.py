"""Running sums and gapless numbers over a whole table, without a window
that holds the table in one task.

Rows are cut into as many ranges of the order column as there are shuffle
partitions, at approximate quantiles, so ranges follow the rows and not the
scale of the column: a burst of values within a second spreads like any
other.  Each range is summed on its own; the sums of the ranges before it
(one row per range) are its offset.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def range_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def cut_points(df: DataFrame, order: str, ranges: int) -> list:
    """At most ``ranges - 1`` sorted values that cut the rows evenly."""
    if ranges < 2:
        return []
    probs = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    return sorted(set(df.agg(F.percentile_approx(order, probs, 20 * ranges)).first()[0] or []))


def range_number(value: Column, cuts: Sequence, kind: str = "double") -> Column:
    """Number of cut points below ``value``, by binary search in a literal
    array: one short expression however many cuts there are."""
    if not cuts:
        return F.lit(0)
    return search(value, F.array(*[F.lit(c) for c in cuts]).cast(f"array<{kind}>"), F.lit(len(cuts)), len(cuts))


def search(value: Column, cuts: Column, size: Column, most: int) -> Column:
    """Number of elements below ``value`` in a sorted array of ``size``
    elements, ``most`` at most."""
    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        return F.when(s["lo"] >= s["hi"], s) \
            .when(F.get(cuts, mid) < value, F.struct((mid + 1).alias("lo"), s["hi"].alias("hi"))) \
            .otherwise(F.struct(s["lo"].alias("lo"), mid.alias("hi")))

    whole = F.struct(F.lit(0).alias("lo"), size.cast("int").alias("hi"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(most.bit_length())), whole, halve)["lo"]


def running_sums(df: DataFrame, order: str, sums: Mapping[str, str], upto: bool = True, ranges: int | None = None) -> DataFrame:
    """Add, per entry ``out -> column`` of ``sums``, the sum of ``column``
    over the rows with a smaller ``order`` (and, with ``upto``, over the row
    itself).  ``order`` must be a number, unique and not null; ``df`` is read
    three times, so it should be a stored table."""
    ranges = ranges or range_count(df)
    kind = df.schema[order].dataType.simpleString()
    ranged = df.withColumn("rng__", range_number(F.col(order), cut_points(df, order, ranges), kind))
    totals = ranged.groupBy("rng__").agg(*[F.sum(c).alias(f"__all_{out}") for out, c in sums.items()])
    before = Window.orderBy("rng__").rowsBetween(Window.unboundedPreceding, -1)    # one row per range
    offsets = totals.select("rng__", *[F.coalesce(F.sum(f"__all_{out}").over(before), F.lit(0)).alias(f"__off_{out}") for out in sums])
    inside = Window.partitionBy("rng__").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if upto else -1)
    return (ranged.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"__sum_{out}") for out, c in sums.items()])
            .join(F.broadcast(offsets), "rng__")                                   # at most `ranges` rows
            .select(*df.columns, *[(F.col(f"__off_{out}") + F.col(f"__sum_{out}")).alias(out) for out in sums]))


def numbered(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Add ``out``: the place of each row in ascending ``order``, from 0 and
    without gaps.  Spark's range partitioning deals the rows; a partition's
    first number is the rows of the partitions before it."""
    from ..session import written
    part = written(df.repartitionByRange(range_count(df), *order).withColumn("__part", F.spark_partition_id()), "numbered")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)     # one row per partition
    starts = part.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows")) \
        .select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return part.withColumn("__place", place).join(F.broadcast(starts), "__part") \
        .select(*df.columns, (F.col("__start") + F.col("__place")).cast("long").alias(out))
