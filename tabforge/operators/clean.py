"""Row and value cleaning.

Each operator is one projection or one filter, so Catalyst fuses a chain
of them into a single whole-stage-codegen span and pushes filters on
source columns into the scan.  Filling with a statistic of the split
(P11, P12) needs that statistic first: it is computed by a distributed
aggregate and only the scalar reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.contract import flag, keep_unless
from .quantile import exact_quantiles, exact_quantiles_multi

_OPS = {"<": lambda c, v: c < v, "<=": lambda c, v: c <= v,
        ">": lambda c, v: c > v, ">=": lambda c, v: c >= v}


def drop_outside(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Drop rows with a value below ``lo`` or above ``hi``; a missing
    value is kept (C7).  One filter, pushed into the scan when the columns
    come straight from parquet."""
    cond = F.lit(False)
    for c, (lo, hi) in bounds.items():
        if lo is not None:
            cond = cond | (F.col(c) < lo)
        if hi is not None:
            cond = cond | (F.col(c) > hi)
    return df.where(keep_unless(cond))


def where_present(df: DataFrame, cond: Column, present: Sequence[str] = ()) -> DataFrame:
    """Boolean-mask filter AND-ed with ``notnull`` on some columns."""
    for c in present:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def assign_where(df: DataFrame, name: str, default, cond: Column, value) -> DataFrame:
    """``df[name] = default; df.loc[cond, name] = value``."""
    return df.withColumn(name, F.when(F.coalesce(cond, F.lit(False)), F.lit(value))
                         .otherwise(F.lit(default)))


def null_beyond(df: DataFrame, rules: Mapping[str, tuple[str, float]]) -> DataFrame:
    """``df[c][df[c] op v] = NaN`` for each rule ``c: (op, v)``."""
    exprs = {c: F.when(_OPS[op](F.col(c), v), F.lit(None)).otherwise(F.col(c))
             for c, (op, v) in rules.items()}
    return df.withColumns(exprs)


def sentinel_to_null(df: DataFrame, sentinels: Mapping[str, object]) -> DataFrame:
    """Replace a sentinel value (``'XNA'``, ``365243``) with missing."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(v)) for c, v in sentinels.items()})


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """P10: ``fillna`` with constants."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                           for c, v in values.items()})


def fill_median(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Fill missing values with the split's own exact median."""
    cols = list(cols)
    medians = {c: exact_quantiles(df, c, [0.5])[0] for c in cols}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(medians[c]).cast(df.schema[c].dataType))
                           for c in cols})


def fill_mean(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Fill missing values with the split's own mean (one aggregate
    job; a single row of scalars reaches the driver)."""
    cols = list(cols)
    row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(row[c]).cast(df.schema[c].dataType))
                           for c in cols})


def fill_stats(df: DataFrame, median: Iterable[str] = (), mean: Iterable[str] = ()) -> DataFrame:
    """P11 + P12 together: exact medians and means of the split in the same
    three jobs (one row of scalars reaches the driver)."""
    median, mean = list(median), list(mean)
    qs, means = exact_quantiles_multi(df, {c: [0.5] for c in median},
                                      extra_aggs={c: F.avg(c) for c in mean})
    fills = {c: qs[c][0] for c in median}
    fills.update(means)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                           for c, v in fills.items()})


def drop_any_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """``dropna(how='any')``."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def isin_flag(c: str | Column, values: Sequence) -> Column:
    """Membership in a short fixed list -> 1/0 (missing -> 0)."""
    cc = F.col(c) if isinstance(c, str) else c
    return flag(cc.isin(list(values)))
