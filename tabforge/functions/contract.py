"""Missing-value and arithmetic contract.

The reference programs lean on pandas semantics: NaN is the only missing
marker, aggregates skip it, ``x/0`` is infinite, ``!= v`` is true for a
missing value and ``groupby.last`` skips missing values.  Spark differs on
each of these, so the translation lives in one place and every operator
builds on these column expressions.  All of them are JVM-side built-ins
and stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# C0 -------------------------------------------------------------------------
def nan_to_null(c: ColumnOrName) -> Column:
    """NaN -> NULL (Spark treats NaN as a value that wins max/greatest)."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


# C4 / C5 ----------------------------------------------------------------------
def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` with a zero or missing denominator giving NULL (C4)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def ratio_inf0(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Ratio followed by ``replace(inf, 0)``.

    +inf (positive over zero) becomes 0; 0/0 and negative/0 stay missing.
    """
    n, d = col(num).cast("double"), col(den).cast("double")
    return F.when((d == 0) & (n > 0), F.lit(0.0)).otherwise(F.try_divide(n, d))


# C6 ---------------------------------------------------------------------------
def flag(cond: Column) -> Column:
    """Boolean -> 0/1 with a missing comparison counting as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def flag_ne(c: ColumnOrName, value) -> Column:
    """``(c != value).astype(int)``: a missing value counts as *not equal*."""
    return (~col(c).eqNullSafe(F.lit(value))).cast("int")


def flag_eq(c: ColumnOrName, value) -> Column:
    return flag(col(c) == F.lit(value))


# C7 ---------------------------------------------------------------------------
def keep_unless(cond: Column) -> Column:
    """Filter predicate for ``drop(df[cond].index)``: rows where cond is
    missing are kept."""
    return ~F.coalesce(cond, F.lit(False))


# C1 / C2 / C8 aggregates -------------------------------------------------------
def sum0(c: ColumnOrName) -> Column:
    """Group sum with an all-missing (or empty) group giving 0."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def last_non_null(value: ColumnOrName, order: ColumnOrName) -> Column:
    """``groupby.last()``: value at the greatest ``order`` among rows whose
    value is not missing (C8).  A partial aggregate: no sort, no window."""
    v = col(value)
    return F.max_by(v, F.when(v.isNotNull(), col(order)))


# C12 --------------------------------------------------------------------------
def safe_corr(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Pairwise-complete Pearson correlation, NULL for a constant column.

    Spark's ``corr`` raises under ANSI on a constant input; this form
    divides with ``try_divide`` instead.
    """
    a, b = col(a).cast("double"), col(b).cast("double")
    both = a.isNotNull() & b.isNotNull()
    a2, b2 = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(a2, b2),
                        F.sqrt(F.var_pop(a2)) * F.sqrt(F.var_pop(b2)))


# Aggregates by name (SURVEY §2.15: ``agg('mean')`` etc.) -------------------------
def agg_by_name(name: str, c: ColumnOrName) -> Column:
    """Spark aggregate for a pandas aggregate name.

    ``median`` is exact (``percentile`` with interpolation, like pandas);
    ``var``/``std`` are sample statistics (ddof=1, NULL for one row, C2).
    """
    c = col(c)
    if name == "mean":
        return F.avg(c)
    if name == "min":
        return F.min(c)
    if name == "max":
        return F.max(c)
    if name == "sum":
        return sum0(c)
    if name == "var":
        return F.var_samp(c)
    if name == "std":
        return F.stddev_samp(c)
    if name == "median":
        return F.median(c)
    if name == "count":
        return F.count(c)
    if name == "nunique":
        return F.count_distinct(c)
    if name == "size":
        return F.count(F.lit(1))
    raise ValueError(f"unknown aggregate {name!r}")


AGG_NAMES = ("mean", "min", "max", "sum", "var", "std", "median", "count", "nunique", "size")


def all_not_null(cols: Iterable[ColumnOrName]) -> Column:
    """True when every key is present (C3: a missing key forms no group)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & col(c).isNotNull()
    return cond
