"""Data profiling and chart-ready tables.

Drawing is out of scope; every chart's *data* is a small DataFrame built
by distributed aggregates.  Wide statistics are computed in one ``agg``
pass and unpivoted, histograms bin with column arithmetic against bounds
from one min/max pass, and densities sum kernels at blocks of grid points
within reach of each distinct value (never a join of data x grid).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.contract import safe_corr
from ..session import written
from .joins import join_measured, measured
from .ml import sample
from .quantile import exact_quantiles_multi, group_quantiles

# --- D01-D05 ---------------------------------------------------------------------------------


def missing_table(df: DataFrame) -> DataFrame:
    """Missing count and percent (1 decimal) per column, only columns
    with missing values, largest first.  One aggregate pass."""
    cols = df.columns
    n = F.count(F.lit(1))
    wide = df.agg(n.alias("__n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    long = wide.unpivot(["__n"], cols, "column", "missing")
    return (long.where(F.col("missing") > 0)
            .select("column", "missing", F.round(F.col("missing") * 100.0 / F.col("__n"), 1).alias("percent"))
            .orderBy(F.desc("percent"), "column"))


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-missing values per column (one pass)."""
    wide = df.agg(*[F.count_distinct(F.col(f"`{c}`")).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "n_unique")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, std (ddof 1), min, quartiles (linear), max.

    Moments ride the first pass of the bracketed exact quartiles, so no
    task holds a whole column and the rows are scanned three times in all.
    """
    extra = {f"{c}__{n}": e for c in cols for n, e in (
        ("count", F.count(c)), ("mean", F.avg(c)), ("std", F.stddev_samp(c)), ("min", F.min(c).cast("double")),
        ("max", F.max(c).cast("double")))}
    qs, moments = exact_quantiles_multi(df, {c: [0.25, 0.5, 0.75] for c in cols}, extra_aggs=extra)
    rows = []
    for c in cols:
        q1, q2, q3 = qs[c]
        rows.append((c, int(moments[f"{c}__count"]), moments[f"{c}__mean"], moments[f"{c}__std"],
                     moments[f"{c}__min"], q1, q2, q3, moments[f"{c}__max"]))
    return df.sparkSession.createDataFrame(
        rows, "column string, count long, mean double, std double, min double, "
              "p25 double, p50 double, p75 double, max double")


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Counts per value for each column, missing excluded, largest
    first; many columns go through one unpivot + one aggregate."""
    long = (df.select([F.col(f"`{c}`").cast("string").alias(c) for c in cols])
            .unpivot([], list(cols), "column", "value").where(F.col("value").isNotNull()))
    return long.groupBy("column", "value").count().orderBy("column", F.desc("count"), "value")


def table_profile(df: DataFrame) -> DataFrame:
    """Row count, column count and columns per type."""
    from collections import Counter
    types = Counter(t for _, t in df.dtypes)
    spark = df.sparkSession
    meta = spark.createDataFrame([("columns", len(df.columns))] +
                                 [(f"type:{t}", n) for t, n in sorted(types.items())],
                                 "item string, value long")
    rows = df.agg(F.count(F.lit(1)).alias("value")).select(F.lit("rows").alias("item"), "value")
    return rows.unionByName(meta)


# --- D06, O04 ----------------------------------------------------------------------------------


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Upper-triangle pairwise correlations (C12) in one pass, long form."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[safe_corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = wide.unpivot([], [f"`{a}|{b}`" for a, b in pairs], "pair", "corr")
    parts = F.split("pair", r"\|")
    return long.select(parts.getItem(0).alias("a"), parts.getItem(1).alias("b"), "corr")


def top_k_share(df: DataFrame, value: str, k: int, tie: str | None = None) -> DataFrame:
    """Top k rows by ``value`` (descending) and their summed share.
    ``orderBy().limit()`` plans as a per-partition top-k plus one merge."""
    order = [F.desc(value)] + ([F.col(tie)] if tie else [])
    top = df.orderBy(*order).limit(k)
    return top.select("*", F.sum(value).over(Window.partitionBy()).alias("share"))


def head(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """Deterministic ``head(n)``: needs an order."""
    return df.orderBy(*order).limit(n)


# --- D07, D08: histograms -----------------------------------------------------------------------


def histogram(df: DataFrame, col: str, bins: int = 50, by: str | None = None) -> DataFrame:
    """Equal-width histogram over [min, max] of the whole column
    (shared edges across classes when ``by`` is given); the last bin is
    closed on the right."""
    x = F.col(col).cast("double")
    lo_hi = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = lo_hi["lo"], lo_hi["hi"]
    if lo is None:
        raise ValueError("empty column")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    keys = ([F.col(by)] if by else []) + [b.alias("bin")]
    out = df.where(x.isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return out.select("*", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("left"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("right"))


# --- D09-D11: densities and box statistics ------------------------------------------------------


REACH = 39.0      # bandwidths beyond which a Gaussian kernel is 0 in double precision
GRID_BLOCK = 32   # grid points summed side by side in one aggregate


def kde(df: DataFrame, col: str, by: str | None = None, gridsize: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density per class on an even grid.

    Bandwidth by Scott's rule (``std * n^(-1/5)``, per class); the grid
    spans ``[min - cut*bw, max + cut*bw]`` of the class.  Rows collapse to
    (class, value, weight).  Grid points stand in blocks; a value goes to the
    blocks within reach of its kernel (the larger the class, the narrower
    its bandwidth, the fewer), and one partial aggregate per (class, block)
    sums the kernels at all points of the block side by side.  A class with
    one value has no bandwidth and null densities.
    """
    x = F.col(col).cast("double")
    data = df.where(x.isNotNull())
    if by is None:                      # one class: a literal key
        data, by = data.withColumn("_class", F.lit(0)), "_class"
    weights = written(data.groupBy(F.col(by), x.alias("v")).agg(F.count(F.lit(1)).alias("w")), "weights")
    n, total = F.sum("w"), F.sum(F.col("w") * F.col("v"))
    sq = F.sum(F.col("w") * (F.col("v") - F.col("mean")) * (F.col("v") - F.col("mean")))
    means = weights.groupBy(by).agg(n.cast("double").alias("n"), (total / n).alias("mean"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    means, fits = measured(means)       # one row per class
    means = F.broadcast(means) if fits else means
    spread = weights.join(means, by).groupBy(by).agg(F.sqrt(F.try_divide(sq, F.first("n") - 1)).alias("sd"))
    stats = means.join(spread, by).withColumn("bw", F.nullif(F.col("sd") * F.pow(F.col("n"), F.lit(-0.2)), F.lit(0.0))) \
        .withColumn("g0", F.col("lo") - F.lit(cut) * F.col("bw")) \
        .withColumn("step", (F.col("hi") - F.col("lo") + F.lit(2 * cut) * F.col("bw")) / F.lit(gridsize - 1)) \
        .select(by, "n", "bw", "g0", "step")
    joined = join_measured(weights, stats, by, "inner")
    last = (gridsize - 1) // GRID_BLOCK

    def block(edge: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(last), F.floor((edge - F.col("g0")) / F.col("step") / GRID_BLOCK))).cast("int")

    reach = F.lit(REACH) * F.col("bw")
    within = F.coalesce(F.sequence(block(F.col("v") - reach), block(F.col("v") + reach)), F.sequence(F.lit(0), F.lit(last)))
    z = [(F.col("g0") + (F.col("block") * GRID_BLOCK + j) * F.col("step") - F.col("v")) / F.col("bw") for j in range(GRID_BLOCK)]
    scale = F.col("n") * F.col("bw") * F.lit(math.sqrt(2 * math.pi))
    sums = joined.withColumn("block", F.explode(within)).groupBy(by, "block").agg(
        F.first("g0").alias("g0"), F.first("step").alias("step"),
        *[F.sum(F.col("w") * F.exp(-0.5 * z[j] * z[j]) / scale).alias(f"d{j}") for j in range(GRID_BLOCK)])
    points = sums.select(by, "block", "g0", "step", F.posexplode(F.array(*[f"d{j}" for j in range(GRID_BLOCK)])).alias("j", "density"))
    gi = (F.col("block") * GRID_BLOCK + F.col("j")).cast("int")
    found = points.select(by, gi.alias("gi"), (F.col("g0") + gi * F.col("step")).alias("x"), "density").where(F.col("gi") < gridsize)
    # blocks out of every value's reach have density 0
    grid = stats.select(by, F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("gi"), "g0", "step") \
        .select(by, "gi", (F.col("g0") + F.col("gi") * F.col("step")).alias("x"))
    return grid.join(found.drop("x"), [by, "gi"], "left") \
        .select(by, "gi", "x", F.when(F.col("x").isNotNull(), F.coalesce("density", F.lit(0.0))).alias("density"))


def box_stats(df: DataFrame, col: str, by: str) -> DataFrame:
    """Quartiles per group, whiskers at the most extreme values within
    1.5 IQR of the box, and the count of values outside them.

    Per-group exact quartiles come from ``group_quantiles`` (distinct
    values per group, spillable), then one join and one aggregate.
    """
    x = F.col(col).cast("double")
    q = group_quantiles(df, col, [by], [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = join_measured(df.select(by, x.alias("v")).where(F.col("v").isNotNull()), q, by, "inner")
    inside = (F.col("v") >= F.col("q1") - 1.5 * F.col("iqr")) & (F.col("v") <= F.col("q3") + 1.5 * F.col("iqr"))
    return j.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))


def violin(df: DataFrame, col: str, by: str, gridsize: int = 100) -> DataFrame:
    """Density per group joined with its box statistics."""
    return kde(df, col, by, gridsize).join(box_stats(df, col, by).select(by, "q1", "median", "q3"), by)


# --- D12, D13 -------------------------------------------------------------------------------------


def bar_data(df: DataFrame, y: str, x: str, hue: str | None = None) -> DataFrame:
    """Mean of y per (x, hue) with a normal 95% interval."""
    keys = [x] + ([hue] if hue else [])
    g = df.where(F.col(y).isNotNull()).groupBy(*keys).agg(
        F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"), F.count(F.lit(1)).alias("n"))
    half = F.lit(1.96) * F.col("std") / F.sqrt(F.col("n"))
    return g.select("*", (F.col("mean") - half).alias("ci_low"), (F.col("mean") + half).alias("ci_high"))


def scatter_sample(df: DataFrame, pairs: Sequence[tuple[str, str]], color: str, fraction: float,
                   seed: int = 0, id_col: str | None = None) -> DataFrame:
    """Seeded sample of column pairs for scatter plots, long form
    ``(x_name, y_name, x, y, color)``, rows with missing values dropped; by
    hashed id if an id column is given.  The rows are scanned once."""
    s = sample(df, fraction, seed, id_col)
    both = F.array(*[F.struct(F.lit(a).alias("x_name"), F.lit(b).alias("y_name"), F.col(a).cast("double").alias("x"),
                              F.col(b).cast("double").alias("y")) for a, b in pairs])
    return s.select(F.explode(both).alias("p"), F.col(color)).select("p.*", color) \
        .where(F.col("x").isNotNull() & F.col("y").isNotNull())
