"""Recipe-driven group statistics.

A recipe is ``(keys, [(column, agg), ...])``.  The reference merges one
single-statistic frame per spec (37 merges for the application recipes);
here each key set compiles to ONE ``groupBy(keys).agg(...)`` and ONE left
join, so 7 joins replace 37 and every aggregate rides the same partial
(map-side) aggregation.

Scale notes
-----------
* ``groupBy`` uses partial aggregation, so a hot key (a third of all rows)
  is combined map-side before the shuffle; algebraic aggregates never
  pull a whole group into one task.
* All key sets are computed in ONE pass (``GROUPING SETS``), so the source
  is scanned once however many key sets a recipe has.
* The statistics have one row per key combination.  They are joined back
  after being materialised and measured: broadcast only when under the
  broadcast threshold, else a sort-merge join with AQE skew splitting.
  The fact side is never shuffled for a small side.
* Rows with a missing key form no group (C3) and an equi-join never
  matches NULL, so they receive NULL statistics, as in pandas.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.contract import agg_by_name, all_not_null
from ..session import written
from .joins import broadcast_limit, join_measured, row_width, text_bytes
from .quantile import grouping_quantiles

Spec = tuple[str, str]
Recipe = tuple[Sequence[str], Sequence[Spec]]

# aggregates whose value is on the column's own scale, so a deviation
# ``x - stat`` means something
DEVIATION_AGGS = ("mean", "median", "max", "min")


def stat_name(keys: Sequence[str], agg: str, column: str) -> str:
    """Generated feature name ``{keys}_{agg}_{col}``."""
    return "{}_{}_{}".format("_".join(keys), agg, column)


def _merged(recipes: Sequence[Recipe]) -> list[tuple[tuple[str, ...], list[Spec]]]:
    """Group specs by key set (first-seen order), dropping duplicates."""
    out: dict[tuple[str, ...], list[Spec]] = {}
    for keys, specs in recipes:
        bucket = out.setdefault(tuple(keys), [])
        for spec in specs:
            if tuple(spec) not in bucket:
                bucket.append(tuple(spec))
    return list(out.items())


def _gid(keys: Sequence[str], all_keys: Sequence[str]) -> int:
    """``grouping_id()`` of a grouping set over ``all_keys``."""
    n = len(all_keys)
    return sum(1 << (n - 1 - i) for i, k in enumerate(all_keys) if k not in keys)


def _stats_plan(df: DataFrame, recipes: Sequence[Recipe], keep: Callable[[DataFrame], DataFrame] | None = None):
    """(combined, [(keys, stats)]): every key set from ONE aggregation.
    ``keep`` stores the combined table, medians included, so that the key
    sets' slices read what was stored instead of each repeating the work.

    With several key sets the source is scanned once: ``GROUPING SETS``
    expands each row once per set before the partial aggregation, and each
    set's rows are picked out by ``grouping_id()``.  Groups with a missing
    key (C3) are exactly the groups whose set keys hold a NULL, so they are
    dropped after the aggregation.  Medians are holistic: those of all key
    sets and columns come from one more pass that counts (key set, keys,
    column, value) (``grouping_quantiles``), so a hot group never sits in
    one in-memory aggregation buffer.
    """
    merged = _merged(recipes)
    all_keys: list[str] = []
    for keys, _ in merged:
        all_keys += [k for k in keys if k not in all_keys]
    plain: list[Spec] = []
    for _, specs in merged:
        plain += [sp for sp in specs if sp[1] != "median" and sp not in plain]

    def tmp(c, a):
        return f"__{a}__{c}"

    medians = list(dict.fromkeys(c for _, specs in merged for c, a in specs if a == "median"))
    exprs = [agg_by_name(a, c).alias(tmp(c, a)) for c, a in plain] or [F.count(F.lit(1)).alias("_n")]
    if len(merged) == 1:
        keys = list(merged[0][0])
        combined = per_key(df, keys, exprs, list(dict.fromkeys(c for c, _ in plain))).withColumn("_gid", F.lit(0).cast("long"))
    else:
        combined = df.groupingSets([list(k) for k, _ in merged], *all_keys).agg(
            *exprs, F.grouping_id().cast("long").alias("_gid"))
    if medians:
        sets = [list(k) for k, specs in merged if any(a == "median" for _, a in specs)]
        found = grouping_quantiles(df, [list(k) for k, _ in merged], medians, [0.5], ["_q"]) \
            if len(sets) == len(merged) else _spread(grouping_quantiles(df, sets, medians, [0.5], ["_q"]), sets, all_keys)
        wide = found.groupBy("_gid", *all_keys).agg(
            *[F.max(F.when(F.col("_col") == i, F.col("_q"))).alias(tmp(c, "median")) for i, c in enumerate(medians)])
        wide = wide.withColumnsRenamed({k: f"_of_{k}" for k in ["_gid", *all_keys]})
        match = F.lit(True)
        for k in ["_gid", *all_keys]:        # keys outside a row's set are null on both sides
            match = match & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
        combined = combined.join(wide, match, "left").drop(*[f"_of_{k}" for k in ["_gid", *all_keys]])
    if keep:
        combined = keep(combined)
    parts = []
    for keys, specs in merged:
        keys = list(keys)
        part = combined.where((F.col("_gid") == _gid(keys, all_keys)) & all_not_null(keys))
        parts.append((tuple(keys), part.select(*keys, *[F.col(tmp(c, a)).alias(stat_name(keys, a, c)) for c, a in specs])))
    return combined, parts


STATE = 13          # bytes of partial sums per aggregate, about, for a group and task
HOT_SHARE = 1000    # a key with more than this part of the rows is hot


def per_key(df: DataFrame, keys: Sequence[str], exprs: Sequence[Column], columns: Sequence[str],
            derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``exprs`` over ``columns`` per key, groups with a missing key dropped;
    with ``derive``, over the columns that it makes of them row by row.

    Partial sums of many statistics are far wider than the rows they come
    from, and where a group has few rows a task combines few of them.  So
    the rows are counted per key first (narrow); if the partial sums would
    outweigh the rows, the rows themselves go to their group, but for those
    of hot keys (fewer than ``HOT_SHARE``), which are combined before they
    move as always."""
    keys = list(keys)
    rows = df.where(all_not_null(keys)).select(*keys, *[c for c in columns if c not in keys])

    def grouped(part: DataFrame) -> DataFrame:
        return (derive(part) if derive else part).groupBy(*keys).agg(*exprs)

    by_task = rows.select(*keys, F.spark_partition_id().alias("_task")).groupBy(*keys, "_task").agg(F.count(F.lit(1)).alias("_n"))
    counted = written(by_task.groupBy(*keys).agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_parts")), "per-key")
    size = counted.agg(F.sum("_rows").alias("rows"), F.sum("_parts").alias("parts")).first()
    total = size["rows"] or 0
    if (size["parts"] or 0) * STATE * len(exprs) <= total * row_width(rows):
        return grouped(rows)
    hot = counted.where(F.col("_rows") * HOT_SHARE > total).select(*keys)
    if hot.isEmpty():
        return grouped(rows.repartition(*keys))
    cold = rows.join(F.broadcast(hot), keys, "left_anti")
    return grouped(cold.repartition(*keys)).unionByName(grouped(rows.join(F.broadcast(hot), keys, "left_semi")))


def _spread(found: DataFrame, sets: Sequence[Sequence[str]], all_keys: Sequence[str]) -> DataFrame:
    """Quantiles of some of the key sets under the grouping ids of all."""
    own = list(dict.fromkeys(k for keys in sets for k in keys))
    gid = F.lit(None).cast("long")
    for keys in sets:
        gid = F.when(F.col("_gid") == _gid(keys, own), F.lit(_gid(keys, all_keys)).cast("long")).otherwise(gid)
    return found.withColumn("_gid", gid).withColumns({k: F.lit(None) for k in all_keys if k not in own})


def aggregate(df: DataFrame, recipes: Sequence[Recipe]) -> list[tuple[tuple[str, ...], DataFrame]]:
    """One statistics frame per key set, keys with missing values
    dropped; all key sets come from a single aggregation pass."""
    return _stats_plan(df, recipes)[1]


def stored_stats(df: DataFrame, recipes: Sequence[Recipe]) -> list[tuple[tuple[str, ...], DataFrame]]:
    """The statistics frames of ``aggregate``, read from one stored table
    and marked for broadcast where they were measured to fit: each key set's
    own rows, with its medians and the bytes of its texts."""
    combined, parts = _stats_plan(df, recipes, keep=lambda stats: written(stats, "stats"))
    limit = broadcast_limit(df)
    if limit < 0:
        return parts
    sizes = {r["_gid"]: r for r in
             combined.groupBy("_gid").agg(F.count(F.lit(1)).alias("n"), text_bytes(combined).alias("b")).collect()}
    all_keys = [k for k in dict.fromkeys(k for keys, _ in parts for k in keys)]
    out = []
    for keys, part in parts:
        size = sizes.get(_gid(keys, all_keys))
        fits = size is None or size["n"] * row_width(part) + size["b"] <= limit
        out.append((keys, F.broadcast(part) if fits else part))
    return out


def group_stats(df: DataFrame, keys: Sequence[str], specs: Sequence[Spec]) -> DataFrame:
    """Statistics for a single key set."""
    return aggregate(df, [(keys, specs)])[0][1]


def deviation_exprs(recipes: Sequence[Recipe]) -> list[Column]:
    """``{stat}_diff`` and ``{stat}_abs_diff`` for mean/median/max/min."""
    exprs = []
    for keys, specs in _merged(recipes):
        for c, a in specs:
            if a in DEVIATION_AGGS:
                name = stat_name(keys, a, c)
                diff = F.col(c) - F.col(name)
                exprs.append(diff.alias(f"{name}_diff"))
                exprs.append(F.abs(diff).alias(f"{name}_abs_diff"))
    return exprs


def enrich(df: DataFrame, recipes: Sequence[Recipe], stats_from: DataFrame | None = None,
           deviations: bool = True) -> DataFrame:
    """W01 + J02 + W02: attach group statistics beside each row.

    The statistics of all key sets come from one aggregation, written once;
    a key set's slice that fits the broadcast threshold is broadcast (the
    rows are never shuffled), any other is a shuffle join.  ``stats_from`` fits the statistics
    on another split (e.g. train) and applies them here; by default each
    split uses its own rows, as the reference does.
    """
    source = df if stats_from is None else stats_from
    out = df
    for keys, stats in stored_stats(source, recipes):
        out = out.join(stats, on=list(keys), how="left")
    if deviations:
        out = out.select("*", *deviation_exprs(recipes))
    return out


def attach_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join fitted statistics onto rows by 1-4 keys."""
    return join_measured(df, stats, list(keys), "left")


def recipe_grid(keys: Sequence[str], columns: Sequence[str], aggs: Sequence[str]) -> list[Recipe]:
    """The child-table recipes: every agg over every column, agg-major order."""
    return [(list(keys), [(c, a) for a in aggs for c in columns])]
