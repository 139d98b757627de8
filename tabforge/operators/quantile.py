"""Exact quantiles without holding a column in one task or on the driver.

``percentile``/``median`` keep every distinct value of a group in one
aggregation buffer; fine per low-cardinality group, not for a global
statistic over a huge table.  ``exact_quantiles_multi`` works in three
jobs whatever the number of columns and probabilities:

1. one aggregate: the count and ``percentile_approx`` at ``p -/+ margin``
   for every target p (rank error of the sketch <= n / accuracy);
2. one aggregate: how many values fall below each bracket;
3. the values inside each bracket, collapsed to (value, count), get their
   running count from a window per bracket, and a filter keeps the order
   statistics wanted: two values per probability reach the driver.

Interpolation is linear between neighbouring order statistics, as pandas
does.  Should a bracket miss its rank (it cannot when the sketch keeps its
guarantee), the probability is taken again with a bracket ten times wider.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .prefix import range_count, search

ACCURACY = 100_000


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float],
                    accuracy: int = ACCURACY) -> list[float | None]:
    return exact_quantiles_multi(df, {column: list(probs)}, accuracy)[column]


def exact_quantiles_multi(df: DataFrame, spec: dict[str, Sequence[float]],
                          accuracy: int = ACCURACY, extra_aggs: dict | None = None,
                          margin: float | None = None):
    """Exact quantiles of several columns in three jobs in total.

    ``extra_aggs`` (name -> aggregate column) ride along in the first job;
    when given, ``(quantiles, extras)`` is returned instead of the
    quantiles alone.  ``margin`` is half the width of a bracket as a share
    of the rows (by default three times the sketch's error)."""
    extra_aggs = extra_aggs or {}
    cols = list(spec)
    margin = 3.0 / accuracy if margin is None else margin
    edges = {c: [e for p in spec[c] for e in (max(0.0, p - margin), min(1.0, p + margin))] for c in cols}
    x = {c: F.col(c).cast("double") for c in cols}
    first = df.agg(F.lit(0).alias("_z"), *[F.count(x[c]).alias(f"n{i}") for i, c in enumerate(cols)],
                   *[F.percentile_approx(x[c], edges[c], accuracy).alias(f"q{i}") for i, c in enumerate(cols)],
                   *[e.alias(f"x_{k}") for k, e in extra_aggs.items()]).first()
    extras = {k: first[f"x_{k}"] for k in extra_aggs}
    targets = []        # (column, probability index, low edge, high edge, ranks)
    for i, c in enumerate(cols):
        n, q, e = first[f"n{i}"], first[f"q{i}"] or [], edges[c]
        for j, p in enumerate(spec[c] if n else []):
            lo_rank = int(p * (n - 1))
            targets.append((c, j, None if e[2 * j] == 0.0 else q[2 * j],
                            None if e[2 * j + 1] == 1.0 else q[2 * j + 1], (lo_rank, min(lo_rank + 1, n - 1))))
    picks = _order_statistics(df, x, targets) if targets else {}
    out: dict[str, list[float | None]] = {c: [None] * len(spec[c]) for c in cols}
    missed: dict[str, list[int]] = {}
    for t, (c, j, _, _, (a, b)) in enumerate(targets):
        if (t, a) in picks and (t, b) in picks:
            pos = spec[c][j] * (first[f"n{cols.index(c)}"] - 1)
            out[c][j] = picks[t, a] + (picks[t, b] - picks[t, a]) * (pos - a)
        else:
            missed.setdefault(c, []).append(j)
    if missed:
        again = exact_quantiles_multi(df, {c: [spec[c][j] for j in js] for c, js in missed.items()},
                                      accuracy, margin=10 * margin)
        for c, js in missed.items():
            for j, v in zip(js, again[c]):
                out[c][j] = v
    return (out, extras) if extra_aggs else out


def _order_statistics(df: DataFrame, x: dict[str, Column], targets: Sequence[tuple]) -> dict:
    """``(target, rank) -> value`` for the ranks inside their brackets."""
    below = df.agg(*[(F.count_if(x[c] < lo) if lo is not None else F.lit(0)).alias(f"b{t}")
                     for t, (c, _, lo, _, _) in enumerate(targets)]).first()
    inside, wanted = [], F.lit(False)
    for t, (c, _, lo, hi, ranks) in enumerate(targets):
        cond = x[c].isNotNull()
        if lo is not None:
            cond = cond & (x[c] >= lo)
        if hi is not None:
            cond = cond & (x[c] <= hi)
        inside.append(F.struct(F.lit(t).alias("t"), F.when(cond, x[c]).alias("x")))
        for k in sorted(set(ranks)):
            k -= below[f"b{t}"]
            wanted = wanted | ((F.col("t") == t) & (F.col("upto") > k) & (F.col("upto") - F.col("c") <= k))
    w = Window.partitionBy("t").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (df.select(F.explode(F.array(*inside)).alias("e")).select("e.*").where(F.col("x").isNotNull())
            .groupBy("t", "x").agg(F.count(F.lit(1)).alias("c"))
            .withColumn("upto", F.sum("c").over(w)).where(wanted).collect())
    picks = {}
    for r in rows:
        start = below[f"b{r['t']}"] + r["upto"] - r["c"]
        for k in targets[r["t"]][4]:
            if start <= k < start + r["c"]:
                picks[r["t"], k] = r["x"]
    return picks


def group_quantiles(df: DataFrame, column: str, keys: Sequence[str], probs: Sequence[float],
                    names: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Exact per-group quantiles (linear interpolation) as a DataFrame, one
    scan of the rows.  Groups with a missing key are dropped (C3)."""
    keys = list(keys)
    cond = F.col(column).isNotNull()
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    counts = df.where(cond).groupBy(*keys, F.col(column).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    counts = written(counts.withColumn("_col", F.lit(0)), "values")
    return _quantiles(counts, keys, probs, names, 1, ranges)


def grouping_quantiles(df: DataFrame, sets: Sequence[Sequence[str]], columns: Sequence[str], probs: Sequence[float],
                       names: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Exact quantiles of several columns for several key sets together.

    One pass over the rows counts (key set, keys, column, value): rows are
    unpivoted to (column, value) and grouped by ``GROUPING SETS``, combined
    before the shuffle.  One split into value ranges per column and one
    table of offsets serve all sets.  Rows of the result: all keys (null
    where a set does not have them), ``_gid`` (``grouping_id()`` over the
    keys in order of first use), ``_col`` (index into ``columns``) and
    ``names``.  Groups with a missing key of their set are dropped (C3)."""
    all_keys = list(dict.fromkeys(k for keys in sets for k in keys))
    values = F.array(*[F.struct(F.lit(i).alias("_col"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(columns)])
    long = df.select(*all_keys, F.explode(values).alias("_e")).select(*all_keys, "_e.*").where(F.col("_v").isNotNull())
    counts = long.groupingSets([[*keys, "_col", "_v"] for keys in sets], *all_keys, "_col", "_v") \
        .agg(F.count(F.lit(1)).alias("_c"), F.shiftright(F.grouping_id(), 2).cast("long").alias("_gid"))
    n, present = len(all_keys), F.lit(False)
    for keys in sets:
        own = F.col("_gid") == sum(1 << (n - 1 - i) for i, k in enumerate(all_keys) if k not in keys)
        for k in keys:
            own = own & F.col(k).isNotNull()
        present = present | own
    return _quantiles(written(counts.where(present), "values"), [*all_keys, "_gid"], probs, names, len(columns), ranges,
                      by_column=True)


def _quantiles(counts: DataFrame, keys: Sequence[str], probs: Sequence[float], names: Sequence[str], columns: int,
               ranges: int | None, by_column: bool = False) -> DataFrame:
    """Quantiles per (keys, column) from a stored table of ``keys, _col, _v,
    _c`` (value and how often).

    1. One sketch per column over the distinct values cuts them into
       ``ranges`` value ranges (default: as many as shuffle partitions, so a
       range keeps its size as data and cluster grow).
    2. Per (group, range) totals give each range its offset within the
       group (a window over at most ``ranges`` rows per group); only the
       ranges that hold a wanted rank are kept.
    3. Those join back, and a window partitioned by (group, range) adds the
       running count.  However many rows a group has, a window task holds
       one range of it; the cut points only balance the work, the ranks
       stay exact.
    """
    ranges = ranges or range_count(counts)
    cuts: list[list[float]] = [[] for _ in range(columns)]
    if ranges > 1:
        sketch = F.percentile_approx("_v", [i / ranges for i in range(1, ranges)], 20 * ranges)
        for r in counts.groupBy("_col").agg(sketch.alias("q")).collect():     # one row per column
            cuts[r["_col"]] = sorted(set(r["q"] or []))
    table = F.array(*[F.array(*[F.lit(float(c)) for c in own]).cast("array<double>") for own in cuts])
    own = F.get(table, F.col("_col"))
    counts = counts.withColumn("_r", search(F.col("_v"), own, F.size(own), max(map(len, cuts))))
    keys = [*keys, "_col"]
    group = Window.partitionBy(*keys)
    before = group.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offs = (counts.groupBy(*keys, "_r").agg(F.sum("_c").alias("_rc"))
            .select(*keys, "_r", "_rc", F.coalesce(F.sum("_rc").over(before), F.lit(0)).alias("_off"),
                    F.sum("_rc").over(group).alias("_n")))
    ranks, holds = [], F.lit(False)
    for p in probs:
        pos = F.lit(p) * (F.col("_n") - 1)
        lo = F.floor(pos)
        hi = F.least(lo + 1, F.col("_n") - 1)
        ranks.append((pos, lo, hi))
        for k in (lo, hi):
            holds = holds | ((F.col("_off") <= k) & (k < F.col("_off") + F.col("_rc")))
    wanted = offs.where(holds).drop("_rc").withColumnsRenamed({k: f"_of_{k}" for k in [*keys, "_r"]})
    match = F.lit(True)
    for k in [*keys, "_r"]:      # keys that are not in a row's set are null on both sides
        match = match & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    upto = Window.partitionBy(*keys, "_r").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (counts.join(wanted, match)
              .select(*keys, "_v", (F.col("_off") + F.sum("_c").over(upto)).alias("_cum"), "_n"))
    aggs, outs = [], []
    for i, (pos, lo, hi) in enumerate(ranks):
        aggs += [F.min(F.when(F.col("_cum") > lo, F.col("_v"))).alias(f"_lo{i}"),
                 F.min(F.when(F.col("_cum") > hi, F.col("_v"))).alias(f"_hi{i}"),
                 F.first(pos - lo).alias(f"_f{i}")]
        outs.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(names[i]))
    return ranked.groupBy(*keys).agg(*aggs).select(*(keys if by_column else keys[:-1]), *outs)
