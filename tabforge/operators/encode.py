"""Encoding and augmentation.

Categories have two forms.  Long or sparse: a dictionary table numbers
them, and rows meet it by a join, so their number has no bound and none
reaches the driver.  Wide: a given list of categories is a list of columns,
and applying it is one ``select`` of flag expressions, without a join, in
whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.contract import flag
from ..session import written
from .joins import join_measured
from .prefix import numbered
from .project import align  # noqa: F401  (J07)

SEP = "="


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


# --- long and sparse forms: any number of categories --------------------------------------


def fit_dictionary(df: DataFrame, cols: Sequence[str] | None = None, numbers: Sequence[str] = (), sep: str = SEP
                   ) -> DataFrame:
    """E01/E03 fit for any number of categories: ``column, value, feature,
    index`` with one row per distinct non-missing value of each column, and
    one per number column (its value is null).  ``feature`` is
    ``column{sep}value`` (a number's own name), and ``index`` its place in
    ascending order of the features, without gaps.

    The distinct pairs are found by a partial aggregate and numbered by
    ranges (``prefix.numbered``); nothing but the rows per range is counted
    together, and no category reaches the driver."""
    cols = list(cols) if cols is not None else string_columns(df)
    spark = df.sparkSession
    found = spark.createDataFrame([(c, None, c) for c in numbers], "column string, value string, feature string")
    if cols:
        pairs = _pairs(df, cols).where(F.col("value").isNotNull()).distinct()
        found = pairs.select("column", "value", F.concat("column", F.lit(sep), "value").alias("feature")).unionByName(found)
    return written(numbered(found, ["feature", "column"], "index"), "dictionary")


def _pairs(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols])
    return df.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.column", "_p.value")


def encode_long(df: DataFrame, id_col: str, dictionary: DataFrame, cols: Sequence[str] | None = None,
                numbers: Sequence[str] = ()) -> DataFrame:
    """E01/E03 in long form: ``id, index, feature, value`` with one row per
    feature of a row that is not 0: 1.0 for a fitted category, the number
    itself for a number column.  Missing and unseen values give no row (C17).

    The dictionary is broadcast only if its measured size allows; otherwise
    (column, value) meets it by a shuffle join, hot values split by AQE."""
    cols = list(cols) if cols is not None else string_columns(df)
    names = dictionary.select("column", "value", "feature", "index")
    out = None
    if cols:
        flags = _pairs(df, cols, [id_col]).where(F.col("value").isNotNull())
        out = join_measured(flags, names.where(F.col("value").isNotNull()), ["column", "value"], "inner") \
            .select(id_col, "index", "feature", F.lit(1.0).alias("value"))
    if numbers:
        given = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("number")) for c in numbers])
        long = df.select(id_col, F.explode(given).alias("_p")).select(id_col, "_p.column", "_p.number").where("number != 0")
        own = names.where(F.col("value").isNull()).select("column", "feature", "index")    # one row per number column
        part = long.join(F.broadcast(own), "column").select(id_col, "index", "feature", F.col("number").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def encode_sparse(df: DataFrame, id_col: str, dictionary: DataFrame, cols: Sequence[str] | None = None,
                  numbers: Sequence[str] = ()) -> DataFrame:
    """The same as one row per row of ``df``: ``id, size, indices, values``,
    indices ascending (the parts of a sparse vector)."""
    long = encode_long(df, id_col, dictionary, cols, numbers)
    parts = long.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("index", "value"))).alias("_e"))
    size = dictionary.agg(F.count(F.lit(1)).alias("size"))
    empty = F.array().cast("array<struct<index: bigint, value: double>>")
    return (df.select(id_col).join(parts, id_col, "left").withColumn("_e", F.coalesce("_e", empty))
            .join(F.broadcast(size))                                    # one row
            .select(id_col, "size", F.col("_e.index").alias("indices"), F.col("_e.value").alias("values")))


def common_features(a: DataFrame, b: DataFrame) -> DataFrame:
    """J07 on dictionaries: the features that both splits have, numbered
    anew, so that two splits get equal columns however many there are."""
    both = a.select("column", "value", "feature").join(b.select("feature"), "feature", "left_semi")
    return written(numbered(both, ["feature", "column"], "index"), "dictionary")


# --- wide form: one column per category of a given list ---------------------------------------


def fit_categories(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, list]:
    """Distinct non-missing values per column, sorted, as lists for a wide
    frame: one distributed job, and as many values on the driver as the
    frame will have columns.  For columns with many values use the long or
    sparse form (``fit_dictionary``), whose lists never leave the cluster."""
    cols = list(cols) if cols is not None else string_columns(df)
    out: dict[str, list] = {c: [] for c in cols}
    if cols:
        for r in _pairs(df, cols).where(F.col("value").isNotNull()).distinct().collect():
            out[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in out.items()}


def one_hot(df: DataFrame, categories: Mapping[str, Sequence], sep: str = "_",
            prefix: Mapping[str, str] | None = None, drop: bool = True) -> DataFrame:
    """``get_dummies``: one 0/1 column ``{prefix}{sep}{value}`` per
    fitted category, appended after the other columns; a missing or unseen
    value gives all zeros (C17)."""
    prefix = prefix or {}
    flags = []
    for c, values in categories.items():
        p = prefix.get(c, c)
        flags += [flag(F.col(c).cast("string") == F.lit(str(v))).alias(f"{p}{sep}{v}") for v in values]
    keep = [c for c in df.columns if not (drop and c in categories)]
    return df.select(*keep, *flags)


def dict_vectorize(df: DataFrame, categories: Mapping[str, Sequence]) -> DataFrame:
    """Dictionary vectoriser: strings become ``f=v`` flags, numbers pass
    through, and the output columns are sorted by name.  ``categories`` is
    fitted on the training split and applied unchanged to the others."""
    enc = one_hot(df, categories, sep="=")
    return enc.select(*sorted(enc.columns))


def reverse_one_hot(prefix: str, n: int, start: int = 1):
    """``sum(i * {prefix}{i})`` over the indicator columns."""
    total = None
    for i in range(start, start + n):
        term = F.col(f"{prefix}{i}") * i
        total = term if total is None else total + term
    return total


def target_mean(train: DataFrame, key: str, cols: Sequence[str], name_fmt: str = "{col}_gby_{key}",
                min_count: int = 0, count_name: str | None = None) -> DataFrame:
    """E06 (+A11): per-key means of ``cols`` fitted on the training split;
    with ``min_count`` keep only keys with more than that many rows (the
    count of a key column, as ``groupby().count()['id']``)."""
    aggs = [F.avg(c).alias(name_fmt.format(col=c, key=key)) for c in cols]
    if min_count or count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name or "_n"))
    stats = train.groupBy(key).agg(*aggs).where(F.col(key).isNotNull())   # C3, after the aggregate
    if min_count:
        stats = stats.where(F.col(count_name or "_n") > min_count)
    if not count_name and min_count:
        stats = stats.drop("_n")
    return stats


def apply_target_means(frames: Sequence[DataFrame], train: DataFrame, keys: Sequence[str],
                       cols: Sequence[str], name_fmt: str = "{col}_gby_{key}") -> list[DataFrame]:
    """E06 + J03 for several keys at once: the per-key means of all keys
    come from ONE grouping-sets pass over the training split, written
    once, and each key's slice is left-joined (broadcast when it fits)."""
    from .recipes import stat_name, stored_stats
    recipes = [([k], [(c, "mean") for c in cols]) for k in keys]
    out = list(frames)
    for (key,), part in stored_stats(train, recipes):
        part = part.select(key, *[F.col(stat_name([key], "mean", c)).alias(name_fmt.format(col=c, key=key))
                                  for c in cols])
        out = [f.join(part, on=key, how="left") for f in out]
    return out


def draw_offsets(copies: int, ranges: Mapping[str, tuple[int, int]], seed: int) -> list[dict[str, int]]:
    """E07 draw: one integer offset per copy *and column*, ``low <= o < high``
    (numpy ``randint`` semantics), seeded so a run can be repeated."""
    rng = np.random.default_rng(seed)
    return [{c: int(rng.integers(lo, hi)) for c, (lo, hi) in ranges.items()} for _ in range(copies)]


def noisy_copies(df: DataFrame, id_col: str, id_shift: int, offsets: Sequence[Mapping[str, int]],
                 distinct_ids: bool = False) -> DataFrame:
    """The original rows plus one shifted copy per offset set.

    The rows are scanned once: each is exploded over the original and the
    copies, a literal list of offsets.  No join, no shuffle.  By default
    every copy gets ``id + id_shift`` like the reference; ``distinct_ids``
    gives copy i the shift ``i * id_shift`` instead.
    """
    moved = list(dict.fromkeys([id_col, *(c for o in offsets for c in o)]))
    copies = []
    for i, offs in enumerate([{}, *offsets]):
        shift = id_shift * (i if distinct_ids else min(i, 1))
        by = {id_col: shift, **offs}
        copies.append(F.struct(*[(F.col(c) + by.get(c, 0)).alias(c) for c in moved]))
    out = df.withColumn("_copy", F.explode(F.array(*copies)))
    return out.select(*[F.col(f"_copy.{c}").alias(c) if c in moved else F.col(c) for c in df.columns])
