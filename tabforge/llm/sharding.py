"""Rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import gapless

# 13 hex digits of the digest fill the 52 bits a double holds exactly.
_DIGITS = 13


def _unit(key: Column, shard: int) -> Column:
    """Uniform draw in (0, 1) that depends on the key and the shard alone.
    md5 because every SQL engine has it, so the placement can be repeated
    outside Spark."""
    digest = F.md5(F.concat(key, F.lit(f"/{shard}")).cast("binary"))
    return (F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") + 0.5) / F.lit(float(16 ** _DIGITS))


def rendezvous(key: Column, weights: Sequence[float]) -> list[Column]:
    """``-ln(u) / weight`` per shard; the smallest wins.  A key's draws for
    the old shards stay as they are when shards are added, so rows only
    move into a new shard, and a shard gets rows in proportion to its
    weight."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive and at least one")
    return [-F.ln(_unit(key, i)) / F.lit(float(w)) for i, w in enumerate(weights)]


def winner(scores: Sequence[Column]) -> Column:
    """Index of the smallest score; ties go to the lower shard."""
    return F.array_min(F.array(*[F.struct(s.alias("s"), F.lit(i).alias("i")) for i, s in enumerate(scores)]))["i"]


def key_text(*keys: Column) -> Column:
    """Stable text of a record key; a null part has a form of its own."""
    return F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), k.cast("string")), F.lit("null")) for k in keys])


def shard(df: DataFrame, keys: Sequence[str], weights: Sequence[float], added: Sequence[float] = (),
          out: str = "shard", slot: str | None = "slot", grown: str | None = "grown_shard",
          order: Sequence[str] = ()) -> DataFrame:
    """Add ``out`` (shard of the key), ``grown`` (shard once shards of the
    ``added`` weights join) and ``slot`` (gapless place in the shard).

    The shard is a pure function of key and weights: no shuffle, no state.
    Slots are numbered over hash buckets of keys plus ``order`` columns, so
    a shard is never one task.  Null keys: all in the shard of the null
    key.  Repeated rows: same shard, different slots.  Empty table: empty.
    Other columns of ``df`` are kept; ``out``, ``slot`` and ``grown`` must
    not be among them."""
    clash = {out, slot, grown} & set(df.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    text = key_text(*[F.col(f"`{k}`") for k in keys])
    scored = df.withColumn("__scores", F.array(*rendezvous(text, [*weights, *added])))
    at = [F.col("__scores")[i] for i in range(len(weights) + len(added))]
    scored = scored.withColumn(out, winner(at[:len(weights)]))
    if grown:
        scored = scored.withColumn(grown, winner(at))
    scored = scored.drop("__scores")
    if not slot:
        return scored
    spread = [*keys, *order]
    return gapless(scored, [out], spread, slot, counted=scored.select(out, *spread))
