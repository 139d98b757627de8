"""Repeated passages by longest-previous-factor arrays.

A byte of a text is repeated if a string of ``length`` bytes that covers it
also starts elsewhere.  In the suffix array of all texts such strings are
runs of suffixes whose neighbours' LCP reaches ``length``.  Within a run in
order of position, the previous smaller position is an earlier match (the
longest previous factor reaches ``length``), the next larger one a later.

The array is cut into independent parts.  A suffix goes to the part named by
the smallest hash of the ``GRAM``-grams in its first ``length`` bytes: equal
strings have the same one.  Consecutive suffixes of a text mostly have the
same one too, so they travel as one block: the few bytes that they cover
together.  Blocks that no other block shares a part with are dropped before
any text moves, and equal blocks are one class.  The classes of a part are
sorted in one task by prefix doubling; a part with more than ``PART`` bytes
is not: its suffixes are named by digests of their first ``length`` bytes,
and equal names meet in partial aggregates."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import Scratch, frugal, only, prepare, spread_join
from tabforge.llm.shingles import mix

LENGTH = 400
GRAM = 48               # bytes of a gram; half the length, if that is less
SEGMENT = 1 << 19       # suffixes of a text hashed at once
PART = 2 << 20          # bytes of a part that one task sorts
BATCH = 1 << 19         # bytes of small parts sorted at once

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20250713).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def _grams(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes from each place on."""
    h, power, width = _BYTE[data], np.array([_ODD]), 1      # h: hash of ``width`` bytes
    out, have = np.zeros(len(data), np.uint64), 0
    while have < k:
        if k & width:
            size = max(0, len(data) - have - width + 1)
            out = out[:size] * power + h[have:have + size]
            have += width
        h = h[:max(0, len(h) - width)] * power + h[width:]
        power, width = power * power, 2 * width
    return mix(out)


def _over_windows(best: np.ufunc, h: np.ndarray, w: int) -> np.ndarray:
    """Least or largest of w values from each place on."""
    width = 1
    while width < w:
        step = min(width, w - width)
        h = best(h[:len(h) - step], h[step:])
        width += step
    return h


def blocks(data: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """First suffix, number of suffixes, part, and whether suffixes inside may
    be equal, of each block of a text, a segment at a time.  A block ends
    where the part changes, or with its segment, and covers the bytes of its
    suffixes' first ``length``."""
    many, w = len(data) - length + 1, length - gram + 1
    for at in range(0, many, SEGMENT):
        h = _grams(data[at:min(at + SEGMENT, many) + length - 1], gram)
        low = _over_windows(np.minimum, h, w)
        first = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
        size, part = np.diff(np.r_[first, len(low)]), low[first]
        # Equal suffixes of one block need the block's smallest gram twice.
        rim = np.zeros(w - 1, np.uint64)
        spots = np.flatnonzero(_over_windows(np.maximum, np.r_[rim, low, rim], w) == h)
        a, b = np.searchsorted(spots, first), np.searchsorted(spots, first + size + w - 1)
        own = np.repeat(np.arange(len(first)), b - a)
        spot = spots[np.arange(len(own)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[own]]
        twice = np.bincount(own[h[spot] == part[own]], minlength=len(first)) > 1
        yield at + first, size, part.view(np.int64), twice


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    for s in column:
        yield np.frombuffer(s.as_buffer(), np.uint8) if s.is_valid else np.empty(0, np.uint8)


def _digest(data: np.ndarray) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _occurrences(length: int, gram: int):
    """Blocks of each text.  Equal blocks have equal names."""
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data in enumerate(_texts(batch.column(2))):
                for first, many, part, twice in blocks(data, length, gram):
                    names = [_digest(data[a:a + n + length - 1]) for a, n in zip(first.tolist(), many.tolist(), strict=True)]
                    row = pa.array(np.full(len(first), i))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(row), batch.column(1).take(row), pa.array(first), pa.array(many.astype(np.int32)),
                         pa.array(part), pa.array(twice), pa.array(names, pa.binary())],
                        ["key", "digest", "first", "many", "part", "twice", "block"])
    return run


def _cut(length: int):
    """Bytes of the wanted blocks of each text."""
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (data, wanted) in enumerate(zip(_texts(batch.column(2)), batch.column(3), strict=True)):
                want = wanted.as_py()
                for a in range(0, len(want), 4096):
                    part = want[a:a + 4096]
                    row = pa.array(np.full(len(part), i))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(row), batch.column(1).take(row), pa.array([w["first"] for w in part], pa.int64()),
                         pa.array([w["part"] for w in part], pa.int64()), pa.array([w["block"] for w in part], pa.binary()),
                         pa.array([data[w["first"]:w["first"] + w["many"] + length - 1].tobytes() for w in part], pa.binary())],
                        ["key", "digest", "first", "part", "block", "data"])
    return run


def suffix_names(data: np.ndarray, length: int) -> np.ndarray:
    """A number per place, equal where the ``length`` bytes from it on are
    equal and ascending with them, by prefix doubling."""
    padded = np.zeros(len(data) + 8, np.uint64)
    padded[:len(data)] = data
    name = np.zeros(len(data), np.uint64)
    have = min(8, length)
    for i in range(have):
        name = (name << np.uint64(8)) | padded[i:len(data) + i]
    name = np.unique(name, return_inverse=True)[1]
    while have < length:
        step = min(have, length - have)
        both = name.astype(np.uint64) << np.uint64(32)
        both[:max(0, len(name) - step)] |= name[step:].astype(np.uint64) + np.uint64(1)
        name = np.unique(both, return_inverse=True)[1]
        have += step
    return name


def previous_and_next(parts: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix, in order of position, whether the suffix array has an
    earlier and a later one whose LCP with it reaches the length.

    Runs of such suffixes have one part and name.  Within a run suffixes that
    agree as far as they are told apart lie in order of position, so the
    previous smaller position is the neighbour before and the next larger
    one the neighbour behind."""
    order = np.lexsort((names, parts))     # stable: ties stay in order of position
    same = (parts[order][1:] == parts[order][:-1]) & (names[order][1:] == names[order][:-1])
    earlier, later = np.zeros(len(order), bool), np.zeros(len(order), bool)
    earlier[order[1:]] = same
    later[order[:-1]] = same
    return earlier, later


def _spans(flags: np.ndarray) -> list[tuple[int, int]]:
    """Runs of true flags: first and number."""
    edge = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return [(int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2], strict=True)]


_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("many", pa.int32())]))
_RESULT = ("part long, block binary, earlier array<struct<first: int, many: int>>, "
           "other array<struct<first: int, many: int>>")


def _result(rows: list[tuple]) -> pa.RecordBatch:
    def spans(k):
        return pa.array([[{"first": a, "many": n} for a, n in r[k]] for r in rows], _SPANS)

    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                                       spans(2), spans(3)], ["part", "block", "earlier", "other"])


def _sort_parts(length: int):
    """Suffix arrays of whole parts, small ones together.  Input rows are in
    order of part and position."""
    def work(held: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        sizes = np.array([len(d) for _, _, d in held])
        data = np.frombuffer(b"".join(d for _, _, d in held), np.uint8)
        many = sizes - (length - 1)
        at = np.arange(many.sum()) + np.repeat(np.cumsum(sizes - many) - (sizes - many), many)
        parts = np.repeat(np.array([p for p, _, _ in held], np.int64), many)
        earlier, later = previous_and_next(parts, suffix_names(data, length)[at])
        cuts = np.cumsum(many)[:-1]
        return _result([(p, b, _spans(e), _spans(o)) for (p, b, _), e, o in
                        zip(held, np.split(earlier, cuts), np.split(earlier | later, cuts), strict=True) if o.any()])

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part, block, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[-1][:2] == (part, block):
                    continue        # the same class from a repeated row
                if size >= BATCH and part != held[-1][0]:
                    yield work(held)
                    held, size = [], 0
                held.append((part, block, data))
                size += len(data)
        if held:
            yield work(held)
    return run


def _name_suffixes(length: int):
    """Digest of the first ``length`` bytes of each suffix of a block."""
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data in enumerate(_texts(batch.column(5))):
                for a in range(0, len(data) - length + 1, 4096):
                    at = np.arange(a, min(a + 4096, len(data) - length + 1))
                    row = pa.array(np.full(len(at), i))
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).take(row) for c in range(5)), pa.array(at.astype(np.int32)),
                         pa.array([_digest(data[x:x + length]) for x in at.tolist()], pa.binary())],
                        ["key", "digest", "first", "part", "block", "at", "name"])
    return run


@frugal
def _from_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of a class from the places of its repeated suffixes."""
    for batch in batches:
        rows = []
        for part, block, earlier, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            spans = []
            for places in (earlier, other):
                flags = np.zeros(max(other) + 1, bool)
                flags[places] = True
                spans.append(_spans(flags))
            rows.append((part, block, *spans))
        yield _result(rows)


@frugal
def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge a text's spans and take them out."""
    for batch in batches:
        spans, kept = [], []
        for data, found in zip(_texts(batch.column(batch.num_columns - 2)), batch.column(batch.num_columns - 1).to_pylist(),
                               strict=True):
            merged: list[list[int]] = []
            for s in sorted((s["first"], s["first"] + s["size"]) for s in found or ()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            spans.append([{"first": a, "size": b - a} for a, b in merged])
            view, at, left = memoryview(data), 0, []
            for a, b in merged:
                left.append(view[at:a])
                at = b
            kept.append(b"".join((*left, view[at:])))
        names = [*batch.schema.names[:-2], "spans", "kept"]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("size", pa.int64())]))),
             pa.array(kept, pa.binary())], names)


def _order() -> Column:
    """Position of a block: texts by key (null last), then digest."""
    return F.struct(F.col("key").isNull().alias("none"), "key", "digest", "first")


def _classes(occurrences: DataFrame, length: int) -> DataFrame:
    """Classes of equal blocks whose part holds anything twice: ``part,
    block, n`` (occurrences), ``low`` (the first), ``many, twice``, and the
    part's ``classes`` and ``bytes``."""
    classes = occurrences.groupBy("part", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min(_order()).alias("low"), F.max("many").alias("many"), F.max("twice").alias("twice"))
    parts = classes.groupBy("part").agg(
        F.count(F.lit(1)).alias("classes"), F.sum("n").alias("all"), F.max("twice").alias("any_twice"),
        F.sum(F.col("many") + (length - 1)).alias("bytes")).where("all > 1 or any_twice")
    return classes.join(parts.select("part", "classes", "bytes"), "part")


def _content(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``key, digest, first, part, block, data`` of the classes' first blocks."""
    lists = wanted.select("part", "block", "many", "low.key", "low.digest", "low.first").groupBy("key", "digest") \
        .agg(F.collect_list(F.struct("first", "many", "part", "block")).alias("wanted"))
    lists = lists.withColumnsRenamed({"key": "of_key", "digest": "of_digest"})
    both = texts.join(lists, (F.col("digest") == F.col("of_digest")) & F.col("key").eqNullSafe(F.col("of_key")))
    kind = texts.schema["key"].dataType.simpleString()
    return both.select("key", "digest", "data", "wanted").mapInArrow(
        _cut(length), f"key {kind}, digest binary, first long, part long, block binary, data binary")


def _repeated(named: DataFrame, scratch: Scratch) -> DataFrame:
    """Suffixes whose name is there more than once, with the first ``place``
    of it, ``low``.  A name has one part; that of a line which fills texts
    is at a good share of all places, which stay where they are."""
    names = named.groupBy("name").agg(F.min("place").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return spread_join(named, scratch.save(names.select("name", "low"), "repeated"), "name", scratch).where("low is not null")


def _results(texts: DataFrame, classes: DataFrame, length: int, part: int, scratch: Scratch) -> DataFrame:
    """``part, block, earlier, other``: per class the suffixes of its first
    block that match an earlier place, or any other place."""
    shared = classes.where("classes > 1 or twice")
    kind = texts.schema["key"].dataType.simpleString()
    order = [F.col("key").isNull(), "key", "digest", "first"]
    rows = _content(texts, shared.where(F.col("bytes") <= part), length)
    found = rows.repartition("part").sortWithinPartitions("part", *order).select("part", "block", "data") \
        .mapInArrow(_sort_parts(length), _RESULT)
    large = shared.where(F.col("bytes") > part)
    if large.isEmpty():
        return scratch.save(found, "results")
    named = scratch.save(
        _content(texts, large, length).mapInArrow(
            _name_suffixes(length), f"key {kind}, digest binary, first long, part long, block binary, at int, name binary")
        .dropDuplicates(["part", "block", "at"])
        .select("part", "block", "at", "name", F.struct(_order().alias("block"), "at").alias("place")), "names")
    placed = _repeated(named, scratch).groupBy("part", "block").agg(
        F.collect_list(F.when(F.col("low") < F.col("place"), F.col("at"))).alias("earlier"), F.collect_list("at").alias("other"))
    return scratch.save(found.unionByName(placed.mapInArrow(_from_places, _RESULT)), "results")


def remove_repeats(df: DataFrame, length: int = LENGTH, first: bool = True, text: str = "text", key: str = "doc_id",
                   keep: tuple[str, ...] = ("doc_id",), gram: int | None = None, part: int = PART,
                   scratch: Scratch | None = None) -> DataFrame:
    """``keep`` columns plus ``n_bytes`` (UTF-8), ``n_removed``, ``spans``
    (``first, size`` of the maximal removed runs of bytes) and ``kept``
    (binary, the bytes left; a cut may fall inside a character).

    Bytes covered by a string of ``length`` bytes that starts elsewhere too,
    in this or another text, overlaps included, go.  With ``first`` the
    earliest place of each string stays as it is: texts are ordered by key
    (null last), then by a digest of the text.  Without it all places go.
    Strings are judged on the input and never cross texts.

    Null and empty texts, and those shorter than ``length``, have no string
    and stay.  Repeated rows are other places of their strings; rows equal
    in key and text get the same answer, so with ``first`` they all keep
    what one of them keeps.  Texts are read whole, a segment at a time; they
    move once to meet their spans, and once more for the classes of blocks
    that are compared."""
    if length < 2:
        raise ValueError("length must be at least 2")
    prepare(df.sparkSession)
    scratch = scratch or Scratch(df.sparkSession, "repeats")
    gram = gram or min(GRAM, length // 2)
    kept = {f"keep_{i}": c for i, c in enumerate(keep)}
    data = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = only(df, **kept, key=key, data=data).withColumn("digest", F.unhex(F.substring(F.sha2("data", 256), 1, 32)))
    texts = rows.where(F.octet_length("data") >= length).select("key", "digest", "data")
    kind = rows.schema["key"].dataType.simpleString()
    occurrences = scratch.save(texts.mapInArrow(
        _occurrences(length, gram),
        f"key {kind}, digest binary, first long, many int, part long, twice boolean, block binary"), "blocks")
    classes = scratch.save(_classes(occurrences, length), "classes")
    results = _results(texts, classes, length, part, scratch)
    answered = classes.select("part", "block", "n", "low").join(results, ["part", "block"], "left") \
        .where(F.col("other").isNotNull() | (F.col("n") > 1))
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("many")))
    if first:
        spans = F.when(_order() == F.col("low"), F.col("earlier")).otherwise(whole)
    else:
        spans = F.when(F.col("n") > 1, whole).otherwise(F.col("other"))
    found = occurrences.join(answered, ["part", "block"]).select("key", "digest", "first", F.explode(spans).alias("span")) \
        .groupBy("key", "digest").agg(F.collect_set(F.struct(
            (F.col("first") + F.col("span.first")).alias("first"),
            (F.col("span.many") + (length - 1)).cast("long").alias("size"))).alias("found"))
    found = scratch.save(found, "spans").withColumnsRenamed({"key": "of_key", "digest": "of_digest"})
    for spent in (occurrences, classes, results):
        scratch.drop(spent)
    out = rows.join(found, (F.col("digest") == F.col("of_digest")) & F.col("key").eqNullSafe(F.col("of_key")), "left") \
        .select(*kept, "data", "found")
    schema = ", ".join([*(f"{c} {out.schema[c].dataType.simpleString()}" for c in kept),
                        "spans array<struct<first: bigint, size: bigint>>", "kept binary"])
    made = out.mapInArrow(_remove, schema)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["size"])
    return made.select(*[F.col(k).alias(c) for k, c in kept.items()],
                       (F.octet_length("kept") + removed).cast("long").alias("n_bytes"), removed.alias("n_removed"), "spans", "kept")
