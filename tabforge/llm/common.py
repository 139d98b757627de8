"""Helpers shared by the operators: scratch tables in the shared folder,
worker set-up, gapless numbering without a global sort."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import os
import sys
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabforge.session import ensure_checkpoint_dir

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


BATCH_SETTING, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "2m"


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it,
    and hand them rows in batches of 2 MB, unless the session says how (each
    running task, and finished ones for a while, hold one outside the heap).

    On a cluster the package is installed or sent with ``--py-files``; the
    extra path is then simply not there and is ignored."""
    if spark.conf.get(BATCH_SETTING, None) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    env = spark.sparkContext.environment
    if REPO not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(p for p in (REPO, env.get("PYTHONPATH", "")) if p)


class Scratch:
    """Tables written to the shared checkpoint folder to cut lineage.

    They are ordinary Parquet, so a lost executor rereads them.  ``drop``
    removes one that no later plan reads."""

    def __init__(self, spark: SparkSession, name: str):
        prepare(spark)
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
        self.n = 0

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        p = self.path(name)
        df.write.parquet(p)
        # The table is cut off from its shuffles; without a collection on the
        # driver their files would stay on the executors' disks.
        gc.collect()
        self.spark._jvm.System.gc()
        out = self.spark.read.schema(df.schema).parquet(p)
        out._scratch_path = p
        return out

    def drop(self, df: DataFrame) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def gapless(df: DataFrame, group: Sequence[str], spread: Sequence[str], out: str,
            counted: DataFrame | None = None) -> DataFrame:
    """Number the rows of each ``group`` from 0 without gaps.

    A group is dealt by a hash of ``spread`` into as many buckets as there
    are shuffle partitions; a row's number is its place in its bucket plus
    the rows of the buckets before.  So no task holds a whole group, and
    only the bucket counts meet.  ``group`` columns must not be null.
    ``counted`` may be a cheaper frame with the same group and spread
    columns to take the counts from (it must hold the same rows)."""
    n = partitions(df.sparkSession)
    bucket = F.pmod(F.xxhash64(*spread), F.lit(n)).cast("int")
    per = (df if counted is None else counted).withColumn("__bucket", bucket) \
        .groupBy(*group, "__bucket").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = per.select(*group, "__bucket", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*group, "__bucket").orderBy(*spread)
    return (df.withColumn("__bucket", bucket)
            .withColumn("__place", F.row_number().over(inside) - 1)
            .join(start, [*group, "__bucket"])
            .withColumn(out, (F.col("__start") + F.col("__place")).cast("long"))
            .drop("__bucket", "__place", "__start"))


BROADCAST_BYTES = 64 << 20


def join_ids(rows: DataFrame, ids: DataFrame, on: Column, row_bytes: int) -> DataFrame:
    """Inner join of wide rows with a narrow id table.  The id table is
    counted first: up to ``BROADCAST_BYTES`` (``row_bytes`` a row) it goes to
    the wide rows, which then stay where they are; beyond, both are
    shuffled."""
    return rows.join(F.broadcast(ids) if ids.count() * row_bytes <= BROADCAST_BYTES else ids, on)


HOT_SHARE = 1000    # a key with more than this part of the rows is hot


def spread_join(rows: DataFrame, answers: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """``rows.join(answers, key, "left")`` that gathers no hot key in one task.

    ``answers`` has one narrow row per key.  Keys with more than one row in
    ``HOT_SHARE`` are less than ``HOT_SHARE`` in number, so their answers go
    to the rows; all others meet by a shuffle, and rows with a null key,
    which have no answer, stay where they are.  ``rows`` is read several
    times and ``answers`` twice, so both should be tables."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = rows.count()
    hot = scratch.save(counts.where(F.col("__n") * HOT_SHARE > total).select(key), "hot")
    some = rows.where(F.col(key).isNotNull())
    rest = some.join(F.broadcast(hot), key, "left_anti").join(answers, key, "left")
    mine = some.join(F.broadcast(hot.join(answers, key, "left")), key)
    return rest.unionByName(mine).unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True)


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n (null key: null)."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(n))


def only(df: DataFrame, **columns: str | Column) -> DataFrame:
    """The named inputs of an operator under its own column names, so extra
    or clashing columns of the caller's table never meet internal names."""
    return df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(k) for k, c in columns.items()])


_kept: dict[Callable[[], None], tuple[str, ...]] = {}


def keeps(clear: Callable[[], None], *modules: str) -> None:
    """A worker's memory that outlives its tasks: ``clear`` empties it as
    soon as the function of another module than ``modules`` starts."""
    _kept[clear] = modules


def _enter(module: str) -> None:
    for clear, modules in _kept.items():
        if module not in modules:
            clear()


class Memo:
    """Results that a worker remembers, in two generations of ``limit``
    bytes each: when the young one is full it becomes the old one, whose
    entries live on if they are asked for again."""

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.young, self.old, self.held = {}, {}, 0

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.pop(key, None)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        size = 150 + sys.getsizeof(key) + sys.getsizeof(value)
        if self.held + size > self.limit:
            self.old, self.young, self.held = self.young, {}, 0
        self.held += size
        self.young[key] = value


def frugal(run: Callable) -> Callable:
    """Give freed memory back when a task's function ends, and at its start
    what other operators left in the worker: Python workers live on, and an
    executor's limit counts what they still hold."""
    module = run.__module__

    @functools.wraps(run)
    def wrapped(batches):
        _enter(module)
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):      # glibc only
                ctypes.CDLL(None).malloc_trim(0)
    return wrapped


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that few texts are Python objects at once."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def batches_of_text(batch: pa.RecordBatch, column: int, limit: int = 1 << 20, rows: int = 256
                    ) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with at most ``limit`` bytes of text and
    ``rows`` rows each (one row at least), so that per-range temporaries
    stay bounded."""
    sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, size in enumerate(sizes):
        size = 0 if size != size or size is None else int(size)
        if i > start and (total + size > limit or i - start >= rows):
            yield start, i
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)
