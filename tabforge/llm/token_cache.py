"""Token counts through a digest cache.

Counts live in a Parquet table keyed by the digest of the content and the
digest of the tokenizer version.  A run looks its contents up, encodes each
distinct content that is missing once, appends the new counts and joins."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm.common import BROADCAST_BYTES, Scratch, batches_of_text, frugal, keeps, only, prepare, spread_join

_loaded: dict[str, object] = {}
keeps(_loaded.clear, __name__)


def _tokenizer(path: str):
    if path not in _loaded:
        if path.endswith(".model"):
            import sentencepiece
            _loaded[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark's tasks share the cores already
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            _loaded[path] = t
    return _loaded[path]


def lengths(path: str, texts: list[str]) -> list[int]:
    """Tokens of each text, without begin, end or added special tokens."""
    t = _tokenizer(path)
    if path.endswith(".model"):
        return [len(ids) for ids in t.encode(texts, num_threads=1)]
    return [len(e.ids) for e in t.encode_batch_fast(texts, add_special_tokens=False)]


def version(path: str) -> str:
    """Digest of a tokenizer: its file and the library that reads it."""
    name = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        return hashlib.sha256(name.encode() + __import__(name).__version__.encode() + f.read()).hexdigest()[:32]


def content_digest(text: Column) -> Column:
    """sha-256 of the normalised content: null becomes the empty text and
    nothing else changes, since any other change could change the count."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def stored(spark: SparkSession, cache: str) -> DataFrame:
    """``content, n_tokens`` of a cache folder, one row per content (tasks
    that ran twice may have appended twice); empty if there is none yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "content binary, n_tokens long")
    found = spark.read.schema("content binary, n_tokens long").parquet(cache)
    return found.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def _counter(path: str):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in batches_of_text(batch, 1, 1 << 18):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lengths(path, part.column(1).to_pylist()), pa.int64())],
                    ["content", "n_tokens"])
    return run


def count_tokens(df: DataFrame, path: str, cache: str, text: str = "text", keep: tuple[str, ...] = (),
                 limit: int = 1024) -> DataFrame:
    """``keep`` columns plus ``n_bytes`` (UTF-8), ``n_tokens`` and
    ``over_limit`` (more than ``limit`` tokens) for each whole text.

    Null text counts as empty: 0 bytes, 0 tokens.  Equal texts are encoded
    once in all runs that share ``cache``, a folder all machines can reach.
    Digests are looked up before any text moves: a text whose count is stored
    stays where it is (beyond 64 MB of missing digests texts are combined by
    digest first, and hits dropped then).  Copies are combined before the
    shuffle, so a text that a third of the rows share costs one row per
    task, and its count goes back to the rows without gathering them.
    Reading the result later needs the cache to be still there."""
    spark = df.sparkSession
    prepare(spark)
    own = only(df, __text=text, **{k: k for k in keep}) \
        .withColumn("__text", F.coalesce("__text", F.lit(""))) \
        .withColumn("__content", content_digest(F.col("__text")))
    folder = f"{cache.rstrip('/')}/tokenizer={version(path)}"
    scratch = Scratch(spark, "token-cache")
    digests = scratch.save(own.select(*keep, F.octet_length("__text").cast("long").alias("n_bytes"), F.col("__content").alias("content")),
                           "digests")
    missing = scratch.save(digests.select("content").distinct().join(stored(spark, folder), "content", "left_anti"), "missing")
    texts = own.select(F.col("__content").alias("content"), F.col("__text").alias("text"))
    if missing.count() * 160 <= BROADCAST_BYTES:    # 160 bytes a row as measured; texts of hits stay where they are
        texts = texts.join(F.broadcast(missing), "content", "left_semi").groupBy("content").agg(F.first("text").alias("text"))
    else:
        texts = texts.groupBy("content").agg(F.first("text").alias("text")).join(missing, "content", "left_semi")
    texts.mapInArrow(_counter(path), "content binary, n_tokens long").write.mode("append").parquet(folder)
    return spread_join(digests, stored(spark, folder), "content", scratch) \
        .select(*keep, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
