"""A14 over a file stream: watermark + tumbling window + count.

State is bounded by the watermark: a bucket is finalised and dropped from
state once the event-time watermark passes its end, so memory does not
grow with the stream.  Output mode ``append`` emits each bucket once,
final; the checkpoint location (on shared storage, under
``spark.checkpoint.dir``) makes the query restartable after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def bucket_counts_stream(spark: SparkSession, source_dir: str, schema: StructType | str, ts: str,
                         key_expr, minutes: int = 60, watermark: str = "2 hours",
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of ``(bucket, key, cnt)`` from parquet files.

    ``key_expr`` is a column expression (e.g. ``user_id % 20``) named
    ``key``.  The caller starts it with ``writeStream`` (append mode).
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.parquet(source_dir)
    t = F.col(ts).cast("timestamp")
    return (events.select(t.alias("_ts"), key_expr.alias("key"))
            .withWatermark("_ts", watermark)
            .groupBy(F.window("_ts", f"{minutes} minutes").alias("w"), "key")
            .agg(F.count(F.lit(1)).alias("cnt"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("bucket"), "key", "cnt"))
