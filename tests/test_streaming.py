"""The streaming bucket counts equal the batch A14 result once the input is drained."""

import os
import tempfile

from pyspark.sql import functions as F

from tabforge.operators.timebucket import bucket_counts
from tabforge.streaming import bucket_counts_stream
from tests.conftest import SF001


def test_stream_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="tf-stream-src-")
    events = spark.read.parquet(f"{SF001}/events.parquet")
    events.write.mode("append").parquet(os.path.join(src, "part"))
    schema = events.schema
    stream = bucket_counts_stream(spark, os.path.join(src, "part"), schema, "ts",
                                  (F.col("user_id") % 20).cast("int"), watermark="1000 days")
    ckpt = tempfile.mkdtemp(prefix="tf-stream-ckpt-")
    q = (stream.writeStream.outputMode("update").format("memory").queryName("bucket_stream")
         .option("checkpointLocation", ckpt).start())
    q.processAllAvailable()
    q.stop()
    got = {(str(r["bucket"]), r["key"]): r["cnt"] for r in spark.sql("SELECT * FROM bucket_stream").collect()}
    ev = events.select("ts", (F.col("user_id") % 20).cast("int").alias("key"))
    want = {(str(r["bucket"]), r["key"]): r["cnt"] for r in bucket_counts(ev, "ts", "key", 60).collect()}
    assert got == want
