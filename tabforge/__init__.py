"""tabforge: Spark-native feature engineering and model-data operators.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark
column expressions, so Catalyst can prune, push down and fuse it, and the
work is partitioned and shuffled by Spark.  Fitted state (group statistics,
category lists, centroids, models) is an explicit small DataFrame or a
Spark ML model passed between functions.

Layout
------
``functions``  column expressions (missing-value contract, row-wise stats,
               geo, time, scalar helpers)
``operators``  DataFrame operators (cleaning, recipes, recency, time buckets,
               encoding, selection, profiling, sets, ML, metrics)
``sources``    CSV / parquet scans and the prediction sink
``plans``      the four feature programs mapped onto the driver tables,
               plus the query registry used by ``__spark_entry__``
``streaming``  the time-bucket counts as a Structured Streaming query
"""

__version__ = "0.1.0"
