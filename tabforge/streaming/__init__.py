"""Structured Streaming form of the time-bucket counts.

The reference programs read batch files only (SURVEY §2.14: no streaming
operator).  The one windowed aggregate they compute, the per-(hour,
cluster) counts of A14, is offered here over a stream too, so the counts
can be maintained incrementally as files arrive.
"""

from .buckets import bucket_counts_stream  # noqa: F401
