"""Streaming adapters.

The reference is batch only (no watermark, window or state). The text operators here are
stateless row expressions plus one aggregate, so the same functions run unchanged on a
streaming DataFrame: ``stream_lines`` gives the line source and ``running_counts`` starts a
query whose state is Spark's own aggregation state, checkpointed in the shared folder.
"""

from kestrel.streaming.text import running_counts, stream_lines

__all__ = ["running_counts", "stream_lines"]
