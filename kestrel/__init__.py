"""kestrel: batch text, sort, relational and graph operators as lazy Spark DataFrame plans.

Every operator is ``f(df, column names, parameters) -> DataFrame``: no collect, no
row-at-a-time Python UDF, no hard-coded path. Catalyst and adaptive execution pick the
physical strategy; operators only state the logical plan and, where size matters, the
partitioning and the bounds on anything broadcast.
"""

from kestrel.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
