"""Connected components of links, with the alternating large-star / small-star method.

Each round replaces links by links to smaller ends; it stops at a forest of stars, after a
number of rounds that grows with the logarithm of the size of a component. Every step is an
aggregate and an equi-join on the end of a link; rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import Scratch, cut


def components(links: DataFrame, a: str = "a", b: str = "b", scratch: Scratch | None = None) -> DataFrame:
    """id, component: the smallest id reachable, for every id that has a link to another.

    Links with a null end or from an id to itself are ignored; repeats do no harm. With ``scratch`` the rounds
    are its tables, of which the last one stays.
    """
    keep, gone = (cut, None) if scratch is None else (scratch.cut, scratch.drop)
    e = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    e = keep(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        # A forest of stars is done: every id is either a centre or has one link to a centre.
        roles = (e.select(F.col("u").alias("id"), F.lit(1).alias("child"), F.lit(0).alias("centre"))
                 .union(e.select("v", F.lit(0), F.lit(1))).groupBy("id").agg(F.sum("child").alias("child"), F.max("centre").alias("centre")))
        if roles.where("child + centre > 1").isEmpty():
            return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        # large star: larger neighbours of u move to u's smallest neighbour (or u itself)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        e1 = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
              .where("u <> v").distinct())
        # small star: smaller neighbours of u, and u, move to the smallest of them
        low = e1.groupBy("u").agg(F.min("v").alias("m"))
        moved = e1.join(low, "u")
        last, e = e, keep(moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                          .union(low.select("u", F.col("m").alias("v"))).distinct())
        if gone is not None:
            gone(last)
