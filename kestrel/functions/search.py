"""Binary search over a sorted array column, as a JVM-side higher-order function."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_below(sorted_arr: Column, key: Column, max_len: int, inclusive: bool = False) -> Column:
    """Number of elements of ``sorted_arr`` that are ``< key`` (``<= key`` if inclusive).

    Bisection in ``ceil(log2(max_len + 1)) + 1`` steps of ``aggregate``: O(log n) compares
    per row instead of a nested-loop join against every bound. ``max_len`` is an upper bound
    on the array size (the number of ranges asked for).
    """
    steps = max(1, math.ceil(math.log2(max(1, max_len) + 1)) + 1)
    init = F.struct(F.lit(0).alias("lo"), F.size(sorted_arr).alias("hi"))

    def step(acc, _):
        lo, hi = acc["lo"], acc["hi"]
        mid = F.shiftright(lo + hi, 1)
        probe = F.element_at(sorted_arr, mid + 1)
        right = (probe <= key) if inclusive else (probe < key)
        moved = F.struct(F.when(right, mid + 1).otherwise(lo).alias("lo"),
                         F.when(right, hi).otherwise(mid).alias("hi"))
        return F.when(lo >= hi, acc).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step)["lo"]
