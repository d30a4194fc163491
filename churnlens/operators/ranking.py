"""Ordering and top-k (O1-O6, M16 ranking part).

Global top-k is ``orderBy(...).limit(k)``, which Spark runs as
TakeOrderedAndProject (each task keeps k rows).  Per-group top-k ranks within
(group, salt) first, then ranks the survivors: at most k rows per salt reach
the group's task, whatever k and the size of the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of a total order (include a unique key in ``order``)."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    salt_key: str, salt_buckets: int = 16, rank_col: str = "rank") -> DataFrame:
    """Exact top-k per group (skew-safe)."""
    salt = F.pmod(F.xxhash64(F.col(salt_key)), F.lit(salt_buckets))
    w1 = Window.partitionBy(*group, "__salt").orderBy(*order)
    w2 = Window.partitionBy(*group).orderBy(*order)
    pre = (df.withColumn("__salt", salt)
           .withColumn("__r1", F.row_number().over(w1))
           .where(F.col("__r1") <= k).drop("__r1", "__salt"))
    return pre.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k)
