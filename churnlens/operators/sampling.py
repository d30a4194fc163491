"""Seeded, partition-independent sampling and splitting.

Spark's ``sample``/``randomSplit`` depend on the partition layout, so a
re-run after an executor loss or a repartition can pick different rows.  Here
a row's fate depends only on its key and the seed, through MD5, which plain
SQL has too: different seeds are independent, and text and integer keys are
treated alike.  A null key is a key of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MOD = 1 << 32


def key_hash(key: str | Column, seed: int = 0) -> Column:
    """Uniform 32-bit hash of a key: the first 8 hex digits of md5('<key>:<seed>')."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.coalesce(k.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def key_uniform(key: str | Column, seed: int = 0) -> Column:
    """Key hash mapped to [0, 1)."""
    return key_hash(key, seed) / F.lit(float(_MOD))


def hash_split(df: DataFrame, key: str, train_fraction: float = 0.7, seed: int = 2018):
    """M8: (train, test) split by key hash; stable under repartitioning."""
    u = key_uniform(key, seed)
    return df.where(u < train_fraction), df.where(u >= train_fraction)


def next_batch(candidates: DataFrame, known: DataFrame, key: str, n: int,
               seed: int = 0) -> DataFrame:
    """Seeded batch of ``n`` candidates not yet known.

    Resumable by construction: anti-join the fetched set and take the next
    ``n`` in hash order (no offsets that could overlap, B15).  ``limit`` is
    the feature here (batch size); it runs as a distributed top-n.
    """
    fresh = candidates.join(known.select(key).distinct(), key, "left_anti")
    return fresh.orderBy(key_hash(key, seed), F.col(key)).limit(n)


def _stored_with_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """``df``, stored, with the number of rows that meet each condition (one aggregate row, broadcast).

    The input is computed once; the counts read a few columns of what is stored.
    """
    from churnlens.sources.tables import stored_table
    held, _ = stored_table(df, "counted")
    total = held.agg(*[F.count(F.when(c, 1)).alias(n) for n, c in conditions.items()])
    return held.join(F.broadcast(total))


def class_weights(df: DataFrame, label: str = "label", out: str = "class_weight") -> DataFrame:
    """M6: weight ``ratio`` for positives and ``1 - ratio`` for negatives, ratio = (N - P) / N."""
    counted = _stored_with_counts(df, __n=F.lit(True), __p=F.col(label) == 1)
    ratio = F.coalesce(F.try_divide(F.col("__n") - F.col("__p"), F.col("__n")), F.lit(0.0))
    return counted.withColumn(out, F.when(F.col(label) == 1, ratio).otherwise(1.0 - ratio)).drop("__n", "__p")


def undersample_majority(df: DataFrame, label: str, key: str, seed: int = 0,
                         minority_value=0) -> DataFrame:
    """All minority rows plus a key-hash sample of the majority, as one filter.

    Fraction = minority / majority, at most 1.
    """
    y = F.col(label)
    counted = _stored_with_counts(df, __m=y == minority_value, __a=y != minority_value)
    fraction = F.coalesce(F.try_divide(F.col("__m").cast("double"), F.col("__a")), F.lit(1.0))
    keep = (y == minority_value) | ((y != minority_value) & (key_uniform(key, seed) < fraction))
    return counted.where(keep).drop("__m", "__a")


def seeded_shuffle(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """A seeded total order (hash, then key)."""
    return df.orderBy(key_hash(key, seed), F.col(key))
