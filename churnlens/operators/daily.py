"""Stored daily partial aggregates of the event log.

The day table holds one row per (day, user, public): event count, first and
last event time and one count per event type.  All of these merge, so the
profile of any period is an aggregation of day rows, and only days whose events
have changed are read from the raw log again.  The table is partitioned by
day; a refresh replaces the partitions of the named days and no others.

Distinct users don't add up, but sketches do: the sketch table holds one
HyperLogLog sketch of the users per day, from which months and years are merged.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.config import DEFAULT_SPEC, ChurnSpec
from churnlens.functions.columns import row_sum
from churnlens.operators.activity import in_period
from churnlens.operators.merge import merge_profiles, outlier_filter



def day_profiles(events: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """(day, actor, public, event_count, last_event, first_event, one count per type)."""
    return events.groupBy(F.to_date("created_at").alias("day"), "actor", "public").agg(
        F.count("type").alias("event_count"), F.max("created_at").alias("last_event"), F.min("created_at").alias("first_event"),
        *[F.count(F.when(F.col("type") == t, 1)).alias(c) for t, c in zip(spec.event_types, spec.count_columns)])


def _on(days: Sequence[dt.date]) -> Column:
    """The events of some days, as ranges that reach the scan; days that follow one another are one range."""
    cond, start = F.lit(False), None
    days = sorted(set(days))
    for i, d in enumerate(days):
        start = start or d
        if i + 1 == len(days) or days[i + 1] != d + dt.timedelta(days=1):
            cond = cond | in_period(dt.datetime.combine(start, dt.time()), dt.datetime.combine(d + dt.timedelta(days=1), dt.time()))
            start = None
    return cond


def store_days(events: DataFrame, path: str, days: Sequence[dt.date] | None = None, spec: ChurnSpec = DEFAULT_SPEC, files: int = 4) -> None:
    """Write the day table, or replace the rows of ``days``, reading the events of these days only.

    Every day is written as ``files`` files at most, whatever the number of
    tasks.  A day that has no events any more loses its partition; writing a
    day again gives the same rows, so a refresh that was cut short is repeated.
    """
    if days is not None and not days:
        return
    rows = day_profiles(events if days is None else events.where(_on(days)), spec)
    rows = rows.where("day IS NOT NULL").repartition(F.col("day"), F.pmod(F.xxhash64("actor"), F.lit(files)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static" if days is None else "dynamic").partitionBy("day").parquet(path)
    if days is not None:
        left = {r["day"] for r in events.where(_on(days)).select(F.to_date("created_at").alias("day")).distinct().collect()}  # at most the named days
        for day in set(days) - left:
            _drop(events.sparkSession, f"{path}/day={day:%Y-%m-%d}")


def _drop(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_days(spark: SparkSession, path: str, events: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """The day table at ``path``; ``events`` gives the types of its columns."""
    return spark.read.schema(day_profiles(events, spec).schema).parquet(path)


def day_marks(events: DataFrame) -> DataFrame:
    """(day, n, mark): what tells that a day's events have changed; the mark is a sum of row hashes, in any order."""
    return events.groupBy(F.to_date("created_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*events.columns).cast("decimal(38,0)")).alias("mark"))


def changed_days(before: DataFrame, after: DataFrame) -> list[dt.date]:
    """Days whose marks differ, new and vanished ones included (one row per day)."""
    a = before.select(F.col("day").alias("d0"), F.col("n").alias("n0"), F.col("mark").alias("m0"))
    both = after.join(a, F.col("day") == F.col("d0"), "full")
    moved = both.where(~(F.col("n").eqNullSafe(F.col("n0")) & F.col("mark").eqNullSafe(F.col("m0"))))
    return sorted(r["day"] for r in moved.select(F.coalesce("day", "d0").alias("day")).where("day IS NOT NULL").collect())


def _days_of(period: tuple[dt.datetime, dt.datetime]) -> Column:
    """Day rows of a half-open period, whose ends must be midnights."""
    if any(t.time() != dt.time() for t in period):
        raise ValueError("periods of a day table start and end at midnight")
    return (F.col("day") >= F.lit(period[0].date())) & (F.col("day") < F.lit(period[1].date()))


def period_profile(days: DataFrame, start: dt.datetime, end: dt.datetime, spec: ChurnSpec = DEFAULT_SPEC, public_only: bool = False) -> DataFrame:
    """A2 from day rows: what ``activity_profile`` gives for the period."""
    rows = days.where(_days_of((start, end)))
    if public_only:
        rows = rows.where(F.col("public"))
    return rows.groupBy("actor").agg(F.sum("event_count").alias("event_count"), F.max("last_event").alias("last_event"),
                                     F.min("first_event").alias("first_event"), *[F.sum(c).alias(c) for c in spec.count_columns])


def two_periods(days: DataFrame, spec: ChurnSpec = DEFAULT_SPEC, public_only: bool = False) -> DataFrame:
    """Both periods of the churn split from day rows: what ``two_period_profile`` gives."""
    first, second = _days_of(spec.first_period), _days_of(spec.second_period)
    rows = days.where(first | second)
    if public_only:
        rows = rows.where(F.col("public"))
    late = F.coalesce(F.sum(F.when(second, row_sum(spec.count_columns))), F.lit(0)).alias("second_period_event_count")
    return rows.groupBy("actor").agg(
        *[F.sum(F.when(first, F.col(c))).alias(c) for c in ("event_count",)], F.max(F.when(first, F.col("last_event"))).alias("last_event"),
        F.min(F.when(first, F.col("first_event"))).alias("first_event"), *[F.sum(F.when(first, F.col(c))).alias(c) for c in spec.count_columns], late)


def churn_table_from_days(users: DataFrame, days: DataFrame, spec: ChurnSpec = DEFAULT_SPEC, keep_inactive: bool = False,
                          public_only: bool = True) -> DataFrame:
    """M24 without reading a raw event."""
    merged = merge_profiles(users, two_periods(days, spec, public_only), spec, keep_inactive=keep_inactive)
    return outlier_filter(merged, spec.outlier_limit)


# ---------------------------------------------------------------- distinct users

def user_sketches(events: DataFrame, lg_k: int = 14) -> DataFrame:
    """(day, n_events, users): a sketch of each day's users (2**lg_k registers; relative error about 0.8 / sqrt(2**lg_k))."""
    return events.groupBy(F.to_date("created_at").alias("day")).agg(F.count(F.lit(1)).alias("n_events"), F.hll_sketch_agg("actor", lg_k).alias("users"))


def distinct_users(sketches: DataFrame, unit: str) -> DataFrame:
    """(period, n_events, number_active_users): distinct users per ``unit`` (day, week, month, quarter, year) from daily
    sketches; ``period`` is its first day."""
    return sketches.groupBy(F.trunc("day", unit).alias("period") if unit != "day" else F.col("day").alias("period")).agg(
        F.sum("n_events").alias("n_events"), F.hll_sketch_estimate(F.hll_union_agg("users")).alias("number_active_users"))
