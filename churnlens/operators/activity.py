"""Activity profiles.

An activity profile is one row per user for a time slice: event count,
first/last event time and one conditional count per event type.  It is a
single hash aggregation: partial aggregation runs before the shuffle, so a
user holding a third of all events costs one partial row per map task, not a
hot reducer.  Time slices are plain range filters on the event time and are
pushed into the parquet scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.config import DEFAULT_SPEC, ChurnSpec
from churnlens.functions.columns import json_field, month_of


def in_period(start: dt.datetime, end: dt.datetime, ts: str = "created_at",
              partition_column: str | None = None) -> Column:
    """Half-open slice [start, end) of the event time.

    With a date ``partition_column`` the same range is also stated on it, so
    the scan prunes whole partitions before reading any file.
    """
    cond = (F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end))
    if partition_column:
        last_day = (end - dt.timedelta(microseconds=1)).date()
        cond = cond & F.col(partition_column).between(F.lit(start.date()), F.lit(last_day))
    return cond


def day_range(first_day: dt.date, last_day: dt.date, ts: str = "created_at") -> Column:
    """Day-inclusive range at both ends (TABLE_DATE_RANGE semantics)."""
    start = dt.datetime.combine(first_day, dt.time())
    end = dt.datetime.combine(last_day + dt.timedelta(days=1), dt.time())
    return in_period(start, end, ts)


def years_of(df: DataFrame, years: Sequence[int], ts: str) -> DataFrame:
    """Several yearly slices scanned as one (UNION ALL of year tables)."""
    bounds = [in_period(dt.datetime(y, 1, 1), dt.datetime(y + 1, 1, 1), ts) for y in years]
    cond = bounds[0]
    for b in bounds[1:]:
        cond = cond | b
    return df.where(cond)


def _profile_aggs(types: Sequence[str], mask: Column | None = None) -> list[Column]:
    def m(c: Column) -> Column:
        return c if mask is None else F.when(mask, c)
    return [
        F.count(m(F.col("type"))).alias("event_count"),
        F.max(m(F.col("created_at"))).alias("last_event"),
        F.min(m(F.col("created_at"))).alias("first_event"),
        *[F.count(F.when((F.col("type") == t) if mask is None else (mask & (F.col("type") == t)),
                         F.lit(1))).alias(f"{t}_count") for t in types],
    ]


def activity_profile(events: DataFrame, start: dt.datetime | None = None,
                     end: dt.datetime | None = None, spec: ChurnSpec = DEFAULT_SPEC,
                     public_only: bool = False, key: str = "actor") -> DataFrame:
    """A2: ``GROUP BY actor`` with count, max, min and one count per type.

    Counts of absent types are 0 (not null as ``pivot`` would give).
    """
    ev = events
    if start is not None and end is not None:
        ev = ev.where(in_period(start, end, partition_column=spec.partition_column))
    if public_only:
        ev = ev.where(F.col("public"))
    return ev.groupBy(key).agg(*_profile_aggs(spec.event_types))


def user_activity(events: DataFrame, user, spec: ChurnSpec = DEFAULT_SPEC,
                  public_only: bool = True) -> DataFrame:
    """A1: activity profile of one user over the whole log; exactly one row.

    ``user`` is a literal key, or a one-row DataFrame with column ``actor``
    (a key computed by Spark), applied as a broadcast semi-join.
    """
    if isinstance(user, DataFrame):
        ev = events.join(F.broadcast(user.select("actor").limit(1)), "actor", "left_semi")
    else:
        ev = events.where(F.col("actor") == F.lit(user))
    if public_only:
        ev = ev.where(F.col("public"))
    return ev.agg(*_profile_aggs(spec.event_types))


def monthly_event_counts(events: DataFrame) -> DataFrame:
    """Public events per month, ordered by month."""
    return (events.where(F.col("public"))
            .groupBy(month_of("created_at").alias("month"))
            .agg(F.count("type").alias("event_count"))
            .orderBy("month"))


def monthly_active_users(events: DataFrame, approximate: bool = False) -> DataFrame:
    """A4: distinct active users per month (exact by default)."""
    agg = (F.approx_count_distinct("actor") if approximate else F.count_distinct("actor"))
    return (events.where(F.col("public"))
            .groupBy(month_of("created_at").alias("month"))
            .agg(agg.alias("number_active_users"))
            .orderBy("month"))


def json_field_counts(events: DataFrame, path: str, event_type: str | None,
                      first_day: dt.date, last_day: dt.date) -> DataFrame:
    """Rows per JSON field value over a filtered date range."""
    ev = events.where(day_range(first_day, last_day))
    if event_type is not None:
        ev = ev.where(F.col("type") == event_type)
    return ev.groupBy(json_field("payload", path).alias("field_value")).agg(
        F.count(F.lit(1)).alias("n_events"))


def two_period_profile(events: DataFrame, spec: ChurnSpec = DEFAULT_SPEC,
                       public_only: bool = False) -> DataFrame:
    """Both periods of the churn split in ONE scan and ONE shuffle.

    First-period columns are null for a user without first-period events (the
    row would be absent from a per-period table); ``second_period_event_count``
    is the 14-type (here: all declared types) sum of the second period.
    """
    f0, f1 = spec.first_period
    s0, s1 = spec.second_period
    pc = spec.partition_column
    # OR of the two ranges: pushed into the scan as is, so a gap between the
    # periods is never read
    ev = events.where(in_period(f0, f1, partition_column=pc) | in_period(s0, s1, partition_column=pc))
    if public_only:
        ev = ev.where(F.col("public"))
    first = in_period(f0, f1)
    second = in_period(s0, s1) & F.col("type").isin(*spec.event_types)
    aggs = _profile_aggs(spec.event_types, first)
    prof = ev.groupBy("actor").agg(*aggs, F.count(F.when(second, F.lit(1))).alias("second_period_event_count"))
    has_first = F.col("event_count") > 0
    cols = ["event_count", "last_event", "first_event", *spec.count_columns]
    return prof.select(
        "actor",
        *[F.when(has_first, F.col(c)).alias(c) for c in cols],
        "second_period_event_count",
    )


def with_payload(events: DataFrame, payload: str = "payload", out: str = "parsed") -> DataFrame:
    """The payload parsed once into a VARIANT; malformed text becomes null."""
    return events.withColumn(out, F.try_parse_json(F.col(payload)))


def payload_fields(parsed: DataFrame, paths: dict[str, tuple[str, str]], variant: str = "parsed") -> DataFrame:
    """One column per (path, type) of a parsed payload; null where the path is missing or doesn't cast.

    All paths are read from the same parsed value; nothing is parsed again.
    """
    return parsed.withColumns({name: F.try_variant_get(F.col(variant), path, kind) for name, (path, kind) in paths.items()})


def payload_schema(parsed: DataFrame, variant: str = "parsed") -> DataFrame:
    """(schema, n_parsed): the merged schema of all payloads, from which paths are discovered."""
    return parsed.agg(F.schema_of_variant_agg(F.col(variant)).alias("schema"), F.count(variant).alias("n_parsed"))


def period_days(spark, periods: dict[str, tuple[dt.datetime, dt.datetime]]) -> DataFrame:
    """(period, day) for named half-open periods of whole days."""
    rows = [(name, a.date(), (b - dt.timedelta(microseconds=1)).date()) for name, (a, b) in periods.items()]
    table = spark.createDataFrame(rows, "period string, first date, last date")
    return table.select("period", F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("day"))


def profiles_of_periods(events_by_day: DataFrame, days: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """A2 for several periods at once, from a log that is partitioned by ``day``.

    The scan learns its days from the period table at run time (dynamic
    pruning): a day that no period has is not listed; one that several have
    is read once.
    """
    hit = events_by_day.join(F.broadcast(days), "day")  # a row for each day of each period
    return hit.groupBy("period", "actor").agg(*_profile_aggs(spec.event_types))
