"""The merged churn table (M24) and its parts.

One row per user: profile counts and presence flags, date features from the
first period, the first-period type counts, ``frequency`` (their row sum) and
``second_period_event_count`` (the label source).  Both periods come from one
aggregation (:func:`two_period_profile`), so the events are shuffled once; the
profile join is on the same key and reuses that partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.config import DEFAULT_SPEC, ChurnSpec
from churnlens.functions.columns import day_diff, presence_flag, row_sum, try_int
from churnlens.operators.activity import two_period_profile

PROFILE_COUNTS = ("followers_count", "following_count", "public_repos_count", "public_gists_count")


def churn_columns(spec: ChurnSpec = DEFAULT_SPEC) -> list[str]:
    """The column list of the merged table, in order."""
    return ["login", "followers_count", "following_count", "blog", "company", "created_at",
            "public_repos_count", "public_gists_count", "hireable", "recency", "updated_at",
            "time_between_first_last_event", "last_event", "first_event", "frequency",
            "second_period_event_count", *spec.count_columns]


def merge_profiles(users: DataFrame, periods: DataFrame, spec: ChurnSpec = DEFAULT_SPEC,
                   keep_inactive: bool = False, how: str | None = None, fill_ts=None) -> DataFrame:
    """J1+J2+E4+P4+P5+P8+P11+P1 on a two-period profile.

    ``keep_inactive=False`` pins the reference result: users without a
    first-period row have a null ``frequency`` and are dropped by the outlier
    filter, so the join is written as the inner join Catalyst would derive
    anyway.  ``keep_inactive=True`` keeps them with zero counts, and
    ``fill_ts`` then stands for their missing first and last event.
    """
    how = how or ("left" if keep_inactive else "inner")
    j = users.join(periods, users.login == periods.actor, how).drop("actor")
    if fill_ts is not None:
        j = j.withColumns({c: F.coalesce(F.col(c), F.lit(fill_ts)) for c in ("last_event", "first_event")})
    counts = [F.col(c) for c in spec.count_columns]
    if keep_inactive:
        counts = [F.coalesce(c, F.lit(0)).alias(n) for c, n in zip(counts, spec.count_columns)]
    cols = {
        "login": F.col("login"),
        **{c: try_int(c) for c in PROFILE_COUNTS},
        "blog": presence_flag("blog"),
        "company": presence_flag("company"),
        "hireable": presence_flag("hireable"),
        "created_at": F.col("created_at"),
        "updated_at": F.col("updated_at"),
        "recency": day_diff("last_event", "created_at"),
        "time_between_first_last_event": day_diff("last_event", "first_event"),
        "last_event": F.col("last_event"),
        "first_event": F.col("first_event"),
        "frequency": row_sum(counts),
        "second_period_event_count": F.coalesce(F.col("second_period_event_count"), F.lit(0)),
    }
    for c, n in zip(counts, spec.count_columns):
        cols[n] = c
    return j.select([cols[c].alias(c) for c in churn_columns(spec)])


def outlier_filter(df: DataFrame, limit: int) -> DataFrame:
    """keep users under ``limit`` events in both periods (null frequency drops)."""
    return df.where((F.col("frequency") < limit) & (F.col("second_period_event_count") < limit))


def churn_table(users: DataFrame, events: DataFrame, spec: ChurnSpec = DEFAULT_SPEC,
                keep_inactive: bool = False, public_only: bool = True) -> DataFrame:
    """The flagship merged churn table of public events, outliers removed."""
    periods = two_period_profile(events, spec, public_only=public_only)
    merged = merge_profiles(users, periods, spec, keep_inactive=keep_inactive)
    return outlier_filter(merged, spec.outlier_limit)


def merge_period_profiles(users: DataFrame, first: DataFrame, second: DataFrame,
                          spec: ChurnSpec = DEFAULT_SPEC, keep_inactive: bool = False) -> DataFrame:
    """M24 from stored profiles of the two periods (columns of
    :func:`activity_profile`, unique on ``actor``) instead of raw events."""
    late = second.select("actor", row_sum([F.col(c) for c in spec.count_columns]).alias("second_period_event_count"))
    periods = first.join(late, "actor", "full")
    merged = merge_profiles(users, periods, spec, keep_inactive=keep_inactive)
    return outlier_filter(merged, spec.outlier_limit)


def serving_table(users: DataFrame, events: DataFrame, spec: ChurnSpec = DEFAULT_SPEC, fill_ts=None,
                  public_only: bool = True) -> DataFrame:
    """M16's input: the churn table's columns for every user, active or not,
    outliers included; missing counts are 0 and missing event times ``fill_ts``."""
    periods = two_period_profile(events, spec, public_only=public_only)
    return merge_profiles(users, periods, spec, keep_inactive=True, fill_ts=fill_ts)


def outlier_share(users: DataFrame, events: DataFrame, spec: ChurnSpec = DEFAULT_SPEC,
                  public_only: bool = True) -> DataFrame:
    """Users before/after the outlier filter and % removed, in one pass."""
    periods = two_period_profile(events, spec, public_only=public_only)
    merged = merge_profiles(users, periods, spec, how="left")
    kept = (F.col("frequency") < spec.outlier_limit) & (
        F.col("second_period_event_count") < spec.outlier_limit)
    # Unfiltered total as in the reference: every profile row (left join).
    out = merged.agg(F.count(F.lit(1)).alias("n_total_users"),
                     F.count(F.when(kept, 1)).alias("n_users"))
    return out.select("n_total_users", "n_users",
                      F.round(F.lit(100.0) - F.try_divide(F.col("n_users") * 100.0, F.col("n_total_users")), 2)
                      .alias("pct_dropped"))


def serving_fill(df: DataFrame, spec: ChurnSpec = DEFAULT_SPEC, fill_ts=None) -> DataFrame:
    """P15 (P3+P11+P12): ``event_count`` becomes ``frequency``, the sum of the
    type counts as in training (B13; without those it is renamed); null counts and scale columns -> 0; null
    first/last event -> ``fill_ts``.  One projection."""
    fills0 = set(spec.count_columns) | set(spec.scale_columns)
    out = []
    for f in df.schema.fields:
        name = "frequency" if f.name == "event_count" else f.name
        c = F.col(f.name)
        if f.name == "event_count" and set(spec.count_columns) <= set(df.columns):
            c = row_sum([F.coalesce(F.col(x), F.lit(0)) for x in spec.count_columns])
        elif name in fills0:
            c = F.coalesce(c, F.lit(0).cast(f.dataType))
        elif name in ("last_event", "first_event") and fill_ts is not None:
            c = F.coalesce(c, F.lit(fill_ts).cast(f.dataType))
        out.append(c.alias(name))
    return df.select(out)


# ---------------------------------------------------------------- co-located merge

def store_by_user(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``df`` as a table bucketed and sorted by its user key in the warehouse.

    Tables with the same number of buckets join on that key without a shuffle,
    also when only one side has been stored anew.
    """
    # One task a bucket: a bucket is one file, not one per task.
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def colocated_churn_table(users: DataFrame, periods: DataFrame, spec: ChurnSpec = DEFAULT_SPEC, keep_inactive: bool = False) -> DataFrame:
    """M24 from two tables of :func:`store_by_user` (profiles by ``login``, two-period profiles by ``actor``): each
    bucket is merged where it lies."""
    merged = merge_profiles(users.hint("merge"), periods, spec, keep_inactive=keep_inactive)
    return outlier_filter(merged, spec.outlier_limit)
