"""SQL entry: the reference's warehouse queries as parameterised Spark SQL.

Views are registered over the typed sources; values (periods, user keys,
event types) are bound with named parameter markers (``spark.sql(q,
args=...)``), never spliced into the text.  Catalyst plans these exactly
like the DataFrame forms.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from churnlens.config import DEFAULT_SPEC, ChurnSpec
from churnlens.sources.tables import event_log


def register_views(spark: SparkSession, sf_dir: str, spec: ChurnSpec = DEFAULT_SPEC) -> None:
    """Temp view ``event_log`` (actor, type, created_at, payload, public)."""
    event_log(spark, sf_dir, spec).createOrReplaceTempView("event_log")


def _type_counts(spec: ChurnSpec) -> str:
    # Column names come from the declared spec (identifiers cannot be bound
    # as parameters); every value is a parameter marker.
    return ",\n  ".join(f"COUNT(CASE WHEN type = :t{i} THEN 1 END) AS {t}_count"
                        for i, t in enumerate(spec.event_types))


def _type_args(spec: ChurnSpec) -> dict:
    return {f"t{i}": t for i, t in enumerate(spec.event_types)}


def events_per_month(spark: SparkSession) -> DataFrame:
    """A3 in SQL: public events per month, grouped by the month expression."""
    return spark.sql("""
        SELECT month(created_at) AS month, COUNT(type) AS event_count
        FROM event_log WHERE public
        GROUP BY month(created_at) ORDER BY month""")


def active_users_per_month(spark: SparkSession) -> DataFrame:
    """A4 in SQL: distinct active users per month."""
    return spark.sql("""
        SELECT month(created_at) AS month, COUNT(DISTINCT actor) AS number_active_users
        FROM event_log WHERE public
        GROUP BY month(created_at) ORDER BY month""")


def activity_export(spark: SparkSession, start: dt.datetime, end: dt.datetime,
                    spec: ChurnSpec = DEFAULT_SPEC, public_only: bool = True) -> DataFrame:
    """A2 in SQL (the reference's export query) for [start, end)."""
    where = "created_at >= :start AND created_at < :end" + (" AND public" if public_only else "")
    return spark.sql(f"""
        SELECT actor, COUNT(type) AS event_count, MAX(created_at) AS last_event,
               MIN(created_at) AS first_event,
          {_type_counts(spec)}
        FROM event_log WHERE {where}
        GROUP BY actor""", args={"start": start, "end": end, **_type_args(spec)})


def user_events(spark: SparkSession, user: int, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """A1 in SQL: one user's public activity; the key is a bound parameter."""
    return spark.sql(f"""
        SELECT COUNT(type) AS event_count, MAX(created_at) AS last_event,
               MIN(created_at) AS first_event,
          {_type_counts(spec)}
        FROM event_log WHERE actor = :user AND public""",
                     args={"user": user, **_type_args(spec)})
