"""DuckDB twins of the registered queries (the correctness oracle).

Each string runs on the driver's pre-registered views.  Shared pieces are
CTE fragments built from the same spec the Spark side uses, so a change to
the spec changes both sides.  Computed doubles are rounded equally on both
sides; counts are BIGINT on both sides.
"""

from __future__ import annotations

from churnlens.config import DEFAULT_SPEC, ChurnSpec


def _ts(x) -> str:
    return f"TIMESTAMP '{x:%Y-%m-%d %H:%M:%S}'"


def in_period_sql(period, col="ts") -> str:
    return f"{col} >= {_ts(period[0])} AND {col} < {_ts(period[1])}"


def type_counts_sql(spec: ChurnSpec = DEFAULT_SPEC, mask: str = "TRUE") -> str:
    return ",\n".join(
        f"count(CASE WHEN {mask} AND event_type = '{t}' THEN 1 END) AS {t}_count"
        for t in spec.event_types)


def profile_select_sql(spec: ChurnSpec = DEFAULT_SPEC) -> str:
    return (f"count(event_type) AS event_count, max(ts) AS last_event, min(ts) AS first_event,\n"
            f"{type_counts_sql(spec)}")


def users_cte(spec: ChurnSpec = DEFAULT_SPEC) -> str:
    return """
order_stats AS (
  SELECT o_custkey AS login, CAST(count(*) AS INTEGER) AS followers_count,
         min(o_orderdate) AS created_at, max(o_orderdate) AS updated_at
  FROM orders GROUP BY o_custkey),
line_stats AS (
  SELECT o_custkey AS login, CAST(count(*) AS INTEGER) AS following_count,
         CAST(count(DISTINCT l_partkey) AS INTEGER) AS public_repos_count,
         CAST(count(DISTINCT l_suppkey) AS INTEGER) AS public_gists_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey),
profiles AS (
  SELECT c.c_custkey AS login,
         coalesce(os.followers_count, 0) AS followers_count,
         coalesce(ls.following_count, 0) AS following_count,
         coalesce(ls.public_repos_count, 0) AS public_repos_count,
         coalesce(ls.public_gists_count, 0) AS public_gists_count,
         c.c_name AS bio,
         CASE WHEN c.c_acctbal >= 0 THEN c.c_name END AS blog,
         CASE WHEN c.c_mktsegment = 'BUILDING' THEN c.c_mktsegment END AS company,
         CASE WHEN c.c_mktsegment <> 'AUTOMOBILE' THEN c.c_nationkey % 2 = 0 END AS hireable,
         os.created_at, os.updated_at
  FROM customer c
  LEFT JOIN order_stats os ON c.c_custkey = os.login
  LEFT JOIN line_stats ls ON c.c_custkey = ls.login)"""


ORDERS_AS_EVENTS = ("(SELECT o_custkey AS user_id, o_orderstatus AS event_type, o_orderdate AS ts "
                    "FROM orders)")


def periods_cte(spec: ChurnSpec = DEFAULT_SPEC, prefix: str = "", source: str = "events",
                public: bool = False) -> str:
    """``{prefix}first_period`` and ``{prefix}second_period`` over an event
    source with columns (user_id, event_type, ts); ``public`` leaves private
    types out."""
    if public and spec.private_types:
        private = ", ".join(f"'{t}'" for t in spec.private_types)
        source = f"(SELECT * FROM {source} WHERE event_type NOT IN ({private}))"
    types = ", ".join(f"'{t}'" for t in spec.event_types)
    return f"""
{prefix}first_period AS (
  SELECT user_id AS actor, {profile_select_sql(spec)}
  FROM {source} ev WHERE {in_period_sql(spec.first_period)} GROUP BY user_id),
{prefix}second_period AS (
  SELECT user_id AS actor,
         count(CASE WHEN event_type IN ({types}) THEN 1 END) AS second_period_event_count
  FROM {source} ev WHERE {in_period_sql(spec.second_period)} GROUP BY user_id)"""


def merged_cte(spec: ChurnSpec = DEFAULT_SPEC, how: str = "JOIN", fill: bool = False,
               prefix: str = "") -> str:
    counts = [f"coalesce(f.{c}, 0)" if fill else f"f.{c}" for c in spec.count_columns]
    return f"""
{prefix}merged AS (
  SELECT p.login, CAST(p.followers_count AS INTEGER) AS followers_count,
         CAST(p.following_count AS INTEGER) AS following_count,
         CAST(p.blog IS NOT NULL AS INTEGER) AS blog,
         CAST(p.company IS NOT NULL AS INTEGER) AS company,
         p.created_at,
         CAST(p.public_repos_count AS INTEGER) AS public_repos_count,
         CAST(p.public_gists_count AS INTEGER) AS public_gists_count,
         CAST(p.hireable IS NOT NULL AS INTEGER) AS hireable,
         CAST(date_diff('day', CAST(p.created_at AS DATE), CAST(f.last_event AS DATE)) AS INTEGER) AS recency,
         p.updated_at,
         CAST(date_diff('day', CAST(f.first_event AS DATE), CAST(f.last_event AS DATE)) AS INTEGER)
              AS time_between_first_last_event,
         f.last_event, f.first_event,
         CAST({' + '.join(counts)} AS BIGINT) AS frequency,
         CAST(coalesce(s.second_period_event_count, 0) AS BIGINT) AS second_period_event_count,
         {', '.join(f'CAST({e} AS BIGINT) AS {c}' for e, c in zip(counts, spec.count_columns))}
  FROM profiles p {how} {prefix}first_period f ON p.login = f.actor
  LEFT JOIN {prefix}second_period s ON p.login = s.actor)"""


def churn_ctes(spec: ChurnSpec = DEFAULT_SPEC, prefix: str = "", source: str = "events") -> str:
    """CTE list (no WITH, no users) ending in ``{prefix}churn``; needs ``profiles``."""
    return (periods_cte(spec, prefix, source, public=True) + "," + merged_cte(spec, prefix=prefix) + f""",
{prefix}churn AS (
  SELECT * FROM {prefix}merged
  WHERE frequency < {spec.outlier_limit} AND second_period_event_count < {spec.outlier_limit})""")


def churn_cte(spec: ChurnSpec = DEFAULT_SPEC) -> str:
    """WITH-list ending in ``churn``: the merged table after the outlier filter."""
    return "WITH " + users_cte(spec) + "," + churn_ctes(spec)


def churn_column_names(spec: ChurnSpec = DEFAULT_SPEC) -> list[str]:
    """Column order of the merged churn table (mirrors ``merge.churn_columns``)."""
    from churnlens.operators.merge import churn_columns
    return churn_columns(spec)
