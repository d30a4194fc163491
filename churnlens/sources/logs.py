"""Other tables seen as event logs (actor, type, created_at, public)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.sources.tables import read_table


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as purchase events of a customer (used for lifetime value)."""
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("actor"), F.col("o_orderstatus").alias("type"),
        F.col("o_orderdate").alias("created_at"), F.lit(True).alias("public"))


def archive_event_log(raw: DataFrame) -> DataFrame:
    """The GitHub archive's event schema (type, public, repo{name},
    actor{login}, created_at, payload JSON) as the canonical event log.

    ``type`` stays as it is, so filters on it reach the scan.
    """
    return raw.select(
        F.col("actor.login").alias("actor"),
        F.col("type"),
        F.col("created_at").alias("created_at"),
        F.col("payload").alias("payload"),
        F.col("public").alias("public"),
        F.col("repo.name").alias("repo"),
    )
