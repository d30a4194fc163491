"""Sources and sinks: typed reads, CSV/parquet round trips, partition pruning."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from churnlens.plans.lifetime import BGNBDParams, params_frame
from churnlens.sources.tables import (SCHEMAS, read_csv, read_parquet, read_table, user_profiles,
                                      write_csv, write_parquet)
from tests.conftest import SF_SMALL


def test_typed_scan_schema(spark):
    for name in ("events", "customer", "orders", "lineitem", "part"):
        df = read_table(spark, SF_SMALL, name)
        assert df.schema == SCHEMAS[name]


def test_user_profiles_unique_login(spark):
    u = user_profiles(spark, SF_SMALL)
    assert u.count() == u.select("login").distinct().count()


def test_csv_roundtrip_and_stacking(spark, scratch):
    ev = read_table(spark, SF_SMALL, "events")
    a, b = ev.where("event_id % 2 = 0"), ev.where("event_id % 2 = 1")
    write_csv(a, f"{scratch}/part_a")
    write_csv(b, f"{scratch}/part_b")
    back = read_csv(spark, [f"{scratch}/part_a", f"{scratch}/part_b"], SCHEMAS["events"])
    assert back.count() == ev.count()
    assert back.exceptAll(ev).count() == 0


def test_csv_bad_values_become_null(spark, scratch):
    path = f"{scratch}/bad.csv"
    with open(path, "w") as fh:
        fh.write("c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment\n1,x,notanint,2.5,A\n")
    r = read_csv(spark, path, SCHEMAS["customer"]).collect()[0]
    assert r.c_nationkey is None and r.c_acctbal == 2.5


def test_parquet_partitioned_roundtrip_prunes(spark, scratch):
    ev = read_table(spark, SF_SMALL, "events").withColumn("day", F.to_date("ts"))
    write_parquet(ev, f"{scratch}/ev", partition_by=["day"])
    back = read_parquet(spark, f"{scratch}/ev").where(F.col("day") == dt.date(2024, 1, 3))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-03" in plan
    assert back.count() == ev.where(F.col("day") == dt.date(2024, 1, 3)).count()


def test_params_roundtrip(spark, scratch):
    p = BGNBDParams(0.3, 4.0, 0.8, 2.5, 1.0, 10, True)
    write_parquet(params_frame(spark, p), f"{scratch}/params")
    r = read_parquet(spark, f"{scratch}/params").first()
    assert (r.r, r.alpha, r.a, r.b, r.converged) == (0.3, 4.0, 0.8, 2.5, True)


def test_period_filters_prune_day_partitions(spark, scratch):
    from dataclasses import replace

    from churnlens.config import DEFAULT_SPEC
    from churnlens.operators.activity import two_period_profile
    from churnlens.sources.tables import event_log
    ev = read_table(spark, SF_SMALL, "events").withColumn("day", F.to_date("ts"))
    write_parquet(ev, f"{scratch}/events_by_day", partition_by=["day"])
    spec = replace(DEFAULT_SPEC, partition_column="day")
    log = event_log(spark, SF_SMALL, spec, path=f"{scratch}/events_by_day")
    prof = two_period_profile(log, spec)
    plan = prof._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-16" in plan
    plain = two_period_profile(event_log(spark, SF_SMALL), DEFAULT_SPEC)
    assert prof.exceptAll(plain).count() == 0 and plain.exceptAll(prof).count() == 0


def test_export_with_zone_suffix_is_read(spark, scratch):
    from churnlens.sources.tables import read_activity_export
    from churnlens.config import ChurnSpec
    spec = ChurnSpec.for_year(2016)
    head = "actor,event_count,last_event,first_event," + ",".join(spec.count_columns)
    for k, name in enumerate(("octocat", "o'brien")):
        with open(f"{scratch}/shard-{k}.csv", "w") as f:
            f.write(f"{head}\n{name},14,2016-05-31 23:59:59 UTC,2016-01-02 03:04:05 UTC," + ",".join("1" * 14) + "\n")
    rows = read_activity_export(spark, [f"{scratch}/shard-0.csv", f"{scratch}/shard-1.csv"], spec).collect()
    assert {r.actor for r in rows} == {"octocat", "o'brien"}
    assert all(str(r.last_event) == "2016-05-31 23:59:59" and r.PushEvent_count == 1 for r in rows)


def test_stored_tables_follow_the_data(spark, scratch):
    from churnlens.sources import tables
    spark.range(3).write.parquet(f"{scratch}/t.parquet")
    build = lambda: spark.read.parquet(f"{scratch}/t.parquet")
    assert tables._stored(spark, "t", scratch, build).count() == 3
    spark.range(5).write.mode("overwrite").parquet(f"{scratch}/t.parquet")
    assert tables._stored(spark, "t", scratch, build).count() == 5


def test_shared_folder_is_required_on_a_cluster(monkeypatch):
    from churnlens import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())
