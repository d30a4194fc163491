"""Live profile: incremental micro-batches give the same result as one batch job."""

from churnlens.config import DEFAULT_SPEC
from churnlens.operators.activity import activity_profile
from churnlens.sources.tables import event_log, read_table
from churnlens.streaming import latest_profiles, run_profile_changelog
from tests.conftest import SF_SMALL


def test_incremental_equals_batch(spark, scratch):
    ev = read_table(spark, SF_SMALL, "events")
    src = f"{scratch}/src"
    ev.where("ts < '2024-01-15'").coalesce(1).write.parquet(f"{src}/a")
    ckpt, table = f"{scratch}/ckpt", f"{scratch}/profiles"
    # file source reads files under the directory; sub-folders are written as they "arrive"
    run_profile_changelog(spark, f"{src}/*", table, DEFAULT_SPEC, checkpoint=ckpt)
    first = latest_profiles(spark, table).count()
    ev.where("ts >= '2024-01-15'").coalesce(1).write.parquet(f"{src}/b")
    run_profile_changelog(spark, f"{src}/*", table, DEFAULT_SPEC, checkpoint=ckpt)
    got = latest_profiles(spark, table)
    want = activity_profile(event_log(spark, SF_SMALL))
    assert first > 0
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    batches = spark.read.parquet(table).select("batch_id").distinct().count()
    assert batches == 2
