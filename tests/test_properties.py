"""Property-based checks (hypothesis) of two invariants, batched so each
example set is one Spark job."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from churnlens.operators import stats
from churnlens.operators.sampling import key_hash

KEYS = st.lists(st.integers(min_value=-(2 ** 62), max_value=2 ** 62), min_size=1, max_size=50)
VALUES = st.lists(st.one_of(st.none(), st.floats(min_value=-0.5, max_value=1.5, allow_nan=False)),
                  min_size=0, max_size=60)


@settings(max_examples=8, deadline=None)
@given(keys=KEYS, seed=st.integers(min_value=0, max_value=10_000))
def test_key_hash_is_python_definition(spark, keys, seed):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [r.h for r in df.select(key_hash("k", seed).alias("h")).collect()]
    assert got == [int(hashlib.md5(f"{k}:{seed}".encode()).hexdigest()[:8], 16) for k in keys]


@settings(max_examples=8, deadline=None)
@given(values=VALUES, bins=st.integers(min_value=1, max_value=12))
def test_fixed_histogram_conserves_in_range_rows(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "p double")
    h = stats.fixed_histogram(df, "p", bins, 0.0, 1.0).collect()
    assert sorted(r.bin for r in h) == list(range(bins))
    assert sum(r["count"] for r in h) == sum(1 for v in values if v is not None and 0.0 <= v <= 1.0)
