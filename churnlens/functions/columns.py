"""Scalar column functions.

All are built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen; none is a Python UDF.  Spark 4 runs with ANSI on, so casts and
parses that may meet dirty input use the ``try_`` forms.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_sum(cols: Iterable[str | Column], null_safe: bool = False) -> Column:
    """Row-wise sum; null if any input is null unless ``null_safe``."""
    cs = [_c(c) for c in cols]
    if not cs:
        return F.lit(0)
    if null_safe:
        cs = [F.coalesce(c, F.lit(0)) for c in cs]
    return reduce(add, cs)


def presence_flag(c: str | Column) -> Column:
    """1 when the value is present (not null), else 0 — as int."""
    return _c(c).isNotNull().cast("int")


def try_int(c: str | Column) -> Column:
    """P5: cast to int; bad text or out-of-range values become null."""
    return F.try_cast(_c(c), T.IntegerType()) if hasattr(F, "try_cast") else _c(c).try_cast("int")


def narrow_bigints(df: DataFrame) -> DataFrame:
    """Every ``bigint`` column narrowed to int in one projection."""
    return df.select([
        _c(f.name).try_cast("int").alias(f.name) if isinstance(f.dataType, T.LongType)
        else F.col(f.name) for f in df.schema.fields
    ])


def log1p_scaled(c: str | Column) -> Column:
    """ln(x + 1) as double; null for x <= -1."""
    return F.log1p(_c(c).cast("double"))


def day_diff(end: str | Column, start: str | Column) -> Column:
    """Whole calendar days between two timestamps (end - start)."""
    return F.datediff(_c(end).cast("date"), _c(start).cast("date"))


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def frac_days(end: str | Column, start: str | Column) -> Column:
    """E5: fractional day difference (end - start) / 1 day."""
    return (_micros(_c(end)) - _micros(_c(start))) / F.lit(86400e6)


def to_central(c: str | Column) -> Column:
    """UTC wall time to US Central wall time."""
    return F.from_utc_timestamp(_c(c).cast("timestamp"), "America/Chicago")


def month_of(c: str | Column) -> Column:
    """Month number 1-12."""
    return F.month(_c(c))


def json_field(c: str | Column, path: str) -> Column:
    """JSON path value as unquoted text."""
    return F.get_json_object(_c(c), path)


def strip_spaces(c: str | Column) -> Column:
    """Remove every space."""
    return F.replace(_c(c), F.lit(" "), F.lit(""))


def vector_element(c: str | Column, i: int) -> Column:
    """Element ``i`` of an ML vector (e.g. P(label=1) of ``probability``)."""
    return vector_to_array(_c(c))[i]


def verdict(p: str | Column, threshold: float = 0.5) -> Column:
    """Verdict text from a probability of staying active."""
    return F.when(_c(p) > threshold, F.lit("remain active")).otherwise(F.lit("leave"))


def strip_zone_suffix(c: str | Column) -> Column:
    """Cut a trailing ``' UTC'`` zone name (null-safe, unlike a UDF)."""
    return F.regexp_replace(_c(c), r"\s+UTC$", "")


def parse_ts(c: str | Column) -> Column:
    """Text to timestamp; unparsable text becomes null."""
    col = _c(c)
    return F.try_to_timestamp(strip_zone_suffix(col.cast("string")))
