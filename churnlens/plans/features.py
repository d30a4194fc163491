"""Feature engineering.

All columns are produced by ONE projection over the churn table (no
``withColumn`` chains): log scaling, binarised counts, the label and the two
K-means activity features.  The feature list is picked from the schema by
type, as the reference does, but from a declared schema.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.config import DEFAULT_SPEC, ChurnSpec
from churnlens.functions.columns import log1p_scaled, row_sum

# Columns never used as model inputs, whatever their type.
EXCLUDED_FEATURES = ("second_period_event_count", "frequency", "public_repos_count",
                     "public_gists_count", "high_low_user", "company",
                     "time_between_first_last_event", "label", "non_passive_events",
                     "public_repos_gists")


def feature_table(churn: DataFrame, spec: ChurnSpec = DEFAULT_SPEC,
                  label_threshold: float = 0.5) -> DataFrame:
    """E8+E9+E10+M2: scaled features, bins, label and K-means inputs.

    * counts, profile scale columns and ``recency``: ln(x + 1) (null below -1)
    * ``<type>_count_bin`` for binarised types: raw count > 0.5
    * ``label`` = 1.0 when the second-period count exceeds the threshold
    * ``non_passive_events`` = ln(1 + frequency - passive counts) from RAW
      counts (B3), ``public_repos_gists`` = ln(1 + repos + gists)
    """
    scaled = set(spec.count_columns) | set(spec.scale_columns) | {"recency"}
    passive = [f"{t}_count" for t in spec.passive_types]
    out = []
    for f in churn.schema.fields:
        c = f.name
        out.append(log1p_scaled(c).alias(c) if c in scaled else F.col(c))
    out += [(F.col(f"{t}_count") > label_threshold).cast("double").alias(f"{t}_count_bin")
            for t in spec.binarised_types]
    out += [
        (F.col("second_period_event_count").cast("double") > label_threshold).cast("double").alias("label"),
        log1p_scaled(F.col("frequency") - row_sum(passive)).alias("non_passive_events"),
        log1p_scaled(F.col("public_repos_count") + F.col("public_gists_count")).alias("public_repos_gists"),
    ]
    return churn.select(out)


def feature_columns(df: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> list[str]:
    """P10: int/double columns minus the exclusion list and binarised types,
    then the binarised substitutes (order of the schema)."""
    dropped = (set(EXCLUDED_FEATURES) | {f"{t}_count" for t in spec.binarised_types}
               | {f"{t}_count" for t in spec.dropped_types})
    bins = [f"{t}_count_bin" for t in spec.binarised_types]
    picked = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.IntegerType, T.DoubleType))
              and f.name not in dropped and f.name not in bins]
    return picked + bins


def assembler(inputs: list[str], output: str = "features") -> VectorAssembler:
    """Vector assembly; rows with null/NaN inputs are skipped."""
    return VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="skip")


def segment_inputs(original: bool = False) -> list[str]:
    """M1: the two K-means inputs (derived activity, or scaled frequency/recency)."""
    return ["non_passive_events", "public_repos_gists"] if original else ["frequency", "recency"]
