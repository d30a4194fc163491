"""Descriptive statistics and metrics as aggregations.

Every metric is one ``agg`` (partial + final, one small shuffle or none);
nothing is computed by collecting rows.  Only histogram ranges (two
scalars) come back to the driver, to become literals of the bin expression.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def segment_counts(df: DataFrame, segments: Mapping[str, Column]) -> DataFrame:
    """Row count of the table and of each named segment, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count(F.when(cond, 1)).alias(f"n_{name}") for name, cond in segments.items()])


QUARTILES = (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))


def exact_quartiles(df: DataFrame, cols: Sequence[str], accuracy: int = 10000) -> DataFrame:
    """(column, p25, p50, p75): the smallest value whose cumulative count
    reaches p * n, exact at any size.

    A first pass brackets each quartile with approximate percentiles (rank
    error at most 1 / accuracy), a second counts the rows below each bracket in
    one aggregate row, and a third counts the values inside the brackets, about
    6 / accuracy of the rows; no other row is passed on.  ``df`` is read three
    times, so it should be a stored table.
    """
    margin = 3.0 / accuracy
    probes = [p for _, q in QUARTILES for p in (max(0.0, q - margin), min(1.0, q + margin))]
    got = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probes, accuracy).alias(f"q{i}")
                   for i, c in enumerate(cols)]).first()  # one row
    spots = [(i, j, c, name, q, *((got[f"q{i}"][2 * j], got[f"q{i}"][2 * j + 1]) if got[f"q{i}"] else (0.0, 0.0)))
             for i, c in enumerate(cols) for j, (name, q) in enumerate(QUARTILES)]
    x = [F.col(c).cast("double") for c in cols]
    below = df.agg(*[F.count(v).alias(f"n{i}") for i, v in enumerate(x)],
                   *[F.count(F.when(x[i] < lo, 1)).alias(f"b{i}_{j}") for i, j, _, _, _, lo, _ in spots]).first()  # one row
    inside = F.array(*[F.when((x[i] >= lo) & (x[i] <= hi), F.struct(
        F.lit(c).alias("column"), F.lit(name).alias("name"), F.lit(math.ceil(q * below[f"n{i}"]) - below[f"b{i}_{j}"]).cast("long").alias("need"), x[i].alias("v")))
        for i, j, c, name, q, lo, hi in spots])
    counted = df.select(F.inline(F.filter(inside, lambda s: s.isNotNull()))).groupBy("column", "name", "need", "v").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("column", "name").orderBy("v"))
    found = counted.select("column", "name", "need", "v", upto.alias("upto")).where("upto >= need").groupBy("column", "name").agg(F.min("v").alias("v"))
    return found.groupBy("column").agg(*[F.max(F.when(F.col("name") == n, F.col("v"))).alias(n) for n, _ in QUARTILES])


def summary_stats(df: DataFrame, cols: Sequence[str], quartiles: bool = False,
                  approximate: bool = False, accuracy: int = 10000) -> DataFrame:
    """count/mean/stddev/min/max per column (long form), one scan.

    ``quartiles=True`` adds exact quartiles (the columns are stored and read
    three more times), or, with ``approximate=True``, ``percentile_approx``
    ones in the same scan.
    """
    if quartiles and not approximate:
        from churnlens.sources.tables import stored_table
        held, _ = stored_table(df.select(*cols), "summary")
        return summary_stats(held, cols).join(exact_quartiles(held, cols, accuracy), "column", "left")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
        if quartiles:
            aggs.append(F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy).alias(f"{c}__q"))
    wide = df.agg(*aggs)
    rows = []
    for c in cols:
        fields = [F.lit(c).alias("column"), F.col(f"{c}__count").alias("count"),
                  F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__stddev").alias("stddev"),
                  F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max")]
        if quartiles:
            fields += [F.col(f"{c}__q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))]
        rows.append(F.struct(*fields))
    return wide.select(F.inline(F.array(*rows)))


def pearson(a: str | Column, b: str | Column, a_nullable: bool = True,
            b_nullable: bool = True) -> Column:
    """Pearson r over the rows where both are present; null (not an ANSI
    division error, as ``corr`` raises) when either side has no variance.

    A side known to hold no nulls needs no pairwise mask on the other, which
    lets Catalyst share its ``stddev_samp`` between all pairs of one ``agg``.
    """
    x, y = _c(a).cast("double"), _c(b).cast("double")
    x2 = F.when(y.isNotNull(), x) if b_nullable else x
    y2 = F.when(x.isNotNull(), y) if a_nullable else y
    return F.try_divide(F.covar_samp(x2, y2), F.stddev_samp(x2) * F.stddev_samp(y2))


def _co_moments(m: np.ndarray) -> np.ndarray:
    """(6, k, k) of the rows of ``m`` (nulls are NaN) where both columns of a pair are present: count, mean of the first,
    mean of the second, and the sums of squares and products about these means."""
    has = ~np.isnan(m)
    h = has.astype("float64")
    size = h.sum(axis=0)
    pivot = np.divide(np.where(has, m, 0.0).sum(axis=0), size, out=np.zeros(len(size)), where=size > 0)
    v = np.where(has, m - pivot, 0.0)  # small numbers: sums about the pivot don't cancel
    n, x, y = h.T @ h, v.T @ h, h.T @ v
    some = np.maximum(n, 1.0)
    return np.stack([n, pivot[:, None] + x / some, pivot[None, :] + y / some,
                     np.maximum((v * v).T @ h - x * x / some, 0.0), np.maximum(h.T @ (v * v) - y * y / some, 0.0), v.T @ v - x * y / some])


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The co-moments of two sets of rows together."""
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    dx, dy, both = b[1] - a[1], b[2] - a[2], a[0] * share
    return np.stack([n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dx * both, a[4] + b[4] + dy * dy * both, a[5] + b[5] + dx * dy * both])


def correlation_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every pair c1 < c2 (upper triangle), over the rows
    where both are present; null when either side has no variance there.

    One pass: each task keeps, for all pairs at once, counts, means and
    centred co-moments of its rows (matrix products with null masks), and
    Spark combines the tasks about the common mean.  Nothing of the size of a
    squared mean is ever subtracted, so timestamps and large ids keep their r.
    """
    k = len(cols)
    pairs = list(itertools.combinations(range(k), 2))
    names = ("n", "x", "y", "xx", "yy", "xy")

    def moments(batches):
        total = np.zeros((6, k, k))
        for pdf in batches:
            total = _merged(total, _co_moments(pdf.to_numpy(dtype="float64", na_value=np.nan)))
        yield pd.DataFrame({"a": [i for i, _ in pairs], "b": [j for _, j in pairs],
                            **{c: [total[q, i, j] for i, j in pairs] for q, c in enumerate(names)}})

    wide = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    got = wide.mapInPandas(moments, "a int, b int, " + ", ".join(f"{c} double" for c in names)).where("n > 0")
    pair = Window.partitionBy("a", "b")  # a row for each task
    size = F.sum("n").over(pair)
    got = got.withColumns({"mx": F.sum(F.col("n") * F.col("x")).over(pair) / size, "my": F.sum(F.col("n") * F.col("y")).over(pair) / size})
    n, dx, dy = F.col("n"), F.col("x") - F.col("mx"), F.col("y") - F.col("my")
    got = got.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max(F.abs("mx")).alias("mx"), F.max(F.abs("my")).alias("my"),
                                    F.sum(F.col("xx") + n * dx * dx).alias("xx"), F.sum(F.col("yy") + n * dy * dy).alias("yy"),
                                    F.sum(F.col("xy") + n * dx * dy).alias("xy"))
    # a spread that rounding of the values themselves can make is none
    def flat(s, m):
        return F.col(s) <= F.col("n") * F.pow(F.col(m) * F.lit(4e-15), F.lit(2))

    named = F.array(*[F.lit(c) for c in cols])
    # a pair without common rows has no r
    every = df.sparkSession.createDataFrame(pairs, "a int, b int") if pairs else got.select("a", "b").limit(0)
    out = every.join(got, ["a", "b"], "left")
    return out.select(named[F.col("a")].alias("c1"), named[F.col("b")].alias("c2"),
                      F.when(~(flat("xx", "mx") | flat("yy", "my")), F.col("xy") / F.sqrt(F.col("xx") * F.col("yy"))).alias("r"))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns of numeric type (int/long/double/...), schema order."""
    from pyspark.sql.types import NumericType
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in set(exclude)]


def _bins_frame(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).select(F.col("id").cast("int").alias("bin"))


def bin_index(col: str | Column, bins: int, lo: float, hi: float) -> Column:
    """The bin of a value among ``bins`` equal ones on [lo, hi] (last bin
    right-closed); null outside.  The one rule of all histograms here."""
    x = _c(col).cast("double")
    w = (hi - lo) / bins
    return F.when((x >= lo) & (x <= hi), F.least(F.floor((x - F.lit(lo)) / F.lit(w)), F.lit(bins - 1))).cast("int")


def fixed_histogram(df: DataFrame, col: str | Column, bins: int = 10, lo: float = 0.0,
                    hi: float = 1.0) -> DataFrame:
    """A10: ``bins`` equal bins on [lo, hi]; last bin right-closed; empty bins 0.

    Values outside [lo, hi] are not counted.  The bin table is generated from
    the parameter (size ``bins``), so broadcasting it is bounded.
    """
    w = (hi - lo) / bins
    counted = (df.groupBy(bin_index(col, bins, lo, hi).alias("bin"))
               .agg(F.count(F.lit(1)).alias("n")).where("bin IS NOT NULL"))
    spark = df.sparkSession
    return (_bins_frame(spark, bins).join(F.broadcast(counted), "bin", "left")
            .select("bin",
                    (F.lit(lo) + F.col("bin") * F.lit(w)).alias("lower"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(w)).alias("upper"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("count")))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """``bins`` equal bins over the observed range of ``col``."""
    r = df.agg(F.min(F.col(col).cast("double")).alias("lo"),
               F.max(F.col(col).cast("double")).alias("hi")).first()
    if r is None or r["lo"] is None:
        return fixed_histogram(df.limit(0), col, bins, 0.0, 1.0)
    lo, hi = float(r["lo"]), float(r["hi"])
    if hi == lo:
        hi = lo + 1.0
    return fixed_histogram(df, col, bins, lo, hi)


def histograms(df: DataFrame, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """A9 for several columns at once (``df.hist()``): one aggregation for all
    ranges, one grouped count over (column, bin), empty bins 0.

    Each row contributes one (column, bin) pair per column via ``inline`` of
    a fixed-size array, so the shuffle carries at most columns x bins partial
    rows per map task.
    """
    rng = df.agg(*[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
                 *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    bounds = []
    for i, _ in enumerate(cols):
        lo, hi = rng[f"lo{i}"], rng[f"hi{i}"]
        lo = 0.0 if lo is None else float(lo)
        hi = lo + 1.0 if hi is None or float(hi) == lo else float(hi)
        bounds.append((lo, hi, (hi - lo) / bins))
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"),
                 # least() skips nulls: guard so a null value gets no bin
                 F.when(F.col(c).isNotNull(),
                        F.least(F.floor((F.col(c).cast("double") - F.lit(lo)) / F.lit(w)), F.lit(bins - 1)))
                 .cast("int").alias("bin"))
        for c, (lo, hi, w) in zip(cols, bounds)])
    counts = (df.select(F.inline(pairs)).where(F.col("bin").isNotNull())
              .groupBy("column").agg(F.array(*[F.count(F.when(F.col("bin") == b, 1)) for b in range(bins)])
                                     .alias("__c")))
    edges = F.create_map(*[x for c, (lo, hi, w) in zip(cols, bounds) for x in (F.lit(c), F.array(
        F.lit(lo), F.lit(w)))])
    out = counts.select("column", F.posexplode("__c").alias("bin", "count"))
    e = edges[F.col("column")]
    return out.select("column", F.col("bin").cast("int").alias("bin"),
                      (e[0] + F.col("bin") * e[1]).alias("lower"),
                      (e[0] + (F.col("bin") + 1) * e[1]).alias("upper"), "count")


def histogram_2d(df: DataFrame, x: str | Column, y: str | Column, x_range: tuple[float, float],
                 y_range: tuple[float, float], bins: int = 20) -> DataFrame:
    """2-D binned density (non-empty cells only)."""
    def b(c, rng):
        w = (rng[1] - rng[0]) / bins
        return F.least(F.floor((_c(c).cast("double") - F.lit(rng[0])) / F.lit(w)),
                       F.lit(bins - 1)).cast("int")
    xc, yc = _c(x).cast("double"), _c(y).cast("double")
    inside = xc.between(*x_range) & yc.between(*y_range)
    return (df.where(inside).groupBy(b(x, x_range).alias("bx"), b(y, y_range).alias("by"))
            .agg(F.count(F.lit(1)).alias("n")))


def joint_density(df: DataFrame, x: str | Column, y: str | Column, x_range: tuple[float, float], y_range: tuple[float, float],
                  bins: int = 20, kernel: Sequence[float] = (0.25, 0.5, 0.25)) -> DataFrame:
    """A11 with marginals: (part, x_bin, y_bin, n, smoothed) for the joint grid ("joint")
    and both margins ("x": y_bin is null, "y": x_bin is null).

    One pass counts all three by grouping sets.  The kernel (odd length, centred)
    is then applied along one axis after the other on the counts, a table of
    at most bins**2 + 2 * bins rows; what it would move off the grid is left out.
    """
    counted = df.select(bin_index(x, bins, *x_range).alias("x_bin"), bin_index(y, bins, *y_range).alias("y_bin")).where("x_bin IS NOT NULL AND y_bin IS NOT NULL")
    cells = counted.groupingSets([[F.col("x_bin"), F.col("y_bin")], [F.col("x_bin")], [F.col("y_bin")]], F.col("x_bin"), F.col("y_bin")).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("__g"))
    part = F.when(F.col("__g") == 0, "joint").when(F.col("__g") == 1, "x").otherwise("y")
    cells = cells.select(part.alias("part"), "x_bin", "y_bin", "n")
    half = len(kernel) // 2
    taps = F.array(*[F.struct(F.lit(i - half).alias("d"), F.lit(float(w)).alias("w")) for i, w in enumerate(kernel)])

    def along(t: DataFrame, axis: str) -> DataFrame:
        spread = t.withColumn("__t", F.explode(taps)).withColumns({
            "s": F.when(F.col(axis).isNull(), F.when(F.col("__t.d") == 0, F.col("s"))).otherwise(F.col("s") * F.col("__t.w")),
            axis: F.col(axis) + F.col("__t.d")})
        inside = F.col(axis).isNull() | F.col(axis).between(0, bins - 1)
        return spread.where(inside & F.col("s").isNotNull()).groupBy("part", "x_bin", "y_bin").agg(F.sum("s").alias("s"))

    smooth = along(along(cells.withColumn("s", F.col("n").cast("double")), "x_bin"), "y_bin")
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in ("part", "x_bin", "y_bin")]
    held = cells.select(*[F.col(c).alias(f"__{c}") for c in ("part", "x_bin", "y_bin")], "n")
    return smooth.join(held, same[0] & same[1] & same[2], "left").select(
        "part", "x_bin", "y_bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.col("s").alias("smoothed"))


def mean_se_by_group(df: DataFrame, group: str | Column, value: str | Column) -> DataFrame:
    """Mean and standard error of ``value`` per group (each its own SE)."""
    v = _c(value).cast("double")
    return df.groupBy(_c(group).alias("group")).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"),
        F.try_divide(F.stddev_samp(v), F.sqrt(F.count(v))).alias("se"))


def churn_rate(df: DataFrame, by: Sequence[str | Column] = (),
               outcome: str = "second_period_event_count") -> DataFrame:
    """% of users with no second-period event, 2 decimals."""
    rate = F.round(F.avg((F.col(outcome) < 1).cast("double")) * 100.0, 2).alias("churn_pct")
    n = F.count(F.lit(1)).alias("n_users")
    return df.groupBy(*by).agg(n, rate) if by else df.agg(n, rate)


def confusion_metrics(df: DataFrame, prediction: str | Column = "prediction",
                      label: str | Column = "label", by: Sequence[str | Column] = ()) -> DataFrame:
    """TP/FN/FP/TN and precision, recall, accuracy, F1 (null on 0/0)."""
    p, y = _c(prediction), _c(label)
    counts = [F.count(F.when((y == 1) & (p == 1), 1)).alias("tp"),
              F.count(F.when((y == 1) & (p == 0), 1)).alias("fn"),
              F.count(F.when((y == 0) & (p == 1), 1)).alias("fp"),
              F.count(F.when((y == 0) & (p == 0), 1)).alias("tn")]
    base = df.groupBy(*by).agg(*counts) if by else df.agg(*counts)
    tp, fn, fp, tn = (F.col(c).cast("double") for c in ("tp", "fn", "fp", "tn"))
    precision = F.try_divide(tp, tp + fp)
    recall = F.try_divide(tp, tp + fn)
    return base.select(
        *[F.col(c) if isinstance(c, str) else c for c in by], "tp", "fn", "fp", "tn",
        precision.alias("precision"), recall.alias("recall"),
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.try_divide(2 * precision * recall, precision + recall).alias("f1"))


def pearson_rmse(df: DataFrame, predicted: str | Column, actual: str | Column) -> DataFrame:
    """Pearson r and RMSE of predicted vs actual."""
    a, b = _c(predicted).cast("double"), _c(actual).cast("double")
    return df.agg(pearson(a, b).alias("pearson_r"),
                  F.sqrt(F.avg(F.pow(a - b, 2))).alias("rmse"), F.count(F.lit(1)).alias("n"))


def class_balance(df: DataFrame, label: str | Column = "label") -> DataFrame:
    """Positives, size and balancing ratio (N - P) / N."""
    y = _c(label)
    return df.agg(F.count(F.when(y == 1, 1)).alias("n_positive"),
                  F.count(F.lit(1)).alias("n_rows")).select(
        "n_positive", "n_rows",
        F.try_divide((F.col("n_rows") - F.col("n_positive")).cast("double"),
                     F.col("n_rows").cast("double")).alias("balancing_ratio"))


def value_share(df: DataFrame, col: str | Column, value=0) -> DataFrame:
    """% of rows whose ``col`` equals ``value``."""
    return df.agg((F.avg((_c(col) == value).cast("double")) * 100.0).alias("share_pct"),
                  F.count(F.lit(1)).alias("n_rows"))


def distinct_values(df: DataFrame, col: str | Column) -> DataFrame:
    """The distinct values of a column."""
    return df.select(_c(col)).distinct()
