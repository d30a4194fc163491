"""Mixing sources to target weights by hash-threshold histograms, in DataFrame expressions only.

A source's target is its share of the budget by weight, but at most ``most`` times its size; what a source can't give
is shared again by weight among the others, until none is above.  A source with target T and size S gives every
document floor(T / S) times, and one more time the documents whose draw lies below a threshold: budgets are nested, so a
larger target keeps whatever a smaller one took.

The draw of a row is a string of hex digits, the MD5 of key and text followed by a row number that sets apart rows which
are alike (which of them is taken makes no difference to the result).  Words are summed by source and the first three
digits; the bucket in which the running sum passes the rest of the target is the boundary.  Only its rows go into the
next histogram, by three more digits, until one row is left there; it is taken if half of it or more is due.  So no
row is sorted, a source's sums are at most 4,096 rows however many documents it has, and the taken words miss the
target by half a document at most.

Defined results: a null text has no words; a null source is a source of its own; a document without words counts for
nothing and takes nothing; repeated rows are documents of their own; a table without rows, or without words, has targets
of 0; other columns aren't read, unless ``keep`` names them (those named like a result are replaced).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.textops import saved

_WORD = "[^\\x20\\x09-\\x0D]+"
_DIGITS = 3  # hex digits that a histogram adds
_LENGTH = 48  # hex digits of a draw
_SALTS = 16
RESULTS = ("size", "source_size", "target", "taken", "copies")


def words_in(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(_WORD)), F.lit(0)).cast("long")


def cyclic_weights(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), source: str = "source") -> DataFrame:
    """(source, weight): the weights in turn for the sources in code-point order, null last."""
    names = docs.select(F.col(source).alias("source")).distinct()  # one row a source
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    return names.select("source", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).alias("weight"))


def _targets(sizes: DataFrame, share: float, most: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size, weight): sources stop at ``most`` times their size.

    The level rises from round to round, so a stopped source stays stopped; each round is one aggregate row.
    """
    sizes = saved(sizes, "sources")
    cap, level, before = F.lit(most) * F.col("source_size"), -1.0, -1
    stopped = F.lit(False)
    while True:
        got = sizes.agg(F.sum("source_size"), F.sum(F.when(stopped, cap)), F.sum(F.when(~stopped, F.col("weight"))), F.count(F.when(stopped, 1))).first()
        if got[3] == before:
            break
        before = got[3]
        level = ((got[0] or 0) * share - (got[1] or 0)) / got[2] if got[2] else math.inf
        stopped = F.lit(level) * F.col("weight") >= cap
    return sizes.select("source", "source_size", F.when(stopped, cap.cast("double")).otherwise(F.lit(level) * F.col("weight")).alias("target"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _narrowed(rows: DataFrame, state: DataFrame) -> DataFrame:
    """The boundary bucket among the buckets of ``depth`` digits: its prefix, the words of the rows below it, its number
    of rows, and the digits of the next histogram (three more than all of its rows share)."""
    sums = rows.groupBy("source", F.substr("draw", F.lit(1), F.col("depth")).alias("bucket")).agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("draw").alias("lo"), F.max("draw").alias("hi"))
    upto = Window.partitionBy("source").orderBy("bucket")
    known = state.select(F.col("source").alias("__source"), "full", "rest", "before")
    at = sums.join(known, _same(F.col("source"), F.col("__source"))).drop("__source")
    at = at.withColumn("__upto", F.col("before") + F.sum("size").over(upto)).filter(F.col("__upto") > F.col("rest"))
    first = F.min_by(F.struct("bucket", "n", (F.col("__upto") - F.col("size")).alias("before"), "rest", "full", "lo", "hi"), F.col("bucket"))
    at = at.groupBy("source").agg(first.alias("s")).select("source", "s.full", "s.rest", "s.before", F.col("s.bucket").alias("prefix"), "s.n", "s.lo", "s.hi")
    shared = F.size(F.filter(F.sequence(F.lit(1), F.lit(_LENGTH)), lambda i: F.substr("lo", F.lit(1), i) == F.substr("hi", F.lit(1), i)))
    return at.withColumn("depth", F.least(shared + _DIGITS, F.lit(_LENGTH))).drop("lo", "hi")


def mix(docs: DataFrame, weights: DataFrame, share: float = 1.0, most: int = 3, key: str = "doc_id", text: str = "text",
        source: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: key, source, the columns in ``keep``, size, source_size, target, copies (times that the
    mix takes it) and taken (words, repeats counted).

    ``weights`` is (source, weight), one row for each source; a source that it lacks has weight 0.  The budget is
    ``share`` of all words.
    """
    draw = F.concat(F.md5(F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))).cast("binary")),
                    F.lower(F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")))
    names = [c for c in keep if c not in (key, source, *RESULTS)]
    kept = F.struct(F.col(key).alias("__key"), *[F.col(f"`{c}`") for c in names]).alias("__kept")
    rows = saved(docs.select(kept, F.col(source).alias("source"), words_in(text).alias("size"), draw.alias("draw")), "sizes")

    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    given = weights.select(F.col("source").alias("__source"), F.col("weight").cast("double").alias("weight"))
    sizes = totals.join(given, _same(F.col("source"), F.col("__source")), "left").drop("__source").fillna(0.0, ["weight"])
    targets = saved(_targets(sizes, share, most).withColumn("full", F.least(F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))), F.lit(most)))
                    .withColumn("rest", F.col("target") - F.col("full") * F.col("source_size")), "targets")

    # The boundary of each source: at first all of its rows, then a bucket of them.
    held = rows.filter("size > 0").select("source", "draw", "size", F.lit(_DIGITS).alias("depth"))
    state = targets.select("source", "full", "rest", F.lit(0).cast("long").alias("before"))
    stored = []
    while True:
        state = saved(_narrowed(held, state), "boundary")
        stored.append(state)
        state = state.filter("n > 1")
        if state.isEmpty():
            break
        edge = state.select(F.col("source").alias("__source"), "prefix", F.col("depth").alias("__depth"))
        inside = _same(F.col("source"), F.col("__source")) & F.col("draw").startswith(F.col("prefix"))
        held = saved(held.join(edge, inside).select("source", "draw", "size", F.col("__depth").alias("depth")), "inside")
    # One boundary a source: the deepest.
    last = stored[0]
    for s in stored[1:]:
        last = last.unionByName(s)
    last = last.groupBy("source").agg(F.max_by(F.struct("before", "prefix"), F.length("prefix")).alias("s"))
    edges = targets.join(last.withColumnRenamed("source", "__source"), _same(F.col("source"), F.col("__source")), "left").select(
        F.col("source").alias("__source"), "source_size", "target", "full", "rest", F.col("s.before").alias("before"), F.col("s.prefix").alias("prefix"))

    # Rows of a large source are spread over salts where the small table of sources isn't broadcast.
    salted = edges.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    at = rows.withColumn("__row_salt", F.pmod(F.xxhash64("draw"), F.lit(_SALTS)).cast("int"))
    at = at.join(salted, _same(F.col("source"), F.col("__source")) & (F.col("__row_salt") == F.col("__salt")))
    below = F.coalesce(F.col("draw") < F.col("prefix"), F.lit(False))
    due = F.coalesce(F.col("draw").startswith(F.col("prefix")) & (2 * (F.col("rest") - F.col("before")) >= F.col("size")), F.lit(False))
    more = (F.col("size") > 0) & (below | due)
    copies = (F.col("full") + more.cast("int")).cast("int")
    return at.select(F.col("__kept.__key").alias(key), F.col("source").alias(source), *[F.col(f"__kept.`{c}`").alias(c) for c in names], "size", "source_size", "target", copies.alias("copies"),
                     (copies * F.col("size")).cast("long").alias("taken"))
