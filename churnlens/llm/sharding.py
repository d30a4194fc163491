"""Rendezvous hashing of stable record keys over weighted shards.

Every shard draws a number from (key, shard); with weight w its score is -ln(u) / w and the lowest score takes the
record.  A record's draw for a shard never changes, so one more shard takes records only into itself, in proportion
to its weight.  Everything is a column expression.

Slots number the records of a shard without gaps: records are dealt to hash cells of bounded size, one small table of
cell counts gives each cell its first slot, and rows are numbered inside their cells only.  Rows that are alike are dealt
by their place in the table (stored, so that both passes see the same), so copies of one row fill many cells.

Defined results: a null key is a key of its own; a null text has no bytes and the crc32 of the empty text; repeated
rows get slots of their own; other columns are passed through (input columns named like a result are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.textops import saved

_CELL = 4096  # rows of a cell, on average


def score(key: Column, shard: int, weight: float = 1.0) -> Column:
    """The shard's score of a key; the lowest of all shards wins."""
    bits = F.shiftrightunsigned(F.xxhash64(key.cast("string"), F.lit(shard)), 11)
    return -F.log((bits.cast("double") + 0.5) * F.lit(2.0 ** -53)) / F.lit(float(weight))


def shard_of(key: Column, weights: list[float]) -> Column:
    """The shard (0-based) of a key among shards with these weights."""
    scored = [F.struct(score(key, s, w).alias("score"), F.lit(s).alias("shard")) for s, w in enumerate(weights)]
    return (F.least(*scored) if len(scored) > 1 else scored[0])["shard"]


def assign(docs: DataFrame, weights: list[float], key: str = "doc_id", text: str = "text", new_weight: float = 1.0) -> DataFrame:
    """``docs`` with size, text_crc32, shard, slot and grown_shard (the shard if one more of ``new_weight`` were there)."""
    k, t = F.col(key), F.coalesce(F.col(text), F.lit(""))
    made = ("size", "text_crc32", "shard", "slot", "grown_shard")
    rows = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in (*made, text)],
        (F.octet_length(t) + 1).cast("long").alias("size"),
        F.crc32(t.cast("binary")).cast("long").alias("text_crc32"),
        shard_of(k, weights).alias("shard"),
        shard_of(k, [*weights, new_weight]).alias("grown_shard"))
    rows = saved(rows.withColumn("__row", F.monotonically_increasing_id()), "records")
    cells = max(1, rows.count() // (_CELL * len(weights)))
    rows = rows.withColumn("__cell", F.pmod(F.xxhash64("__row"), F.lit(cells)))
    counts = rows.groupBy("shard", "__cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "__cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy("shard", "__cell").orderBy(F.col(key).asc_nulls_first(), "text_crc32", "size", "__row")
    numbered = rows.withColumn("__n", F.row_number().over(inside) - 1)
    out = numbered.join(first, ["shard", "__cell"])
    return out.withColumn("slot", (F.col("__first") + F.col("__n")).cast("long")).drop("__cell", "__first", "__n", "__row")
