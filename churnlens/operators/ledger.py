"""Resumable fetch batches (O7, J6, B15): an append-only ledger of which batch took which users.

A batch is a folder of the ledger.  It counts once its writer has committed it;
what a crash left behind is overwritten by the next attempt.  Asking for a
committed batch again gives the rows it took, whatever the candidates are by
then; a new batch takes the next users in hash order that neither ``known`` nor any
other committed batch has.  One writer at a time.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.operators.sampling import next_batch


def _folder(path: str, batch: str) -> str:
    return f"{path.rstrip('/')}/batch={quote(str(batch), safe='')}"


def committed(spark: SparkSession, path: str) -> list[str]:
    """Folders of the committed batches (one listing of the ledger)."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    marks = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/batch=*/_SUCCESS"))
    return sorted(m.getPath().getParent().toString() for m in marks or [])


def fetch_batch(candidates: DataFrame, known: DataFrame, key: str, n: int, batch: str, path: str, seed: int = 0) -> DataFrame:
    """(key, place): the ``n`` users of a batch in fetch order, taken now or read from the ledger.

    A null key is no candidate.
    """
    spark = candidates.sparkSession
    own, done = _folder(path, batch), committed(spark, path)
    schema = candidates.select(key, F.lit(0).alias("place")).schema
    if not any(d.rsplit("/", 1)[-1] == own.rsplit("/", 1)[-1] for d in done):
        # a batch that was not committed is not read here, so its rows are taken again
        seen = known.select(key)
        if done:
            seen = seen.unionByName(spark.read.schema(schema).parquet(*done).select(key))
        fresh = candidates.select(key).where(F.col(key).isNotNull()).distinct()
        taken = next_batch(fresh, seen, key, n, seed)
        taken.coalesce(1).select(key, F.monotonically_increasing_id().cast("int").alias("place")).write.mode("overwrite").parquet(own)
    return spark.read.schema(schema).parquet(own)
