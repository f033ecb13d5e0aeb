"""Journals as streams: the last record of each key, kept up to date; counts over event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Folders of a kept table; a batch rewrites those that its keys fall in.
BUCKETS = 256


def latest_stream(stream: DataFrame, key: str, order: str) -> DataFrame:
    """The last record of each key so far, for output mode ``update`` or ``complete``: an aggregation whose
    state is one row a key."""
    rest = [c for c in stream.columns if c != key]
    return stream.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*")


def windowed_counts(stream: DataFrame, time: str, by: list[str], window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Rows by event-time window and key; what is later than the watermark is left out, and state of closed
    windows is dropped."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")


def without_repeats(stream: DataFrame, key: list[str], time: str, late: str = "2 days") -> DataFrame:
    """Redelivered rows dropped as long as the watermark remembers them."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def into_table(stream: DataFrame, path: str, checkpoint: str, key: str, order: Column | str):  # noqa: ANN201
    """A query that keeps a Parquet table of latest rows, in ``BUCKETS`` folders by the hash of the key.

    Each batch reads and rewrites only the folders that its keys fall in. Taking the latest row is idempotent,
    so a batch that failed halfway is made good by its own repetition. Only the absence of the table, which
    is looked up, counts as a first batch; any failure to read it ends the query.
    """

    def merge(batch: DataFrame, n: int) -> None:  # noqa: ARG001
        from folioflow.operators.journal import latest

        spark = batch.sparkSession
        rows = batch.where(F.col(key).isNotNull()).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
            touched = [r["bucket"] for r in rows.select("bucket").distinct().collect()]  # BUCKETS at most
            rows = spark.read.parquet(path).where(F.col("bucket").isin(touched)).select(rows.columns).unionByName(rows)
        kept = latest(rows, key, order).repartition("bucket")
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
