"""Structured Streaming twins: the pending-body source and the period windows, run to the end of what is there.

State lives in tables beside the checkpoint, so a batch that is run again after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions import text as T
from quillmark.operators import periods


def _stream(spark: SparkSession, source: str, files_per_batch: int) -> DataFrame:
    """A folder as a stream of files; a lone file is the one its folder's pattern matches."""
    reader = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", files_per_batch)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isFile():
        return reader.option("pathGlobFilter", path.getName()).parquet(path.getParent().toString())
    return reader.parquet(source)


def pending_bodies(spark: SparkSession, source: str, work: str, id_col: str, text: str, files_per_batch: int = 1) -> DataFrame:
    """Each body by hash with its least id, as files arrive in any order. Returns the table of them.

    Each batch keeps its own least ids, of which the result takes the least: a later file may hold a smaller id.
    """
    stream = _stream(spark, source, files_per_batch)
    out = f"{work}/bodies"

    def batch(rows: DataFrame, number: int) -> None:
        rows.groupBy(T.body_hash(F.col(text)).alias("body_hash")).agg(F.min(id_col).alias(id_col)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(out).groupBy("body_hash").agg(F.min(id_col).alias(id_col))


def period_counts(spark: SparkSession, source: str, work: str, date: str, key: str, files_per_batch: int = 1, **grid) -> DataFrame:
    """Counts by window and key, kept as partial sums of each batch: rows that come late are added, never dropped."""
    stream = _stream(spark, source, files_per_batch)
    out = f"{work}/partial"

    def batch(rows: DataFrame, number: int) -> None:
        own = periods.assign(rows.withColumn("_d", F.col(date).cast("timestamp")), "_d", **grid)
        own.groupBy("period", key).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(out).groupBy("period", key).agg(F.sum("n").alias("n"))


def watermarked_counts(rows: DataFrame, date: str, key: str, days: int, delay: str = "7 days") -> DataFrame:
    """The plain variant, which drops what is later than the watermark; windows here are closed at the start."""
    return rows.withWatermark(date, delay).groupBy(F.window(date, f"{days} days"), key).agg(F.count("*").alias("n"))
