"""Incremental ingest with Structured Streaming: each record once, late ones within a watermark, best rows kept current."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_stream(spark: SparkSession, folder: str, schema: StructType | str, files_per_batch: int = 100) -> DataFrame:
    """A folder of parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def once(stream: DataFrame, record_id: str, ingested_at: str, late: str = "30 days") -> DataFrame:
    """Records without repeats: a repeat that comes within ``late`` of the first is dropped, state older than that is forgotten."""
    return stream.withColumn(ingested_at, F.col(ingested_at).cast("timestamp")).withWatermark(ingested_at, late).dropDuplicatesWithinWatermark([record_id])


def windowed_counts(stream: DataFrame, at: str, key: str, window: str = "1 day", late: str = "30 days") -> DataFrame:
    """Counts and means of a value by tumbling window and key, closed when the watermark passes."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).groupBy(F.window(at, window).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), key, "n")


def keep_best(stream: DataFrame, target: str, checkpoint: str, keys: list[str], rank: list[str]):
    """A table of the best row of each key, kept current batch by batch.

    A batch is reduced to its best rows and written to a folder named after the batch, so a batch that is repeated
    after a failure writes the same thing again. Start the returned writer with ``.start()``; read the table with
    :func:`read_best`, which folds the batches.
    """
    order = F.struct(*rank)

    def fold(batch: DataFrame, epoch: int) -> None:
        best = batch.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in batch.columns if c not in keys]), order).alias("_b")).select(*keys, "_b.*")
        best.write.mode("overwrite").parquet(f"{target}/batch={epoch}")

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)


def read_best(spark: SparkSession, target: str, keys: list[str], rank: list[str]) -> DataFrame:
    """The best row of each key over all batches written by :func:`keep_best`."""
    b = spark.read.parquet(target).drop("batch")
    return b.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in b.columns if c not in keys]), F.struct(*rank)).alias("_b")).select(*keys, "_b.*")


def compact(spark: SparkSession, target: str, out: str, keys: list[str], rank: list[str]) -> None:
    """Fold the batches of :func:`keep_best` into one table (a periodic job)."""
    read_best(spark, target, keys, rank).write.mode("overwrite").parquet(out)
