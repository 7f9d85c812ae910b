"""Table access for a folder of parquet tables, with explicit column pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str, *columns: str) -> DataFrame:
    """One parquet table of a folder; ``columns`` narrows it so that only these reach the scan."""
    df = spark.read.parquet(f"{root}/{name}.parquet")
    return df.select(*columns) if columns else df
