"""Multi-source merge: candidates ranked by quality, the best row of each day kept, overlap flagged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FLAGS = ("q_flag", "ssc_flag", "ssl_flag")


def publishable(df: DataFrame) -> DataFrame:
    """Rows with a sediment value; discharge alone is not published."""
    return df.filter("ssc is not null or ssl is not null")


def quality(df: DataFrame, keys: list[str]) -> DataFrame:
    """Of each candidate (``keys``): rows, good and valid flags, and the score good / valid (0 where none is valid)."""
    good = sum(F.when(F.col(f) == 0, 1).otherwise(0) for f in FLAGS)
    valid = sum(F.when(F.col(f).between(0, 3), 1).otherwise(0) for f in FLAGS)
    g = df.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.sum(good).alias("good"), F.sum(valid).alias("valid"))
    return g.withColumn("score", F.coalesce(F.round(F.col("good") / F.nullif(F.col("valid").cast("double"), F.lit(0.0)), 9), F.lit(0.0)))


def ranked(scores: DataFrame, group: list[str], tie: str) -> DataFrame:
    """quality_rank (1 is best), n_candidates and is_top of each candidate in its group; ties by ``tie``. A group has a row a
    candidate, so the window holds sources, not readings."""
    w = W.partitionBy(*group)
    return scores.withColumn("quality_rank", F.row_number().over(w.orderBy(F.col("score").desc(), tie))).withColumn("n_candidates", F.count("*").over(w)).withColumn("is_top", F.col("quality_rank") == 1)


def best_rows_per_day(df: DataFrame, group: str, candidate: str, day: str, record: str) -> DataFrame:
    """One row a group and day: that of the best-ranked candidate (ties: smallest record), with n_rows and is_overlap.

    The choice is a min over a struct, which combines on the map side: no window over readings, and a group with a
    third of all rows costs a row a day and task. The ranks, a row a candidate, are joined on.
    """
    p = publishable(df)
    r = ranked(quality(p, [group, candidate]), [group], candidate).select(group, candidate, "quality_rank")
    rest = [c for c in p.columns if c not in (group, day)]
    j = p.join(r, [group, candidate])
    g = j.groupBy(group, day).agg(F.min(F.struct("quality_rank", record, *[c for c in rest if c != record])).alias("_b"), F.count("*").alias("n_rows"))
    return g.select(group, day, "_b.*", "n_rows", (F.col("n_rows") > 1).alias("is_overlap"))
