"""Numbers and samples over a whole table without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvion.session import fits_broadcast, materialize


def global_number(df: DataFrame, keys: list[Column], out: str) -> DataFrame:
    """0-based number of each row in the order of ``keys`` (which must be unique for a stable result).

    A range-partitioned sort, one count a partition, and an offset for each: the largest task holds one range. Null
    keys sort first. Empty input gives no rows.
    """
    cols = df.columns
    named = df.select("*", *[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    names = [f"_k{i}" for i in range(len(keys))]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = materialize(named.repartitionByRange(n, *names).sortWithinPartitions(*names).withColumn("_at", F.monotonically_increasing_id()))
    low = F.lit((1 << 33) - 1)
    part = F.shiftright("_at", 33)
    sizes = dict(s.groupBy(part.alias("p")).agg((F.max(F.col("_at").bitwiseAND(low)) + 1).alias("n")).collect())  # one row a partition
    offsets, at = [], 0
    for p in sorted(sizes):
        offsets.append((int(p), at))
        at += sizes[p]
    base = df.sparkSession.createDataFrame(offsets, "_p bigint, _base bigint")
    return s.withColumn("_p", part).join(F.broadcast(base), "_p").select(*cols, (F.col("_base") + F.col("_at").bitwiseAND(low)).alias(out))


def average_rank(df: DataFrame, groups: list[str], value: str, out: str) -> DataFrame:
    """1-based rank of ``value`` within its group, ties at their average; nulls rank first among themselves.

    Distinct values are counted first, then numbered over one range-partitioned sort: running counts inside each range
    and the counts of the ranges before it, so no group is ever sorted in one task.
    """
    counts = df.groupBy(*groups, value).agg(F.count("*").alias("_c"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = materialize(counts.repartitionByRange(n, *groups, value).sortWithinPartitions(*groups, value).withColumn("_p", F.spark_partition_id()))
    from pyspark.sql import Window as W

    parts = s.groupBy("_p", *groups).agg(F.sum("_c").alias("_n"))  # a row a range and group
    before = parts.withColumn("_before", F.sum("_n").over(W.partitionBy(*groups).orderBy("_p").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")).drop("_n")
    run = F.sum("_c").over(W.partitionBy("_p", *groups).orderBy(value).rowsBetween(W.unboundedPreceding, 0))
    before = before.withColumnsRenamed({g: f"_b_{g}" for g in groups}).withColumnRenamed("_p", "_q")
    at = F.col("_p") == F.col("_q")
    for g in groups:
        at = at & F.col(g).eqNullSafe(F.col(f"_b_{g}"))
    r = s.withColumn("_run", run).join(F.broadcast(before) if fits_broadcast(before) else before, at)
    r = r.select(*groups, F.col(value).alias("_value"), (F.col("_before") + F.col("_run") - (F.col("_c") - 1) / 2.0).alias(out))
    on = F.col(value).eqNullSafe(F.col("_value"))
    for g in groups:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return df.join(r.withColumnsRenamed({g: f"_g_{g}" for g in groups}), on).drop("_value", *[f"_g_{g}" for g in groups])


def hash_sample(df: DataFrame, key: str, one_in: int, seed: int = 42) -> DataFrame:
    """A sample that any run and any engine state repeats: rows whose seeded hash of the key falls in one of ``one_in`` bins."""
    return df.filter(F.pmod(F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("bigint"), F.lit(one_in)) == 0)
