"""Best representative of each duplicate group, field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _long(df: DataFrame, key: str, row_id: str, fields: dict[str, Column], trust: Column, at: str) -> DataFrame:
    """Unpivot: one row for each field of each record that has a usable value (``fields`` gives null otherwise)."""
    cells = F.array(*[F.struct(F.lit(n).alias("field_name"), v.cast("string").alias("value")) for n, v in fields.items()])
    long = df.select(F.col(key).alias("key"), F.col(row_id).alias("row_id"), trust.alias("trust"), F.col(at).alias("at"), F.explode(cells).alias("c"))
    return long.select("key", "row_id", "trust", "at", "c.*").filter("value is not null and key is not null and row_id is not null")


def groups_of_several(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """Keys with two or more different row ids (a partial aggregate of min and max, no list of ids)."""
    return df.groupBy(key).agg(F.min(row_id).alias("a"), F.max(row_id).alias("b")).filter("a < b").select(key)


def best_rows(df: DataFrame, key: str, row_id: str, fields: dict[str, Column], trust_rank: Column, at: str) -> DataFrame:
    """The row each field is taken from: smallest trust rank (null last), then latest ``at`` (null oldest), then
    smallest row id, by one max_by over the unpivoted rows.

    ``fields`` maps a field to its usable value, null where it has none; a field without any usable value in its
    group gives no row, nor does a null key. Repeated rows change nothing. Only groups of two or more row ids
    come out. The aggregate combines on the map side, so the largest group costs one row a task.
    """
    long = _long(df, key, row_id, fields, trust_rank, at)
    order = F.struct((-F.coalesce(F.col("trust").cast("bigint"), F.lit(2**40))).alias("t"), F.coalesce(F.unix_micros("at"), F.lit(-(2**62))).alias("a"), (-F.col("row_id")).alias("r"))
    won = long.groupBy("key", "field_name").agg(F.max_by(F.struct("row_id", "value"), order).alias("w"))
    many = groups_of_several(df, key, row_id).withColumnRenamed(key, "key")
    out = won.join(many, "key", "left_semi")
    return out.select(F.col("key").alias(key), "field_name", F.col("w.row_id").alias(row_id), F.col("w.value").alias("value"))


def golden_records(df: DataFrame, key: str, row_id: str, fields: dict[str, Column], trust_weight: Column, at: str, normal=F.lower, half_life_days: float = 365.0) -> DataFrame:
    """One built record for each key: each field by votes.

    A vote is trust weight times recency decay (half life in days, counted from the latest ``at`` of the whole
    input; a null ``at`` or weight votes with the least weight, 0.01). Votes are summed for each normalised value; the value of
    most votes wins (ties: the smaller normal form), written as its latest row writes it (ties: smallest row id).
    Fields without usable value are null. Row ids delivered twice vote once.
    """
    long = _long(df, key, row_id, fields, trust_weight, at).dropDuplicates(["key", "row_id", "field_name"])
    latest = df.agg(F.max(at).alias("latest"))  # one row
    age = F.greatest(F.lit(0.0), (F.unix_micros("latest") - F.unix_micros("at")) / 86_400e6)
    vote = F.coalesce(F.greatest(F.lit(0.01), F.col("trust")), F.lit(0.01)) * F.coalesce(F.pow(F.lit(0.5), age / half_life_days), F.lit(0.01))
    long = long.join(F.broadcast(latest)).withColumn("vote", vote).withColumn("normal", normal(F.col("value")))
    votes = long.groupBy("key", "field_name", "normal").agg(F.round(F.sum("vote"), 9).alias("votes"), F.max_by("value", F.struct(F.coalesce(F.unix_micros("at"), F.lit(-(2**62))), -F.col("row_id"))).alias("value"))
    # of equal votes the smaller normal form: a min_by over (-votes, normal)
    won = votes.groupBy("key", "field_name").agg(F.min_by("value", F.struct(-F.col("votes"), F.col("normal"))).alias("value"))
    return won.groupBy(F.col("key").alias(key)).pivot("field_name", list(fields)).agg(F.first("value"))
