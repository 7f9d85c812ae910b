"""Joins by nearness: in time, in space, by window of tolerance, and with ambiguity rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def nearest_by_day(left: DataFrame, right: DataFrame, keys: list[str], left_day: str, right_day: str, left_id: str, order: list[Column], windows: dict[str, int]) -> DataFrame:
    """Of each left row and window (name: tolerance in days, cumulative) the first right row by distance in days, then ``order``.

    The range condition becomes an equi-join: each left row looks at the days around it, of which there are at most
    2 * tolerance + 1, so both sides hash on the keys and the day, and one busy key spreads over its days. Rows
    without key or day have no partner.
    """
    widest = max(windows.values())
    probe = left.withColumn("_day", F.explode(F.sequence(F.date_sub(left_day, widest), F.date_add(F.col(left_day), widest))))
    j = probe.join(right.withColumn("_day", F.col(right_day)), [*keys, "_day"]).withColumn("delta_days", F.datediff(F.col(right_day), F.col(left_day))).drop("_day")
    tolerances = F.array(*[F.struct(F.lit(n).alias("window"), F.lit(t).alias("tolerance")) for n, t in windows.items()])
    j = j.withColumn("_w", F.explode(tolerances)).filter(F.abs("delta_days") <= F.col("_w.tolerance")).withColumn("window", F.col("_w.window")).drop("_w")
    first = F.row_number().over(W.partitionBy(left_id, "window").orderBy(F.abs("delta_days"), *order))
    return j.withColumn("_n", first).filter("_n = 1").drop("_n")


def ranked_with_gap(candidates: DataFrame, key: str, distance: str, order: list[Column], gap: float, ratio: float) -> DataFrame:
    """Adds rank, n_candidates and the decision for each key's best candidate: unique, clear (the next is ``gap`` farther or
    ``ratio`` times as far) or ambiguous."""
    w = W.partitionBy(key).orderBy(*order)
    c = candidates.withColumn("rank", F.row_number().over(w)).withColumn("next_distance", F.lead(distance).over(w)).withColumn("n_candidates", F.count("*").over(W.partitionBy(key)))
    clear = (F.col("next_distance") - F.col(distance) >= gap) | (F.col("next_distance") >= ratio * F.greatest(F.col(distance), F.lit(1e-9)))
    return c.withColumn("decision", F.when(F.col("n_candidates") == 1, "unique").when(clear, "clear").otherwise("ambiguous"))
