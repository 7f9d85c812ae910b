"""Exact quantiles of groups of any size: a sketch brackets each quantile, and only what lies in the bracket is ordered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, keys: list[str], wanted: dict[str, tuple[Column, float]], accuracy: int = 10_000) -> DataFrame:
    """``keys`` and one column for each of ``wanted`` (name: value, probability): linear interpolation between order statistics.

    A first pass sketches each group (bounded memory, combined on the map side) and brackets every quantile by the
    sketch's own error and the step between ranks, four parts in ``accuracy`` of the group's rows on either side (groups of
    up to ``accuracy`` rows by their least and largest value). A second pass counts the rows below each bracket
    and the values inside it; only the distinct values of a bracket are put in order, so a group with a third of all
    rows never meets in one task. Null and NaN values take no part; a group without value gives null; null
    keys are a group. Empty input gives no rows.
    """
    names = list(wanted)
    inner = [f"_k{i}" for i in range(len(keys))]
    named = df.select(*[F.col(k).alias(i) for k, i in zip(keys, inner)], *[v.cast("double").alias(f"_v{i}") for i, (v, _) in enumerate(wanted.values())])
    wide = 4.0 / accuracy
    sketched = []
    for i, (_, p) in enumerate(wanted.values()):
        v = F.when(~F.isnan(f"_v{i}"), F.col(f"_v{i}"))
        sketched += [F.count(v).alias(f"_n{i}"), F.percentile_approx(v, F.array(F.lit(max(0.0, p - wide)), F.lit(min(1.0, p + wide))), accuracy).alias(f"_q{i}"), F.min(v).alias(f"_a{i}"), F.max(v).alias(f"_z{i}")]
    # null keys become a value of their own, so that the join below is an ordinary equi-join
    solid = lambda d: d.withColumns({i: F.coalesce(F.col(i).cast("string"), F.lit("\x00")) for i in inner})
    groups = solid(named).groupBy(*inner).agg(*[F.first(F.lit(1)).alias("_one"), *sketched])
    held = groups.select(*inner, F.array(*[F.struct(F.lit(i).alias("i"), F.when(F.col(f"_n{i}") <= accuracy, F.col(f"_a{i}")).otherwise(F.col(f"_q{i}")[0]).alias("lo"), F.when(F.col(f"_n{i}") <= accuracy, F.col(f"_z{i}")).otherwise(F.col(f"_q{i}")[1]).alias("hi")) for i in range(len(names))]).alias("_b"))
    x = solid(named).join(held, inner) if inner else named.join(F.broadcast(held))  # without keys: one row
    value = F.coalesce(*[F.when(F.col("_x.i") == i, F.col(f"_v{i}")) for i in range(len(names))])
    x = x.withColumn("_x", F.explode("_b")).select(*inner, "_x.*", value.alias("v"))
    x = x.filter(F.col("v").isNotNull() & ~F.isnan("v") & (F.col("v") <= F.col("hi")))
    counted = x.groupBy(*inner, "i", F.when(F.col("v") >= F.col("lo"), F.col("v")).alias("v")).agg(F.count("*").alias("c"))
    run = counted.withColumn("run", F.sum("c").over(W.partitionBy(*inner, "i").orderBy(F.col("v").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)))
    sizes = groups.select(*inner, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(p) * (F.col(f"_n{i}") - 1)).alias("at")) for i, (_, p) in enumerate(wanted.values())])).alias("_s")).select(*inner, "_s.*")
    j = run.join(sizes, [*inner, "i"])
    order = lambda rank: F.min(F.when(F.col("run") > rank, F.col("v")))
    found = j.groupBy(*inner, "i").agg(order(F.floor("at")).alias("a"), order(F.ceil("at")).alias("b"), F.first("at").alias("at"))
    found = found.select(*inner, "i", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at"))).alias("v"))
    pivoted = found.groupBy(*inner).agg(*[F.max(F.when(F.col("i") == i, F.col("v"))).alias(n) for i, n in enumerate(names)])
    out = groups.select(*inner).join(pivoted, inner, "left") if inner else pivoted
    kinds = {k: df.schema[k].dataType for k in keys}
    return out.select(*[F.when(F.col(i) != "\x00", F.col(i)).cast(kinds[k]).alias(k) for k, i in zip(keys, inner)], *names)


def with_quantiles(aggregated: DataFrame, df: DataFrame, keys: list[str], wanted: dict[str, tuple[Column, float]], digits: int = 6) -> DataFrame:
    """``aggregated`` (one row a group of ``keys``) with the quantiles of ``df`` beside it, rounded; null keys match null."""
    q = exact_quantiles(df, keys, wanted)
    q = q.select(*[F.col(k).alias(f"_q_{k}") for k in keys], *[F.round(n, digits).alias(n) for n in wanted])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_q_{k}"))
    return aggregated.join(q, on, "left").drop(*[f"_q_{k}" for k in keys]) if keys else aggregated.join(F.broadcast(q))
