"""Seeded resampling."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bootstrap_median(df: DataFrame, group: str, unit: str, value: str, reps: int = 500, bins: int = 20_000, seed: int = 42) -> DataFrame:
    """2.5 % and 97.5 % points of the median of ``value`` over resamples of the units of each group.

    The units are first counted in at most ``bins`` bins of log value a group (a bin keeps its count and mean), so
    the task of a group holds at most that many rows whatever its size; a resample draws multinomial counts over the
    bins. Up to ``bins`` distinct values a group this is the exact bootstrap. Null and non-positive values are left out.
    """
    b = F.round(F.log10(value) * 1000).cast("bigint")
    x = df.filter(F.col(value) > 0)
    fine = x.groupBy(group, F.col(value).alias("v")).agg(F.count("*").alias("n"))
    sizes = fine.groupBy(group).agg(F.count("*").alias("k"))
    many = fine.join(sizes, group).withColumn("b", F.when(F.col("k") > bins, F.round(F.log10("v") * 1000)).otherwise(F.log10("v")))
    binned = many.groupBy(group, "b").agg((F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("v"), F.sum("n").alias("n"))
    kind = df.schema[group].dataType.simpleString()

    def resample(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("v", kind="stable")
        v, n = pdf["v"].to_numpy(float), pdf["n"].to_numpy(np.int64)
        total = int(n.sum())
        rng = np.random.default_rng(seed)

        def median(counts):
            c = np.cumsum(counts)
            return (v[np.searchsorted(c, (total + 1) // 2)] + v[np.searchsorted(c, total // 2 + 1)]) / 2

        meds = [median(rng.multinomial(total, n / total)) for _ in range(reps)]
        lo, hi = np.percentile(meds, [2.5, 97.5])
        return pd.DataFrame({group: [pdf[group].iloc[0]], "n_units": [total], "median": [median(n)], "lo": [lo], "hi": [hi]})

    return binned.groupBy(group).applyInPandas(resample, f"{group} {kind}, n_units bigint, median double, lo double, hi double")
