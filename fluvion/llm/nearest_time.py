"""Records of two tables paired by nearest time within an entity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _tasks(df: DataFrame, bytes_per_task: int) -> int:
    """Groups to cut the work into, from the optimiser's size estimate (no job)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    low = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(low, min(100_000, size // bytes_per_task))


def nearest_in_time(left: DataFrame, right: DataFrame, entity: str, left_id: str, left_time: str, right_id: str, right_time: str, tolerance_s: float, range_days: float = 8.0, bytes_per_task: int = 32 << 20) -> DataFrame:
    """For each left record the right record nearest in time in the same entity, at most ``tolerance_s`` away.

    Result: ``entity``, ``left_id``, ``right_id``, delta_s (right minus left). Of two as near the earlier is taken, of two at
    one time the smaller id. Rows with a null entity, id or time take no part; a left record without partner gives
    no row; records delivered twice count once.

    Both tables are cut into ranges of time within the entity (right rows near a border go to both sides, by the
    tolerance), and (entity, range) pairs are hashed into groups of bounded size that are co-grouped: a hot entity
    is spread over as many groups as it has ranges. Within a group all entities are searched at once by binary search.
    """
    step, tol = int(range_days * 86_400e6), int(tolerance_s * 1e6)
    if tol * 2 > step:
        raise ValueError("range_days must be at least twice the tolerance")
    n = _tasks(left, bytes_per_task) + _tasks(right, bytes_per_task)
    a = left.select(F.col(entity).alias("e"), F.col(left_id).alias("i"), F.unix_micros(F.col(left_time).cast("timestamp")).alias("t")).filter("e is not null and i is not null and t is not null")
    b = right.select(F.col(entity).alias("e"), F.col(right_id).alias("i"), F.unix_micros(F.col(right_time).cast("timestamp")).alias("t")).filter("e is not null and i is not null and t is not null")
    rng = lambda t: F.floor(t / step)
    a = a.withColumn("r", rng(F.col("t")))
    b = b.withColumn("r", F.explode(F.array_distinct(F.array(rng(F.col("t") - tol), rng(F.col("t") + tol)))))
    group = F.pmod(F.xxhash64("e", "r"), F.lit(n)).alias("g")
    a, b = a.select("*", group), b.select("*", group)
    types = {"e": a.schema["e"].dataType.simpleString(), "li": a.schema["i"].dataType.simpleString(), "ri": b.schema["i"].dataType.simpleString()}

    def search(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"e": x["e"][:0], "li": x["i"][:0], "ri": y["i"][:0], "delta_s": np.empty(0)})
        if x.empty or y.empty:
            return empty
        x, y = x.drop_duplicates(["i"]), y.drop_duplicates(["i", "r"])
        code, _ = pd.factorize(pd.concat([x["e"].astype(str) + "\x1f" + x["r"].astype(str), y["e"].astype(str) + "\x1f" + y["r"].astype(str)]))
        cx, cy = code[: len(x)].astype(np.int64), code[len(x) :].astype(np.int64)
        # time within the range, shifted by the margin, beside the pair's code: one number, one search
        wide = step + 4 * tol + 4
        kx = cx * wide + (x["t"].to_numpy() - x["r"].to_numpy() * step + 2 * tol + 2)
        ky = cy * wide + (y["t"].to_numpy() - y["r"].to_numpy() * step + 2 * tol + 2)
        order = np.lexsort((y["i"].astype(str).to_numpy(), ky))
        ky, cy, iy = ky[order], cy[order], y["i"].to_numpy()[order]
        after = np.searchsorted(ky, kx, side="left")
        before = np.searchsorted(ky, np.where(after > 0, ky[np.maximum(after - 1, 0)], -1), side="left")
        far = np.int64(2**62)

        def gap(j, ok):
            j = np.clip(j, 0, len(ky) - 1)
            return np.where(ok & (cy[j] == cx), np.abs(ky[j] - kx), far), j

        da, ja = gap(after, after < len(ky))
        db, jb = gap(before, after > 0)
        first = db <= da
        d, j = np.where(first, db, da), np.where(first, jb, ja)
        ok = d <= tol
        return pd.DataFrame({"e": x["e"].to_numpy()[ok], "li": x["i"].to_numpy()[ok], "ri": iy[j[ok]], "delta_s": (ky[j[ok]] - kx[ok]) / 1e6})

    out = a.groupBy("g").cogroup(b.groupBy("g")).applyInPandas(search, f"e {types['e']}, li {types['li']}, ri {types['ri']}, delta_s double")
    return out.select(F.col("e").alias(entity), F.col("li").alias(left_id), F.col("ri").alias(right_id), "delta_s")
