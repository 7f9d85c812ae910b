"""Walks on directed networks, and order-dependent clustering of stations within a basin."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvion.functions.geo import EARTH_RADIUS_ROUND_M
from fluvion.session import drop_tables, materialize


def edges_from_columns(df: DataFrame, node: str, parents: list[str]) -> DataFrame:
    """Edges (src, dst) from a node to each of its upstream columns; missing and non-positive parents are none."""
    return df.select(F.col(node).alias("src"), F.explode(F.array(*parents)).alias("dst")).filter("dst is not null and dst > 0")


def reach(edges: DataFrame, starts: DataFrame, start: str, max_hops: int) -> DataFrame:
    """(start, node, hops): the nodes within ``max_hops`` steps of each start along the edges, with the fewest hops.

    Breadth first over all starts at once. A node leaves the frontier once seen, so cycles and diamonds end; each
    frontier is written once to the shared folder and never again, and a step is one shuffle join on the node. The result
    is the union of the frontiers.
    """
    front = materialize(starts.select(F.col(start).alias("start"), F.col(start).alias("node")).filter("start is not null").distinct().withColumn("hops", F.lit(0)))
    seen = front
    e = edges.distinct()
    for k in range(1, max_hops + 1):
        step = front.join(e, front["node"] == e["src"]).select("start", F.col("dst").alias("node")).distinct().join(seen, ["start", "node"], "left_anti")
        front = materialize(step.withColumn("hops", F.lit(k)))
        if front.isEmpty():
            drop_tables(front)
            break
        seen = seen.unionByName(front)
    return seen


def relation(edges: DataFrame, pairs: DataFrame, a: str, b: str, max_hops: int) -> DataFrame:
    """Adds relation (same, upstream, downstream, none, unknown) and hops of b seen from a.

    ``unknown`` where the walk from either side was still going at ``max_hops``. The upstream walk counts first;
    the downstream one replaces it only with fewer hops.
    """
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    up = reach(edges, pairs, a, max_hops).select(F.col("start").alias(a), F.col("node").alias(b), F.col("hops").alias("up"))
    down = reach(back, pairs, a, max_hops).select(F.col("start").alias(a), F.col("node").alias(b), F.col("hops").alias("down"))
    cut = lambda d, c, e: d.filter(F.col(c) == max_hops).join(e.select(F.col("src").alias(b)), b, "left_semi").select(a).distinct().withColumn(f"{c}_cut", F.lit(True))
    j = pairs.join(up, [a, b], "left").join(down, [a, b], "left").join(cut(up, "up", edges), a, "left").join(cut(down, "down", back), a, "left")
    r = F.when(F.col(a) == F.col(b), "same").when(F.col("up").isNotNull() & (F.col("down").isNull() | (F.col("up") <= F.col("down"))), "upstream").when(F.col("down").isNotNull(), "downstream").when(F.coalesce("up_cut", F.lit(False)) | F.coalesce("down_cut", F.lit(False)), "unknown").otherwise("none")
    return j.withColumn("relation", r).withColumn("hops", F.least("up", "down")).drop("up", "down", "up_cut", "down_cut")


def _greedy(lat: np.ndarray, lon: np.ndarray, area: np.ndarray, distance_m: float, error: float) -> np.ndarray:
    """Cluster number (index of its first member) of each station in the order given: complete linkage, scanning pairs
    of clusters from the first, merging the first pair that may merge and starting again."""
    n = len(lat)
    p, q = np.radians(lat), np.radians(lon)
    h = np.sin((p[:, None] - p[None, :]) / 2) ** 2 + np.cos(p[:, None]) * np.cos(p[None, :]) * np.sin((q[:, None] - q[None, :]) / 2) ** 2
    d = 2 * EARTH_RADIUS_ROUND_M * np.arcsin(np.sqrt(np.clip(h, 0, 1)))
    top = np.maximum(np.abs(area[:, None]), np.abs(area[None, :]))
    with np.errstate(divide="ignore", invalid="ignore"):
        e = np.where(top == 0, 0.0, np.abs(area[:, None] - area[None, :]) / top)
    ok = (d <= distance_m) & (e <= error)
    members = [[i] for i in range(n)]
    link = ok.copy()  # may clusters i and j merge: all cross pairs may
    np.fill_diagonal(link, False)
    alive = list(range(n))
    i = 0
    while i < len(alive):
        a = alive[i]
        later = [b for b in alive[i + 1 :] if link[a, b]]
        if not later:
            i += 1
            continue
        b = later[0]
        members[a] += members[b]
        alive.remove(b)
        link[a] &= link[b]
        link[:, a] &= link[:, b]
        i = 0  # the scan starts again after a merge
    out = np.empty(n, np.int64)
    for a in alive:
        out[members[a]] = a
    return out


def complete_linkage(df: DataFrame, station: str, basin: str, status: str, lat: str, lon: str, area: str, kind: str, distance_m: float = 5000.0, error: float = 0.10, block_rows: int = 4000) -> DataFrame:
    """(station, cluster): stations of a basin merged while all members are within ``distance_m`` and ``error`` of each other.

    Unresolved stations, those without basin, position or area, and satellite stations stay alone (their own id). The
    result depends on ascending station ids, by definition. Stations farther apart than ``distance_m`` can never share
    a cluster, so a basin is first cut along its gaps (a gap in latitude, then one in longitude, wider than
    ``distance_m``): the cuts change nothing, and a task holds one connected patch of a basin, not the basin. A patch of more than
    ``block_rows`` stations raises instead of filling a task.
    """
    from pyspark.sql import Window as W

    s = df.select(F.col(station).alias("s"), F.col(basin).alias("b"), F.col(lat).cast("double").alias("la"), F.col(lon).cast("double").alias("lo"), F.col(area).cast("double").alias("ar"), ((F.col(status) == "resolved") & F.col(basin).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.col(area).isNotNull() & ~F.coalesce(F.lower(F.trim(kind)).contains("satellite"), F.lit(False))).alias("may"))
    alone = s.filter("not coalesce(may, false)").select(F.col("s").alias(station), F.col("s").alias("cluster"))
    deg = float(np.degrees(distance_m / EARTH_RADIUS_ROUND_M))
    m = s.filter("may")
    w1 = W.partitionBy("b").orderBy("la", "s")
    m = m.withColumn("g1", F.sum(F.when(F.col("la") - F.lag("la").over(w1) > deg, 1).otherwise(0)).over(w1))
    w2 = W.partitionBy("b", "g1").orderBy("lo", "s")
    wide = deg / F.greatest(F.cos(F.radians(F.least(F.abs("la") + deg, F.lit(89.9)))), F.lit(1e-3))
    most = F.max(wide).over(W.partitionBy("b", "g1"))
    m = m.withColumn("most", most).withColumn("g2", F.sum(F.when(F.col("lo") - F.lag("lo").over(w2) > F.col("most"), 1).otherwise(0)).over(w2)).drop("most")
    # most patches hold one station: those are answered here and never travel to Python
    m = m.withColumn("n", F.count("*").over(W.partitionBy("b", "g1", "g2")))
    lone = m.filter("n = 1").select(F.col("s").alias(station), F.col("s").alias("cluster"))
    m = m.filter("n > 1").drop("n")
    kind_s = df.schema[station].dataType.simpleString()

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) > block_rows:
            raise ValueError(f"a patch of one basin has {len(pdf)} stations, more than {block_rows}")
        pdf = pdf.sort_values("s", kind="stable").drop_duplicates("s")
        first = _greedy(pdf["la"].to_numpy(), pdf["lo"].to_numpy(), pdf["ar"].to_numpy(), distance_m, error)
        ids = pdf["s"].to_numpy()
        return pd.DataFrame({station: ids, "cluster": ids[first]})

    out = m.groupBy("b", "g1", "g2").applyInPandas(work, f"{station} {kind_s}, cluster {kind_s}")
    return alone.unionByName(lone).unionByName(out)
