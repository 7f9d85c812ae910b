"""Links of satellite stations to clusters along a river network, with the reason for each that has none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluvion.functions.geo import haversine_m, segment_distance_m, symmetric_relative_error
from fluvion.operators.graph import reach


def link_to_clusters(satellites: DataFrame, clusters: DataFrame, edges: DataFrame, segments: DataFrame, max_hops: int = 50, max_area_error: float = 0.10, max_cross_m: float = 1000.0, tie_m: float = 100.0, tie_area: float = 0.01) -> DataFrame:
    """One row a satellite: satellite, cluster, status (linked, ambiguous, unlinked), method, hops, area_error,
    to_cluster_reach_m, to_satellite_reach_m, distance_m, reason.

    ``satellites``: satellite, reach, area, lat, lon; ``clusters``: cluster, reach, area, lat, lon; ``edges``: src flows into dst;
    ``segments``: reach, lat1, lon1, lat2, lon2 (a reach may have several).
    A cluster on the satellite's own reach is taken before all others: the nearest, then the least area error, then the
    smallest cluster. Otherwise clusters up or down the network within ``max_hops``, of like area and with both points near the
    other's reach, ranked by hops, larger cross distance, area error, cluster; ambiguous if the first two have the same hops and
    differ by at most ``tie_m`` and ``tie_area``. The reason of an unlinked one is the first of missing_coordinates, unresolved_reach,
    not_topology_connected, missing_upstream_area, area_mismatch, missing_geometry, distance_mismatch, that of its
    candidate that came farthest. Repeated rows count once; a null satellite or cluster takes no part.
    """
    s = satellites.select("satellite", F.col("reach").alias("sr"), F.col("area").alias("sa"), F.col("lat").alias("sla"), F.col("lon").alias("slo")).filter("satellite is not null").dropDuplicates(["satellite"])
    c = clusters.select("cluster", F.col("reach").alias("cr"), F.col("area").alias("ca"), F.col("lat").alias("cla"), F.col("lon").alias("clo")).filter("cluster is not null and reach is not null").dropDuplicates(["cluster"])
    placed = s.filter("sla is not null and slo is not null and not isnan(sla) and not isnan(slo)")
    usable = placed.filter("sr is not null")
    ok_area = (F.col("sa") > 0) & (F.col("ca") > 0) & ~F.isnan("sa") & ~F.isnan("ca")
    point = haversine_m(F.col("sla"), F.col("slo"), F.col("cla"), F.col("clo"))
    area = F.when(ok_area, symmetric_relative_error(F.col("sa"), F.col("ca")))
    # on the same reach
    same = usable.join(c, F.col("sr") == F.col("cr")).withColumn("distance_m", point).withColumn("area_error", area)
    best = same.groupBy("satellite").agg(F.min_by(F.struct("cluster", "area_error", "distance_m"), F.struct(F.coalesce("distance_m", F.lit(float("inf"))), F.coalesce("area_error", F.lit(float("inf"))), "cluster")).alias("b"))
    linked = best.select("satellite", "b.cluster", F.lit("linked").alias("status"), F.lit("same_reach").alias("method"), F.lit(0).alias("hops"), "b.area_error", F.lit(None).cast("double").alias("to_cluster_reach_m"), F.lit(None).cast("double").alias("to_satellite_reach_m"), "b.distance_m", F.lit("").alias("reason"))
    # along the network: each reach is walked from once, whatever stands on it
    rest = usable.join(best.select("satellite"), "satellite", "left_anti")
    starts = rest.select("sr").distinct()
    down = reach(edges.select("src", "dst"), starts, "sr", max_hops).withColumnRenamed("start", "sr")
    up = reach(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")), starts, "sr", max_hops).withColumnRenamed("start", "sr")
    near = down.select("sr", "node", "hops", F.lit("downstream").alias("method")).unionByName(up.select("sr", "node", "hops", F.lit("upstream").alias("method"))).filter("hops > 0")
    near = near.groupBy("sr", "node").agg(F.min(F.struct("hops", "method")).alias("h")).select("sr", "node", "h.hops", "h.method")
    j = rest.join(near, "sr").join(c, F.col("node") == F.col("cr")).withColumn("distance_m", point).withColumn("area_error", area)
    seg = segments.select(F.col("reach").alias("_r"), "lat1", "lon1", "lat2", "lon2")

    def cross(df: DataFrame, r: str, la: str, lo: str, out: str) -> DataFrame:
        d = df.join(seg, F.col(r) == F.col("_r"), "left").withColumn("_d", segment_distance_m(F.col(la), F.col(lo), F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2")))
        return df.join(d.groupBy("satellite", "cluster").agg(F.min("_d").alias(out)), ["satellite", "cluster"])

    # distances are measured where the areas agree only
    alike = j.filter(F.col("area_error") <= max_area_error)
    alike = cross(cross(alike, "cr", "sla", "slo", "to_cluster_reach_m"), "sr", "cla", "clo", "to_satellite_reach_m")
    far = F.greatest("to_cluster_reach_m", "to_satellite_reach_m")
    have = F.col("to_cluster_reach_m").isNotNull() & F.col("to_satellite_reach_m").isNotNull()
    passed = alike.filter(have & (far <= max_cross_m)).withColumn("far", far)
    w = W.partitionBy("satellite").orderBy("hops", "far", "area_error", "cluster")  # candidates of one satellite: the clusters within its hops
    ranked = passed.withColumn("k", F.row_number().over(w))
    for n in ("hops", "far", "area_error"):
        ranked = ranked.withColumn(f"{n}2", F.lead(n).over(w))
    tie = F.coalesce((F.col("hops") == F.col("hops2")) & (F.abs(F.col("far") - F.col("far2")) <= tie_m) & (F.abs(F.col("area_error") - F.col("area_error2")) <= tie_area), F.lit(False))
    first = ranked.filter("k = 1")
    along = first.select("satellite", "cluster", F.when(tie, "ambiguous").otherwise("linked").alias("status"), "method", "hops", "area_error", "to_cluster_reach_m", "to_satellite_reach_m", "distance_m", F.when(tie, "ambiguous_top_candidates").otherwise("").alias("reason"))
    # why the others have none: the reason of the candidate that came farthest
    reasons = ("not_topology_connected", "missing_upstream_area", "area_mismatch", "missing_geometry", "distance_mismatch")
    step = j.select("satellite", F.when(F.col("area_error").isNull(), 1).when(F.col("area_error") > max_area_error, 2).otherwise(0).alias("r"))
    step = step.unionByName(alike.select("satellite", F.when(~have, 3).otherwise(4).alias("r"))).groupBy("satellite").agg(F.max("r").alias("r"))
    names = F.array(*[F.lit(r) for r in reasons])
    none = rest.join(along.select("satellite"), "satellite", "left_anti").join(step, "satellite", "left").select("satellite", names[F.coalesce("r", F.lit(0))].alias("reason"))
    lost = s.join(placed.select("satellite"), "satellite", "left_anti").select("satellite", F.lit("missing_coordinates").alias("reason"))
    lost = lost.unionByName(placed.filter("sr is null").select("satellite", F.lit("unresolved_reach").alias("reason")))
    empty = {"cluster": c.schema["cluster"].dataType, "method": "string", "hops": "int", "area_error": "double", "to_cluster_reach_m": "double", "to_satellite_reach_m": "double", "distance_m": "double"}
    out = none.unionByName(lost).withColumn("status", F.lit("unlinked")).withColumns({n: F.lit(None).cast(t) for n, t in empty.items()})
    return linked.unionByName(along).unionByName(out.select(*linked.columns))
