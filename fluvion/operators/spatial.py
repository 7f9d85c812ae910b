"""Points near points or inside regions, by adaptive cell coverage.

The sphere is cut into rings of equal height, each ring into cells of about equal width; every cell splits
into 4 x 4 children. A region is covered by the largest cells that lie wholly inside it and, along its edge,
by the smallest ones. A point carries the ids of the cells that hold it, one per level, so that an equi-join
finds all pairs: pairs from interior cells are accepted as they are, pairs from edge cells are tested exactly.

Nothing here depends on the number of points or regions: the cover of a region has a constant size, the join
is an ordinary hash or sort-merge join on a long key, and cells that hold very many points are salted.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvion.functions.geo import EARTH_RADIUS_M, haversine_m, valid_position, wrap_lon
from fluvion.session import materialize

SPLIT = 4  # children of a cell in either direction
SLACK_M = 1e-3  # how far from the edge a cell must lie to count as inside or outside


class Grid:
    """The cells for one base cell height (degrees)."""

    def __init__(self, base_deg: float, levels: int = 2):
        self.rings = max(1, int(180.0 // base_deg))
        self.height = 180.0 / self.rings
        self.levels = levels

    def columns(self, ring: Column) -> Column:
        """Cells of a base ring: as many as keep them no narrower than high, at the edge nearer to the equator."""
        lo = F.abs(ring * F.lit(self.height) - 90.0)
        hi = F.abs((ring + 1) * F.lit(self.height) - 90.0)
        across = F.when((ring * F.lit(self.height) - 90.0) * ((ring + 1) * F.lit(self.height) - 90.0) < 0, F.lit(0.0)).otherwise(F.least(lo, hi))
        return F.greatest(F.lit(1), F.floor(F.cos(F.radians(across)) * F.lit(360.0 / self.height))).cast("bigint")

    @staticmethod
    def key(level: int | Column, ring: Column, column: Column) -> Column:
        level = F.lit(level) if isinstance(level, int) else level
        return (F.shiftleft(ring.cast("bigint"), 34) + F.shiftleft(column.cast("bigint"), 3) + level).cast("bigint")

    def cell(self, lat: Column, lon: Column, level: int) -> tuple[Column, Column]:
        """Ring and column of the cell of a level that holds a position (lon in [-180, 180))."""
        n = SPLIT**level
        ring = F.least(F.floor((lat + 90.0) / F.lit(self.height / n)), F.lit(self.rings * n - 1)).cast("bigint")
        cols = self.columns(F.floor(ring / n).cast("bigint")) * n
        return ring, F.least(F.floor((lon + 180.0) / 360.0 * cols), cols - 1).cast("bigint")


def cover_discs(regions: DataFrame, lat: str, lon: str, distance_m: float, grid: Grid, radius: float = EARTH_RADIUS_M) -> DataFrame:
    """Rows of ``regions`` times the cells of their discs: adds _cell, _parent (base cell) and _inside."""
    delta = np.degrees(distance_m / radius)
    la, lo = F.col(lat), F.col(lon)
    ring0 = F.greatest(F.lit(0), F.floor((la - delta + 90.0) / F.lit(grid.height))).cast("bigint")
    ring1 = F.least(F.lit(grid.rings - 1), F.floor((la + delta + 90.0) / F.lit(grid.height))).cast("bigint")
    df = regions.withColumn("_ring", F.explode(F.sequence(ring0, ring1))).withColumn("_n", grid.columns(F.col("_ring")))
    half = F.when(F.abs(la) + delta >= 90.0, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), F.lit(np.sin(np.radians(delta))) / F.cos(F.radians(la))))) + 1e-9)
    c0 = F.floor((lo - half + 180.0) / 360.0 * F.col("_n")).cast("bigint")
    c1 = F.floor((lo + half + 180.0) / 360.0 * F.col("_n")).cast("bigint")
    whole = (c1 - c0 + 1) >= F.col("_n")
    df = df.withColumn("_u", F.explode(F.when(whole, F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)).otherwise(F.sequence(c0, c1))))
    df = df.withColumn("_col", F.pmod(F.col("_u"), F.col("_n"))).drop("_u").withColumn("_parent", Grid.key(0, F.col("_ring"), F.col("_col")))

    hav = lambda m: float(np.sin(min(m / radius, np.pi) / 2) ** 2)
    outside, inside = hav(distance_m + SLACK_M), hav(max(distance_m - SLACK_M, 0.0))
    half_sq = lambda angle: F.pow(F.sin(angle / 2), F.lit(2.0))
    temporary = ("_a0", "_a1", "_c0", "_c1", "_s0", "_s1", "_lat_in", "_lon_in", "_wide")

    def classed(d: DataFrame, level: int) -> DataFrame:
        """Class of each cell: 2 inside (its farthest corner is), 1 edge, 0 outside, by haversines of the parts.

        hav(distance) = hav(dlat) + cos cos hav(dlon). The largest value is at a corner; the smallest is at least the sum
        of the smallest parts, so a cell may pass for edge though it is outside, never the other way round.
        """
        n = SPLIT**level
        lat0 = F.radians(F.col("_ring") * F.lit(grid.height / n) - 90.0)
        lat1 = F.radians((F.col("_ring") + 1) * F.lit(grid.height / n) - 90.0)
        w = F.lit(360.0) / (F.col("_n") * n)
        lon0 = F.col("_col") * w - 180.0
        p = F.radians(la)
        d = d.withColumns({"_a0": half_sq(lat0 - p), "_a1": half_sq(lat1 - p), "_c0": F.cos(p) * F.cos(lat0), "_c1": F.cos(p) * F.cos(lat1), "_s0": half_sq(F.radians(lon0 - lo)), "_s1": half_sq(F.radians(lon0 + w - lo)), "_lat_in": (p >= lat0) & (p <= lat1), "_lon_in": F.pmod(lo - lon0, F.lit(360.0)) <= w, "_wide": w > 45.0})
        far = F.greatest(F.col("_a0") + F.col("_c0") * F.greatest("_s0", "_s1"), F.col("_a1") + F.col("_c1") * F.greatest("_s0", "_s1"))
        near = F.when(F.col("_lat_in"), F.lit(0.0)).otherwise(F.least("_a0", "_a1")) + F.when(F.col("_lon_in"), F.lit(0.0)).otherwise(F.least("_c0", "_c1") * F.least("_s0", "_s1"))
        # near a pole a wide cell's sides behave otherwise: leave such cells to the exact test
        d = d.withColumn("_class", F.when(F.col("_wide"), F.lit(1)).when(near > outside, F.lit(0)).when(far <= inside, F.lit(2)).otherwise(F.lit(1)))
        return d.filter(F.col("_class") > 0).drop(*temporary)

    steps = F.array(*[F.lit(i) for i in range(SPLIT)])
    df, done = classed(df, 0), None
    for level in range(grid.levels):
        last = level == grid.levels - 1
        part = df if last else df.filter(F.col("_class") == 2)
        part = part.withColumn("_cell", Grid.key(level, F.col("_ring"), F.col("_col"))).withColumn("_inside", F.col("_class") == 2).drop("_class", "_ring", "_col", "_n")
        done = part if done is None else done.unionByName(part)
        if not last:
            df = df.filter(F.col("_class") == 1).withColumn("_i", F.explode(steps)).withColumn("_j", F.explode(steps))
            df = classed(df.withColumn("_ring", F.col("_ring") * SPLIT + F.col("_i")).withColumn("_col", F.col("_col") * SPLIT + F.col("_j")).drop("_i", "_j", "_class"), level + 1)
    return done


def _salted(points: DataFrame, cover: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Spread base cells of more than ``hot_rows`` points: points over salts, their cover rows copied to each salt."""
    hot = points.groupBy("_parent").count().filter(F.col("count") > hot_rows).select("_parent", F.ceil(F.col("count") / hot_rows).cast("int").alias("_salts"))
    hot = F.broadcast(hot)  # at most points / hot_rows rows of 12 bytes: two million for 10^12 points
    points = points.join(hot, "_parent", "left").withColumn("_salt", F.when(F.col("_salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("_p"), F.col("_salts")).cast("int"))).drop("_salts")
    cover = cover.join(hot, "_parent", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_salts")
    return points, cover


def within_distance(points: DataFrame, point_lat: str, point_lon: str, centres: DataFrame, centre_lat: str, centre_lon: str, distance_m: float, radius: float = EARTH_RADIUS_M, hot_rows: int = 500_000) -> DataFrame:
    """All pairs of a point and a centre at most ``distance_m`` apart along the great circle.

    Columns of both inputs come out; names that occur in both get a ``centre_`` prefix on the centres' side.
    Rows whose position is missing, NaN or out of range have no partner. Longitudes may use -180..180 or 0..360.
    Equal rows stay as often as they are; an empty input gives no rows.
    """
    grid = Grid(np.degrees(distance_m / radius) / 2)
    # rows travel whole in one struct, so no name of an input can clash with a working column
    whole = lambda d: F.struct(*[F.col(f"`{c}`") for c in d.columns])
    p = points.filter(valid_position(F.col(point_lat), F.col(point_lon))).select(whole(points).alias("_p"), F.col(point_lat).cast("double").alias("_plat"), wrap_lon(F.col(point_lon).cast("double")).alias("_plon"))
    c = centres.filter(valid_position(F.col(centre_lat), F.col(centre_lon))).select(whole(centres).alias("_c"), F.col(centre_lat).cast("double").alias("_clat"), wrap_lon(F.col(centre_lon).cast("double")).alias("_clon"))
    # a cover has a hundred cells or so a centre: spread the centres first, also where their table is one small file
    cover = cover_discs(c.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "_clat", "_clon", distance_m, grid, radius)
    p = p.withColumn("_parent", Grid.key(0, *grid.cell(F.col("_plat"), F.col("_plon"), 0)))
    p, cover = _salted(p, cover, hot_rows)
    cells = F.array(*[Grid.key(level, *grid.cell(F.col("_plat"), F.col("_plon"), level)) for level in range(grid.levels)])
    p = p.withColumn("_cell", F.explode(cells)).drop("_parent")
    # never broadcast: the optimiser takes the cover for as small as its centres, of which each has a hundred rows or more
    near = p.join(cover.drop("_parent").hint("merge"), ["_cell", "_salt"]).filter(F.col("_inside") | (haversine_m(F.col("_plat"), F.col("_plon"), F.col("_clat"), F.col("_clon"), radius) <= distance_m))
    theirs = [F.col(f"_c.`{c}`").alias(f"centre_{c}" if c in points.columns else c) for c in centres.columns]
    return near.select(*[F.col(f"_p.`{c}`") for c in points.columns], *theirs)


def best_near(points: DataFrame, point_lat: str, point_lon: str, candidates: DataFrame, lat: str, lon: str, point_id: str, candidate_id: str, distance_m: float, penalty: Column | None = None, radius: float = EARTH_RADIUS_M) -> DataFrame:
    """Of each point the candidate within ``distance_m`` of least penalty + distance / ``distance_m`` (to nine digits; ties: smallest id).

    Columns of both inputs plus distance_m, penalty and score. ``penalty`` (0 or more, over the columns of both; none
    means the nearest) may be anything, so the search goes outwards: what lies farther than score * distance_m cannot
    win, and a point whose best is that near is settled without the wider circles. Points without candidate give no row.
    Repeated points and candidates count once.
    """
    todo, done = points.dropDuplicates([point_id]), None
    cand = candidates.dropDuplicates([candidate_id])
    at = distance_m / 64
    while True:
        at = min(at * 8, distance_m)
        j = within_distance(todo, point_lat, point_lon, cand, lat, lon, at, radius)
        j = j.withColumn("distance_m", haversine_m(F.col(point_lat), F.col(point_lon), F.col(lat), F.col(lon), radius)).withColumn("penalty", F.lit(0.0) if penalty is None else penalty)
        j = j.withColumn("score", F.round(F.col("penalty") + F.col("distance_m") / distance_m, 9))
        best = j.groupBy(point_id).agg(F.min_by(F.struct(*[c for c in j.columns if c != point_id]), F.struct("score", candidate_id)).alias("_b")).select(point_id, "_b.*")
        if at >= distance_m:
            return best if done is None else done.unionByName(best)
        settled = materialize(best.filter(F.col("score") * distance_m <= at - SLACK_M))
        done = settled if done is None else done.unionByName(settled)
        todo = todo.join(settled.select(point_id), point_id, "left_anti")


def _cover_polygon(ring: np.ndarray, height: float, rings: int, levels: int, limit: int):
    """Cells of one polygon (lat, lon vertices): (level, ring, column, inside). Planar in degrees."""
    lats, lons = ring[:, 0], ring[:, 1]
    todo, out = [], []

    def cols(r):
        a, b = r * height - 90, (r + 1) * height - 90
        across = 0.0 if a * b < 0 else min(abs(a), abs(b))
        return max(1, int(np.floor(np.cos(np.radians(across)) * (360.0 / height))))

    for r in range(max(0, int((lats.min() + 90) // height)), min(rings - 1, int((lats.max() + 90) // height)) + 1):
        n = cols(r)
        for c in range(max(0, int((lons.min() + 180) / 360 * n)), min(n - 1, int((lons.max() + 180) / 360 * n)) + 1):
            todo.append((0, r, c, n))
    x0, y0, x1, y1 = lons, lats, np.roll(lons, -1), np.roll(lats, -1)
    while todo:
        level, r, c, n = todo.pop()
        k = SPLIT**level
        h, w = height / k, 360.0 / (n * k)
        a, b = r * h - 90, c * w - 180
        # an edge touches the cell if the segment, clipped to the cell's box, is not empty
        t0, t1, dx, dy = np.zeros(len(x0)), np.ones(len(x0)), x1 - x0, y1 - y0
        cut = np.ones(len(x0), bool)
        for d, lo, hi, s in ((dx, b, b + w, x0), (dy, a, a + h, y0)):
            still = d == 0
            cut &= ~still | ((s >= lo) & (s <= hi))
            with np.errstate(divide="ignore", invalid="ignore"):
                u, v = (lo - s) / d, (hi - s) / d
            t0 = np.where(still, t0, np.maximum(t0, np.minimum(u, v)))
            t1 = np.where(still, t1, np.minimum(t1, np.maximum(u, v)))
        touched = bool((cut & (t0 <= t1)).any())
        if not touched:
            if points_in_ring(np.array([a + h / 2]), np.array([b + w / 2]), ring)[0]:
                out.append((level, r, c, True))
        elif level == levels - 1 or len(out) + len(todo) > limit:
            out.append((level, r, c, False))
        else:
            todo += [(level + 1, r * SPLIT + i, c * SPLIT + j, n) for i in range(SPLIT) for j in range(SPLIT)]
    return out


def points_in_ring(lat: np.ndarray, lon: np.ndarray, ring: np.ndarray) -> np.ndarray:
    """Even-odd containment of points in a closed ring of (lat, lon) vertices; points on an edge count as inside."""
    inside, edge = np.zeros(len(lat), bool), np.zeros(len(lat), bool)
    y0, x0 = ring[:, 0], ring[:, 1]
    y1, x1 = np.roll(y0, -1), np.roll(x0, -1)
    for ax, ay, bx, by in zip(x0, y0, x1, y1):
        cross = (bx - ax) * (lat - ay) - (by - ay) * (lon - ax)
        edge |= (cross == 0) & (lat >= min(ay, by)) & (lat <= max(ay, by)) & (lon >= min(ax, bx)) & (lon <= max(ax, bx))
        if ay != by:
            inside ^= ((ay > lat) != (by > lat)) & (lon < (bx - ax) * (lat - ay) / (by - ay) + ax)
    return inside | edge


def points_in_polygons(points: DataFrame, lat: str, lon: str, polygons: DataFrame, region_id: str, ring: str, base_deg: float = 1.0, levels: int = 4, max_cells: int = 4096) -> DataFrame:
    """All pairs of a point and a region that contains it (edges included).

    ``polygons``: one row a region, ``ring`` an array of struct<lat, lon> in degrees that does not cross the
    antimeridian. Columns of ``points`` plus ``region_id``. Invalid positions, null and degenerate rings have no
    partner. Interior cells accept by equi-join alone, only edge cells run the exact test (Arrow batches).
    ``max_cells`` bounds the cover of one region: beyond it edge cells stay coarse, which costs exact tests
    and never changes the result.
    """
    grid = Grid(base_deg, levels)
    height, rings = grid.height, grid.rings

    def cover(batches):
        for pdf in batches:
            rows = []
            for rid, pts in zip(pdf["_rid"], pdf["_ring"]):
                v = np.array([(p["lat"], p["lon"]) for p in pts], float) if pts is not None else np.empty((0, 2))
                if len(v) >= 3 and np.isfinite(v).all():
                    rows += [(rid, (r << 34) + (c << 3) + level, inside) for level, r, c, inside in _cover_polygon(v, height, rings, levels, max_cells)]
            yield pd.DataFrame(rows, columns=["_rid", "_cell", "_inside"]).astype({"_cell": "int64", "_inside": bool})

    regions = polygons.select(F.col(region_id).alias("_rid"), F.col(ring).alias("_ring"))
    kind = regions.schema["_rid"].dataType.simpleString()
    covered = regions.mapInPandas(cover, f"_rid {kind}, _cell bigint, _inside boolean")
    whole = F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("_p")
    p = points.filter(valid_position(F.col(lat), F.col(lon))).select(whole, F.col(lat).cast("double").alias("_plat"), wrap_lon(F.col(lon).cast("double")).alias("_plon"))
    p = p.withColumn("_cell", F.explode(F.array(*[Grid.key(level, *grid.cell(F.col("_plat"), F.col("_plon"), level)) for level in range(levels)])))
    near = p.join(covered, "_cell")

    @F.pandas_udf("boolean")
    def exact(la: pd.Series, lo: pd.Series, rings_: pd.Series) -> pd.Series:
        return pd.Series([bool(points_in_ring(np.array([a]), np.array([b]), np.array([(q["lat"], q["lon"]) for q in r], float))[0]) for a, b, r in zip(la, lo, rings_)])

    sure = near.filter("_inside")
    edge = near.filter("not _inside").join(regions, "_rid").filter(exact("_plat", "_plon", "_ring")).drop("_ring")
    return sure.unionByName(edge).select(*[F.col(f"_p.`{c}`") for c in points.columns], F.col("_rid").alias(region_id))
