import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fluvion.functions.geo import EARTH_RADIUS_M
from fluvion.operators.spatial import points_in_polygons, points_in_ring, within_distance


def brute(p, c, d):
    out = set()
    for i, la, lo in p:
        for j, lb, ob in c:
            if None in (la, lo, lb, ob) or not all(np.isfinite([la, lo, lb, ob])) or abs(la) > 90 or abs(lb) > 90 or not -180 <= lo <= 360 or not -180 <= ob <= 360:
                continue
            a, b, dl = np.radians(la), np.radians(lb), np.radians(ob - lo)
            h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(dl / 2) ** 2
            if 2 * EARTH_RADIUS_M * np.arcsin(min(1, np.sqrt(h))) <= d:
                out.add((i, j))
    return out


def run(spark, p, c, d, **kw):
    x = spark.createDataFrame(p, "i int, lat double, lon double")
    y = spark.createDataFrame(c, "j int, lat double, lon double")
    return {(r["i"], r["j"]) for r in within_distance(x, "lat", "lon", y, "lat", "lon", d, **kw).collect()}


@pytest.mark.parametrize("lat0,lon0", [(0, 0), (45, 180), (89.95, 10), (-89.99, -120), (60, -179.99)])
def test_pairs_equal_brute_force(spark, lat0, lon0):
    rng = np.random.default_rng(7)
    near = lambda n, k: [(i + k, float(np.clip(lat0 + rng.normal(0, 0.03), -90, 90)), float((lon0 + rng.normal(0, 0.05) / max(np.cos(np.radians(lat0)), 0.001) + 540) % 360 - 180)) for i in range(n)]
    p, c = near(150, 0), near(120, 1000)
    assert run(spark, p, c, 2000.0) == brute(p, c, 2000.0)


def test_hot_cells_are_salted_without_loss(spark):
    rng = np.random.default_rng(1)
    p = [(i, float(10 + rng.normal(0, 0.001)), float(20 + rng.normal(0, 0.001))) for i in range(300)]
    c = [(j, 10.0 + j / 1e4, 20.0) for j in range(5)]
    assert run(spark, p, c, 500.0, hot_rows=20) == brute(p, c, 500.0)


def test_unusable_positions_conventions_repeats_and_empty(spark):
    p = [(1, 0.0, 359.999), (1, 0.0, 359.999), (2, None, 0.0), (3, float("nan"), 0.0), (4, -9999.0, 0.0), (5, 0.0, None), (6, 0.0, 361.0)]
    c = [(9, 0.0, -0.001)]
    x = spark.createDataFrame(p, "i int, lat double, lon double")
    y = spark.createDataFrame(c, "j int, lat double, lon double")
    assert [r["i"] for r in within_distance(x, "lat", "lon", y, "lat", "lon", 2000.0).collect()] == [1, 1]
    assert within_distance(x.limit(0), "lat", "lon", y, "lat", "lon", 2000.0).count() == 0
    assert within_distance(x, "lat", "lon", y.limit(0), "lat", "lon", 2000.0).count() == 0


def test_working_names_may_occur_in_the_input(spark):
    x = spark.createDataFrame([(1, 0.0, 0.0, "a")], "_cell int, lat double, lon double, _parent string")
    out = within_distance(x, "lat", "lon", x, "lat", "lon", 10.0)
    assert out.columns == ["_cell", "lat", "lon", "_parent", "centre__cell", "centre_lat", "centre_lon", "centre__parent"] and out.count() == 1


def test_polygons(spark):
    rng = np.random.default_rng(3)
    pts = pd.DataFrame({"i": range(800), "lat": rng.uniform(-3, 3, 800), "lon": rng.uniform(-3, 3, 800)})
    star = [(0, 3), (0.7, 0.7), (3, 0), (0.7, -0.7), (0, -3), (-0.7, -0.7), (-3, 0), (-0.7, 0.7)]
    box = [(-1, -1), (-1, 1), (1, 1), (1, -1)]
    rows = [("star", [{"lat": float(a), "lon": float(b)} for a, b in star]), ("box", [{"lat": float(a), "lon": float(b)} for a, b in box]), ("none", None), ("line", [{"lat": 0.0, "lon": 0.0}])]
    poly = spark.createDataFrame(rows, "rid string, ring array<struct<lat: double, lon: double>>")
    out = points_in_polygons(spark.createDataFrame(pts), "lat", "lon", poly, "rid", "ring", base_deg=1.0, levels=3)
    got = {(r["i"], r["rid"]) for r in out.collect()}
    want = {(int(i), n) for n, ring in (("star", star), ("box", box)) for i in pts["i"][points_in_ring(pts["lat"].to_numpy(), pts["lon"].to_numpy(), np.array(ring, float))]}
    assert got == want and len(want) > 50
    assert points_in_polygons(spark.createDataFrame(pts).filter(F.lit(False)), "lat", "lon", poly, "rid", "ring").count() == 0
