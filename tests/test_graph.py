import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluvion.operators.graph import complete_linkage, edges_from_columns, reach, relation

COLUMNS = "station_id bigint, basin_id bigint, basin_status string, uparea double, lat double, lon double, kind string"
FIXTURE = [
    (0, 1, "resolved", 100.0, 0.0, 0.00, None, 0), (1, 1, "resolved", 105.0, 0.0, 0.02, None, 0), (2, 2, "resolved", 200.0, 0.0, 1.00, None, 2), (3, 2, "resolved", 202.0, 0.0, 1.10, None, 3),
    (4, 3, "resolved", 100.0, 1.0, 0.00, None, 4), (5, 3, "resolved", 130.0, 1.0, 0.02, None, 5), (6, 4, "resolved", 150.0, 2.0, 0.00, None, 6), (7, 5, "resolved", 152.0, 2.0, 0.01, None, 7),
    (8, 1, "unresolved", 101.0, 0.0, 0.01, None, 8), (9, 6, "resolved", 100.0, 3.0, 0.00, None, 9), (10, 6, "resolved", 109.0, 3.0, 0.02, None, 9), (11, 6, "resolved", 119.0, 3.0, 0.04, None, 11),
    (12, 7, "resolved", 100.0, 4.0, 0.00, "Satellite", 12), (13, 7, "resolved", 101.0, 4.0, 0.01, "In-situ station data", 13), (14, 7, "resolved", 103.0, 4.0, 0.02, "In-situ station data", 13),
]
ARGS = ("station_id", "basin_id", "basin_status", "lat", "lon", "uparea", "kind")


def test_complete_linkage_fixture(spark):
    df = spark.createDataFrame([r[:7] for r in FIXTURE], COLUMNS)
    got = {r["station_id"]: r["cluster"] for r in complete_linkage(df.orderBy(F.rand(1)), *ARGS).collect()}
    assert got == {r[0]: r[7] for r in FIXTURE}
    assert complete_linkage(df.limit(0), *ARGS).count() == 0


def brute(points, d, e):
    clusters = [[p] for p in sorted(points)]

    def ok(a, b):
        for (_, la, lo, ar), (_, lb, ob, br) in itertools.product(a, b):
            h = np.sin(np.radians(lb - la) / 2) ** 2 + np.cos(np.radians(la)) * np.cos(np.radians(lb)) * np.sin(np.radians(ob - lo) / 2) ** 2
            if 2 * 6371000 * np.arcsin(np.sqrt(h)) > d or abs(ar - br) / max(ar, br) > e:
                return False
        return True

    again = True
    while again:
        again = False
        for i, j in itertools.combinations(range(len(clusters)), 2):
            if ok(clusters[i], clusters[j]):
                clusters[i] += clusters.pop(j)
                again = True
                break
    return {p[0]: min(c)[0] for c in clusters for p in c}


def test_complete_linkage_equals_brute_force_over_patches(spark):
    rng = np.random.default_rng(3)
    pts = [(i, float(rng.choice([0, 0.5]) + rng.normal(0, 0.03)), float(rng.choice([0, 0.7]) + rng.normal(0, 0.03)), float(rng.choice([100, 104, 150]))) for i in range(70)]
    df = spark.createDataFrame([(i, 1, "resolved", ar, la, lo, None) for i, la, lo, ar in pts], COLUMNS)
    got = {r["station_id"]: r["cluster"] for r in complete_linkage(df, *ARGS).collect()}
    assert got == brute(pts, 5000.0, 0.10)


def test_reach_chain_diamond_cycle_and_limit(spark):
    edges = [(1, 2), (1, 3), (2, 4), (3, 4), (4, 5), (5, 1), (10, 11)] + [(100 + i, 101 + i) for i in range(51)]
    e = spark.createDataFrame(edges, "src int, dst int")
    starts = spark.createDataFrame([(1,), (10,), (100,), (None,), (1,)], "n int")
    got = {(r["start"], r["node"]): r["hops"] for r in reach(e, starts, "n", 50).collect()}
    assert {k: v for k, v in got.items() if k[0] == 1} == {(1, 1): 0, (1, 2): 1, (1, 3): 1, (1, 4): 2, (1, 5): 3}
    assert got[10, 11] == 1 and got[100, 150] == 50 and (100, 151) not in got
    assert reach(e, starts.limit(0), "n", 5).count() == 0


def test_relation_and_limit(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(10)], "src int, dst int")
    pairs = spark.createDataFrame([(0, 0), (0, 2), (2, 0), (0, 9), (20, 21)], "a int, b int")
    got = {(r["a"], r["b"]): (r["relation"], r["hops"]) for r in relation(e, pairs, "a", "b", 3).collect()}
    assert got == {(0, 0): ("same", 0), (0, 2): ("upstream", 2), (2, 0): ("downstream", 2), (0, 9): ("unknown", None), (20, 21): ("none", None)}


def test_edges_from_columns(spark):
    df = spark.createDataFrame([(1, 2, None, 0), (2, None, -1, 3)], "n int, up1 int, up2 int, up3 int")
    assert sorted(tuple(r) for r in edges_from_columns(df, "n", ["up1", "up2", "up3"]).collect()) == [(1, 2), (2, 3)]
