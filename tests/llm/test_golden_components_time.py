import datetime
import random

import numpy as np
from pyspark.sql import functions as F

from fluvion.llm.components import connected_components
from fluvion.llm.golden import best_rows, golden_records
from fluvion.llm.nearest_time import nearest_in_time

T = datetime.datetime(2020, 1, 1)
day = lambda k: T + datetime.timedelta(days=k)


def test_best_rows_order_ties_nulls_and_repeats(spark):
    rows = [(1, 10, "x", 1, day(1)), (1, 11, "y", 1, day(2)), (1, 12, "z", 1, day(2)), (1, 11, "y", 1, day(2)), (1, 13, None, 0, day(9)), (2, 20, "a", None, None), (2, 21, "b", None, None), (3, 30, "only", 1, day(1)), (3, 30, "only", 1, day(1)), (4, 40, None, 1, day(1)), (4, 41, None, 1, day(1)), (None, 50, "n", 1, day(1)), (5, 60, "p", 2, day(9)), (5, 61, "q", 1, None)]
    df = spark.createDataFrame(rows, "k int, rid int, v string, tr int, at timestamp").withColumn("key", F.lit("clash"))
    got = {r["k"]: (r["rid"], r["value"]) for r in best_rows(df, "k", "rid", {"v": F.col("v")}, F.col("tr"), "at").collect()}
    assert got == {1: (11, "y"), 2: (20, "a"), 5: (61, "q")}
    assert best_rows(df.limit(0), "k", "rid", {"v": F.col("v")}, F.col("tr"), "at").count() == 0


def test_golden_record_by_votes(spark):
    rows = [(1, 1, "Alpha", 1.0, day(0)), (1, 2, "alpha", 1.0, day(1)), (1, 3, "Beta", 1.5, day(1)), (1, 3, "Beta", 1.5, day(1)), (2, 4, None, 1.0, day(0))]
    df = spark.createDataFrame(rows, "k int, rid int, v string, w double, at timestamp")
    out = golden_records(df, "k", "rid", {"v": F.col("v"), "u": F.lit(None).cast("string")}, F.col("w"), "at")
    assert [(r["k"], r["v"], r["u"]) for r in out.collect()] == [(1, "alpha", None)]


def union_find(edges):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


def check(spark, edges, **kw):
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["vertex"]: r["component"] for r in connected_components(df, "a", "b", **kw).collect()}
    assert got == union_find([e for e in edges if None not in e])


def test_components_of_chains_stars_cycles_and_dust(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(1000, 1130)]
    star = [(5, i) for i in range(2000, 2100)]
    dust = [(rng.randrange(3000, 3300), rng.randrange(3000, 3300)) for _ in range(150)]
    edges = chain + star + dust + [(1, 2), (2, 3), (3, 1), (7, 7), (1, 2)]
    rng.shuffle(edges)
    check(spark, edges)
    check(spark, star + [(None, 1), (2, None)], hot_rows=10)
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_nearest_in_time_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    left = [(f"l{i}", f"e{rng.integers(0, 4)}", T + datetime.timedelta(seconds=int(rng.integers(0, 40 * 86400)))) for i in range(300)]
    right = [(f"r{i:04d}", f"e{rng.integers(0, 4)}", T + datetime.timedelta(seconds=int(rng.integers(0, 40 * 86400)))) for i in range(200)]
    want = {}
    for i, e, t in left:
        best = min(((abs((u - t).total_seconds()), u, j) for j, f, u in right if f == e and abs((u - t).total_seconds()) <= 86400), default=None)
        if best:
            want[i] = best[2]
    a = spark.createDataFrame(left, "lid string, e string, lt timestamp").withColumn("g", F.lit(1))
    b = spark.createDataFrame(right, "rid string, e string, rt timestamp").withColumn("r", F.lit(1))
    for size in (1 << 20, 200):
        out = nearest_in_time(a, b, "e", "lid", "lt", "rid", "rt", 86400, range_days=2.0, bytes_per_task=size)
        assert {r["lid"]: r["rid"] for r in out.collect()} == want


def test_nearest_in_time_limits_ties_repeats_nulls_and_empty(spark):
    a = spark.createDataFrame([("x", "e", T), ("x", "e", T), ("edge", "e", day(10)), ("out", "e", day(20)), ("n", None, T), ("m", "e", None), (None, "e", T)], "lid string, e string, lt timestamp")
    b = spark.createDataFrame([("b2", "e", T + datetime.timedelta(hours=1)), ("b1", "e", T - datetime.timedelta(hours=1)), ("b0", "e", T - datetime.timedelta(hours=1)), ("c", "e", day(11)), ("d", "e", day(21) + datetime.timedelta(microseconds=1)), ("z", None, T)], "rid string, e string, rt timestamp")
    got = {r["lid"]: (r["rid"], r["delta_s"]) for r in nearest_in_time(a, b, "e", "lid", "lt", "rid", "rt", 86400).collect()}
    assert got == {"x": ("b0", -3600.0), "edge": ("c", 86400.0)}
    assert nearest_in_time(a.limit(0), b, "e", "lid", "lt", "rid", "rt", 86400).count() == 0
    assert nearest_in_time(a, b.limit(0), "e", "lid", "lt", "rid", "rt", 86400).count() == 0
