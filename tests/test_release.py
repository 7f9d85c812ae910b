"""Links along the network, asserted joins, look-ups, quantiles and evidence, each on a small fixture."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluvion.operators import checks, lookup
from fluvion.operators.links import link_to_clusters
from fluvion.operators.ordering import average_rank
from fluvion.operators.quantiles import exact_quantiles
from fluvion.plans.release import arbitrated, validated_overrides

POINT = "reach long, area double, lat double, lon double"


def test_satellite_links_and_every_reason(spark):
    # the chain 1 -> 2 -> 3 -> 4; reach 9 stands alone; reach n lies at latitude n
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "src long, dst long")
    seg = spark.createDataFrame([(r, float(r), 10.0, float(r) + 0.001, 10.0) for r in (1, 2, 3, 4)], "reach long, lat1 double, lon1 double, lat2 double, lon2 double")
    clusters = spark.createDataFrame([("A", 2, 100.0, 2.0, 10.0), ("B", 2, 101.0, 2.0, 10.004), ("A", 2, 100.0, 2.0, 10.0), (None, 2, 1.0, 2.0, 10.0)], f"cluster string, {POINT}")
    sats = [(1, 2, 100.0, 2.0, 10.001), (2, 9, 100.0, 9.0, 10.0), (3, None, 100.0, 2.0, 10.0), (4, 2, 1.0, None, 10.0), (5, 1, float("nan"), 1.0, 10.0), (6, 1, 500.0, 1.0, 10.0), (7, 1, 100.0, 1.0, 10.0), (8, 2, 100.0, float("nan"), 10.0), (9, 4, 100.0, 4.0, 10.0)]
    out = {r["satellite"]: r for r in link_to_clusters(spark.createDataFrame(sats, f"satellite long, {POINT}"), clusters, edges, seg, max_hops=1).collect()}
    assert {k: (v["cluster"], v["status"], v["method"], v["reason"]) for k, v in out.items()} == {
        1: ("A", "linked", "same_reach", ""),
        2: (None, "unlinked", None, "not_topology_connected"),
        3: (None, "unlinked", None, "unresolved_reach"),
        4: (None, "unlinked", None, "missing_coordinates"),
        5: (None, "unlinked", None, "missing_upstream_area"),
        6: (None, "unlinked", None, "area_mismatch"),
        7: (None, "unlinked", None, "distance_mismatch"),
        8: (None, "unlinked", None, "missing_coordinates"),
        9: (None, "unlinked", None, "not_topology_connected"),
    }
    # close by along the network: linked, or ambiguous where the first two are alike
    near = spark.createDataFrame([(1, 1, 100.0, 2.001, 10.0)], f"satellite long, {POINT}")
    close = seg.filter("reach = 2").unionByName(spark.createDataFrame([(1, 2.002, 10.0, 2.003, 10.0)], seg.schema))
    one = link_to_clusters(near, clusters.filter("cluster = 'A'"), edges, close).first()
    assert (one["cluster"], one["status"], one["method"], one["hops"]) == ("A", "linked", "downstream", 1)
    two = link_to_clusters(near, spark.createDataFrame([("A", 2, 100.0, 2.0, 10.0), ("B", 2, 100.5, 2.0, 10.0002)], f"cluster string, {POINT}"), edges, close).first()
    assert (two["cluster"], two["status"]) == ("A", "ambiguous")
    lone = link_to_clusters(near, clusters.filter("cluster = 'A'"), edges, close.filter("reach = 2")).first()
    assert lone["reason"] == "missing_geometry"
    assert link_to_clusters(near.limit(0), clusters, edges, seg).count() == 0


def test_joins_that_are_asserted(spark):
    a = spark.createDataFrame([("S3_b", 1, 0.0, 0.004), ("S3_a", 0, 0.0, 0.0)], "station_key string, station_id int, lat double, lon double")
    b = spark.createDataFrame([("S3_a", 0, 0.0, 0.0, 100.0), ("S3_b", 1, 0.0, 0.004, 104.0)], "station_key string, station_id int, lat double, lon double, uparea double")
    join = lambda x, y: checks.one_to_one(x, y, "station_key", ["station_id"], {"lat": 1e-10, "lon": 1e-10})
    assert {(r["station_key"], r["uparea"]) for r in join(a, b).collect()} == {("S3_a", 100.0), ("S3_b", 104.0)}
    for wrong in (b.filter("station_id = 0"), b.unionByName(b), b.unionByName(b.filter("station_id = 0").withColumn("station_key", F.lit("S3_c"))), b.withColumn("lon", F.col("lon") + 1e-6), b.withColumn("station_id", F.lit(5))):
        with pytest.raises(ValueError):
            join(a, wrong)
    assert join(a, b.withColumn("lon", F.col("lon") + 1e-12)).count() == 2
    with pytest.raises(ValueError):
        checks.many_to_one(a, b.unionByName(b), "station_key")
    bad = spark.createDataFrame([(" ",), ("1",), ("1.5",), ("1",), (None,)], "id string")
    assert {r["check"]: r["details"] for r in checks.unique_nonempty(bad, "id", whole=True).collect()} == {"id_present": 2, "id_whole": 2, "id_unique": 1}


def test_quantiles_of_groups_of_any_kind(spark):
    rng = np.random.default_rng(1)
    data = {"a": rng.normal(0, 1, 30_000).round(3), "b": rng.lognormal(0, 2, 41), "c": np.full(12_000, 3.5), None: np.array([1.0, 2.0])}
    rows = [(k, float(x)) for k, v in data.items() for x in v] + [("d", None), ("d", float("nan"))]
    df = spark.createDataFrame(rows, "k string, x double").repartition(7)
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], {"p1": (F.col("x"), 0.01), "p50": (F.col("x"), 0.5), "p100": (F.col("x"), 1.0)}).collect()}
    for k, v in data.items():
        assert [got[k][n] for n in ("p1", "p50", "p100")] == pytest.approx([np.quantile(v, q) for q in (0.01, 0.5, 1.0)], abs=1e-12)
    assert got["d"]["p50"] is None and exact_quantiles(df.limit(0), ["k"], {"m": (F.col("x"), 0.5)}).count() == 0
    assert exact_quantiles(df.filter("k = 'b'"), [], {"m": (F.col("x"), 0.5)}).first()["m"] == pytest.approx(np.median(data["b"]))


def test_average_ranks(spark):
    df = spark.createDataFrame([("g", 3.0), ("g", 1.0), ("g", 3.0), ("h", 7.0), (None, 2.0), ("g", 9.0)], "g string, v double")
    assert sorted((r["g"] or "", r["v"], r["r"]) for r in average_rank(df, ["g"], "v", "r").collect()) == [("", 2.0, 1.0), ("g", 1.0, 1.0), ("g", 3.0, 2.5), ("g", 3.0, 2.5), ("g", 9.0, 4.0), ("h", 7.0, 1.0)]


def test_look_ups(spark):
    s = spark.createDataFrame([(1, "HYDAT", "HYD-01", "Upper Weir", "daily/HYDAT/HYDAT_daily_77.nc"), (2, "hydat ", "HYD-02", "HYD-01 Bridge", "daily/HYDAT/HYDAT_daily_78.nc"), (3, "USGS", "HYD-01", "X", None)], "station_id int, source string, native string, name string, path string")
    q = spark.createDataFrame([("a", "hydat", "hyd-01 "), ("b", "HYDAT", "upper weir"), ("c", "HYDAT", "78"), ("d", "USGS", "zzz"), ("e", "USGS", " "), ("f", "HYDAT", None)], "request string, source string, asked string")
    hit = lookup.stations_by_name(s, q, "request", "source", "asked", "native", "name", "path", "source").collect()
    assert {(r["request"], r["station_id"], r["matched_by"]) for r in hit} == {("a", 1, "id"), ("b", 1, "name")} | {(r["request"], r["station_id"], "path") for r in hit if r["request"] == "c"}
    assert {r["station_id"] for r in hit if r["request"] == "c"} <= {2}
    o = spark.createDataFrame([("u", "2020-01-01", 1.0, None), ("u", "2020-01-02", None, float("nan")), ("v", "2020-01-01", 5.0, 6.0)], "uid string, day string, q double, ssc double")
    assert [tuple(r) for r in lookup.series_of(o, "uid", ["u", None], "day", ["q", "ssc"]).collect()] == [("u", "2020-01-01", "q", 1.0)]
    assert lookup.series_of(o, "uid", o.select("uid"), "day", ["q", "ssc"], first="2020-01-02").count() == 0 and lookup.rows_of(o, "uid", []).count() == 0
    places = spark.createDataFrame([("p", 0.0, 179.999), ("q", 80.0, 0.0), ("r", None, 0.0)], "place string, la double, lo double")
    at = spark.createDataFrame([(1, 0.0, -179.999), (2, 0.0, 170.0), (3, 10.0, 10.0)], "id int, la double, lo double")
    n = lookup.nearest_stations(at, "la", "lo", "id", places, "la", "lo", "place", 2).collect()
    assert {(r["place"], r["id"], r["rank"]) for r in n} == {("p", 1, 1), ("p", 2, 2), ("q", 3, 1), ("q", 2, 2)}


def test_evidence(spark):
    cases = [("daily", "daily", "daily", None, "daily", "time_axis", False), ("daily", "monthly", "x", None, "daily", "time_axis_conflict", True), ("daily", None, "monthly", None, "monthly", "path", False), ("single_point", "climatology", None, None, "climatology", "single_point_metadata", False), ("single_point", "daily", None, None, "single_point", "single_point", False), ("irregular", "daily", None, None, "irregular", "time_axis", False), (None, "annual", None, None, "annual", "metadata", False), (None, "odd", None, None, "other", "none", False), ("daily", "monthly", None, "annual", "annual", "override", False)]
    df = spark.createDataFrame([c[:4] for c in cases], "a string, m string, p string, o string")
    got = [tuple(r) for r in df.select(arbitrated(F.col("a"), F.col("m"), F.col("p"), F.col("o")).alias("r")).select("r.*").collect()]
    assert got == [c[4:] for c in cases]
    ok = spark.createDataFrame([("x", " Daily "), ("", "junk")], "k string, v string")
    assert [tuple(r) for r in validated_overrides(ok, "k", "v").collect()] == [("x", "daily")]
    for bad in ([("x", "weekly")], [("x", "daily"), ("x", "annual")], [("x", None)]):
        with pytest.raises(ValueError):
            validated_overrides(spark.createDataFrame(bad, "k string, v string"), "k", "v")
