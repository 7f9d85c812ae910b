"""Queries over positions keep every usable one: both longitude conventions, the antimeridian, high latitudes."""

import pytest

from fluvion.plans import extras, joins

LINKS = "satellite_station_id long, satellite_uparea_merit double, satellite_lat double, satellite_lon double, linked_lat double, linked_lon double"


def catalogue(spark, data, folder, rows):
    """The catalogue with ``rows`` (cluster_id, lat, lon) in place of its own."""
    c = spark.read.parquet(f"{data}/station_catalog.parquet")
    own = spark.createDataFrame([(i, f"SED{k:06d}", k, la, lo, 100.0) for i, (k, la, lo) in enumerate(rows)], "catalog_row_id long, cluster_uid string, cluster_id long, lat double, lon double, basin_area double")
    c.limit(0).unionByName(own, allowMissingColumns=True).select(c.columns).write.parquet(f"{folder}/station_catalog.parquet")


def test_satellite_stations_of_both_conventions_are_linked(spark, data, tmp_path):
    catalogue(spark, data, tmp_path, [(1, 10.0, -100.0), (2, 10.0, 179.999), (3, 20.0, 30.0), (3, 20.001, 29.0), (4, 5.0, 7.0)])
    # 260 is -100; -179.999 lies beyond the antimeridian of 179.999; cluster 3 stands at one of its rows, not between them
    rows = [(1, 100.0, 10.0, 260.0, None, None), (2, 100.0, 10.0, -179.999, None, None), (3, 100.0, 20.0, 30.0, None, None), (4, 100.0, 5.0, 7.0, None, None), (5, 100.0, 5.0, 361.0, None, None)]
    spark.createDataFrame(rows, LINKS).write.parquet(f"{tmp_path}/satellite_links.parquet")
    got = {r["satellite_station_id"]: (r["cluster_uid"], r["distance_m"], r["decision"]) for r in joins.satellite_link(spark, str(tmp_path)).collect()}
    assert got == {1: ("SED000001", 0.0, "linked"), 2: ("SED000002", pytest.approx(219.0, abs=0.1), "linked"), 3: ("SED000003", 0.0, "linked"), 4: ("SED000004", 0.0, "linked")}


@pytest.mark.parametrize("name", ["nearest_reach", "match_select_ambiguity"])
def test_clusters_near_the_antimeridian_are_found(spark, data, tmp_path, name):
    catalogue(spark, data, tmp_path, [(1, 10.0, 179.999), (2, 20.0, 30.0)])
    s = spark.read.parquet(f"{data}/source_stations.parquet")
    own = spark.createDataFrame([(1, 10.0, -179.999), (2, 20.0, 30.0)], "station_id long, lat double, lon double")
    s.limit(0).unionByName(own, allowMissingColumns=True).select(s.columns).write.parquet(f"{tmp_path}/source_stations.parquet")
    got = {r["station_id"]: (r["cluster_uid"], r["distance_m"]) for r in getattr(joins, name)(spark, str(tmp_path)).collect()}
    assert got == {1: ("SED000001", pytest.approx(219.0, abs=0.1)), 2: ("SED000002", 0.0)}


@pytest.mark.parametrize("name", ["point_line_distance", "polyline_distance"])
def test_distances_to_lines_in_both_conventions(spark, tmp_path, name):
    # each pair is that of station 1, moved around the globe or written in the other convention; 7 and 8 have no usable position
    rows = [(1, 0.0, 10.0, 50.0, 10.01, 50.0), (2, 0.0, 10.0, 300.0, 10.01, -60.0), (3, 0.0, 10.0, 310.0, 10.01, 310.0), (4, 0.0, 10.0, 179.999, 10.01, -180.001 + 360), (5, 0.0, 10.0, -179.995, 10.01, 180.005), (6, 0.0, 85.0, 10.0, 85.01, 10.0), (7, 0.0, 91.0, 10.0, 10.0, 10.0), (8, 0.0, 10.0, 10.0, None, 10.0)]
    spark.createDataFrame(rows, LINKS).write.parquet(f"{tmp_path}/satellite_links.parquet")
    got = {r["satellite_station_id"]: r["distance_m"] for r in getattr(extras, name)(spark, str(tmp_path)).collect()}
    assert got == {k: pytest.approx(1111.951, abs=0.01) for k in range(1, 7)}
