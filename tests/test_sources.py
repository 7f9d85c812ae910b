import datetime
import gzip
import json
import os
import sqlite3
import struct

import pytest
from pyspark.sql import functions as F

from fluvion.sources import readers, sinks


def test_series_by_aliases(spark, tmp_path):
    d = datetime.date(2020, 1, 1)
    spark.createDataFrame([(d, 1.0, -9999.0, 0, 0), (d, float("nan"), 2.0, 0, 3)], "date date, discharge double, SSC double, Q_flag int, SSC_flag int").write.parquet(str(tmp_path / "daily/A"))
    spark.createDataFrame([(d, 9.0, 9.0, 0, 0)], "date date, discharge double, SSC double, Q_flag int, SSC_flag int").write.parquet(str(tmp_path / "daily/skipped"))
    rows = readers.read_series(spark, str(tmp_path), exclude=("/skipped/",)).collect()
    assert sorted((r["q"] is None, r["q"], r["ssc"], r["ssl"], r["ssl_flag"]) for r in rows) == [(False, 1.0, None, None, 9), (True, None, None, None, 9)]


def test_csv_gz(spark, tmp_path):
    p = tmp_path / "a.csv.gz"
    with gzip.open(p, "wt") as f:
        f.write("k,v\n1,2.5\n2,\n")
    assert sorted((r["k"], r["v"]) for r in readers.read_csv(spark, str(p), "k int, v double", 2).collect()) == [(1, 2.5), (2, None)]


def dbf(rows):
    fields = [(b"COMID", 6), (b"NAME", 8)]
    size = 1 + sum(n for _, n in fields)
    head = 32 + 32 * len(fields) + 1
    out = struct.pack("<BBBBIHH20x", 3, 120, 1, 1, len(rows), head, size)
    for name, n in fields:
        out += name.ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([n]) + b"\0" * 15
    out += b"\r"
    for mark, a, b in rows:
        out += mark + a.ljust(6).encode() + b.ljust(8).encode()
    return out


def test_dbf_layers_and_config(spark, tmp_path):
    (tmp_path / "x.dbf").write_bytes(dbf([(b" ", "12", "Alpha"), (b"*", "13", "gone"), (b" ", "14", "")]))
    rows = readers.read_dbf(spark, str(tmp_path)).collect()
    assert [(r["record_no"], r["fields"]["COMID"], r["fields"]["NAME"]) for r in rows] == [(0, "12", "Alpha"), (2, "14", "")]
    db = tmp_path / "v.gpkg"
    with sqlite3.connect(db) as con:
        con.executescript("create table gpkg_contents(table_name text, data_type text); create table reaches(a); insert into reaches values (1), (2); insert into gpkg_contents values ('reaches', 'features')")
    assert readers.list_layers(str(db)) == [("reaches", "features", 2)]
    (tmp_path / "c.json").write_text(json.dumps({"a": 1}))
    assert readers.read_config(str(tmp_path / "c.json")) == {"a": 1}


def test_attributes(spark):
    df = spark.createDataFrame([("s", {"ref": "b", "x": " "}), ("s", {"ref": "a", "y": "1"}), ("t", {}), ("s", {"ref": "a"})], "k string, m map<string,string>")
    assert {r["k"]: r["m"] for r in readers.merged_attributes(df, "k", "m").collect()} == {"s": {"ref": "a | b", "y": "1"}}


def test_sinks(spark, tmp_path):
    root = str(tmp_path)
    facts = spark.createDataFrame([(1, "daily", "A"), (2, "monthly", "A")], "k int, resolution string, cluster_uid string")
    dim = spark.createDataFrame([("A", "/home/u/x.nc"), ("B", None)], "cluster_uid string, p string")
    sinks.write_star(facts, {"clusters": (dim, "cluster_uid")}, f"{root}/star")
    assert spark.read.parquet(f"{root}/star/clusters").count() == 1
    sinks.write_matrix(facts, f"{root}/matrix")
    assert sorted(x for x in os.listdir(f"{root}/matrix") if x.startswith("res")) == ["resolution=daily", "resolution=monthly"]
    sinks.write_csv(facts, f"{root}/csv", compressed=True, order=["k"])
    assert spark.read.csv(f"{root}/csv", header=True).count() == 2
    pts = spark.createDataFrame([(1, 2.0, 3.0), (2, None, 1.0)], "k int, lat double, lon double")
    (line,) = [json.loads(r["value"]) for r in sinks.geojson_points(pts, "lat", "lon", ["k"]).collect()]
    assert line == {"type": "Feature", "geometry": {"type": "Point", "coordinates": [3.0, 2.0]}, "properties": {"k": 1}}
    sinks.write_geojson(pts, f"{root}/geo", "lat", "lon", ["k"])
    assert sinks.minimal(pts, ["k", "nope"]).columns == ["k"]
    with pytest.raises(ValueError):
        sinks.minimal(pts, ["k"], ["k"])
    assert sinks.publish_names(pts, {"k": "station", "zz": "y"}).columns == ["station", "lat", "lon"]
    assert [r["p"] for r in sinks.masked_paths(dim, "p").collect()] == ["x.nc", None]
    assert sinks.inventory(spark, f"{root}/geo").filter(F.length("sha256") == 64).count() >= 1
    assert sinks.coverage_properties(pts, "lat", "lon", "k")["geospatial_lat_max"] == "2.0"
