"""Rules of the domain against their fixtures."""

import datetime

import pytest
from pyspark.sql import functions as F

from fluvion.functions import domain as D
from fluvion.functions.text import canonical_uid, clean_text, cluster_number
from fluvion.operators import checks
from fluvion.operators.merge import best_rows_per_day, publishable
from fluvion.operators.metrics import error_metrics
from fluvion.operators.ordering import global_number, hash_sample
from fluvion.operators.pairing import nearest_by_day, ranked_with_gap


def test_basin_policy(spark):
    rows = [
        (12345, "distance_only", 250.0, "USGS", False, False, "resolved", "ok"), (12345, "distance_only", 2000.0, "GSED", True, True, "unresolved", "large_offset"), (12345, "distance_only", 750.0, "RiverSed", True, True, "resolved", "ok"),
        (12345, "distance_only", 2000.0, "RiverSed", True, True, "unresolved", "large_offset"), (12345, "distance_only", 2000.0, "GSED", False, True, "unresolved", "large_offset"), (12345, "distance_only", 2000.0, "USGS", True, True, "unresolved", "large_offset"),
        (None, "distance_only", 2000.0, "GSED", True, True, "unresolved", "no_match"), (12345, "failed", 2000.0, "GSED", True, True, "unresolved", "no_match"), (1, "area_mismatch", 10.0, "USGS", True, True, "unresolved", "area_mismatch"),
        (1, "area_matched", 900.0, "USGS", None, None, "resolved", "ok"), (1, None, None, None, None, None, "unresolved", "geometry_inconsistent"),
    ]
    df = spark.createDataFrame(rows, "b bigint, q string, d double, s string, l boolean, i boolean, status string, flag string")
    c = F.col
    for r in df.select("*", D.basin_result(c("b"), c("q"), c("d"), c("s"), c("l"), c("i")).alias("r")).collect():
        assert (r["r"]["basin_status"], r["r"]["basin_flag"]) == (r["status"], r["flag"]), r


@pytest.mark.parametrize(
    "source,resolution,kind,family",
    [("RiverSed (USA)", "daily", None, "satellite"), ("Ali & De Boer", None, None, "climatology"), ("Yellow River", "climatology", None, "climatology"), ("Huanghe", "monthly", None, "in_situ"), (" USGS ", None, None, "in_situ"), ("Nobody", None, "Remote sensing", "satellite"), ("Nobody", None, "In-situ station data", "in_situ"), (None, None, None, "other"), ("compiled", None, None, "secondary_compilation")],
)
def test_source_family(spark, source, resolution, kind, family):
    df = spark.createDataFrame([(source, resolution, kind)], "s string, r string, k string")
    assert df.select(D.source_family(F.col("s"), F.col("r"), F.col("k"))).first()[0] == family


def test_frequency_limits(spark):
    cases = [(1.9, 5, "hourly"), (2.0, 5, "daily"), (36.0, 5, "monthly"), (1080.0, 5, "quarterly"), (2880.0, 5, "annual"), (12000.0, 5, "irregular"), (None, 1, "single_point")]
    df = spark.createDataFrame(cases, "h double, n int, f string")
    assert all(r[0] == r[1] for r in df.select(D.frequency(F.col("h"), F.col("n")), "f").collect())


def test_cleaning_of_keys_and_text(spark):
    df = spark.createDataFrame([(" sed121 ", None), ("SED000121", 5), (None, 7), ("x", None), ("SED1234567", None), (None, -1)], "u string, n bigint")
    got = [(r[0], r[1]) for r in df.select(canonical_uid(F.col("u"), F.col("n")), cluster_number(F.col("u"), F.col("n"))).collect()]
    assert got == [("SED000121", 121), ("SED000005", 5), ("SED000007", 7), (None, None), ("SED1234567", 1234567), (None, None)]
    t = spark.createDataFrame([(x,) for x in (" a ", "", " ", "NaN", "N/A", "-", " b ", None, "nano")], "t string")
    assert [r[0] for r in t.select(clean_text("t")).collect()] == ["a", None, None, None, None, None, "b", None, "nano"]


def test_publishable_rows_and_rank(spark):
    d = [datetime.date(2020, 1, k) for k in (1, 2)]
    rows = [(1, "c", "q_only", d[0], 10.0, None, None, 0, 9, 9), (2, "c", "sediment", d[0], 8.0, None, 100.0, 1, 9, 1), (3, "c", "sediment", d[1], 9.0, 5.0, None, 0, 0, 9), (4, "c", "other", d[1], 9.0, 6.0, None, 2, 2, 9), (5, None, "x", d[0], None, 1.0, None, 9, 0, 9)]
    df = spark.createDataFrame(rows, "rid int, cl string, src string, day date, q double, ssc double, ssl double, q_flag int, ssc_flag int, ssl_flag int")
    assert publishable(df).count() == 4
    got = {r["day"].day: (r["rid"], r["is_overlap"]) for r in best_rows_per_day(df.filter("cl is not null"), "cl", "src", "day", "rid").collect()}
    assert got == {1: (2, False), 2: (3, True)}
    assert best_rows_per_day(df.limit(0), "cl", "src", "day", "rid").count() == 0


def test_nearest_by_day(spark):
    d = lambda k: datetime.date(2020, 1, k)
    s = spark.createDataFrame([("sat", "C1", d(2)), ("lone", "C2", d(2)), ("nokey", None, d(2))], "sid string, c string, sd date")
    i = spark.createDataFrame([("good", "C1", d(2), 1), ("next", "C1", d(3), 0), ("far", "C1", d(9), 0)], "iid string, c string, d date, f int")
    got = [(r["window"], r["iid"], r["delta_days"]) for r in nearest_by_day(s, i, ["c"], "sd", "d", "sid", [F.col("f"), F.col("iid")], {"exact": 0, "pm1d": 1, "pm2d": 2}).orderBy("window").collect()]
    assert got == [("exact", "good", 0), ("pm1d", "good", 0), ("pm2d", "good", 0)]


def test_ambiguity(spark):
    df = spark.createDataFrame([("u", 1, 50.0), ("g", 1, 50.0), ("g", 2, 200.0), ("r", 1, 10.0), ("r", 2, 16.0), ("a", 1, 500.0), ("a", 2, 550.0)], "k string, c int, d double")
    got = {r["k"]: r["decision"] for r in ranked_with_gap(df, "k", "d", [F.col("d"), F.col("c")], 100.0, 1.5).filter("rank = 1").collect()}
    assert got == {"u": "unique", "g": "clear", "r": "clear", "a": "ambiguous"}


def test_metrics_leave_zero_references_out_of_mape(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 1.0), (4.0, 2.0)], "x double, y double")
    r = df.agg(*error_metrics("x", "y")).first()
    assert (r["n"], r["mape"]) == (3, 100.0) and r["r2"] == pytest.approx(r["r"] ** 2, abs=1e-5)
    assert df.filter("false").agg(*error_metrics("x", "y")).first()["bias"] is None


def test_numbers_and_samples(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    got = {r["v"]: r["n"] for r in global_number(df, [F.col("v")], "n").collect()}
    assert got == {v: v for v in range(1000)}
    a = sorted(r[0] for r in hash_sample(df, "v", 10).collect())
    assert a == sorted(r[0] for r in hash_sample(df.repartition(7), "v", 10).collect()) and 50 < len(a) < 160


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k int, v string")
    got = {r["check"]: (r["status"], r["details"]) for r in checks.together(checks.counted(df, {"v": F.col("v").isNull()}), checks.unique(df, "k", "k"), checks.contained(df, df, "self", "k")).collect()}
    assert got == {"v": ("fail", 1), "k": ("fail", 1), "self": ("pass", 0)}
    with pytest.raises(ValueError):
        checks.require(checks.unique(df, "k", "k"))


def test_distances_to_lines(spark):
    from fluvion.functions.geo import polyline_distance_m, segment_distance_m

    r = 6371008.8
    df = spark.createDataFrame([([(0.0, 1.0), (0.0, 3.0)],), ([(0.0, 1.0)],), ([],), (None,)], "line array<struct<lat: double, lon: double>>")
    got = [x[0] for x in df.select(polyline_distance_m(F.lit(0.01), F.lit(2.0), F.col("line"))).collect()]
    import math

    assert got[0] == pytest.approx(math.radians(0.01) * r, rel=1e-6) and got[1] == pytest.approx(math.hypot(math.radians(1) * r, math.radians(0.01) * r), rel=1e-3) and got[2:] == [None, None]
    one = spark.range(1).select(segment_distance_m(0.0, 0.0, 0.0, 1.0, 0.0, 2.0).alias("d"), segment_distance_m(0.0, 0.0, 0.0, 1.0, 0.0, 1.0).alias("e")).first()
    assert one["d"] == pytest.approx(math.radians(1) * r) and one["e"] == pytest.approx(math.radians(1) * r)


def test_text_similarity_and_decomposition(spark):
    from fluvion.functions.text import sequence_ratio, strip_marks

    df = spark.createDataFrame([("Östjö", "ostjo"), (None, "x"), ("", "")], "a string, b string")
    rows = df.select(strip_marks(F.col("a")).alias("m"), sequence_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [x["m"] for x in rows] == ["ostjo", None, ""] and rows[1]["r"] is None and rows[2]["r"] == 1.0


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    from fluvion import session

    assert session.shared_dir(spark)

    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "yarn"

            @staticmethod
            def getConf():
                return Conf()

    monkeypatch.delattr(session.shared_dir, "own", raising=False)
    with pytest.raises(ValueError):
        session.shared_dir(Cluster())
