"""Error metrics of groups in which nothing varies."""

from fluvion.operators.metrics import error_metrics_by


def test_a_group_without_variation_has_no_correlation(spark):
    rows = [("x", 1.1, 2.0), ("x", 1.1, 3.0), ("x", 1.1, 5.0), ("y", 1.0, 0.7), ("y", 2.0, 0.7), ("both", 0.1, 0.1), ("both", 0.1, 0.1), ("one", 1.0, 2.0), ("line", 1.0, 2.0), ("line", 2.0, 4.0), ("line", 4.0, 8.0), ("gap", 1.0, None), ("gap", 2.0, 3.0), ("gap", 2.0, 4.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double").repartition(5)
    got = {r["k"]: (r["n"], r["r"], r["r2"], r["median_ae"]) for r in error_metrics_by(df, ["k"], "x", "y", 5).collect()}
    assert got["x"] == (3, None, None, 1.9) and got["y"] == (2, None, None, 0.8) and got["both"] == (2, None, None, 0.0) and got["one"] == (1, None, None, 1.0)
    assert got["line"] == (3, 1.0, 1.0, 2.0) and got["gap"][1] is None


def test_levels_with_constant_pairs_give_the_rows_of_their_sql(spark, tmp_path):
    import os
    import sys

    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from compare import connect, same
    from fluvion.plans import registry, release  # noqa: F401 - the module registers its queries

    def write(name, side, values):
        rows = [(f"{side}{i}", c, " A ", f"2020-01-0{d} 10:00:00", v) for i, (c, d, v) in enumerate(values)]
        df = spark.createDataFrame(rows, f"{side}_record_id string, cluster_uid string, source string, t string, {side}_ssc double")
        df = df.selectExpr(f"{side}_record_id", "cluster_uid", "source", f"cast(t as timestamp) {side}_time", f"{side}_ssc", "cast(null as int) ssc_flag")
        df.toPandas().to_parquet(f"{tmp_path}/{name}.parquet", coerce_timestamps="us")

    write("satellite_obs", "satellite", [("SED000001", 1, 5.5), ("SED000001", 2, 5.5), ("SED000001", 3, 5.5), ("SED000002", 1, 1.0), ("SED000002", 2, 2.0)])
    write("insitu_obs", "insitu", [("SED000001", 1, 1.0), ("SED000001", 2, 2.0), ("SED000001", 3, 4.0), ("SED000002", 1, 3.0), ("SED000002", 2, 7.0)])
    for name in ("metrics_three_levels", "metrics_four_scopes"):
        same(registry.QUERIES[name](spark, str(tmp_path)), connect(str(tmp_path)), registry.ORACLE[name])
