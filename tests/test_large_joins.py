"""Joins whose one side looks small to the optimiser and is not."""

from pyspark.sql import functions as F

from fluvion.operators.spatial import within_distance


def test_a_cover_is_never_broadcast(spark):
    # a centre is a row of a few bytes, its cover a hundred rows and more: by the centres' size the optimiser would broadcast it
    points = spark.range(40).select(F.col("id").alias("p"), (F.col("id") / 40.0).alias("a"), F.lit(0.0).alias("o"))
    near = within_distance(points, "a", "o", points.toDF("c", "b", "e"), "b", "e", 120_000.0)
    plan = near._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "_cell" in line]
    assert len(joins) == 1 and "SortMergeJoin" in joins[0]
    assert near.count() == sum(abs(i - j) / 40.0 * 111_195.08 <= 120_000.0 for i in range(40) for j in range(40))


def test_rounds_of_nearest_stations_do_not_pile_up_in_the_plan(spark):
    from fluvion.operators.lookup import nearest_stations

    stations = spark.range(3).select(F.col("id").alias("st"), F.lit(0.0).alias("a"), (F.col("id") * 0.02).alias("o"))
    places = spark.createDataFrame([("near", 0.0, 0.1), ("lonely", 10.0, 30.0), ("opposite", 0.0, -179.95)], "pl string, b double, e double").repartition("pl")
    n = nearest_stations(stations, "a", "o", "st", places, "b", "e", "pl", 2)
    assert sorted((r["pl"], r["rank"], r["st"]) for r in n.collect()) == [("lonely", 1, 2), ("lonely", 2, 1), ("near", 1, 2), ("near", 2, 1), ("opposite", 1, 0), ("opposite", 2, 1)]
    # the rounds before the last come from their tables, and so do the places that the last one is for
    plan = n._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan
