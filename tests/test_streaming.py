import datetime

from fluvion.streaming import bronze

SCHEMA = "rid string, cl string, day date, score int, ingested_at timestamp"


def write(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_each_record_once(spark, tmp_path):
    t = datetime.datetime(2020, 1, 1)
    src = str(tmp_path / "in")
    write(spark, src, [("a", "c", t.date(), 1, t), ("a", "c", t.date(), 1, t + datetime.timedelta(days=2)), ("b", "c", t.date(), 2, t)])
    s = bronze.once(bronze.read_stream(spark, src, SCHEMA), "rid", "ingested_at")
    q = s.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["rid"] for r in spark.table("once").collect()) == ["a", "b"]


def test_best_rows_stay_current_over_batches(spark, tmp_path):
    t = datetime.datetime(2020, 1, 1)
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, src, [("a", "c", t.date(), 2, t), ("b", "d", t.date(), 5, t)])
    for more in ([], [("x", "c", t.date(), 1, t), ("y", "d", t.date(), 9, t)]):
        if more:
            write(spark, src, more)
        q = bronze.keep_best(bronze.read_stream(spark, src, SCHEMA), out, str(tmp_path / "ck"), ["cl", "day"], ["score", "rid"]).start()
        q.processAllAvailable()
        q.stop()
    got = {r["cl"]: r["rid"] for r in bronze.read_best(spark, out, ["cl", "day"], ["score", "rid"]).collect()}
    assert got == {"c": "x", "d": "b"}
    bronze.compact(spark, out, str(tmp_path / "whole"), ["cl", "day"], ["score", "rid"])
    assert spark.read.parquet(str(tmp_path / "whole")).count() == 2


def test_windows_close_with_the_watermark(spark, tmp_path):
    t = datetime.datetime(2020, 1, 1, 5)
    src = str(tmp_path / "in")
    write(spark, src, [("a", "c", t.date(), 1, t), ("b", "c", t.date(), 1, t), ("z", "c", t.date(), 1, t + datetime.timedelta(days=60))])
    w = bronze.windowed_counts(bronze.read_stream(spark, src, SCHEMA), "ingested_at", "cl")
    q = w.writeStream.format("memory").queryName("win").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    write(spark, src, [("y", "c", t.date(), 1, t + datetime.timedelta(days=61))])
    q.processAllAvailable()
    q.stop()
    assert [(r["cl"], r["n"]) for r in spark.table("win").collect()] == [("c", 2)]
