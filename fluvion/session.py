"""Session construction and lineage cutting shared by all operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "fluvion", master: str | None = None, cores: int = 8) -> SparkSession:
    """A UTC session with AQE; on a cluster the master and memory come from spark-submit."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master).config("spark.sql.shuffle.partitions", str(cores)).config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
    return (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir); a private one only where none is set, as in tests."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if d:
        return d.rstrip("/")
    if not getattr(shared_dir, "own", None):
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared_dir.own = "file://" + tempfile.mkdtemp(prefix="fluvion-")
    return shared_dir.own


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, drop: list[str] | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts lineage without localCheckpoint: the written table survives the loss of any executor, and its
    file size gives later joins true statistics. ``drop`` are tables from earlier calls that are no longer
    needed (an iteration keeps its last state only).
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/fluvion-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for p in drop or []:
        _remove(spark, p)
    out = spark.read.schema(df.schema).parquet(path)
    out.fluvion_path = path
    atexit.register(_forget, spark, path)
    return out


def drop_tables(*tables: DataFrame) -> None:
    """Remove tables that ``materialize`` wrote and that nothing lazy refers to any more."""
    for t in tables:
        _remove(t.sparkSession, t.fluvion_path)


def _forget(spark: SparkSession, path: str) -> None:
    """Delete a table when the program ends: through the session if it is still there, else as a file of this machine."""
    try:
        if spark.sparkContext._jsc is not None:
            return _remove(spark, path)
    except Exception:  # noqa: BLE001 - the session may be gone already
        pass
    shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


def fits_broadcast(df: DataFrame, max_rows: int = 20_000) -> bool:
    """True if a frame has at most ``max_rows`` rows, found by a count that stops there."""
    return df.limit(max_rows + 1).count() <= max_rows
