"""Publishing: star schema, long matrix, delimited text, GeoJSON, minimal package, inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_star(facts: DataFrame, dims: dict[str, tuple[DataFrame, str]], root: str) -> None:
    """Facts and the rows of each dimension that the facts refer to. ``dims``: name -> (frame, key also in facts)."""
    facts.write.mode("overwrite").parquet(f"{root}/facts")
    for name, (dim, key) in dims.items():
        active = dim.join(facts.select(key), key, "left_semi")
        active.write.mode("overwrite").parquet(f"{root}/{name}")


def write_matrix(long: DataFrame, root: str, resolution: str = "resolution", cluster: str = "cluster_uid") -> None:
    """The matrix product in long form, a folder a resolution, clusters together within files (row groups then prune by key)."""
    long.repartitionByRange(resolution, cluster).sortWithinPartitions(resolution, cluster).write.mode("overwrite").partitionBy(resolution).parquet(root)


def write_csv(df: DataFrame, path: str, compressed: bool = False, order: list[str] | None = None) -> None:
    """Delimited text with a header; in order over all parts if ``order`` is given."""
    out = df.orderBy(*order) if order else df
    out.write.mode("overwrite").option("header", "true").option("compression", "gzip" if compressed else "none").csv(path)


def geojson_points(df: DataFrame, lat: str, lon: str, properties: list[str]) -> DataFrame:
    """One GeoJSON feature a row (column ``value``); rows without position are left out."""
    geometry = F.struct(F.lit("Point").alias("type"), F.array(F.col(lon), F.col(lat)).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties"))
    return df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.to_json(feature).alias("value"))


def write_geojson(df: DataFrame, path: str, lat: str, lon: str, properties: list[str]) -> None:
    """Line-delimited GeoJSON."""
    geojson_points(df, lat, lon, properties).write.mode("overwrite").text(path)


def minimal(df: DataFrame, keep: list[str], forbidden: list[str] = ()) -> DataFrame:
    """The columns of the minimal package that the frame has; raises if one of them is forbidden."""
    bad = sorted(set(keep) & set(forbidden))
    if bad:
        raise ValueError("forbidden columns: " + ", ".join(bad))
    return df.select(*[F.col(f"`{c}`") for c in keep if c in df.columns])


def publish_names(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns under their public names; names the frame lacks are ignored."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def masked_paths(df: DataFrame, *columns: str) -> DataFrame:
    """Absolute local paths in text replaced by their last part."""
    return df.withColumns({c: F.regexp_replace(c, r"(?:/[\w.-]+){2,}/([\w.-]+)", "$1") for c in columns})


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root``: name, size and SHA-256, hashed by the tasks that read them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)

    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def coverage_properties(df: DataFrame, lat: str, lon: str, day: str) -> dict[str, str]:
    """Discovery metadata of a product (one row of extremes)."""
    r = df.agg(F.min(lat), F.max(lat), F.min(lon), F.max(lon), F.min(day), F.max(day)).first()
    names = ("geospatial_lat_min", "geospatial_lat_max", "geospatial_lon_min", "geospatial_lon_max", "time_coverage_start", "time_coverage_end")
    return {n: str(v) for n, v in zip(names, r) if v is not None}
