"""Scans beyond parquet: series files, delimited text, vector attribute files, layered databases, configuration.

Every reader has an explicit schema; nothing is inferred by reading data twice. Binary formats are read by tasks, one file a
row, never on the driver.
"""

from __future__ import annotations

import json
import sqlite3
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Names under which series files carry the variables.
ALIASES = {"time": ("time", "date", "datetime"), "q": ("Q", "discharge", "q"), "ssc": ("SSC", "ssc", "suspended_sediment_concentration"), "ssl": ("SSL", "ssl", "sediment_load"), "q_flag": ("Q_flag", "q_flag"), "ssc_flag": ("SSC_flag", "ssc_flag"), "ssl_flag": ("SSL_flag", "ssl_flag")}
SERIES_SCHEMA = "path string, obs_date date, q double, ssc double, ssl double, q_flag int, ssc_flag int, ssl_flag int"


def resolve_aliases(df: DataFrame, canonical: str, names: tuple[str, ...]) -> Column:
    """The first of ``names`` that the frame has and that is not null; null where it has none."""
    have = [n for n in names if n in df.columns]
    return F.coalesce(*[F.col(f"`{n}`") for n in have]).alias(canonical) if have else F.lit(None).alias(canonical)


def read_series(spark: SparkSession, root: str, fmt: str = "parquet", exclude: tuple[str, ...] = ()) -> DataFrame:
    """Series files below ``root`` with the columns of any alias, as canonical rows. ``exclude``: path parts to leave out.

    Fill values and NaN become null, a missing flag 9, and a reading flagged 3 or 9 null. ``fmt`` netcdf needs the
    netCDF4 package on the workers.
    """
    if fmt == "netcdf":
        return _clean(read_netcdf(spark, root, exclude))
    raw = spark.read.option("recursiveFileLookup", "true").format(fmt).load(root).withColumn("path", F.col("_metadata.file_path"))
    for part in exclude:
        raw = raw.filter(~F.col("path").contains(part))
    cols = [F.col("path"), resolve_aliases(raw, "obs_date", (*ALIASES["time"], "obs_date")).cast("date").alias("obs_date")]
    cols += [resolve_aliases(raw, v, ALIASES[v]).cast("double").alias(v) for v in ("q", "ssc", "ssl")]
    cols += [resolve_aliases(raw, f, ALIASES[f]).cast("int").alias(f) for f in ("q_flag", "ssc_flag", "ssl_flag")]
    return _clean(raw.select(*cols))


def _clean(df: DataFrame) -> DataFrame:
    for v in ("q", "ssc", "ssl"):
        f = F.when(F.col(f"{v}_flag").isNull() | (F.col(f"{v}_flag") == -127), 9).otherwise(F.col(f"{v}_flag"))
        gone = F.isnan(v) | (F.abs(F.col(v) + 9999) < 1e-5) | f.isin(3, 9)
        df = df.withColumn(f"{v}_flag", f).withColumn(v, F.when(~F.coalesce(gone, F.lit(True)), F.col(v)))
    return df


def read_netcdf(spark: SparkSession, root: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Rows of NetCDF series files, a file a row of work. The package is looked for on the workers, where it is needed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.nc").load(root).select("path", "content")
    for part in exclude:
        files = files.filter(~F.col("path").contains(part))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import netCDF4  # noqa: PLC0415 - optional

        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                with netCDF4.Dataset("memory", memory=bytes(content)) as ds:
                    names = {k: next((n for n in v if n in ds.variables), None) for k, v in ALIASES.items()}
                    if names["time"] is None:
                        continue
                    t = ds.variables[names["time"]]
                    days = [d.date() if hasattr(d, "date") else None for d in netCDF4.num2date(t[:], t.units, only_use_cftime_datetimes=False)]
                    out = pd.DataFrame({"path": path, "obs_date": days})
                    for k in ("q", "ssc", "ssl", "q_flag", "ssc_flag", "ssl_flag"):
                        x = ds.variables[names[k]][:] if names[k] else None
                        out[k] = pd.Series(x.filled(float("nan")) if hasattr(x, "filled") else x).reindex(range(len(out))) if x is not None else None
                    for k in ("q_flag", "ssc_flag", "ssl_flag"):
                        out[k] = out[k].astype("Int32")
                    yield out

    return files.mapInPandas(read, SERIES_SCHEMA)


def read_csv(spark: SparkSession, path: str, schema: str, partitions: int | None = None) -> DataFrame:
    """Delimited text with a header and a given schema. A gzip file cannot be split: ``partitions`` spreads its rows."""
    df = spark.read.csv(path, schema=schema, header=True, mode="PERMISSIVE", nanValue="NaN", nullValue="")
    return df.repartition(partitions) if partitions else df


def read_dbf(spark: SparkSession, path: str) -> DataFrame:
    """Attribute records of dBase files (the .dbf of vector layers): path, record_no and a map of field to text."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.dbf").load(path).select("path", "content")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, b in zip(pdf["path"], pdf["content"]):
                yield pd.DataFrame(list(dbf_records(p, bytes(b))), columns=["path", "record_no", "fields"])

    return files.mapInPandas(read, "path string, record_no int, fields map<string,string>")


def dbf_records(path: str, data: bytes) -> Iterator[tuple[str, int, dict[str, str]]]:
    """The records of one dBase file that are not marked deleted."""
    n, head, size = struct.unpack_from("<IHH", data, 4)
    fields, at = [], 32
    while data[at] != 0x0D:
        name, length = data[at : at + 11].split(b"\0")[0].decode("latin-1"), data[at + 16]
        fields.append((name, length))
        at += 32
    for k in range(n):
        row = data[head + k * size : head + (k + 1) * size]
        if row[:1] == b"*":
            continue
        out, at = {}, 1
        for name, length in fields:
            out[name] = row[at : at + length].decode("utf-8", errors="replace").strip()
            at += length
        yield path, k, out


def list_layers(path: str) -> list[tuple[str, str, int]]:
    """(table, kind, rows) of each layer of a layered SQLite vector file (a handful of layers, read on the driver)."""
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as con:
        layers = con.execute("select table_name, data_type from gpkg_contents order by table_name").fetchall()
        return [(t, k, con.execute(f'select count(*) from "{t}"').fetchone()[0]) for t, k in layers]


def read_excel(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """A sheet of a workbook, all columns as text; workbooks are small tables of configuration. Needs openpyxl."""
    pdf = pd.read_excel(path, sheet_name=sheet, dtype=str)
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None))


def read_config(path: str) -> dict:
    """A JSON or (if the package is there) YAML file of settings."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        return json.loads(text)
    import yaml  # noqa: PLC0415 - optional

    return yaml.safe_load(text)


def merged_attributes(df: DataFrame, key: str, attributes: str) -> DataFrame:
    """One map a key from the maps of its files: each attribute's distinct values, sorted and joined by ' | '. Blank values are left out."""
    kv = df.select(F.col(key).alias("_key"), F.explode(attributes).alias("_k", "_v")).withColumn("_v", F.trim("_v")).filter("_v is not null and _v <> '' and lower(_v) not in ('nan', 'none')")
    # distinct values first: a key with very many files then gathers values, not files
    kv = kv.distinct().groupBy("_key", "_k").agg(F.array_join(F.sort_array(F.collect_set("_v")), " | ").alias("_v"))
    return kv.groupBy(F.col("_key").alias(key)).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("_k", "_v")))).alias(attributes))
