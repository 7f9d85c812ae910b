"""Views that several queries share, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvion.functions.text import canonical_uid, clean_text, cluster_number, key_text
from fluvion.sources.tables import table

VARIABLES = ("q", "ssc", "ssl")


def present(c: str, flag: str | None = None) -> Column:
    """A reading without fill and NaN, and without those flagged bad or missing."""
    gone = F.isnan(c) | (F.col(c) == -9999)
    if flag:
        gone = gone | F.coalesce(F.col(flag).isin(3, 9), F.lit(True))
    return F.when(~gone, F.col(c))


def observations(spark: SparkSession, sf: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Daily readings, each record once; a variable is null where it is missing or flagged 3 or 9.

    ``by``: keys that the query groups by next. Rows are then partitioned by them once, which serves both the removal
    of repeats (a repeated record has the same keys) and the grouping: one shuffle of the readings instead of two.
    """
    d = table(spark, sf, "daily_matrix", "record_id", "cluster_uid", "source_station_uid", "source", "obs_date", "q", "ssc", "ssl", "q_flag", "ssc_flag", "ssl_flag")
    d = d.repartition(*by).dropDuplicates([*by, "record_id"]) if by else d.dropDuplicates(["record_id"])
    return d.withColumns({v: present(v, f"{v}_flag") for v in VARIABLES})


_gone = "case when isnan({0}) or {0} = -9999 or coalesce({0}_flag, 9) in (3, 9) then null else {0} end {0}"
OBS = f"obs as (select distinct record_id, cluster_uid, source_station_uid, source, obs_date, {', '.join(_gone.format(v) for v in VARIABLES)}, q_flag, ssc_flag, ssl_flag from daily_matrix)"


def stations(spark: SparkSession, sf: str) -> DataFrame:
    """Source stations, each once, with cleaned text and positions."""
    s = table(spark, sf, "source_stations").drop("ingested_at").dropDuplicates(["station_id"])
    ok = F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180) & ~F.isnan("lat") & ~F.isnan("lon")
    return s.select("station_id", "station_key", "path", F.trim("source").alias("source"), key_text("source").alias("source_key"), key_text("resolution").alias("resolution"), F.when(ok, F.col("lat")).alias("lat"), F.when(ok, F.col("lon")).alias("lon"), clean_text("observation_type").alias("observation_type"), clean_text("station_name").alias("station_name"), clean_text("river_name").alias("river_name"), "source_station_id", F.when(F.col("reported_area") > 0, F.col("reported_area")).alias("reported_area"), clean_text("country").alias("country"))


MISSING_SQL = "('', 'nan', 'none', 'null', 'nat', 'na', 'n/a', 'n.a.', 'n.a', '<na>', 'unknown', 'unk', 'missing', 'not available', 'not known', 'undefined', '-', '--', '---', '?', '??', '.', '...', '_', 'x', '-9999', '-999', '#n/a')"


def clean_sql(c: str) -> str:
    return f"case when lower(trim({c})) in {MISSING_SQL} then null else trim({c}) end"


STATIONS = f"""st as (select distinct station_id, station_key, path, trim(source) source, lower(trim(source)) source_key, lower(trim(resolution)) resolution,
 case when lat between -90 and 90 and lon between -180 and 180 and not isnan(lat) and not isnan(lon) then lat end lat, case when lat between -90 and 90 and lon between -180 and 180 and not isnan(lat) and not isnan(lon) then lon end lon,
 {clean_sql('observation_type')} observation_type, {clean_sql('station_name')} station_name, {clean_sql('river_name')} river_name, source_station_id, case when reported_area > 0 then reported_area end reported_area, {clean_sql('country')} country from source_stations)"""


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogue rows, each once, with canonical keys and cleaned text."""
    c = table(spark, sf, "station_catalog").dropDuplicates(["catalog_row_id"])
    ok = F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180) & ~F.isnan("lat") & ~F.isnan("lon")
    text = ("pfaf_code", "station_name", "river_name", "source_station_id", "sources_used", "country", "continent_region", "basin_status", "basin_match_quality")
    return c.select("catalog_row_id", canonical_uid(F.col("cluster_uid"), F.col("cluster_id")).alias("cluster_uid"), cluster_number(F.col("cluster_uid"), F.col("cluster_id")).alias("cluster_id"), F.when(ok, F.col("lat")).alias("lat"), F.when(ok, F.col("lon")).alias("lon"), F.when(F.col("basin_area") > 0, F.col("basin_area")).alias("basin_area"), *[clean_text(t).alias(t) for t in text], F.when(F.col("n_source_stations_in_cluster") > 0, F.col("n_source_stations_in_cluster").cast("int")).alias("n_source_stations_in_cluster"), key_text("export_tier").alias("export_tier"), "exported_at")


_cid = "coalesce(cast(cluster_id as bigint), try_cast(regexp_extract(upper(trim(cluster_uid)), '([0-9]+)$', 1) as bigint))"
CATALOG = f"""cat as (select distinct catalog_row_id, 'SED' || lpad(cast({_cid} as varchar), 6, '0') cluster_uid, {_cid} cluster_id,
 case when lat between -90 and 90 and lon between -180 and 180 and not isnan(lat) and not isnan(lon) then lat end lat, case when lat between -90 and 90 and lon between -180 and 180 and not isnan(lat) and not isnan(lon) then lon end lon, case when basin_area > 0 then basin_area end basin_area,
 {', '.join(clean_sql(t) + ' ' + t for t in ('pfaf_code', 'station_name', 'river_name', 'source_station_id', 'sources_used', 'country', 'continent_region', 'basin_status', 'basin_match_quality'))},
 case when n_source_stations_in_cluster > 0 then cast(n_source_stations_in_cluster as int) end n_source_stations_in_cluster, lower(trim(export_tier)) export_tier, exported_at from station_catalog)"""


def paired(spark: SparkSession, sf: str) -> DataFrame:
    """Same-day satellite and in-situ concentrations of a cluster (each record once), with their sources."""
    usable = lambda v: F.col(v).isNotNull() & ~F.isnan(v) & (F.col(v) >= 0) & ~F.coalesce(F.col("ssc_flag").isin(3, 9), F.lit(False))
    s = table(spark, sf, "satellite_obs", "satellite_record_id", "cluster_uid", "source", "satellite_time", "satellite_ssc", "ssc_flag").filter(usable("satellite_ssc")).dropDuplicates(["satellite_record_id"])
    i = table(spark, sf, "insitu_obs", "insitu_record_id", "cluster_uid", "source", "insitu_time", "insitu_ssc", "ssc_flag").filter(usable("insitu_ssc")).dropDuplicates(["insitu_record_id"])
    s = s.select("satellite_record_id", F.upper(F.trim("cluster_uid")).alias("cluster_uid"), F.trim("source").alias("satellite_source"), F.to_date("satellite_time").alias("day"), F.col("satellite_ssc").alias("x"))
    i = i.select("insitu_record_id", F.upper(F.trim("cluster_uid")).alias("cluster_uid"), F.trim("source").alias("insitu_source"), F.to_date("insitu_time").alias("day"), F.col("insitu_ssc").alias("y"))
    return s.join(i, ["cluster_uid", "day"])


_ok = "{0} >= 0 and not isnan({0}) and coalesce(ssc_flag, 0) not in (3, 9)"
PAIRED = f"""s as (select distinct satellite_record_id, upper(trim(cluster_uid)) cluster_uid, trim(source) satellite_source, cast(satellite_time as date) as day, satellite_ssc x from satellite_obs where {_ok.format('satellite_ssc')}),
i as (select distinct insitu_record_id, upper(trim(cluster_uid)) cluster_uid, trim(source) insitu_source, cast(insitu_time as date) as day, insitu_ssc y from insitu_obs where {_ok.format('insitu_ssc')}),
pr as (select s.cluster_uid, s.day, satellite_record_id, satellite_source, x, insitu_record_id, insitu_source, y from s join i on s.cluster_uid = i.cluster_uid and s.day = i.day)"""
