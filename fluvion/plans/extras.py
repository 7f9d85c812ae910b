"""Remaining operators: distances to lines, text similarity, subsets, projections of sweeps, provenance, sampled audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvion.functions.geo import polyline_distance_m, segment_distance_m, valid_position, wrap_lon
from fluvion.functions.text import sequence_ratio, strip_marks
from fluvion.operators.merge import best_rows_per_day
from fluvion.operators.ordering import hash_sample
from fluvion.plans.aggregates import _RK
from fluvion.plans.common import CATALOG, OBS, STATIONS, catalog, observations, stations
from fluvion.plans.registry import query
from fluvion.sources.tables import table

S = SparkSession
_POS = "{0}_lat between -90 and 90 and {0}_lon between -180 and 360 and not isnan({0}_lat) and not isnan({0}_lon)"
_WRAP = "case when {0}_lon >= 180 then {0}_lon - 360 else {0}_lon end"
_LINKED = f"l as (select distinct satellite_station_id s, satellite_lat a, {_WRAP.format('satellite')} o, linked_lat a1, {_WRAP.format('linked')} o1 from satellite_links where {_POS.format('satellite')} and {_POS.format('linked')}), w as (select *, (o1 - o) - 360 * round((o1 - o) / 360) turn from l)"
_R = "6371008.8"


def _linked_positions(spark: S, sf: str) -> DataFrame:
    """Satellite stations and the positions linked to them, each once, where both are usable; longitudes in [-180, 180)."""
    l = table(spark, sf, "satellite_links", "satellite_station_id", "satellite_lat", "satellite_lon", "linked_lat", "linked_lon")
    for side in ("satellite", "linked"):
        l = l.filter(valid_position(F.col(f"{side}_lat"), F.col(f"{side}_lon"))).withColumn(f"{side}_lon", wrap_lon(F.col(f"{side}_lon")))
    return l.distinct()


@query(f"""with {_LINKED},
p as (select *, radians(turn) * cos(radians(a)) * {_R} x1, radians(a1 - a) * {_R} y1, radians(turn + 0.01) * cos(radians(a)) * {_R} x2, radians(a1 + 0.01 - a) * {_R} y2 from w),
t as (select *, least(1.0, greatest(0.0, -(x1 * (x2 - x1) + y1 * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2)))) t from p)
select s as satellite_station_id, a1 as linked_lat, o1 as linked_lon, round(sqrt(pow(x1 + t * (x2 - x1), 2) + pow(y1 + t * (y2 - y1), 2)), 3) as distance_m from t""")
def point_line_distance(spark: S, sf: str) -> DataFrame:
    """Distance of each satellite position to a reach that begins at the linked one."""
    l = _linked_positions(spark, sf)
    c = F.col
    d = segment_distance_m(c("satellite_lat"), c("satellite_lon"), c("linked_lat"), c("linked_lon"), c("linked_lat") + 0.01, c("linked_lon") + 0.01)
    return l.select("satellite_station_id", "linked_lat", "linked_lon", F.round(d, 3).alias("distance_m"))


def _segment_sql(k: int) -> str:
    """Distance to the part of the line between its points k and k + 1."""
    at = [(f"(radians(turn + {0.02 * i * i}) * cos(radians(a)) * {_R})", f"(radians(a1 + {0.01 * i} - a) * {_R})") for i in (k, k + 1)]
    (x1, y1), (x2, y2) = at
    t = f"least(1.0, greatest(0.0, -({x1} * ({x2} - {x1}) + {y1} * ({y2} - {y1})) / (pow({x2} - {x1}, 2) + pow({y2} - {y1}, 2))))"
    return f"sqrt(pow({x1} + {t} * ({x2} - {x1}), 2) + pow({y1} + {t} * ({y2} - {y1}), 2))"


@query(f"with {_LINKED} select s as satellite_station_id, round(least({_segment_sql(0)}, {_segment_sql(1)}), 3) as distance_m from w")
def polyline_distance(spark: S, sf: str) -> DataFrame:
    """The same for a line of three points."""
    l = _linked_positions(spark, sf)
    at = lambda k: F.struct((F.col("linked_lat") + 0.01 * k).alias("lat"), (F.col("linked_lon") + 0.02 * k * k).alias("lon"))
    return l.select("satellite_station_id", F.round(polyline_distance_m(F.col("satellite_lat"), F.col("satellite_lon"), F.array(at(0), at(1), at(2))), 3).alias("distance_m"))


@query(None)
def name_sequence_ratio(spark: S, sf: str) -> DataFrame:
    """Similarity of a station's and its river's name by matching blocks, after decomposition."""
    s = stations(spark, sf).filter("station_name is not null and river_name is not null").select("station_id", strip_marks(F.col("station_name")).alias("a"), strip_marks(F.col("river_name")).alias("b"))
    return s.select("station_id", F.round(sequence_ratio(F.col("a"), F.col("b")), 6).alias("ratio"))


@query("select trim(s.source) as source, count(distinct satellite_record_id) as n from satellite_obs s where lower(trim(s.source)) in ('riverlume', 'reacheye') and exists (select 1 from satellite_links l where lower(trim(l.satellite_source)) = lower(trim(s.source)) and lower(trim(l.satellite_resolution)) = 'monthly') group by 1")
def satellite_subset(spark: S, sf: str) -> DataFrame:
    """Records of two sources that have monthly stations: a subset by source alias and resolution."""
    names = ("riverlume", "reacheye")
    l = table(spark, sf, "satellite_links", "satellite_source", "satellite_resolution").filter(F.lower(F.trim("satellite_resolution")) == "monthly").select(F.lower(F.trim("satellite_source")).alias("k"))
    s = table(spark, sf, "satellite_obs", "satellite_record_id", "source").withColumn("k", F.lower(F.trim("source"))).filter(F.col("k").isin(*names))
    return s.join(l, "k", "left_semi").groupBy(F.trim("source").alias("source")).agg(F.countDistinct("satellite_record_id").alias("n"))


@query(f"with {OBS}, c as (select cluster_uid, count(*) n from obs where ssc is not null group by 1), l as (select distinct 'SED' || lpad(cast(linked_cluster_id as varchar), 6, '0') u, representative_point_distance_m d from satellite_links where linked_cluster_id is not null), t as (select * from (values (500), (1000), (5000)) v(threshold)) select threshold, count(distinct cluster_uid) as n_clusters from c, t where exists (select 1 from l where l.u = c.cluster_uid and l.d <= t.threshold) group by 1")
def sweep_release_projection(spark: S, sf: str) -> DataFrame:
    """Published clusters that keep a satellite link at each threshold."""
    c = observations(spark, sf).filter("ssc is not null").select("cluster_uid").distinct()
    l = table(spark, sf, "satellite_links", "linked_cluster_id", "representative_point_distance_m").filter("linked_cluster_id is not null")
    n = F.col("linked_cluster_id").cast("string")
    near = l.groupBy(F.concat(F.lit("SED"), F.when(F.length(n) < 6, F.lpad(n, 6, "0")).otherwise(n)).alias("cluster_uid")).agg(F.min("representative_point_distance_m").alias("d"))
    levels = (500, 1000, 5000)
    g = c.join(near, "cluster_uid").agg(*[F.count_if(F.col("d") <= t).alias(str(t)) for t in levels])
    return g.unpivot([], [str(t) for t in levels], "threshold", "n_clusters").select(F.col("threshold").cast("int").alias("threshold"), "n_clusters").filter("n_clusters > 0")


@query(f"with {OBS}, m as (select cluster_uid, date_trunc('month', obs_date) p, list_sort(list_distinct(list(source))) s, count(distinct source_station_uid) k from obs where ssc is not null group by 1, 2) select cluster_uid, cast(p as date) as period, array_to_string(s, '|') as sources, case when len(s) = 1 and k = 1 then 'single' when len(s) = 1 then 'same_source' else 'mixed' end as provenance from m")
def provenance_class(spark: S, sf: str) -> DataFrame:
    """What a cluster's monthly value is made of: one series, several of a source, or several sources."""
    g = observations(spark, sf).filter("ssc is not null").groupBy("cluster_uid", F.trunc("obs_date", "MM").alias("period")).agg(F.sort_array(F.collect_set("source")).alias("s"), F.countDistinct("source_station_uid").alias("k"))
    c = F.when((F.size("s") == 1) & (F.col("k") == 1), "single").when(F.size("s") == 1, "same_source").otherwise("mixed")
    return g.select("cluster_uid", "period", F.array_join("s", "|").alias("sources"), c.alias("provenance"))


@query(f"with {_RK}, b as (select record_id, ssc from (select pb.record_id, pb.ssc, row_number() over (partition by pb.cluster_uid, obs_date order by quality_rank, record_id) k from pb join rk on rk.cluster_uid = pb.cluster_uid and rk.source_station_uid = pb.source_station_uid) where k = 1), s as (select * from b where cast(('0x' || substr(md5(record_id || ':42'), 1, 8)) as bigint) % 10 = 0) select count(*) as n_sampled, count(*) filter (exists (select 1 from daily_matrix d where d.record_id = s.record_id and (s.ssc is null or d.ssc = s.ssc))) as n_faithful from s")
def sampled_audit(spark: S, sf: str) -> DataFrame:
    """Published rows, one in ten by hash, against what was delivered: the sampled audit of the release."""
    o = observations(spark, sf, ("cluster_uid", "obs_date")).filter("cluster_uid is not null")
    b = best_rows_per_day(o, "cluster_uid", "source_station_uid", "obs_date", "record_id").select("record_id", "ssc")
    raw = table(spark, sf, "daily_matrix", "record_id", "ssc").groupBy("record_id").agg(F.max("ssc").alias("raw"))
    j = hash_sample(b, "record_id", 10).join(raw, "record_id", "left")
    return j.agg(F.count("*").alias("n_sampled"), F.count_if(F.col("raw").isNotNull() & (F.col("ssc").isNull() | (F.col("ssc") == F.col("raw"))) | (F.col("ssc").isNull())).alias("n_faithful"))


@query(f"with {STATIONS}, {CATALOG}, c as (select lower(river_name) r, count(distinct cluster_uid) n from cat where river_name is not null group by 1) select lower(st.river_name) as river, count(*) as n_stations, coalesce(max(c.n), 0) as n_clusters from st left join c on c.r = lower(st.river_name) where st.river_name is not null group by 1")
def river_rollup(spark: S, sf: str) -> DataFrame:
    c = catalog(spark, sf).filter("river_name is not null").groupBy(F.lower("river_name").alias("river")).agg(F.countDistinct("cluster_uid").alias("n_clusters"))
    s = stations(spark, sf).filter("river_name is not null").groupBy(F.lower("river_name").alias("river")).agg(F.count("*").alias("n_stations"))
    return s.join(c, "river", "left").na.fill(0, ["n_clusters"])
