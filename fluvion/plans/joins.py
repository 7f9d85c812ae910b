"""Joins: keyed with assertions, full and anti, by fallback, in space, in time, and on intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluvion.functions.geo import haversine_m, valid_position, wrap_lon
from fluvion.operators.pairing import nearest_by_day, ranked_with_gap
from fluvion.operators.spatial import best_near, within_distance
from fluvion.plans.common import CATALOG, OBS, PAIRED, STATIONS, catalog, observations, paired, stations
from fluvion.plans.registry import query
from fluvion.sources.tables import table

S = SparkSession


@query("select (select count(*) from orders) as n_left, (select count(*) from (select l_orderkey from lineitem group by 1)) as n_right, (select count(*) from orders o where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey)) as missing, (select count(*) from (select o_orderkey from orders group by 1 having count(*) > 1)) as duplicates")
def one_to_one_check(spark: S, sf: str) -> DataFrame:
    """Whether two tables pair one to one on a key: sizes, keys without partner, keys that repeat."""
    o, l = table(spark, sf, "orders", "o_orderkey"), table(spark, sf, "lineitem", "l_orderkey").distinct()
    k = o.groupBy("o_orderkey").agg(F.count("*").alias("n")).join(l, F.col("o_orderkey") == F.col("l_orderkey"), "full")
    return k.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_left"), F.count("l_orderkey").alias("n_right"), F.count_if(F.col("l_orderkey").isNull()).alias("missing"), F.count_if(F.col("n") > 1).alias("duplicates"))


@query("select l_orderkey, l_linenumber, n_name, o_orderpriority from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey left join nation on n_nationkey = c_nationkey where l_quantity > 45")
def many_to_one_join(spark: S, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity").filter("l_quantity > 45")
    o, c = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderpriority"), table(spark, sf, "customer", "c_custkey", "c_nationkey")
    n = table(spark, sf, "nation", "n_nationkey", "n_name")  # 25 nations
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return j.select("l_orderkey", "l_linenumber", "n_name", "o_orderpriority")


@query(f"with {CATALOG}, c as (select cluster_uid, count(*) n_catalog from cat group by 1), d as (select cluster_uid, count(distinct record_id) n_daily from daily_matrix group by 1) select coalesce(c.cluster_uid, d.cluster_uid) as cluster_uid, n_catalog, n_daily, case when c.cluster_uid is null then 'daily_only' when d.cluster_uid is null then 'catalog_only' else 'both' end as side from c full join d on c.cluster_uid = d.cluster_uid")
def reconcile_full_outer(spark: S, sf: str) -> DataFrame:
    c = catalog(spark, sf).groupBy("cluster_uid").agg(F.count("*").alias("n_catalog"))
    d = table(spark, sf, "daily_matrix", "cluster_uid", "record_id").dropDuplicates(["record_id"]).groupBy(F.col("cluster_uid").alias("d_uid")).agg(F.count("*").alias("n_daily"))
    j = c.join(d, F.col("cluster_uid") == F.col("d_uid"), "full")
    side = F.when(F.col("cluster_uid").isNull(), "daily_only").when(F.col("d_uid").isNull(), "catalog_only").otherwise("both")
    return j.select(F.coalesce("cluster_uid", "d_uid").alias("cluster_uid"), "n_catalog", "n_daily", side.alias("side"))


@query("select coalesce(a.s, b.s) as source, coalesce(a.n, 0) as n_satellite, coalesce(b.n, 0) as n_insitu from (select trim(source) s, count(*) n from satellite_obs group by 1) a full join (select trim(source) s, count(*) n from insitu_obs group by 1) b on a.s = b.s")
def full_outer_coalesce(spark: S, sf: str) -> DataFrame:
    a = table(spark, sf, "satellite_obs", "source").groupBy(F.trim("source").alias("source")).agg(F.count("*").alias("n_satellite"))
    b = table(spark, sf, "insitu_obs", "source").groupBy(F.trim("source").alias("source")).agg(F.count("*").alias("n_insitu"))
    return a.join(b, "source", "full").na.fill(0, ["n_satellite", "n_insitu"])


@query("select c_custkey, c_name from customer where exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 200000)")
def semi_prune(spark: S, sf: str) -> DataFrame:
    o = table(spark, sf, "orders", "o_custkey", "o_totalprice").filter("o_totalprice > 200000")
    c = table(spark, sf, "customer", "c_custkey", "c_name")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left_semi")


@query(f"with {CATALOG} select distinct cluster_uid from cat where cluster_uid not in (select cluster_uid from daily_matrix where cluster_uid is not null)")
def keyset_anti(spark: S, sf: str) -> DataFrame:
    return catalog(spark, sf).select("cluster_uid").distinct().join(table(spark, sf, "daily_matrix", "cluster_uid"), "cluster_uid", "left_anti")


_FALL = "k1 as (select source_key || '/' || resolution k, max(country) v from st group by 1), k2 as (select source_key k, max(country) v from st group by 1)"


@query(f"with {STATIONS}, {_FALL} select st.station_id, coalesce(st.country, k1.v, k2.v, 'unknown') as country, case when st.country is not null then 'own' when k1.v is not null then 'source+resolution' when k2.v is not null then 'source' else 'none' end as step from st left join k1 on k1.k = st.source_key || '/' || st.resolution left join k2 on k2.k = st.source_key")
def fallback_lookup(spark: S, sf: str) -> DataFrame:
    """A value looked up by the narrowest key that has one."""
    s = stations(spark, sf)
    k1 = s.groupBy("source_key", "resolution").agg(F.max("country").alias("v1"))
    k2 = s.groupBy("source_key").agg(F.max("country").alias("v2"))
    j = s.join(k1, ["source_key", "resolution"], "left").join(k2, "source_key", "left")
    step = F.when(F.col("country").isNotNull(), "own").when(F.col("v1").isNotNull(), "source+resolution").when(F.col("v2").isNotNull(), "source").otherwise("none")
    return j.select("station_id", F.coalesce("country", "v1", "v2", F.lit("unknown")).alias("country"), step.alias("step"))


@query(f"with {CATALOG}, x as (select catalog_row_id, unnest(string_split(sources_used, '|')) s from cat where sources_used is not null), n as (select source_key k, count(*) n from (with {STATIONS} select * from st) group by 1) select catalog_row_id, s as source, n as n_stations from x left join n on n.k = lower(s)")
def explode_join(spark: S, sf: str) -> DataFrame:
    x = catalog(spark, sf).filter("sources_used is not null").select("catalog_row_id", F.explode(F.split("sources_used", r"\|")).alias("source"))
    n = stations(spark, sf).groupBy(F.col("source_key").alias("k")).agg(F.count("*").alias("n_stations"))
    return x.join(n, F.lower("source") == F.col("k"), "left").select("catalog_row_id", "source", "n_stations")


@query(f"""with {STATIONS}, {CATALOG}, c as (select source_station_id, min(cluster_uid) u from cat where source_station_id is not null group by 1), nm as (select lower(station_name) n, min(cluster_uid) u from cat where station_name is not null group by 1),
a as (select station_id, c.u, 'id' as how from st join c on c.source_station_id = st.source_station_id)
select * from a union all select st.station_id, nm.u, 'name' from st join nm on nm.n = lower(st.station_name) where st.station_id not in (select station_id from a)""")
def two_phase_fallback(spark: S, sf: str) -> DataFrame:
    """Stations linked by id, and those still open by name."""
    s, c = stations(spark, sf).select("station_id", "source_station_id", "station_name"), catalog(spark, sf)
    by_id = c.filter("source_station_id is not null").groupBy("source_station_id").agg(F.min("cluster_uid").alias("u"))
    by_name = c.filter("station_name is not null").groupBy(F.lower("station_name").alias("n")).agg(F.min("cluster_uid").alias("u"))
    first = s.join(by_id, "source_station_id").select("station_id", "u", F.lit("id").alias("how"))
    rest = s.join(first, "station_id", "left_anti").join(by_name, F.lower("station_name") == F.col("n")).select("station_id", "u", F.lit("name").alias("how"))
    return first.unionByName(rest)


@query("select r_name, tier, trust_rank from region, export_tiers")
def cross_join_small(spark: S, sf: str) -> DataFrame:
    """Every region with every tier: both tables are of fixed size (5 and 4 rows)."""
    return table(spark, sf, "region", "r_name").withColumn("one", F.lit(1)).join(F.broadcast(table(spark, sf, "export_tiers").withColumn("one", F.lit(1))), "one").select("r_name", "tier", "trust_rank")


@query(f"with {OBS} select cluster_uid, obs_date, count(distinct source_station_uid) as n_series, round(max(ssc) - min(ssc), 6) as ssc_spread, count(ssc) as n_ssc from obs where cluster_uid is not null group by 1, 2 having count(distinct source_station_uid) > 1")
def overlap_groups(spark: S, sf: str) -> DataFrame:
    """Days of a cluster with readings of several series: one row a group, with its spread, instead of all pairs."""
    o = observations(spark, sf, ("cluster_uid", "obs_date")).filter("cluster_uid is not null")
    g = o.groupBy("cluster_uid", "obs_date").agg(F.countDistinct("source_station_uid").alias("n_series"), F.round(F.max("ssc") - F.min("ssc"), 6).alias("ssc_spread"), F.count("ssc").alias("n_ssc"))
    return g.filter("n_series > 1")


def _one_position(lat: str, lon: str) -> Column:
    """The smallest position of a group: latitude and longitude of one row, whichever convention it is written in."""
    return F.min(F.struct(F.col(lat).alias("lat"), wrap_lon(F.col(lon)).alias("lon")))


def _cluster_positions(spark: S, sf: str, *more: Column) -> DataFrame:
    """One position of each cluster that has one, with further aggregates of the rows that have positions."""
    c = catalog(spark, sf).filter("lat is not null").groupBy("cluster_uid").agg(_one_position("lat", "lon").alias("p"), *more)
    return c.select("cluster_uid", "p.lat", "p.lon", *[n for n in c.columns if n not in ("cluster_uid", "p")])


_wrap = "case when {0} >= 180 then {0} - 360 else {0} end"
# one position a cluster: latitude and longitude of one row, the smallest; joined with it what is asked for
_CP = f"cp as (select cluster_uid, lat, {_wrap.format('lon')} lon from (select cluster_uid, lat, lon, row_number() over (partition by cluster_uid order by lat, {_wrap.format('lon')}) k from cat where lat is not null) where k = 1)"
_D = "2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin(radians({1}.lat - {0}.lat) / 2), 2) + cos(radians({0}.lat)) * cos(radians({1}.lat)) * pow(sin(radians({1}.lon - {0}.lon) / 2), 2))))"


@query(f"with {STATIONS}, {CATALOG}, c as (select distinct cluster_uid, lat, lon from cat where lat is not null) select st.station_id, cluster_uid, round({_D.format('st', 'c')}, 2) as distance_m from st, c where st.lat is not null and abs(st.lat - c.lat) < 0.06 and {_D.format('st', 'c')} <= 5000")
def distance_join(spark: S, sf: str) -> DataFrame:
    """All catalogue positions within 5 km of each station."""
    s = stations(spark, sf).filter("lat is not null").select("station_id", F.col("lat").alias("slat"), F.col("lon").alias("slon"))
    c = catalog(spark, sf).filter("lat is not null").select("cluster_uid", "lat", "lon").distinct()
    j = within_distance(s, "slat", "slon", c, "lat", "lon", 5000.0)
    return j.select("station_id", "cluster_uid", F.round(haversine_m(F.col("slat"), F.col("slon"), F.col("lat"), F.col("lon")), 2).alias("distance_m"))


_REACH = f"""with {STATIONS}, {CATALOG}, {_CP}, c as (select cp.*, a.area from cp left join (select cluster_uid, max(basin_area) area from cat group by 1) a on a.cluster_uid = cp.cluster_uid),
j as (select st.station_id, cluster_uid, {_D.format('st', 'c')} d, st.reported_area reported, c.area from st, c where st.lat is not null and abs(st.lat - c.lat) < 1.2 and {_D.format('st', 'c')} <= 120000),
e as (select *, case when reported is null then 0.0 else coalesce(abs(log10(least(1000.0, greatest(0.001, area / reported)))), 3.0) end area_error from j)"""


@query(f"""{_REACH} select station_id, cluster_uid, round(d, 2) as distance_m, round(area_error + d / 120000, 6) as score, case when reported is null then 'distance_only' when area_error < 0.1 then 'area_matched' when area_error < 0.3 then 'area_approximate' else 'area_mismatch' end as match_quality
from (select *, row_number() over (partition by station_id order by round(area_error + d / 120000, 9), cluster_uid) k from e) where k = 1""")
def nearest_reach(spark: S, sf: str) -> DataFrame:
    """The reach of each station among those within 120 km: by distance, and by the logarithm of the ratio of areas where the
    station reports one. A candidate without area counts as one of a thousandth of it."""
    s = stations(spark, sf).filter("lat is not null").select("station_id", "reported_area", F.col("lat").alias("slat"), F.col("lon").alias("slon"))
    c = _cluster_positions(spark, sf).join(catalog(spark, sf).groupBy("cluster_uid").agg(F.max("basin_area").alias("area")), "cluster_uid")
    off = F.abs(F.log10(F.least(F.lit(1000.0), F.greatest(F.lit(0.001), F.col("area") / F.col("reported_area")))))
    error = F.when(F.col("reported_area").isNull(), 0.0).otherwise(F.coalesce(off, F.lit(3.0)))
    b = best_near(s, "slat", "slon", c, "lat", "lon", "station_id", "cluster_uid", 120_000.0, error)
    quality = F.when(F.col("reported_area").isNull(), "distance_only").when(F.col("penalty") < 0.1, "area_matched").when(F.col("penalty") < 0.3, "area_approximate").otherwise("area_mismatch")
    return b.select("station_id", "cluster_uid", F.round("distance_m", 2).alias("distance_m"), F.round("score", 6).alias("score"), quality.alias("match_quality"))


@query(f"{_REACH} select station_id, count(*) as n_reaches, round(min(d), 2) as nearest_m, count(*) filter (d <= 5000) as n_within_5_km from e group by 1")
def reach_candidates(spark: S, sf: str) -> DataFrame:
    """The candidate set of each station: how many reaches lie within 120 km, and how near."""
    s = stations(spark, sf).filter("lat is not null").select("station_id", F.col("lat").alias("slat"), F.col("lon").alias("slon"))
    j = within_distance(s, "slat", "slon", _cluster_positions(spark, sf), "lat", "lon", 120_000.0).withColumn("d", haversine_m(F.col("slat"), F.col("slon"), F.col("lat"), F.col("lon")))
    return j.groupBy("station_id").agg(F.count("*").alias("n_reaches"), F.round(F.min("d"), 2).alias("nearest_m"), F.count_if(F.col("d") <= 5000).alias("n_within_5_km"))


@query(f"with {STATIONS} select station_id, cast(floor((lat + 90) / 0.25) as bigint) as row_no, cast(floor(((lon + 360) % 360) / 0.25) as bigint) as col_no from st where lat is not null")
def nearest_grid_cell(spark: S, sf: str) -> DataFrame:
    """The quarter-degree model cell of each station, in closed form."""
    return stations(spark, sf).filter("lat is not null").select("station_id", F.floor((F.col("lat") + 90) / 0.25).alias("row_no"), F.floor(F.pmod(F.col("lon") + 360, F.lit(360.0)) / 0.25).alias("col_no"))


@query(f"""with s as (select distinct satellite_record_id, upper(trim(cluster_uid)) c, cast(satellite_time as date) d from satellite_obs where satellite_ssc >= 0 and not isnan(satellite_ssc) and coalesce(ssc_flag, 0) not in (3, 9)),
i as (select distinct insitu_record_id, upper(trim(cluster_uid)) c, cast(insitu_time as date) d, lower(trim(source)) src, coalesce(ssc_flag, 9) f from insitu_obs where insitu_ssc >= 0 and not isnan(insitu_ssc) and coalesce(ssc_flag, 0) not in (3, 9)),
w as (select * from (values ('exact', 0), ('pm1d', 1), ('pm2d', 2)) t(win, tol)),
j as (select satellite_record_id, win, insitu_record_id, date_diff('day', s.d, i.d) delta, row_number() over (partition by satellite_record_id, win order by abs(date_diff('day', s.d, i.d)), f, src, i.d, insitu_record_id) k from s join i on s.c = i.c join w on abs(date_diff('day', s.d, i.d)) <= tol)
select satellite_record_id, win as "window", insitu_record_id, delta as delta_days from j where k = 1""")
def asof_pairs(spark: S, sf: str) -> DataFrame:
    """The best in-situ record of each satellite record for three cumulative windows of days."""
    ok = lambda v: F.col(v).isNotNull() & ~F.isnan(v) & (F.col(v) >= 0) & ~F.coalesce(F.col("ssc_flag").isin(3, 9), F.lit(False))
    s = table(spark, sf, "satellite_obs", "satellite_record_id", "cluster_uid", "satellite_time", "satellite_ssc", "ssc_flag").filter(ok("satellite_ssc")).dropDuplicates(["satellite_record_id"])
    i = table(spark, sf, "insitu_obs", "insitu_record_id", "cluster_uid", "insitu_time", "insitu_ssc", "ssc_flag", "source").filter(ok("insitu_ssc")).dropDuplicates(["insitu_record_id"])
    s = s.select("satellite_record_id", F.upper(F.trim("cluster_uid")).alias("c"), F.to_date("satellite_time").alias("sd"))
    i = i.select("insitu_record_id", F.upper(F.trim("cluster_uid")).alias("c"), F.to_date("insitu_time").alias("d"), F.lower(F.trim("source")).alias("src"), F.coalesce("ssc_flag", F.lit(9)).alias("f"))
    j = nearest_by_day(s, i, ["c"], "sd", "d", "satellite_record_id", [F.col("f"), F.col("src"), F.col("d"), F.col("insitu_record_id")], {"exact": 0, "pm1d": 1, "pm2d": 2})
    return j.select("satellite_record_id", "window", "insitu_record_id", "delta_days")


@query(f"with {OBS}, m as (select source_station_uid u, cast(date_trunc('month', obs_date) as date) a, last_day(obs_date) b, avg(ssc) v from obs where ssc is not null group by 1, 2, 3) select u as source_station_uid, a as period_start, count(*) as n_inside, round(avg(ssc) - min(v), 6) as difference from m join obs on obs.source_station_uid = u and obs_date between a and b and ssc is not null group by 1, 2")
def interval_containment(spark: S, sf: str) -> DataFrame:
    """Daily readings inside each monthly value's period. The period's start is a function of the day, so the range becomes a key."""
    o = observations(spark, sf).filter("ssc is not null").select("source_station_uid", F.trunc("obs_date", "MM").alias("period_start"), "ssc")
    m = o.groupBy("source_station_uid", "period_start").agg(F.avg("ssc").alias("v"))
    j = m.join(o, ["source_station_uid", "period_start"])
    return j.groupBy("source_station_uid", "period_start").agg(F.count("*").alias("n_inside"), F.round(F.avg("ssc") - F.min("v"), 6).alias("difference"))


@query("with r as (select upper(trim(cluster_uid)) c, min(satellite_time) - interval 2 day a, max(satellite_time) + interval 2 day b from satellite_obs where cluster_uid is not null group by 1) select count(distinct insitu_record_id) as n_kept, (select count(distinct insitu_record_id) from insitu_obs) as n_all from insitu_obs i join r on upper(trim(i.cluster_uid)) = r.c and insitu_time between a and b")
def window_semi_prune(spark: S, sf: str) -> DataFrame:
    """In-situ records that fall in the span of their cluster's satellite records, two days wider."""
    r = table(spark, sf, "satellite_obs", "cluster_uid", "satellite_time").filter("cluster_uid is not null").groupBy(F.upper(F.trim("cluster_uid")).alias("c")).agg((F.min("satellite_time") - F.expr("interval 2 days")).alias("a"), (F.max("satellite_time") + F.expr("interval 2 days")).alias("b"))
    i = table(spark, sf, "insitu_obs", "insitu_record_id", "cluster_uid", "insitu_time").dropDuplicates(["insitu_record_id"]).withColumn("c", F.upper(F.trim("cluster_uid")))
    return i.join(r, "c", "left").agg(F.count_if(F.col("insitu_time").between(F.col("a"), F.col("b"))).alias("n_kept"), F.count("*").alias("n_all"))


@query(f"with {OBS}, m as (select cluster_uid, source, date_trunc('month', obs_date) p, avg(ssc) v from obs where ssc is not null group by 1, 2, 3) select a.cluster_uid, cast(a.p as date) as period, a.source as source_a, b.source as source_b, round(a.v, 6) as value_a, round(b.v, 6) as value_b from m a join m b on a.cluster_uid = b.cluster_uid and a.p = b.p and a.source < b.source")
def period_equi_join(spark: S, sf: str) -> DataFrame:
    """Monthly means of two sources of a cluster in the same month (a cluster has as many rows a month as sources, of which there are few)."""
    o = observations(spark, sf).filter("ssc is not null")
    m = o.groupBy("cluster_uid", F.trunc("obs_date", "MM").alias("period"), "source").agg(F.avg("ssc").alias("v"))
    a, b = m.select("cluster_uid", "period", F.col("source").alias("source_a"), F.col("v").alias("va")), m.select("cluster_uid", "period", F.col("source").alias("source_b"), F.col("v").alias("vb"))
    return a.join(b, ["cluster_uid", "period"]).filter("source_a < source_b").select("cluster_uid", "period", "source_a", "source_b", F.round("va", 6).alias("value_a"), F.round("vb", 6).alias("value_b"))


@query(f"with {PAIRED} select satellite_source, count(*) as n, count(*) filter (x = y) as exact, count(*) filter (abs(x - y) <= 0.05 + 0.1 * abs(y)) as near from pr group by 1")
def native_equality(spark: S, sf: str) -> DataFrame:
    """Values of one day in two tables: equal, and equal within tolerance."""
    return paired(spark, sf).groupBy("satellite_source").agg(F.count("*").alias("n"), F.count_if(F.col("x") == F.col("y")).alias("exact"), F.count_if(F.abs(F.col("x") - F.col("y")) <= 0.05 + 0.1 * F.abs("y")).alias("near"))


@query(f"""with {CATALOG}, {_CP}, c as (select cp.*, a.area from cp join (select cluster_uid, min(basin_area) area from cat where lat is not null group by 1) a on a.cluster_uid = cp.cluster_uid),
sl as (select satellite_station_id, satellite_uparea_merit area, satellite_lat lat, {_wrap.format('satellite_lon')} lon from satellite_links where satellite_lat between -90 and 90 and satellite_lon between -180 and 360 and not isnan(satellite_lat) and not isnan(satellite_lon)),
s as (select p.satellite_station_id, a.area, p.lat, p.lon from (select *, row_number() over (partition by satellite_station_id order by lat, lon) k from sl) p join (select satellite_station_id, min(area) area from sl group by 1) a on a.satellite_station_id = p.satellite_station_id where k = 1),
j as (select satellite_station_id, cluster_uid, {_D.format('s', 'c')} d, abs(s.area - c.area) / greatest(s.area, c.area) e from s, c where abs(s.lat - c.lat) < 0.1 and {_D.format('s', 'c')} <= 5000),
r as (select *, row_number() over (partition by satellite_station_id order by round(d, 3), e nulls last, cluster_uid) k, lead(round(d, 3)) over (partition by satellite_station_id order by round(d, 3), e nulls last, cluster_uid) d2, lead(e) over (partition by satellite_station_id order by round(d, 3), e nulls last, cluster_uid) e2 from j)
select satellite_station_id, cluster_uid, round(d, 3) as distance_m, case when d > 1000 then 'distance_too_far' when e > 0.10 then 'area_mismatch' when d2 - round(d, 3) <= 100 and abs(coalesce(e2, 0) - coalesce(e, 0)) <= 0.01 then 'ambiguous' else 'linked' end as decision from r where k = 1""")
def satellite_link(spark: S, sf: str) -> DataFrame:
    """The cluster of each satellite station: the nearest, if near, alike in area and not tied with the next."""
    c = _cluster_positions(spark, sf, F.min("basin_area").alias("area_c"))
    s = table(spark, sf, "satellite_links", "satellite_station_id", "satellite_uparea_merit", "satellite_lat", "satellite_lon").filter(valid_position(F.col("satellite_lat"), F.col("satellite_lon")))
    s = s.groupBy("satellite_station_id").agg(F.min("satellite_uparea_merit").alias("area"), _one_position("satellite_lat", "satellite_lon").alias("p"))
    s = s.select("satellite_station_id", "area", F.col("p.lat").alias("slat"), F.col("p.lon").alias("slon"))
    j = within_distance(s, "slat", "slon", c, "lat", "lon", 5000.0)
    j = j.withColumn("d0", haversine_m(F.col("slat"), F.col("slon"), F.col("lat"), F.col("lon"))).withColumn("d", F.round("d0", 3)).withColumn("e", F.abs(F.col("area") - F.col("area_c")) / F.greatest("area", "area_c"))
    w = W.partitionBy("satellite_station_id").orderBy("d", F.col("e").asc_nulls_last(), "cluster_uid")
    j = j.withColumn("k", F.row_number().over(w)).withColumn("d2", F.lead("d").over(w)).withColumn("e2", F.lead("e").over(w)).filter("k = 1")
    tie = (F.col("d2") - F.col("d") <= 100) & (F.abs(F.coalesce("e2", F.lit(0.0)) - F.coalesce("e", F.lit(0.0))) <= 0.01)
    why = F.when(F.col("d0") > 1000, "distance_too_far").when(F.col("e") > 0.10, "area_mismatch").when(tie, "ambiguous").otherwise("linked")
    return j.select("satellite_station_id", "cluster_uid", F.col("d").alias("distance_m"), why.alias("decision"))


@query(f"""with {STATIONS}, {CATALOG}, {_CP}, c as (select * from cp), j as (select station_id, cluster_uid, round({_D.format('st', 'c')}, 3) d from st, c where st.lat is not null and abs(st.lat - c.lat) < 0.06 and {_D.format('st', 'c')} <= 5000),
r as (select *, row_number() over (partition by station_id order by d, cluster_uid) k, lead(d) over (partition by station_id order by d, cluster_uid) d2, count(*) over (partition by station_id) n from j)
select station_id, cluster_uid, d as distance_m, case when n = 1 then 'unique' when d2 - d >= 100 or d2 >= 1.5 * greatest(d, 1e-9) then 'clear' else 'ambiguous' end as decision from r where k = 1""")
def match_select_ambiguity(spark: S, sf: str) -> DataFrame:
    s = stations(spark, sf).filter("lat is not null").select("station_id", F.col("lat").alias("slat"), F.col("lon").alias("slon"))
    c = _cluster_positions(spark, sf)
    j = within_distance(s, "slat", "slon", c, "lat", "lon", 5000.0).withColumn("distance_m", F.round(haversine_m(F.col("slat"), F.col("slon"), F.col("lat"), F.col("lon")), 3))
    r = ranked_with_gap(j, "station_id", "distance_m", [F.col("distance_m"), F.col("cluster_uid")], 100.0, 1.5)
    return r.filter("rank = 1").select("station_id", "cluster_uid", "distance_m", "decision")


@query("select a, b, string_agg(distinct m, '|' order by m) as modes, count(*) as n from (select least(upper(trim(left_source_station_id)), upper(trim(right_source_station_id))) a, greatest(upper(trim(left_source_station_id)), upper(trim(right_source_station_id))) b, match_method m from station_pairs where left_source_station_id is not null and right_source_station_id is not null) group by 1, 2")
def unordered_pairs(spark: S, sf: str) -> DataFrame:
    key = lambda c: F.upper(F.trim(c))
    p = table(spark, sf, "station_pairs", "left_source_station_id", "right_source_station_id", "match_method").filter("left_source_station_id is not null and right_source_station_id is not null")
    l, r = key("left_source_station_id"), key("right_source_station_id")
    g = p.groupBy(F.least(l, r).alias("a"), F.greatest(l, r).alias("b"))
    return g.agg(F.array_join(F.sort_array(F.collect_set("match_method")), "|").alias("modes"), F.count("*").alias("n"))


@query(f"with {CATALOG}, g as (select cluster_uid, min(country) country, min(continent_region) region from cat group by 1), d as (select cluster_uid, count(distinct source_station_uid) n_series from daily_matrix group by 1) select d.cluster_uid, n_series, coalesce(country, '') as country, coalesce(region, '') as region from d left join g on d.cluster_uid = g.cluster_uid")
def geo_attach(spark: S, sf: str) -> DataFrame:
    g = catalog(spark, sf).groupBy("cluster_uid").agg(F.min("country").alias("country"), F.min("continent_region").alias("region"))
    d = table(spark, sf, "daily_matrix", "cluster_uid", "source_station_uid").distinct().groupBy("cluster_uid").agg(F.count("source_station_uid").alias("n_series"))
    return d.join(g, "cluster_uid", "left").select("cluster_uid", "n_series", F.coalesce("country", F.lit("")).alias("country"), F.coalesce("region", F.lit("")).alias("region"))


@query(f"with {PAIRED}, {CATALOG}, a as (select cluster_uid, max(basin_area) area from cat group by 1) select satellite_record_id, insitu_record_id, area as basin_area from pr left join a on a.cluster_uid = pr.cluster_uid")
def external_attributes(spark: S, sf: str) -> DataFrame:
    a = catalog(spark, sf).groupBy("cluster_uid").agg(F.max("basin_area").alias("basin_area"))
    return paired(spark, sf).join(a, "cluster_uid", "left").select("satellite_record_id", "insitu_record_id", "basin_area")


@query(None)
def within_polygons(spark: S, sf: str) -> DataFrame:
    """The half-degree box, as a polygon, that holds each station: boundary attachment by coverage (held against closed-form cells in the tests)."""
    from fluvion.operators.spatial import points_in_polygons

    s = stations(spark, sf).filter("lat is not null").select("station_id", "lat", "lon")
    cells = s.select(F.floor(F.col("lat") * 2).alias("r"), F.floor(F.col("lon") * 2).alias("c")).distinct()
    corner = lambda i, j: F.struct(((F.col("r") + i) / 2.0).alias("lat"), ((F.col("c") + j) / 2.0).alias("lon"))
    polygons = cells.select(F.concat_ws("_", "r", "c").alias("region_id"), F.array(corner(0, 0), corner(0, 1), corner(1, 1), corner(1, 0)).alias("ring"))
    return points_in_polygons(s, "lat", "lon", polygons, "region_id", "ring")
