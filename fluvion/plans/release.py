"""Release: links along the network, validation, look-ups over many keys, evidence with overrides, match selection, further strata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvion.functions.geo import haversine_m, valid_position, wrap_lon
from fluvion.operators import checks, lookup
from fluvion.operators.graph import edges_from_columns
from fluvion.operators.links import link_to_clusters
from fluvion.operators.metrics import error_metrics_by, error_metrics_sql
from fluvion.operators.quantiles import with_quantiles
from fluvion.operators.spatial import within_distance
from fluvion.plans.common import CATALOG, OBS, PAIRED, STATIONS, catalog, observations, paired, stations
from fluvion.plans.joins import _CP, _D, _cluster_positions
from fluvion.plans.registry import query
from fluvion.plans.temporal import _FREQ, _frequencies
from fluvion.session import materialize
from fluvion.sources.tables import table

S = SparkSession

# --- satellite stations linked along a network --------------------------------------------------
# the network of the tests: reach n flows into reach n / 2; a satellite stands on reach 1 + comid % parts, a cluster on that of
# the first satellite delivered as linked to it by reach, else on reach 1 + cluster number % parts

_SATS = """np as (select max(p_partkey) n from part), sv as (select satellite_station_id s, cast(1 + satellite_comid % n as bigint) r, satellite_uparea_merit a, satellite_lat la, case when satellite_lon >= 180 then satellite_lon - 360 else satellite_lon end lo, satellite_lat between -90 and 90 and satellite_lon between -180 and 360 and not isnan(satellite_lat) and not isnan(satellite_lon) ok, linked_cluster_id c, link_method m from satellite_links, np where satellite_station_id is not null),
sp as (select s, la, lo from (select s, la, lo, row_number() over (partition by s order by la, lo) k from sv where ok) where k = 1), sa as (select s, min(r) r, min(case when not isnan(a) then a end) a from sv group by 1), sat as (select sa.s, sa.r, sa.a, sp.la, sp.lo from sa left join sp on sp.s = sa.s)"""
_SEGS = "seg as (select r, min(struct_pack(la := la, lo := lo)) p from (select r, la, lo from sat where la is not null union all select r, la, lo from cl) group by 1), sg as (select r, p.la la1, p.lo lo1, p.la + 0.01 la2, p.lo + 0.01 lo2 from seg)"


def _cross(point: str, seg: str) -> str:
    """Distance of a point (la, lo) to a segment on the plane at the point."""
    k = f"cos(radians({point}.la))"
    turn = f"(({seg}.lo1 - {point}.lo) - 360 * round(({seg}.lo1 - {point}.lo) / 360))"
    x1, y1 = f"(radians({turn}) * {k} * 6371008.8)", f"(radians({seg}.la1 - {point}.la) * 6371008.8)"
    x2, y2 = f"(radians({turn} + 0.01) * {k} * 6371008.8)", f"(radians({seg}.la1 + 0.01 - {point}.la) * 6371008.8)"
    t = f"least(1.0, greatest(0.0, -({x1} * ({x2} - {x1}) + {y1} * ({y2} - {y1})) / (pow({x2} - {x1}, 2) + pow({y2} - {y1}, 2))))"
    return f"sqrt(pow({x1} + {t} * ({x2} - {x1}), 2) + pow({y1} + {t} * ({y2} - {y1}), 2))"


_PT = "2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin(radians(c.la - s.la) / 2), 2) + cos(radians(s.la)) * cos(radians(c.la)) * pow(sin(radians(c.lo - s.lo) / 2), 2))))"
_LINKS = f"""with {CATALOG}, {_CP}, {_SATS},
cr as (select c, min(r) r from sv where c is not null and m = 'same_reach' group by 1),
cl as (select cp.cluster_uid c, coalesce(cr.r, cast(1 + cast(substr(cp.cluster_uid, 4) as bigint) % np.n as bigint)) r, ar.a, cp.lat la, cp.lon lo from cp cross join np join (select cluster_uid, max(basin_area) a from cat group by 1) ar on ar.cluster_uid = cp.cluster_uid left join cr on cr.c = cast(substr(cp.cluster_uid, 4) as bigint)), {_SEGS},
us as (select * from sat where la is not null and r is not null),
same as (select s.s, c.c, {_PT} d, abs(s.a - c.a) / greatest(s.a, c.a) e from us s join cl c on s.r = c.r),
sb as (select * from (select *, row_number() over (partition by s order by d, e nulls last, c) k from same) where k = 1),
rest as (select * from us where s not in (select s from sb)),
hop as (select unnest([1, 2, 3]) h),
cand as (select s.s, c.c, h, s.r // cast(pow(2, h) as bigint) = c.r down, {_PT} d, abs(s.a - c.a) / greatest(s.a, c.a) e, c.r creach, s.r sreach, s.la sla, s.lo slo, c.la cla, c.lo clo from rest s cross join hop join cl c on (s.r // cast(pow(2, h) as bigint) = c.r and c.r > 0) or (c.r // cast(pow(2, h) as bigint) = s.r)),
al as (select cand.*, (select {_cross('p', 'g')} from (select cand.sla la, cand.slo lo) p, sg g where g.r = cand.creach) d1, (select {_cross('p', 'g')} from (select cand.cla la, cand.clo lo) p, sg g where g.r = cand.sreach) d2 from cand where e <= 0.10),
ok as (select *, greatest(d1, d2) f, row_number() over w k, lead(h) over w h2, lead(greatest(d1, d2)) over w f2, lead(e) over w e2 from al where greatest(d1, d2) <= 1000 window w as (partition by s order by h, greatest(d1, d2), e, c)),
tied as (select *, coalesce(h = h2 and abs(f - f2) <= 100 and abs(e - e2) <= 0.01, false) tie from ok where k = 1),
why as (select s, max(r) r from (select s, case when e is null then 1 when e > 0.10 then 2 else 4 end r from cand) group by 1)"""


@query(f"""{_LINKS} select s as satellite, c as cluster, 'linked' as status, 'same_reach' as method, 0 as hops, '' as reason from sb
union all select s, c, case when tie then 'ambiguous' else 'linked' end, case when down then 'downstream' else 'upstream' end, cast(h as int), case when tie then 'ambiguous_top_candidates' else '' end from tied
union all select rest.s, null, 'unlinked', null, null, case coalesce(why.r, 0) when 0 then 'not_topology_connected' when 1 then 'missing_upstream_area' when 2 then 'area_mismatch' else 'distance_mismatch' end from rest left join why on why.s = rest.s where rest.s not in (select s from tied)
union all select s, null, 'unlinked', null, null, case when la is null then 'missing_coordinates' else 'unresolved_reach' end from sat where la is null or r is null""")
def satellite_link_rules(spark: S, sf: str) -> DataFrame:
    """Each satellite station with its cluster by reach or network, or the reason why it has none."""
    n = table(spark, sf, "part", "p_partkey").agg(F.max("p_partkey").alias("n"))  # one row
    v = table(spark, sf, "satellite_links", "satellite_station_id", "satellite_comid", "satellite_uparea_merit", "satellite_lat", "satellite_lon", "linked_cluster_id", "link_method").filter("satellite_station_id is not null").join(F.broadcast(n))
    ok = valid_position(F.col("satellite_lat"), F.col("satellite_lon"))
    v = v.withColumn("reach", (1 + F.col("satellite_comid") % F.col("n")).cast("bigint"))
    s = v.groupBy(F.col("satellite_station_id").alias("satellite")).agg(F.min("reach").alias("reach"), F.min(F.when(~F.isnan("satellite_uparea_merit"), F.col("satellite_uparea_merit"))).alias("area"), F.min(F.when(ok, F.struct(F.col("satellite_lat").alias("lat"), wrap_lon(F.col("satellite_lon")).alias("lon")))).alias("p")).select("satellite", "reach", "area", "p.lat", "p.lon")
    own = v.filter("linked_cluster_id is not null and link_method = 'same_reach'").groupBy(F.col("linked_cluster_id").alias("_c")).agg(F.min("reach").alias("_r"))
    number = F.substring("cluster_uid", 4, 30).cast("bigint")
    c = _cluster_positions(spark, sf).join(catalog(spark, sf).groupBy("cluster_uid").agg(F.max("basin_area").alias("area")), "cluster_uid").join(F.broadcast(n)).withColumn("_no", number)
    c = c.join(own, F.col("_no") == F.col("_c"), "left").select(F.col("cluster_uid").alias("cluster"), F.coalesce("_r", (1 + F.col("_no") % F.col("n")).cast("bigint")).alias("reach"), "area", "lat", "lon")
    places = s.filter("lat is not null").select("reach", "lat", "lon").unionByName(c.select("reach", "lat", "lon"))
    seg = places.groupBy("reach").agg(F.min(F.struct("lat", "lon")).alias("p")).select("reach", F.col("p.lat").alias("lat1"), F.col("p.lon").alias("lon1"), (F.col("p.lat") + 0.01).alias("lat2"), (F.col("p.lon") + 0.01).alias("lon2"))
    tree = table(spark, sf, "part", "p_partkey").select("p_partkey", F.floor(F.col("p_partkey") / 2).alias("down"))
    links = link_to_clusters(s, c, edges_from_columns(tree, "p_partkey", ["down"]), seg, max_hops=3)
    return links.select("satellite", "cluster", "status", "method", "hops", "reason")


# --- validation ---------------------------------------------------------------------------------
# checks by table: name -> the condition that no row may meet, in SQL that both engines read

_ROW_CHECKS: dict[str, dict[str, str]] = {
    "obs": {
        "daily_record_present": "record_id is null",
        "daily_cluster_present": "cluster_uid is null",
        "daily_series_present": "source_station_uid is null",
        "daily_source_present": "source is null or trim(source) = ''",
        "daily_date_present": "obs_date is null",
        "daily_date_not_before_1800": "obs_date < date '1800-01-01'",
        "daily_date_not_in_future": "obs_date > date '2100-01-01'",
        "daily_q_not_negative": "q < 0",
        "daily_ssc_not_negative": "ssc < 0",
        "daily_ssl_not_negative": "ssl < 0",
        "daily_q_flag_known": "q_flag is not null and q_flag not in (0, 1, 2, 3, 9)",
        "daily_ssc_flag_known": "ssc_flag is not null and ssc_flag not in (0, 1, 2, 3, 9)",
        "daily_ssl_flag_known": "ssl_flag is not null and ssl_flag not in (0, 1, 2, 3, 9)",
        "daily_q_good_has_value": "q_flag = 0 and q is null",
        "daily_ssc_good_has_value": "ssc_flag = 0 and ssc is null",
        "daily_ssl_good_has_value": "ssl_flag = 0 and ssl is null",
        "daily_sediment_required": "ssc is null and ssl is null",
        "daily_load_without_water": "q = 0 and ssl > 0",
        "daily_load_follows_inputs": "q > 0 and ssc > 0 and ssl > 0 and (ssl > q * ssc * 0.0864 * 2 or ssl < q * ssc * 0.0864 / 2)",
        "daily_q_within_limits": "q > 500000",
        "daily_ssc_within_limits": "ssc > 1600000",
        "daily_ssl_within_limits": "ssl > 500000000",
    },
    "cat": {
        "catalog_row_present": "catalog_row_id is null",
        "catalog_cluster_present": "cluster_uid is null",
        "catalog_latitude_usable": "lat is null",
        "catalog_longitude_usable": "lon is null",
        "catalog_area_positive": "basin_area is null",
        "catalog_name_present": "station_name is null",
        "catalog_river_present": "river_name is null",
        "catalog_sources_present": "sources_used is null",
        "catalog_count_positive": "n_source_stations_in_cluster is null",
        "catalog_country_present": "country is null",
        "catalog_status_known": "basin_status is null or basin_status not in ('resolved', 'unresolved')",
        "catalog_quality_known": "basin_match_quality is null or basin_match_quality not in ('distance_only', 'area_matched', 'area_approximate', 'area_mismatch', 'failed')",
        "catalog_resolved_not_failed": "basin_status = 'resolved' and basin_match_quality in ('failed', 'area_mismatch')",
        "catalog_tier_present": "export_tier is null",
        "catalog_export_time_present": "exported_at is null",
    },
    "st": {
        "station_present": "station_id is null",
        "station_key_present": "station_key is null",
        "station_path_present": "path is null",
        "station_path_relative": "path like '/%'",
        "station_source_present": "source is null or source = ''",
        "station_resolution_known": "resolution is null or resolution not in ('daily', 'monthly', 'annual', 'climatology')",
        "station_position_usable": "lat is null or lon is null",
        "station_native_id_present": "source_station_id is null",
    },
}
_CHECKED = " union all ".join(f"select '{n}' as \"check\", count(*) filter ({c}) n from {t}" for t, cs in _ROW_CHECKS.items() for n, c in cs.items())
_KEYED = """select 'daily_record_unique' as "check", (select count(*) from (select record_id from obs where record_id is not null group by 1 having count(*) > 1)) n
union all select 'daily_day_unique_in_series', (select count(*) from (select source_station_uid, obs_date from obs group by 1, 2 having count(*) > 1))
union all select 'catalog_row_unique', (select count(*) from (select catalog_row_id from cat where catalog_row_id is not null group by 1 having count(*) > 1))
union all select 'station_unique', (select count(*) from (select station_id from st where station_id is not null group by 1 having count(*) > 1))
union all select 'station_key_unique', (select count(*) from (select station_key from st where station_key is not null group by 1 having count(*) > 1))
union all select 'daily_cluster_in_catalog', (select count(distinct cluster_uid) from obs where cluster_uid is not null and cluster_uid not in (select cluster_uid from cat where cluster_uid is not null))
union all select 'catalog_cluster_has_records', (select count(distinct cluster_uid) from cat where cluster_uid is not null and cluster_uid not in (select cluster_uid from obs where cluster_uid is not null))
union all select 'catalog_station_registered', (select count(distinct source_station_id) from cat where source_station_id is not null and source_station_id not in (select source_station_id from st where source_station_id is not null))"""


@query(f"with {OBS}, {CATALOG}, {STATIONS}, r as ({_CHECKED} union all {_KEYED}) select \"check\", case when n = 0 then 'pass' else 'fail' end as status, n as details from r")
def release_validation(spark: S, sf: str) -> DataFrame:
    """Some fifty named checks of the release: rows of each product, keys, and keys across products. One pass a product for the rows."""
    frames = {"obs": observations(spark, sf), "cat": catalog(spark, sf), "st": stations(spark, sf)}
    parts = [checks.counted(frames[t], {n: F.expr(c) for n, c in cs.items()}) for t, cs in _ROW_CHECKS.items()]
    o, c, s = frames["obs"], frames["cat"], frames["st"]
    some = lambda d, k: d.filter(F.col(k).isNotNull())
    parts += [checks.unique(some(o, "record_id"), "daily_record_unique", "record_id"), checks.unique(o, "daily_day_unique_in_series", "source_station_uid", "obs_date"), checks.unique(some(c, "catalog_row_id"), "catalog_row_unique", "catalog_row_id"), checks.unique(some(s, "station_id"), "station_unique", "station_id"), checks.unique(some(s, "station_key"), "station_key_unique", "station_key")]
    parts += [checks.contained(o, c, "daily_cluster_in_catalog", "cluster_uid"), checks.contained(c, o, "catalog_cluster_has_records", "cluster_uid"), checks.contained(c, s, "catalog_station_registered", "source_station_id")]
    return checks.together(*parts)


@query(f"with {STATIONS} select station_id, path, source_key, resolution, lat, lon from st where station_id is not null")
def asserted_one_to_one(spark: S, sf: str) -> DataFrame:
    """Two views of the stations joined one to one, after keys and positions have been held against each other (raises otherwise)."""
    s = stations(spark, sf).filter("station_id is not null")
    return checks.one_to_one(s.select("station_id", "path", "lat", "lon"), s.select("station_id", "source_key", "resolution", "lat", "lon"), "station_id", close={"lat": 1e-10, "lon": 1e-10}).select("station_id", "path", "source_key", "resolution", "lat", "lon")


# --- look-ups -------------------------------------------------------------------------------------

_TOP = "top as (select cluster_uid from cat where basin_status = 'resolved' and cluster_uid is not null group by 1)"


@query(f"with {CATALOG}, {OBS}, {_TOP}, o as (select cluster_uid, obs_date, variable, value from (unpivot (select cluster_uid, record_id, obs_date, q, ssc, ssl from obs where cluster_uid in (select cluster_uid from top)) on q, ssc, ssl into name variable value value)) select cluster_uid, obs_date, variable, value from o")
def cluster_series_lookup(spark: S, sf: str) -> DataFrame:
    """The series of many clusters (all those with a resolved basin), looked up by uid."""
    wanted = catalog(spark, sf).filter("basin_status = 'resolved'").select("cluster_uid")
    return lookup.series_of(observations(spark, sf), "cluster_uid", wanted, "obs_date", ["q", "ssc", "ssl"])


@query(f"with {OBS} select * from (" + " union all ".join(f"select cluster_uid, '{v}' as variable, count({v}) as n, round(100.0 * count({v}) / count(*), 6) as pct, min(case when {v} is not null then obs_date end) as first_day, max(case when {v} is not null then obs_date end) as last_day from obs group by 1" for v in ("q", "ssc", "ssl")) + ")")
def cluster_availability(spark: S, sf: str) -> DataFrame:
    return lookup.availability(observations(spark, sf), "cluster_uid", "obs_date", ["q", "ssc", "ssl"])


@query(f"""with {STATIONS}, {CATALOG}, rq as (select distinct c.source_station_id a, st.source_key k from cat c join st on st.source_station_id = c.source_station_id where trim(c.source_station_id) <> '')
select distinct rq.a as asked, st.station_id, 'id' as matched_by from rq join st on upper(trim(st.source_station_id)) = upper(trim(rq.a)) and upper(trim(st.source)) = upper(rq.k)""")
def native_id_lookup(spark: S, sf: str) -> DataFrame:
    """The stations that the catalogue's member ids mean in their sources."""
    s = stations(spark, sf)
    asked = catalog(spark, sf).select(F.col("source_station_id").alias("asked")).distinct()
    q = asked.join(s.select("source_station_id", "source_key"), F.col("asked") == F.col("source_station_id")).select("asked", "source_key").distinct()
    hit = lookup.stations_by_name(s, q.withColumn("request", F.col("asked")), "request", "source_key", "asked", "source_station_id", "station_name", "path", "source")
    return hit.select(F.col("request").alias("asked"), "station_id", "matched_by").distinct()


@query(f"""with {STATIONS}, p as (select station_uid, min(struct_pack(la := lat, lo := lon)) p from climatology_stations where lat between -90 and 90 and lon between -180 and 180 and not isnan(lat) and not isnan(lon) group by 1), c as (select station_uid, p.la lat, p.lo lon from p),
j as (select station_uid, station_id, {_D.format('c', 'st')} d from c, st where st.lat is not null),
r as (select *, row_number() over (partition by station_uid order by d, station_id) k from j) select station_uid, station_id, round(d, 2) as distance_m, k as rank from r where k <= 2""")
def nearest_two_stations(spark: S, sf: str) -> DataFrame:
    """The two stations nearest to each climatology station."""
    c = table(spark, sf, "climatology_stations", "station_uid", "lat", "lon").filter("lat between -90 and 90 and lon between -180 and 180 and not isnan(lat) and not isnan(lon)")
    c = c.groupBy("station_uid").agg(F.min(F.struct("lat", "lon")).alias("p")).select("station_uid", "p.lat", "p.lon")
    n = lookup.nearest_stations(stations(spark, sf).filter("lat is not null"), "lat", "lon", "station_id", c, "lat", "lon", "station_uid", 2)
    return n.select("station_uid", "station_id", F.round("distance_m", 2).alias("distance_m"), "rank")


# --- evidence, taxonomy, policy ---------------------------------------------------------------------
# Reviewed answers of the tests, station and resolution; in use they come as a table.
_REVIEWED = ((7, "monthly"), (21, "annual"), (64, "climatology"))
_RESOLUTIONS = ("daily", "monthly", "annual", "climatology", "single_point", "irregular", "other")


def validated_overrides(df: DataFrame, key: str, value: str, vocabulary: tuple[str, ...] = _RESOLUTIONS) -> DataFrame:
    """Overrides in lower case, blank keys left out; raises if a value is not in the vocabulary or a key has two."""
    o = df.select(F.trim(F.col(key).cast("string")).alias(key), F.lower(F.trim(value)).alias(value)).filter(F.col(key) != "").distinct()
    checks.require(checks.together(checks.counted(o, {f"{value}_in_vocabulary": ~F.coalesce(F.col(value).isin(*vocabulary), F.lit(False))}), checks.unique(o, f"{key}_unique", key)))
    return o


def arbitrated(axis: Column, metadata: Column, path: Column, override: Column) -> Column:
    """struct<resolution, basis, review>: an override first; then the time axis, whose conflict with the metadata is for review and which
    the path replaces where the metadata say nothing; then what a single point's metadata say; then the metadata."""
    answer = lambda r, b, v=False: F.struct((r if isinstance(r, Column) else F.lit(r)).alias("resolution"), F.lit(b).alias("basis"), F.lit(v).alias("review"))
    m = F.coalesce(metadata, F.lit(""))
    by_path = F.when(path == "daily", "daily").when(path == "monthly", "monthly").when(path == "annually_climatology", "annual").otherwise(axis)
    regular = axis.isin("daily", "monthly", "annual")
    out = F.when(override.isNotNull(), answer(override, "override"))
    out = out.when(regular & (m == ""), answer(by_path, "path")).when(regular & (m != axis), answer(axis, "time_axis_conflict", True)).when(regular, answer(axis, "time_axis"))
    out = out.when((axis == "single_point") & (m == "climatology"), answer("climatology", "single_point_metadata")).when(axis == "single_point", answer("single_point", "single_point"))
    out = out.when(axis.isin("irregular", "no_time_var", "error"), answer(axis, "time_axis"))
    return out.when(m.isin(*_RESOLUTIONS), answer(m, "metadata")).otherwise(answer("other", "none"))


@query(f"""with {STATIONS}, {_FREQ}, ax as (select cast(substr(u, 4) as bigint) i, case frequency when 'hourly' then 'daily' when 'daily' then 'daily' when 'monthly' then 'monthly' when 'quarterly' then 'monthly' when 'annual' then 'annual' else frequency end a from fq),
ov as (select * from (values {', '.join(f"({k}, '{v}')" for k, v in _REVIEWED)}) t(i, o)),
e as (select st.station_id, ax.a, ov.o, coalesce(case when resolution in ('daily', 'monthly', 'annual', 'climatology') then resolution end, '') m, split_part(path, '/', 1) p from st left join ax on ax.i = st.station_id left join ov on ov.i = st.station_id)
select station_id, case when o is not null then o when a in ('daily', 'monthly', 'annual') and m = '' then case p when 'daily' then 'daily' when 'monthly' then 'monthly' when 'annually_climatology' then 'annual' else a end when a in ('daily', 'monthly', 'annual') then a when a = 'single_point' and m = 'climatology' then 'climatology' when a = 'single_point' then 'single_point' when a = 'irregular' then 'irregular' when m <> '' then m else 'other' end as resolution,
case when o is not null then 'override' when a in ('daily', 'monthly', 'annual') and m = '' then 'path' when a in ('daily', 'monthly', 'annual') and m <> a then 'time_axis_conflict' when a in ('daily', 'monthly', 'annual') then 'time_axis' when a = 'single_point' and m = 'climatology' then 'single_point_metadata' when a = 'single_point' then 'single_point' when a = 'irregular' then 'time_axis' when m <> '' then 'metadata' else 'none' end as basis,
o is null and coalesce(a in ('daily', 'monthly', 'annual') and m <> '' and m <> a, false) as review from e""")
def evidence_with_time_axis(spark: S, sf: str) -> DataFrame:
    """The resolution of each station from reviewed answers, the steps of its own series, its metadata and its path."""
    ax = _frequencies(spark, sf)
    axis = F.when(F.col("frequency").isin("hourly", "daily"), "daily").when(F.col("frequency").isin("monthly", "quarterly"), "monthly").otherwise(F.col("frequency"))
    ax = ax.select(F.substring("source_station_uid", 4, 30).cast("bigint").alias("station_id"), axis.alias("axis"))
    o = validated_overrides(spark.createDataFrame(_REVIEWED, "station_id bigint, override string"), "station_id", "override").withColumn("station_id", F.col("station_id").cast("bigint"))
    e = stations(spark, sf).select("station_id", "resolution", "path").join(ax, "station_id", "left").join(F.broadcast(o), "station_id", "left")  # a handful of answers
    known = F.when(F.col("resolution").isin("daily", "monthly", "annual", "climatology"), F.col("resolution"))
    return e.select("station_id", arbitrated(F.col("axis"), known, F.split_part("path", F.lit("/"), F.lit(1)), F.col("override")).alias("a")).select("station_id", "a.*")


# Families of the tests' sources that a table overrides.
_FAMILIES = (("orstat", "in_situ"), ("sedibank", "secondary_compilation"), ("reacheye", "satellite"))


@query(f"""with {STATIONS}, ov as (select * from (values {', '.join(f"('{k}', '{v}')" for k, v in _FAMILIES)}) t(k, f)), fam as (select source_key, coalesce(ov.f, case when lower(coalesce(observation_type, '')) like '%satellite%' or lower(coalesce(observation_type, '')) like '%remote%' then 'satellite' when lower(coalesce(observation_type, '')) like '%climatolog%' then 'climatology' when regexp_matches(lower(coalesce(observation_type, '')), 'situ|station|gauge') then 'in_situ' else 'other' end) family, ov.f is not null overridden, station_id from st left join ov on ov.k = source_key)
select family, overridden, family not in ('satellite', 'climatology') as merged, case family when 'satellite' then 'satellite products are for validation' when 'climatology' then 'long-term means are not merged' end as reason, count(*) as n_stations from fam group by 1, 2, 3, 4""")
def source_taxonomy(spark: S, sf: str) -> DataFrame:
    """Families of the sources with a table of overrides, whether the family is merged, and the reason where not."""
    s = stations(spark, sf).select("station_id", "source_key", F.lower(F.coalesce("observation_type", F.lit(""))).alias("t"))
    o = spark.createDataFrame(_FAMILIES, "source_key string, override string")
    j = s.join(F.broadcast(o), "source_key", "left")  # a row a source that is overridden
    words = F.when(F.col("t").rlike("satellite|remote"), "satellite").when(F.col("t").rlike("climatolog"), "climatology").when(F.col("t").rlike("situ|station|gauge"), "in_situ").otherwise("other")
    f = F.coalesce("override", words)
    reason = F.when(f == "satellite", "satellite products are for validation").when(f == "climatology", "long-term means are not merged")
    return j.groupBy(f.alias("family"), F.col("override").isNotNull().alias("overridden"), (~f.isin("satellite", "climatology")).alias("merged"), reason.alias("reason")).agg(F.count("*").alias("n_stations"))


# --- match selection with names --------------------------------------------------------------------

_NM = "regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]+', '', 'g')"


@query(f"""with {CATALOG}, {_CP}, cn as (select cluster_uid, min({_NM.format('station_name')}) sn, min({_NM.format('river_name')}) rn from cat group by 1), c as (select cp.*, sn, rn from cp join cn on cn.cluster_uid = cp.cluster_uid),
k0 as (select station_uid, {_NM.format("case when lower(trim(station_name)) in ('', 'nan', 'none', 'null', 'nat', 'na', 'n/a', 'unknown', '-') then null else station_name end")} sn, {_NM.format("case when lower(trim(river_name)) in ('', 'nan', 'none', 'null', 'nat', 'na', 'n/a', 'unknown', '-') then null else river_name end")} rn, lat, lon from climatology_stations where lat between -90 and 90 and lon between -180 and 180 and not isnan(lat) and not isnan(lon)),
k as (select station_uid, min(sn) sn, min(rn) rn, min(struct_pack(la := lat, lo := lon)) p from k0 group by 1), s as (select station_uid, sn, rn, p.la lat, p.lo lon from k),
j as (select station_uid, cluster_uid, round({_D.format('s', 'c')}, 3) d, cast(s.sn <> '' and s.sn = c.sn as int) + cast(s.rn <> '' and s.rn = c.rn as int) names from s, c where abs(s.lat - c.lat) < 0.06 and {_D.format('s', 'c')} <= 5000),
r as (select *, row_number() over w k, count(*) over (partition by station_uid) n, lead(d) over w d2, lead(names) over w names2 from j window w as (partition by station_uid order by cast(d <= 10 as int) desc, names desc, d, cluster_uid))
select station_uid, cluster_uid, d as distance_m, names as name_support, n as n_candidates, case when n = 1 then 'unique' when d <= 10 and d2 > 10 then 'only_exact' when names > names2 then 'better_names' when d2 - d >= 100 or d2 / greatest(d, 1.0) >= 1.5 then 'clear' else 'ambiguous' end as decision from r where k = 1""")
def spatial_match_selection(spark: S, sf: str) -> DataFrame:
    """The cluster of each climatology station among those within 5 km: exact positions first, then support by names, then distance; taken
    if it is the only one, the only exact one, better supported or clearly nearer."""
    norm = lambda c: F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "")
    there = lambda c: F.when(~F.lower(F.trim(c)).isin("", "nan", "none", "null", "nat", "na", "n/a", "unknown", "-"), F.col(c))
    c = _cluster_positions(spark, sf).join(catalog(spark, sf).groupBy("cluster_uid").agg(F.min(norm(F.col("station_name"))).alias("csn"), F.min(norm(F.col("river_name"))).alias("crn")), "cluster_uid")
    s = table(spark, sf, "climatology_stations", "station_uid", "station_name", "river_name", "lat", "lon").filter("lat between -90 and 90 and lon between -180 and 180 and not isnan(lat) and not isnan(lon)")
    s = s.groupBy("station_uid").agg(F.min(norm(there("station_name"))).alias("sn"), F.min(norm(there("river_name"))).alias("rn"), F.min(F.struct("lat", "lon")).alias("p")).select("station_uid", "sn", "rn", F.col("p.lat").alias("slat"), F.col("p.lon").alias("slon"))
    j = within_distance(s, "slat", "slon", c, "lat", "lon", 5000.0).withColumn("d", F.round(haversine_m(F.col("slat"), F.col("slon"), F.col("lat"), F.col("lon")), 3))
    j = j.withColumn("names", ((F.col("sn") != "") & (F.col("sn") == F.col("csn"))).cast("int") + ((F.col("rn") != "") & (F.col("rn") == F.col("crn"))).cast("int"))
    # the first two of a station by partial aggregates: the best, and the best of the others
    order = F.struct((-(F.col("d") <= 10).cast("int")).alias("x"), (-F.col("names")).alias("m"), F.col("d"), F.col("cluster_uid"))
    first = j.groupBy("station_uid").agg(F.min(order).alias("f"), F.count("*").alias("n_candidates"))
    other = j.join(first.select("station_uid", F.col("f.cluster_uid").alias("_c")), "station_uid").filter("cluster_uid <> _c").groupBy("station_uid").agg(F.min(order).alias("o"))
    r = first.join(other, "station_uid", "left")
    d, d2, names, names2 = F.col("f.d"), F.col("o.d"), -F.col("f.m"), -F.col("o.m")
    why = F.when(F.col("n_candidates") == 1, "unique").when((d <= 10) & (d2 > 10), "only_exact").when(names > names2, "better_names").when((d2 - d >= 100) | (d2 / F.greatest(d, F.lit(1.0)) >= 1.5), "clear").otherwise("ambiguous")
    return r.select("station_uid", F.col("f.cluster_uid").alias("cluster_uid"), d.alias("distance_m"), names.alias("name_support"), "n_candidates", why.alias("decision"))


# --- further strata -----------------------------------------------------------------------------------


def _strata(p: DataFrame, sets: dict[str, tuple[str, ...]]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(n).alias("scope"), *[(F.col(c) if c in s else F.lit("ALL")).alias(c) for c in ("cluster_uid", "satellite_source")]) for n, s in sets.items()])
    return p.select(F.explode(rows).alias("_s"), "x", "y").select("_s.*", "x", "y")


_SCOPES = {"all": (), "by_source": ("satellite_source",), "by_cluster": ("cluster_uid",), "by_cluster_and_source": ("cluster_uid", "satellite_source")}
_LEVELS = {"all": (), "by_source": ("satellite_source",), "by_cluster_and_source": ("cluster_uid", "satellite_source")}


def _strata_sql(sets: dict[str, tuple[str, ...]]) -> str:
    part = lambda n, s: f"select '{n}' scope, {', '.join((c if c in s else repr('ALL')) + ' ' + c for c in ('cluster_uid', 'satellite_source'))}, x, y from pr"
    return f"with {PAIRED}, u as ({' union all '.join(part(n, s) for n, s in sets.items())}) select scope, cluster_uid, satellite_source, {error_metrics_sql('x', 'y', 5)} from u group by 1, 2, 3"


@query(_strata_sql(_SCOPES))
def metrics_four_scopes(spark: S, sf: str) -> DataFrame:
    return error_metrics_by(_strata(paired(spark, sf), _SCOPES), ["scope", "cluster_uid", "satellite_source"], "x", "y", 5)


@query(_strata_sql(_LEVELS))
def metrics_three_levels(spark: S, sf: str) -> DataFrame:
    # written down, as the metrics and each pass of the quantiles would join the pairs again; merged, as the small files hide how large
    # the rows of all levels are, which would be broadcast
    p = materialize(paired(spark, sf).select("cluster_uid", "satellite_source", "x", "y")).hint("merge")
    return error_metrics_by(_strata(p, _LEVELS), ["scope", "cluster_uid", "satellite_source"], "x", "y", 5)


@query(f"with {PAIRED}, d as (select cluster_uid, day, satellite_source, x, avg(y) y, count(*) n from pr group by 1, 2, 3, 4) select satellite_source, sum(n) as n_pairs, count(*) as n_collapsed, round(median(x - y), 6) as median_difference from d group by 1")
def duplicate_collapsed_median(spark: S, sf: str) -> DataFrame:
    """The median difference after references of one satellite value are collapsed into their mean."""
    d = paired(spark, sf).groupBy("cluster_uid", "day", "satellite_source", "x").agg(F.avg("y").alias("y"), F.count("*").alias("n"))
    g = d.groupBy("satellite_source").agg(F.sum("n").alias("n_pairs"), F.count("*").alias("n_collapsed"))
    return with_quantiles(g, d, ["satellite_source"], {"median_difference": (F.col("x") - F.col("y"), 0.5)})


@query(f"with {CATALOG}, {OBS}, a as (select cluster_uid, n_source_stations_in_cluster n from (select *, row_number() over (partition by cluster_uid order by exported_at desc nulls last, catalog_row_id) k from cat where n_source_stations_in_cluster is not null) where k = 1), b as (select cluster_uid, count(distinct source_station_uid) m from obs group by 1) select coalesce(a.cluster_uid, b.cluster_uid) as cluster_uid, n as listed, m as found, case when b.cluster_uid is null then 'listed_only' when a.cluster_uid is null then 'found_only' when n <> m then 'contradiction' else 'agree' end as state from a full join b on a.cluster_uid = b.cluster_uid")
def inventory_mismatches(spark: S, sf: str) -> DataFrame:
    """What the catalogue lists for a cluster against what the product holds."""
    a = catalog(spark, sf).filter("n_source_stations_in_cluster is not null").groupBy("cluster_uid").agg(F.max_by("n_source_stations_in_cluster", F.struct(F.coalesce(F.unix_micros("exported_at"), F.lit(-(2**62))), -F.col("catalog_row_id"))).alias("listed"))
    b = table(spark, sf, "daily_matrix", "cluster_uid", "source_station_uid").distinct().groupBy(F.col("cluster_uid").alias("_c")).agg(F.count("source_station_uid").alias("found"))
    j = a.join(b, F.col("cluster_uid") == F.col("_c"), "full")
    state = F.when(F.col("_c").isNull(), "listed_only").when(F.col("cluster_uid").isNull(), "found_only").when(F.col("listed") != F.col("found"), "contradiction").otherwise("agree")
    return j.select(F.coalesce("cluster_uid", "_c").alias("cluster_uid"), "listed", "found", state.alias("state"))
