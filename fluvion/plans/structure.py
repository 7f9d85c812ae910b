"""Graphs and clustering, set operations, reshaping, integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvion.functions.geo import haversine_m
from fluvion.operators import checks
from fluvion.operators.graph import complete_linkage, edges_from_columns, reach, relation
from fluvion.plans.common import CATALOG, OBS, STATIONS, catalog, observations, stations
from fluvion.plans.registry import query
from fluvion.sources.tables import table

S = SparkSession

# --- graphs ------------------------------------------------------------------------------------
# a binary river tree over the parts: reach n flows into reach n / 2


@query("with recursive w(start, node, hops) as (select p_partkey, p_partkey, 0 from part union all select start, node // 2, hops + 1 from w where node > 1) select start, node, hops from w")
def downstream_walk(spark: S, sf: str) -> DataFrame:
    p = table(spark, sf, "part", "p_partkey")
    tree = p.select("p_partkey", F.floor(F.col("p_partkey") / 2).alias("down"))
    return reach(edges_from_columns(tree, "p_partkey", ["down"]), p, "p_partkey", 64)


_TREE = "e as (select p_partkey // 2 src, p_partkey dst from part where p_partkey > 1)"


@query(f"with recursive {_TREE}, w(start, node, hops) as (select s_suppkey, s_suppkey, 0 from supplier union all select w.start, e.dst, w.hops + 1 from w join e on e.src = w.node where w.hops < 3) select start, node, hops from w")
def bounded_hops(spark: S, sf: str) -> DataFrame:
    """Reaches up to three confluences upstream of each supplier's reach."""
    p = table(spark, sf, "part", "p_partkey").filter("p_partkey > 1")
    e = p.select(F.floor(F.col("p_partkey") / 2).alias("src"), F.col("p_partkey").alias("dst"))
    return reach(e, table(spark, sf, "supplier", "s_suppkey"), "s_suppkey", 3)


@query(f"""with recursive {_TREE}, pairs as (select ps.s_suppkey a, ps.s_suppkey * 4 + 1 b from supplier ps), up(a, node, hops) as (select a, a, 0 from pairs union all select up.a, e.dst, up.hops + 1 from up join e on e.src = up.node where up.hops < 2),
u as (select a, node b, min(hops) h from up group by 1, 2) select pairs.a, pairs.b, case when u.h is not null then 'upstream' when exists (select 1 from up join e on e.src = up.node where up.a = pairs.a and up.hops = 2) or pairs.a // 4 > 1 then 'unknown' else 'none' end as relation, u.h as hops from pairs left join u on u.a = pairs.a and u.b = pairs.b""")
def pair_relation(spark: S, sf: str) -> DataFrame:
    p = table(spark, sf, "part", "p_partkey").filter("p_partkey > 1")
    e = p.select(F.floor(F.col("p_partkey") / 2).alias("src"), F.col("p_partkey").alias("dst"))
    pairs = table(spark, sf, "supplier", "s_suppkey").select(F.col("s_suppkey").alias("a"), (F.col("s_suppkey") * 4 + 1).alias("b"))
    return relation(e, pairs, "a", "b", 2)


@query(None)
def greedy_complete_linkage(spark: S, sf: str) -> DataFrame:
    """Stations of a river merged by complete linkage (held against a brute-force version in the tests)."""
    s = stations(spark, sf).withColumn("status", F.lit("resolved"))
    return complete_linkage(s, "station_id", "river_name", "status", "lat", "lon", "reported_area", "observation_type")


@query(f"with {CATALOG}, r as (select *, row_number() over (partition by cluster_uid order by basin_area desc nulls last, catalog_row_id) k from cat where lat is not null) select cluster_uid, catalog_row_id, lat, lon from r where k = 1")
def anchor_choice(spark: S, sf: str) -> DataFrame:
    """The end point of each cluster's reach to stand on: the largest area, then the first."""
    c = catalog(spark, sf).filter("lat is not null").groupBy("cluster_uid")
    return c.agg(F.min_by(F.struct("catalog_row_id", "lat", "lon"), F.struct(-F.coalesce("basin_area", F.lit(-1.0)), "catalog_row_id")).alias("t")).select("cluster_uid", "t.*")


@query(f"with {CATALOG}, m as (select cluster_uid, max(lat) - min(lat) dlat, max(basin_area) hi, min(basin_area) lo, count(*) n from cat group by 1) select cluster_uid, n, coalesce(dlat <= 0.01, true) as near, coalesce((hi - lo) / hi <= 0.1, true) as alike from m")
def clustering_audit(spark: S, sf: str) -> DataFrame:
    """Whether the rows of a cluster stay within the clustering's limits, from their extremes."""
    g = catalog(spark, sf).groupBy("cluster_uid").agg(F.count("*").alias("n"), (F.max("lat") - F.min("lat")).alias("dlat"), F.max("basin_area").alias("hi"), F.min("basin_area").alias("lo"))
    return g.select("cluster_uid", "n", F.coalesce(F.col("dlat") <= 0.01, F.lit(True)).alias("near"), F.coalesce((F.col("hi") - F.col("lo")) / F.col("hi") <= 0.1, F.lit(True)).alias("alike"))


# --- set operations ----------------------------------------------------------------------------


@query("select 'satellite' as kind, trim(source) as source, cast(satellite_time as date) as day, satellite_ssc as value, null as sample_id from (select distinct satellite_record_id, source, satellite_time, satellite_ssc from satellite_obs) union all select 'insitu', trim(source), cast(insitu_time as date), insitu_ssc, insitu_record_id from (select distinct insitu_record_id, source, insitu_time, insitu_ssc from insitu_obs)")
def union_by_name(spark: S, sf: str) -> DataFrame:
    s = table(spark, sf, "satellite_obs", "satellite_record_id", "source", "satellite_time", "satellite_ssc").distinct()
    i = table(spark, sf, "insitu_obs", "insitu_record_id", "source", "insitu_time", "insitu_ssc").distinct()
    s = s.select(F.lit("satellite").alias("kind"), F.trim("source").alias("source"), F.to_date("satellite_time").alias("day"), F.col("satellite_ssc").alias("value"))
    i = i.select(F.lit("insitu").alias("kind"), F.trim("source").alias("source"), F.to_date("insitu_time").alias("day"), F.col("insitu_ssc").alias("value"), F.col("insitu_record_id").alias("sample_id"))
    return s.unionByName(i, allowMissingColumns=True)


@query("select obs_date as day from daily_matrix union select cast(satellite_time as date) from satellite_obs")
def distinct_dates(spark: S, sf: str) -> DataFrame:
    return table(spark, sf, "daily_matrix", "obs_date").select(F.col("obs_date").alias("day")).union(table(spark, sf, "satellite_obs", "satellite_time").select(F.to_date("satellite_time"))).distinct()


@query(f"with {CATALOG} select cluster_uid, 'catalog_only' as side from (select cluster_uid from cat except select cluster_uid from daily_matrix) union all select cluster_uid, 'daily_only' from (select cluster_uid from daily_matrix except select cluster_uid from cat)")
def except_both_ways(spark: S, sf: str) -> DataFrame:
    c, d = catalog(spark, sf).select("cluster_uid"), table(spark, sf, "daily_matrix", "cluster_uid")
    return c.subtract(d).withColumn("side", F.lit("catalog_only")).unionByName(d.subtract(c).withColumn("side", F.lit("daily_only")))


@query("select upper(trim(cluster_uid)) as cluster_uid from satellite_obs intersect select upper(trim(cluster_uid)) from insitu_obs")
def intersect_keys(spark: S, sf: str) -> DataFrame:
    k = lambda t: table(spark, sf, t, "cluster_uid").select(F.upper(F.trim("cluster_uid")).alias("cluster_uid"))
    return k("satellite_obs").intersect(k("insitu_obs"))


@query("select count(distinct satellite_record_id) as n_near from satellite_obs s where exists (select 1 from insitu_obs i where upper(trim(i.cluster_uid)) = upper(trim(s.cluster_uid)) and abs(date_diff('day', cast(i.insitu_time as date), cast(s.satellite_time as date))) <= 2)")
def dilated_semi_join(spark: S, sf: str) -> DataFrame:
    """Satellite records with a sample in the cluster at most two days away, by spreading each sample over five days."""
    key = F.upper(F.trim("cluster_uid")).alias("c")
    s = table(spark, sf, "satellite_obs", "satellite_record_id", "cluster_uid", "satellite_time").select("satellite_record_id", key, F.to_date("satellite_time").alias("day"))
    i = table(spark, sf, "insitu_obs", "cluster_uid", "insitu_time").select(key, F.to_date("insitu_time").alias("d")).distinct()
    i = i.select("c", F.explode(F.sequence(F.date_sub("d", 2), F.date_add("d", 2))).alias("day")).distinct()
    return s.join(i, ["c", "day"], "left_semi").agg(F.countDistinct("satellite_record_id").alias("n_near"))


@query(f"with {CATALOG}, c as (select cluster_uid, list_sort(list_distinct(flatten(list(string_split(sources_used, '|'))))) a from cat where sources_used is not null group by 1), d as (select cluster_uid, list_sort(list_distinct(list(source))) b from daily_matrix group by 1) select c.cluster_uid, len(list_intersect(a, b)) as shared, len(list_intersect(a, b)) > 0 as overlaps, len(list_distinct(list_concat(a, b))) as n_all from c join d on c.cluster_uid = d.cluster_uid")
def source_set_overlap(spark: S, sf: str) -> DataFrame:
    c = catalog(spark, sf).filter("sources_used is not null").groupBy("cluster_uid").agg(F.array_distinct(F.flatten(F.collect_set(F.split("sources_used", r"\|")))).alias("a"))
    d = table(spark, sf, "daily_matrix", "cluster_uid", "source").groupBy("cluster_uid").agg(F.collect_set("source").alias("b"))
    j = c.join(d, "cluster_uid")
    return j.select("cluster_uid", F.size(F.array_intersect("a", "b")).cast("bigint").alias("shared"), F.arrays_overlap("a", "b").alias("overlaps"), F.size(F.array_union("a", "b")).cast("bigint").alias("n_all"))


# --- reshaping ---------------------------------------------------------------------------------


@query(f"with {OBS} select cluster_uid, {', '.join(f'round(avg(case when month(obs_date) = {m} then ssc end), 6) as m{m:02d}' for m in range(1, 13))} from obs group by 1")
def pivot_matrix(spark: S, sf: str) -> DataFrame:
    """Mean concentration by cluster and month, months as columns (a fixed list, so no pass to find them)."""
    o = observations(spark, sf).withColumn("m", F.date_format("obs_date", "'m'MM"))
    p = o.groupBy("cluster_uid").pivot("m", [f"m{m:02d}" for m in range(1, 13)]).agg(F.avg("ssc"))
    return p.select("cluster_uid", *[F.round(f"m{m:02d}", 6).alias(f"m{m:02d}") for m in range(1, 13)])


@query(f"with {OBS} select * from (select record_id, 'q' as variable, q as value from obs union all select record_id, 'ssc', ssc from obs union all select record_id, 'ssl', ssl from obs) where value is not null")
def unpivot_long(spark: S, sf: str) -> DataFrame:
    return observations(spark, sf).unpivot("record_id", ["q", "ssc", "ssl"], "variable", "value").filter("value is not null")


@query("select trim(source) as source, count(*) filter (split_part(path, '/', 1) = 'daily') as daily, count(*) filter (split_part(path, '/', 1) = 'monthly') as monthly, count(*) filter (split_part(path, '/', 1) = 'annual') as annual from source_stations group by 1")
def pivot_counts(spark: S, sf: str) -> DataFrame:
    s = table(spark, sf, "source_stations", "source", "path").select(F.trim("source").alias("source"), F.split_part("path", F.lit("/"), F.lit(1)).alias("r"))
    return s.groupBy("source").pivot("r", ["daily", "monthly", "annual"]).agg(F.count(F.lit(1))).na.fill(0)


@query(f"with {CATALOG} select catalog_row_id, unnest(string_split(sources_used, '|')) as source from cat where sources_used is not null")
def pipe_explode(spark: S, sf: str) -> DataFrame:
    return catalog(spark, sf).filter("sources_used is not null").select("catalog_row_id", F.explode(F.split("sources_used", r"\|")).alias("source"))


@query("select 'rows' as metric, cast(count(*) as double) as value from lineitem union all select 'quantity', cast(sum(l_quantity) as double) from lineitem union all select 'orders', cast(count(distinct l_orderkey) as double) from lineitem")
def eav_summary(spark: S, sf: str) -> DataFrame:
    g = table(spark, sf, "lineitem", "l_quantity", "l_orderkey").agg(F.count("*").cast("double").alias("rows"), F.sum("l_quantity").cast("double").alias("quantity"), F.countDistinct("l_orderkey").cast("double").alias("orders"))
    return g.unpivot([], ["rows", "quantity", "orders"], "metric", "value")


# --- checks ------------------------------------------------------------------------------------


@query(f"""with {OBS}, {CATALOG}, r as (select 'date_present' as "check", count(*) filter (obs_date is null) n from obs union all select 'cluster_present', count(*) filter (cluster_uid is null) from obs union all select 'uid_well_formed', count(*) filter (not regexp_full_match(cluster_uid, 'SED[0-9]{{6,}}')) from obs
 union all select 'flag_in_range', count(*) filter (ssc_flag not in (0, 1, 2, 3, 9)) from obs union all select 'not_negative', count(*) filter (ssc < 0 or q < 0 or ssl < 0) from obs union all select 'record_unique', (select count(*) from (select record_id from obs group by 1 having count(*) > 1)) union all select 'cluster_in_catalog', (select count(distinct cluster_uid) from obs where cluster_uid is not null and cluster_uid not in (select cluster_uid from cat)))
select "check", case when n = 0 then 'pass' else 'fail' end as status, n as details from r""")
def release_checks(spark: S, sf: str) -> DataFrame:
    o = observations(spark, sf)
    c = F.col
    rows = checks.counted(o, {"date_present": c("obs_date").isNull(), "cluster_present": c("cluster_uid").isNull(), "uid_well_formed": ~c("cluster_uid").rlike("^SED[0-9]{6,}$"), "flag_in_range": ~c("ssc_flag").isin(0, 1, 2, 3, 9), "not_negative": (c("ssc") < 0) | (c("q") < 0) | (c("ssl") < 0)})
    return checks.together(rows, checks.unique(o, "record_unique", "record_id"), checks.contained(o, catalog(spark, sf), "cluster_in_catalog", "cluster_uid"))


@query(f"with {OBS}, {CATALOG}, a as (select cluster_uid, count(*) n, min(obs_date) first_day, max(obs_date) last_day from obs where ssc is not null or ssl is not null group by 1), b as (select cluster_uid, count(distinct catalog_row_id) n_cat from cat group by 1) select coalesce(a.cluster_uid, b.cluster_uid) as cluster_uid, n, n_cat, first_day, last_day, case when a.cluster_uid is null then 'no_records' when b.cluster_uid is null then 'no_catalog' else 'ok' end as status from a full join b on a.cluster_uid = b.cluster_uid")
def product_reconciliation(spark: S, sf: str) -> DataFrame:
    a = observations(spark, sf).filter("ssc is not null or ssl is not null").groupBy(F.col("cluster_uid").alias("ca")).agg(F.count("*").alias("n"), F.min("obs_date").alias("first_day"), F.max("obs_date").alias("last_day"))
    b = catalog(spark, sf).groupBy(F.col("cluster_uid").alias("cb")).agg(F.count("*").alias("n_cat"))
    j = a.join(b, F.col("ca") == F.col("cb"), "full")
    status = F.when(F.col("ca").isNull(), "no_records").when(F.col("cb").isNull(), "no_catalog").otherwise("ok")
    return j.select(F.coalesce("ca", "cb").alias("cluster_uid"), "n", "n_cat", "first_day", "last_day", status.alias("status"))


@query(f"with {CATALOG}, g as (select cluster_uid, count(distinct country) nc, count(distinct continent_region) nr from cat group by 1) select 'country' as field, count(*) filter (nc > 1) as n_conflicts, count(*) as n from g union all select 'continent_region', count(*) filter (nr > 1), count(*) from g")
def geo_consistency(spark: S, sf: str) -> DataFrame:
    g = catalog(spark, sf).groupBy("cluster_uid").agg(*[(F.min(f) != F.max(f)).alias(f) for f in ("country", "continent_region")])
    return g.agg(F.count("*").alias("n"), *[F.count_if(F.coalesce(F.col(f), F.lit(False))).alias(f) for f in ("country", "continent_region")]).unpivot(["n"], ["country", "continent_region"], "field", "n_conflicts").select("field", "n_conflicts", "n")


@query("select column_name, n_source, n_climatology from (values ('station_name', 1, 1), ('river_name', 1, 1), ('lat', 1, 1), ('path', 1, 0), ('q', 0, 1)) t(column_name, n_source, n_climatology)")
def attribute_parity(spark: S, sf: str) -> DataFrame:
    """Which of the named attributes each of two tables carries, from their schemas."""
    a, b = table(spark, sf, "source_stations").columns, table(spark, sf, "climatology_stations").columns
    return spark.createDataFrame([(c, int(c in a), int(c in b)) for c in ("station_name", "river_name", "lat", "path", "q")], "column_name string, n_source int, n_climatology int")


@query(f"with {STATIONS}, g as (select source_key, count(distinct resolution) n, max(lat) - min(lat) spread from st group by 1) select source_key, n as n_resolutions, coalesce(spread <= 1e-4, true) as same_place from g")
def structural_consistency(spark: S, sf: str) -> DataFrame:
    g = stations(spark, sf).groupBy("source_key").agg(F.countDistinct("resolution").alias("n_resolutions"), (F.max("lat") - F.min("lat")).alias("spread"))
    return g.select("source_key", "n_resolutions", F.coalesce(F.col("spread") <= 1e-4, F.lit(True)).alias("same_place"))


@query(f"with {CATALOG}, m as (select source_station_id, count(distinct cluster_uid) n from cat where source_station_id is not null group by 1) select count(*) filter (n > 1) as in_several_clusters, count(*) as n_members from m")
def membership_integrity(spark: S, sf: str) -> DataFrame:
    m = catalog(spark, sf).filter("source_station_id is not null").groupBy("source_station_id").agg((F.min("cluster_uid") != F.max("cluster_uid")).alias("several"))
    return m.agg(F.count_if("several").alias("in_several_clusters"), F.count("*").alias("n_members"))


# --- look-ups ----------------------------------------------------------------------------------


@query(f"with {CATALOG}, {OBS} select cluster_uid, 'catalog' as product, count(*) as n from cat where cluster_uid = 'SED000017' group by 1 union all select cluster_uid, 'daily', count(*) from obs where cluster_uid = 'SED000017' group by 1 union all select upper(trim(cluster_uid)), 'satellite', count(distinct satellite_record_id) from satellite_obs where upper(trim(cluster_uid)) = 'SED000017' group by 1")
def cluster_lookup(spark: S, sf: str) -> DataFrame:
    """What each product holds of one cluster (a point look-up: the filter on the key is the feature)."""
    uid = "SED000017"
    c = catalog(spark, sf).filter(F.col("cluster_uid") == uid).groupBy("cluster_uid").agg(F.count("*").alias("n")).withColumn("product", F.lit("catalog"))
    d = table(spark, sf, "daily_matrix", "cluster_uid", "record_id").filter(F.col("cluster_uid") == uid).groupBy("cluster_uid").agg(F.countDistinct("record_id").alias("n")).withColumn("product", F.lit("daily"))
    s = table(spark, sf, "satellite_obs", "cluster_uid", "satellite_record_id").withColumn("cluster_uid", F.upper(F.trim("cluster_uid"))).filter(F.col("cluster_uid") == uid).groupBy("cluster_uid").agg(F.countDistinct("satellite_record_id").alias("n")).withColumn("product", F.lit("satellite"))
    return c.unionByName(d).unionByName(s).select("cluster_uid", "product", "n")


@query(f"with {OBS} select cluster_uid, count(ssc) as n_ssc, round(100.0 * count(ssc) / count(*), 6) as pct_ssc, min(case when ssc is not null then obs_date end) as first_ssc, max(case when ssc is not null then obs_date end) as last_ssc from obs group by 1")
def matrix_availability(spark: S, sf: str) -> DataFrame:
    day = F.when(F.col("ssc").isNotNull(), F.col("obs_date"))
    g = observations(spark, sf).groupBy("cluster_uid")
    return g.agg(F.count("ssc").alias("n_ssc"), F.round(100.0 * F.count("ssc") / F.count("*"), 6).alias("pct_ssc"), F.min(day).alias("first_ssc"), F.max(day).alias("last_ssc"))


@query(f"with {STATIONS}, t as (select source_station_id i, lower(station_name) n, regexp_extract(path, '([0-9]+)', 1) p from st order by station_id limit 1) select station_id, source_key, case when source_station_id = i then 'id' when lower(station_name) = n then 'name' else 'path' end as matched_by from st, t where source_station_id = i or lower(station_name) = n or contains(path, p)")
def station_cascade(spark: S, sf: str) -> DataFrame:
    """The first station of all, looked up by its native id, then its name, then the number in its path."""
    s = stations(spark, sf)
    t = s.agg(F.min_by(F.struct(F.col("source_station_id").alias("i"), F.lower("station_name").alias("n"), F.regexp_extract("path", "([0-9]+)", 1).alias("p")), "station_id").alias("t")).select("t.*")  # one row
    same = lambda c: F.coalesce(c, F.lit(False))
    by_id, by_name, by_path = same(F.col("source_station_id") == F.col("i")), same(F.lower("station_name") == F.col("n")), same(F.col("path").contains(F.col("p")))
    return s.join(F.broadcast(t)).filter(by_id | by_name | by_path).select("station_id", "source_key", F.when(by_id, "id").when(by_name, "name").otherwise("path").alias("matched_by"))


@query(f"with {STATIONS} select station_id, round(2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(lat - 45) / 2), 2) + cos(radians(45)) * cos(radians(lat)) * pow(sin(radians(lon - 66) / 2), 2)))), 4) as distance_km from st where lat is not null order by 2, 1 limit 5")
def nearest_station(spark: S, sf: str) -> DataFrame:
    """The five stations nearest to a place (a top-k)."""
    d = F.round(haversine_m(F.lit(45.0), F.lit(66.0), F.col("lat"), F.col("lon"), 6_371_000.0) / 1000, 4)
    return stations(spark, sf).filter("lat is not null").select("station_id", d.alias("distance_km")).orderBy("distance_km", "station_id").limit(5)


@query("select station_uid, year_start, year_end, round(q * ssc * 0.0864, 6) as load_t_day from (select distinct station_uid, year_start, year_end, q, ssc from climatology_stations) where q is not null and ssc is not null and not isnan(q) and not isnan(ssc)")
def climatology_export(spark: S, sf: str) -> DataFrame:
    c = table(spark, sf, "climatology_stations", "station_uid", "year_start", "year_end", "q", "ssc").distinct().filter("q is not null and ssc is not null and not isnan(q) and not isnan(ssc)")
    return c.select("station_uid", "year_start", "year_end", F.round(F.col("q") * F.col("ssc") * 0.0864, 6).alias("load_t_day"))


@query(f"with {OBS}, d as (select obs_date, avg(ssc) v from obs where ssc is not null group by 1), e as (select cast(ts as date) as day, avg(value) m from events group by 1) select obs_date, round(v, 6) as observed, round(m, 6) as modelled from d join e on obs_date = day")
def usage_workflow(spark: S, sf: str) -> DataFrame:
    """A daily mean aligned with another series by day."""
    d = observations(spark, sf).filter("ssc is not null").groupBy("obs_date").agg(F.round(F.avg("ssc"), 6).alias("observed"))
    e = table(spark, sf, "events", "ts", "value").groupBy(F.to_date("ts").alias("obs_date")).agg(F.round(F.avg("value"), 6).alias("modelled"))
    return d.join(e, "obs_date")
