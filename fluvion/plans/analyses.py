"""Further analyses: overlap of sources, sweeps, membership, reviews, attrition, audits and extremes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluvion.functions.domain import percent
from fluvion.operators.metrics import error_metrics_by, error_metrics_sql
from fluvion.plans.common import CATALOG, OBS, PAIRED, STATIONS, catalog, observations, paired, stations
from fluvion.plans.registry import query
from fluvion.sources.tables import table

S = SparkSession

# days on which two sources of a cluster both have a concentration: a source has one mean a day, so a day has few rows
_DAYS = f"{OBS}, dm as (select cluster_uid, source, obs_date, avg(ssc) v from obs where ssc is not null group by 1, 2, 3), op as (select a.cluster_uid, a.source sa, b.source sb, a.obs_date, a.v x, b.v y from dm a join dm b on a.cluster_uid = b.cluster_uid and a.obs_date = b.obs_date and a.source < b.source)"


def _overlap(spark: S, sf: str) -> DataFrame:
    d = observations(spark, sf).filter("ssc is not null").groupBy("cluster_uid", "source", "obs_date").agg(F.avg("ssc").alias("v"))
    a = d.select("cluster_uid", "obs_date", F.col("source").alias("sa"), F.col("v").alias("x"))
    b = d.select("cluster_uid", "obs_date", F.col("source").alias("sb"), F.col("v").alias("y"))
    return a.join(b, ["cluster_uid", "obs_date"]).filter("sa < sb")


_TP = f"{_DAYS}, tp as (select cluster_uid, sa, sb, count(*) n_days, count(distinct date_trunc('month', obs_date)) n_months, count(distinct year(obs_date)) n_years, avg(case when abs(x - y) <= 1e-9 then 1.0 else 0.0 end) exact, avg(case when abs(x - y) <= 0.05 * abs(y) then 1.0 else 0.0 end) near from op group by 1, 2, 3)"
_PRIO = "case when exact >= 0.9 then 'duplicate' when near >= 0.5 then 'high' when n_days >= 30 then 'medium' else 'low' end"


def _temporal_pairs(spark: S, sf: str) -> DataFrame:
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    gap = F.abs(F.col("x") - F.col("y"))
    g = _overlap(spark, sf).groupBy("cluster_uid", "sa", "sb").agg(F.count("*").alias("n_days"), F.countDistinct(F.trunc("obs_date", "MM")).alias("n_months"), F.countDistinct(F.year("obs_date")).alias("n_years"), share(gap <= 1e-9).alias("exact"), share(gap <= 0.05 * F.abs("y")).alias("near"))
    return g.withColumn("priority", F.when(F.col("exact") >= 0.9, "duplicate").when(F.col("near") >= 0.5, "high").when(F.col("n_days") >= 30, "medium").otherwise("low"))


@query(f"with {_TP} select cluster_uid, sa as source_a, sb as source_b, n_days, n_months, n_years, round(exact, 6) as exact, round(near, 6) as near, {_PRIO} as priority from tp")
def temporal_pair_evaluation(spark: S, sf: str) -> DataFrame:
    t = _temporal_pairs(spark, sf)
    return t.select("cluster_uid", F.col("sa").alias("source_a"), F.col("sb").alias("source_b"), "n_days", "n_months", "n_years", F.round("exact", 6).alias("exact"), F.round("near", 6).alias("near"), "priority")


@query(f"with {_TP} select sa as source_a, sb as source_b, count(*) as n_clusters, cast(sum(n_days) as bigint) as n_days, round(sum(exact * n_days) / sum(n_days), 6) as exact_weighted from tp group by 1, 2")
def source_pair_summary(spark: S, sf: str) -> DataFrame:
    g = _temporal_pairs(spark, sf).groupBy(F.col("sa").alias("source_a"), F.col("sb").alias("source_b"))
    return g.agg(F.count("*").alias("n_clusters"), F.sum("n_days").alias("n_days"), F.round(F.sum(F.col("exact") * F.col("n_days")) / F.sum("n_days"), 6).alias("exact_weighted"))


@query(f"with {_TP} select cluster_uid, sa as source_a, sb as source_b, {_PRIO} as priority, row_number() over (order by case {_PRIO} when 'duplicate' then 0 when 'high' then 1 when 'medium' then 2 else 3 end, n_days desc, cluster_uid, sa, sb) - 1 as position from tp")
def review_queue(spark: S, sf: str) -> DataFrame:
    """Pairs in order of priority; positions from a range-partitioned sort."""
    from fluvion.operators.ordering import global_number

    t = _temporal_pairs(spark, sf)
    o = F.when(F.col("priority") == "duplicate", 0).when(F.col("priority") == "high", 1).when(F.col("priority") == "medium", 2).otherwise(3)
    n = global_number(t.select("cluster_uid", "sa", "sb", "priority", "n_days"), [o, -F.col("n_days"), F.col("cluster_uid"), F.col("sa"), F.col("sb")], "position")
    return n.select("cluster_uid", F.col("sa").alias("source_a"), F.col("sb").alias("source_b"), "priority", "position")


@query(f"with {_DAYS} select sa as source_a, sb as source_b, {error_metrics_sql('x', 'y', 4)} from op group by 1, 2")
def source_pair_metrics(spark: S, sf: str) -> DataFrame:
    return error_metrics_by(_overlap(spark, sf).select(F.col("sa").alias("source_a"), F.col("sb").alias("source_b"), "x", "y"), ["source_a", "source_b"], "x", "y", 4)


@query(f"with {OBS} select cluster_uid, count(distinct source_station_uid) as n_series, count(*) as n, year(min(obs_date)) as first_year, year(max(obs_date)) as last_year from obs group by 1")
def matrix_inventory(spark: S, sf: str) -> DataFrame:
    return observations(spark, sf).groupBy("cluster_uid").agg(F.countDistinct("source_station_uid").alias("n_series"), F.count("*").alias("n"), F.year(F.min("obs_date")).alias("first_year"), F.year(F.max("obs_date")).alias("last_year"))


@query(f"with {PAIRED} select satellite_record_id, insitu_record_id, case when x < 0 or y < 0 then 'negative' when y = 0 then 'zero_reference' else 'used' end as audit from pr")
def pair_audit(spark: S, sf: str) -> DataFrame:
    a = F.when((F.col("x") < 0) | (F.col("y") < 0), "negative").when(F.col("y") == 0, "zero_reference").otherwise("used")
    return paired(spark, sf).select("satellite_record_id", "insitu_record_id", a.alias("audit"))


@query(f"with {CATALOG}, {STATIONS}, u as (select cluster_uid as uid, 'catalog' as product, station_name, lat from cat union all select 'ST' || station_id, 'station', station_name, lat from st union all select distinct station_uid, 'climatology', case when lower(trim(station_name)) in ('', 'nan', 'none', 'null', 'nat', 'na', 'n/a', 'n.a.', 'n.a', '<na>', 'unknown', 'unk', 'missing', 'not available', 'not known', 'undefined', '-', '--', '---', '?', '??', '.', '...', '_', 'x', '-9999', '-999', '#n/a') then null else trim(station_name) end, case when lat between -90 and 90 and not isnan(lat) then lat end from climatology_stations) select uid, product, count(*) as n, min(station_name) as name, round(min(lat), 6) as lat from u group by 1, 2")
def station_dimension(spark: S, sf: str) -> DataFrame:
    """One dimension from three products."""
    from fluvion.functions.text import clean_text

    a = catalog(spark, sf).select(F.col("cluster_uid").alias("uid"), F.lit("catalog").alias("product"), "station_name", "lat")
    b = stations(spark, sf).select(F.concat(F.lit("ST"), F.col("station_id").cast("string")).alias("uid"), F.lit("station").alias("product"), "station_name", "lat")
    c = table(spark, sf, "climatology_stations", "station_uid", "station_name", "lat").select(F.col("station_uid").alias("uid"), F.lit("climatology").alias("product"), clean_text("station_name").alias("station_name"), F.when(F.col("lat").between(-90, 90) & ~F.isnan("lat"), F.col("lat")).alias("lat")).distinct()
    return a.unionByName(b).unionByName(c).groupBy("uid", "product").agg(F.count("*").alias("n"), F.min("station_name").alias("name"), F.round(F.min("lat"), 6).alias("lat"))


@query(f"with {OBS}, s as (select cluster_uid, count(distinct source_station_uid) size from obs group by 1) select size, count(*) as n_clusters, round(100.0 * count(*) / sum(count(*)) over (), 6) as pct from s group by 1")
def cluster_inventory(spark: S, sf: str) -> DataFrame:
    s = observations(spark, sf).groupBy("cluster_uid").agg(F.countDistinct("source_station_uid").alias("size")).groupBy("size").agg(F.count("*").alias("n_clusters"))
    return s.withColumn("pct", F.round(100.0 * F.col("n_clusters") / F.sum("n_clusters").over(W.partitionBy()), 6))


@query(f"with {OBS}, d as (select cluster_uid, obs_date, count(distinct source) k from obs group by 1, 2) select cluster_uid, count(*) as n_days, count(*) filter (k > 1) as n_shared_days, round(100.0 * count(*) filter (k > 1) / count(*), 6) as pct_shared from d group by 1")
def exact_date_overlap(spark: S, sf: str) -> DataFrame:
    d = observations(spark, sf, ("cluster_uid", "obs_date")).groupBy("cluster_uid", "obs_date").agg(F.countDistinct("source").alias("k"))
    return d.groupBy("cluster_uid").agg(F.count("*").alias("n_days"), F.count_if(F.col("k") > 1).alias("n_shared_days"), percent(F.count_if(F.col("k") > 1), F.count("*")).alias("pct_shared"))


@query("with l as (select distinct satellite_station_id, representative_point_distance_m d, linked_cluster_id c, satellite_uparea_merit a from satellite_links), sc as (select * from (values ('strict', 300, 500.0), ('default', 1000, 1000.0), ('loose', 5000, 1e12)) t(scenario, dist, area)) select scenario, count(*) filter (c is not null and d <= dist and coalesce(a, 0) <= area) as resolved, count(*) filter (c is not null and d > dist) as too_far, count(*) as n from l, sc group by 1")
def policy_scenarios(spark: S, sf: str) -> DataFrame:
    """The linking policy under three sets of limits, in one pass over the table."""
    l = table(spark, sf, "satellite_links", "satellite_station_id", "representative_point_distance_m", "linked_cluster_id", "satellite_uparea_merit").distinct()
    d, ok, a = F.col("representative_point_distance_m"), F.col("linked_cluster_id").isNotNull(), F.coalesce("satellite_uparea_merit", F.lit(0.0))
    rows = F.array(*[F.struct(F.lit(s).alias("scenario"), F.count_if(ok & (d <= m) & (a <= x)).alias("resolved"), F.count_if(ok & (d > m)).alias("too_far"), F.count("*").alias("n")) for s, m, x in (("strict", 300, 500.0), ("default", 1000, 1000.0), ("loose", 5000, 1e12))])
    return l.agg(rows.alias("r")).select(F.explode("r").alias("r")).select("r.*")


@query("with l as (select distinct satellite_station_id, representative_point_distance_m d, linked_cluster_id c from satellite_links) select count(*) filter ((d <= 300) = (d <= 1000)) as agree, count(*) filter (d <= 1000 and d > 300) as gained, round(100.0 * count(*) filter ((d <= 300) = (d <= 1000)) / count(*), 6) as agree_pct from l where c is not null and d is not null")
def scenario_comparison(spark: S, sf: str) -> DataFrame:
    l = table(spark, sf, "satellite_links", "satellite_station_id", "representative_point_distance_m", "linked_cluster_id").distinct().filter("linked_cluster_id is not null and representative_point_distance_m is not null")
    d = F.col("representative_point_distance_m")
    same = F.count_if((d <= 300) == (d <= 1000))
    return l.agg(same.alias("agree"), F.count_if((d <= 1000) & (d > 300)).alias("gained"), percent(same, F.count("*")).alias("agree_pct"))


@query("select satellite_station_id, min_by(linked_cluster_id, (representative_point_distance_m, linked_cluster_id)) as nearest, min_by(linked_cluster_id, (case when link_confidence = 'high' then 0 else 1 end, representative_point_distance_m, linked_cluster_id)) as preferred from satellite_links where linked_cluster_id is not null and representative_point_distance_m is not null group by 1")
def candidate_retention(spark: S, sf: str) -> DataFrame:
    """The candidate that each of two rules would keep."""
    l = table(spark, sf, "satellite_links", "satellite_station_id", "linked_cluster_id", "representative_point_distance_m", "link_confidence").filter("linked_cluster_id is not null and representative_point_distance_m is not null")
    d = F.struct("representative_point_distance_m", "linked_cluster_id")
    p = F.struct(F.when(F.col("link_confidence") == "high", 0).otherwise(1), "representative_point_distance_m", "linked_cluster_id")
    return l.groupBy("satellite_station_id").agg(F.min_by("linked_cluster_id", d).alias("nearest"), F.min_by("linked_cluster_id", p).alias("preferred"))


@query(f"with {CATALOG} select cluster_uid, {', '.join(f'min_by({c}, catalog_row_id) filter ({c} is not null) as {c}' for c in ('station_name', 'river_name', 'country', 'pfaf_code'))} from cat group by 1")
def cluster_first_nonempty(spark: S, sf: str) -> DataFrame:
    cols = ("station_name", "river_name", "country", "pfaf_code")
    return catalog(spark, sf).groupBy("cluster_uid").agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("catalog_row_id"))).alias(c) for c in cols])


@query(f"with {CATALOG} select source, count(distinct cluster_uid) as n_clusters, count(*) as n_rows from (select cluster_uid, unnest(string_split(sources_used, '|')) source from cat where sources_used is not null) group by 1")
def source_membership(spark: S, sf: str) -> DataFrame:
    x = catalog(spark, sf).filter("sources_used is not null").select("cluster_uid", F.explode(F.split("sources_used", r"\|")).alias("source"))
    return x.groupBy("source").agg(F.countDistinct("cluster_uid").alias("n_clusters"), F.count("*").alias("n_rows"))


@query(f"with {OBS} select source, min(obs_date) as first_day, max(obs_date) as last_day, date_diff('day', min(obs_date), max(obs_date)) + 1 as span_days, count(distinct cluster_uid) as n_clusters from obs group by 1")
def source_spans(spark: S, sf: str) -> DataFrame:
    g = observations(spark, sf).groupBy("source")
    return g.agg(F.min("obs_date").alias("first_day"), F.max("obs_date").alias("last_day"), (F.datediff(F.max("obs_date"), F.min("obs_date")) + 1).cast("bigint").alias("span_days"), F.countDistinct("cluster_uid").alias("n_clusters"))


@query(f"with {OBS} select source, date_part('year', obs_date) as yr, count(ssc) filter (ssc_flag in (0, 1)) as ssc_usable, count(q) filter (q_flag in (0, 1)) as q_usable from obs group by 1, 2")
def source_variable_counts(spark: S, sf: str) -> DataFrame:
    return observations(spark, sf).groupBy("source", F.year("obs_date").cast("bigint").alias("yr")).agg(F.count(F.when(F.col("ssc_flag").isin(0, 1), F.col("ssc"))).alias("ssc_usable"), F.count(F.when(F.col("q_flag").isin(0, 1), F.col("q"))).alias("q_usable"))


@query(f"with {OBS}, c as (select count(distinct cluster_uid) nc, count(distinct obs_date) nd from obs) select nc as n_clusters, nd as n_days, nc * nd as cells, (select count(*) from (select distinct cluster_uid, obs_date from obs where ssc is not null)) as filled, round(100.0 * (select count(*) from (select distinct cluster_uid, obs_date from obs where ssc is not null)) / (nc * nd), 6) as filled_pct from c")
def matrix_fill(spark: S, sf: str) -> DataFrame:
    # rows a (cluster, day) first: the counts of distinct values then run over an already reduced table
    d = observations(spark, sf, ("cluster_uid", "obs_date")).groupBy("cluster_uid", "obs_date").agg(F.max(F.when(F.col("ssc").isNotNull(), 1).otherwise(0)).alias("f"))
    g = d.agg(F.countDistinct("cluster_uid").alias("n_clusters"), F.countDistinct("obs_date").alias("n_days"), F.sum("f").alias("filled"))
    cells = F.col("n_clusters") * F.col("n_days")
    return g.select("n_clusters", "n_days", cells.alias("cells"), "filled", F.round(100.0 * F.col("filled") / cells, 6).alias("filled_pct"))


@query(None)
def schema_inventory(spark: S, sf: str) -> DataFrame:
    """Columns and types of the tables, from their footers."""
    rows = [(t, f.name, f.dataType.simpleString()) for t in ("daily_matrix", "satellite_obs", "insitu_obs", "station_catalog") for f in table(spark, sf, t).schema.fields]
    return spark.createDataFrame(rows, "table_name string, column_name string, type string")


@query(f"with {CATALOG}, a as (select distinct cluster_uid from cat), b as (select distinct cluster_uid from daily_matrix) select (select count(*) from a) as n_catalog, (select count(*) from b) as n_active, (select count(*) from a where cluster_uid not in (select cluster_uid from b where cluster_uid is not null)) as n_inactive, (select count(*) from b where cluster_uid not in (select cluster_uid from a)) as n_unlisted")
def active_metadata(spark: S, sf: str) -> DataFrame:
    a, b = catalog(spark, sf).select("cluster_uid").distinct(), table(spark, sf, "daily_matrix", "cluster_uid").distinct().withColumnRenamed("cluster_uid", "u")
    j = a.join(b, F.col("cluster_uid") == F.col("u"), "full")
    return j.agg(F.count("cluster_uid").alias("n_catalog"), F.count("u").alias("n_active"), F.count_if(F.col("u").isNull()).alias("n_inactive"), F.count_if(F.col("cluster_uid").isNull()).alias("n_unlisted"))


@query(f"with {STATIONS}, g as (select source_key, country, count(*) n from st where country is not null group by 1, 2), m as (select source_key, max_by(country, (n, country)) c from g group by 1) select st.station_id, coalesce(st.country, m.c) as country, st.country is null and m.c is not null as filled from st left join m on m.source_key = st.source_key")
def country_fill(spark: S, sf: str) -> DataFrame:
    s = stations(spark, sf)
    m = s.filter("country is not null").groupBy("source_key", "country").agg(F.count("*").alias("n")).groupBy("source_key").agg(F.max_by("country", F.struct("n", "country")).alias("c"))
    return s.join(m, "source_key", "left").select("station_id", F.coalesce("country", "c").alias("country"), (F.col("country").isNull() & F.col("c").isNotNull()).alias("filled"))


@query(f"with {STATIONS}, {OBS}, a as (select source_key, count(*) n_stations, count(country) n_country from st group by 1), b as (select lower(trim(source)) k, count(*) n_records, count(distinct cluster_uid) n_clusters from obs group by 1) select a.source_key, n_stations, n_country, coalesce(n_records, 0) as n_records, coalesce(n_clusters, 0) as n_clusters, case when n_records is null then 'catalog_only' else 'published' end as role from a left join b on b.k = a.source_key")
def source_catalog(spark: S, sf: str) -> DataFrame:
    a = stations(spark, sf).groupBy("source_key").agg(F.count("*").alias("n_stations"), F.count("country").alias("n_country"))
    b = observations(spark, sf).groupBy(F.lower(F.trim("source")).alias("k")).agg(F.count("*").alias("n_records"), F.countDistinct("cluster_uid").alias("n_clusters"))
    j = a.join(b, F.col("k") == F.col("source_key"), "left")
    return j.select("source_key", "n_stations", "n_country", F.coalesce("n_records", F.lit(0)).alias("n_records"), F.coalesce("n_clusters", F.lit(0)).alias("n_clusters"), F.when(F.col("n_records").isNull(), "catalog_only").otherwise("published").alias("role"))


@query(f"with {CATALOG}, s as (select cluster_uid, count(*) n, case when max(lat) - min(lat) > 0.02 then 2 else 0 end + case when max(basin_area) > 1.1 * min(basin_area) then 1 else 0 end + case when count(*) filter (basin_status = 'unresolved') > 0 then 1 else 0 end score from cat group by 1) select cluster_uid, n, score, case when score >= 3 then 'first' when score >= 1 then 'second' else 'none' end as review from s")
def review_scores(spark: S, sf: str) -> DataFrame:
    g = catalog(spark, sf).groupBy("cluster_uid").agg(F.count("*").alias("n"), (F.max("lat") - F.min("lat")).alias("d"), F.max("basin_area").alias("hi"), F.min("basin_area").alias("lo"), F.count_if(F.col("basin_status") == "unresolved").alias("u"))
    score = F.when(F.col("d") > 0.02, 2).otherwise(0) + F.when(F.col("hi") > 1.1 * F.col("lo"), 1).otherwise(0) + F.when(F.col("u") > 0, 1).otherwise(0)
    return g.select("cluster_uid", "n", score.alias("score"), F.when(score >= 3, "first").when(score >= 1, "second").otherwise("none").alias("review"))


@query(f"with {OBS}, s as (select 1 step, 'delivered' as name, (select count(*) from daily_matrix) n union all select 2, 'distinct', (select count(*) from obs) union all select 3, 'with_reading', (select count(*) from obs where q is not null or ssc is not null or ssl is not null) union all select 4, 'publishable', (select count(*) from obs where ssc is not null or ssl is not null) union all select 5, 'complete', (select count(*) from obs where q is not null and ssc is not null and ssl is not null)) select name, n, n - lag(n) over (order by step) as change from s")
def stage_attrition(spark: S, sf: str) -> DataFrame:
    """Rows left after each stage of cleaning, and the loss."""
    o = observations(spark, sf)
    some, sed, every = "q is not null or ssc is not null or ssl is not null", "ssc is not null or ssl is not null", "q is not null and ssc is not null and ssl is not null"
    raw = table(spark, sf, "daily_matrix", "record_id").agg(F.count("*").alias("delivered"))
    g = o.agg(F.count("*").alias("distinct"), F.count_if(F.expr(some)).alias("with_reading"), F.count_if(F.expr(sed)).alias("publishable"), F.count_if(F.expr(every)).alias("complete"))
    names = ["delivered", "distinct", "with_reading", "publishable", "complete"]
    one = raw.join(g)  # one row each
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("n"), (F.col(n) - F.col(p) if p else F.lit(None).cast("bigint")).alias("change")) for p, n in zip([None, *names], names)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


@query(f"with {STATIONS} select source_key, {', '.join(f'round(100.0 * count({c}) / count(*), 6) as {c}_pct' for c in ('station_name', 'river_name', 'lat', 'reported_area', 'country'))} from st group by 1")
def completeness(spark: S, sf: str) -> DataFrame:
    cols = ("station_name", "river_name", "lat", "reported_area", "country")
    return stations(spark, sf).groupBy("source_key").agg(*[percent(F.count(c), F.count("*")).alias(f"{c}_pct") for c in cols])


@query("select source, count(*) filter (ssl < 0 and ssl <> -9999) as negative_loads, count(*) filter (ssc > 10000) as high_ssc, count(*) filter (ssc > 50000) as extreme_ssc, round(100.0 * count(*) filter (ssc > 10000) / count(*), 6) as high_pct from (select distinct record_id, source, ssc, ssl from daily_matrix) group by 1")
def extremes(spark: S, sf: str) -> DataFrame:
    d = table(spark, sf, "daily_matrix", "record_id", "source", "ssc", "ssl").dropDuplicates(["record_id"])
    high = F.count_if((F.col("ssc") > 10000) & ~F.isnan("ssc"))
    return d.groupBy("source").agg(F.count_if((F.col("ssl") < 0) & (F.col("ssl") != -9999)).alias("negative_loads"), high.alias("high_ssc"), F.count_if((F.col("ssc") > 50000) & ~F.isnan("ssc")).alias("extreme_ssc"), percent(high, F.count("*")).alias("high_pct"))


@query("select trim(source) as source, count(distinct station_uid) as n, count(distinct case when year_start is null or year_end < year_start then station_uid end) as bad_period, round(avg(year_end - year_start + 1), 6) as mean_years from climatology_stations group by 1")
def climatology_audit(spark: S, sf: str) -> DataFrame:
    c = table(spark, sf, "climatology_stations", "station_uid", "source", "year_start", "year_end")
    bad = F.col("year_start").isNull() | (F.col("year_end") < F.col("year_start"))
    return c.groupBy(F.trim("source").alias("source")).agg(F.countDistinct("station_uid").alias("n"), F.countDistinct(F.when(bad, F.col("station_uid"))).alias("bad_period"), F.round(F.avg(F.col("year_end") - F.col("year_start") + 1), 6).alias("mean_years"))


@query(f"with {CATALOG}, l as (select distinct linked_cluster_id c, satellite_station_id s from satellite_links where linked_cluster_id is not null) select cat.cluster_id, count(distinct s) as n_satellites, count(distinct catalog_row_id) as n_rows from cat left join l on l.c = cat.cluster_id group by 1")
def catalog_satellite_join(spark: S, sf: str) -> DataFrame:
    """Both sides are reduced to a row a cluster before they meet."""
    c = catalog(spark, sf).groupBy("cluster_id").agg(F.count("*").alias("n_rows"))
    l = table(spark, sf, "satellite_links", "linked_cluster_id", "satellite_station_id").filter("linked_cluster_id is not null").groupBy("linked_cluster_id").agg(F.countDistinct("satellite_station_id").alias("n"))
    return c.join(l, F.col("cluster_id") == F.col("linked_cluster_id"), "left").select("cluster_id", F.coalesce("n", F.lit(0)).alias("n_satellites"), "n_rows")
