"""Aggregates, windows and rankings over the merged observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluvion.functions.domain import percent
from fluvion.operators.merge import best_rows_per_day, publishable, quality, ranked
from fluvion.operators.metrics import error_metrics_by, error_metrics_sql, ratio_metrics_by
from fluvion.operators.ordering import average_rank
from fluvion.operators.quantiles import exact_quantiles, with_quantiles
from fluvion.plans.common import CATALOG, OBS, PAIRED, STATIONS, catalog, observations, paired, stations
from fluvion.plans.registry import query
from fluvion.sources.tables import table

S = SparkSession
_G = "(case when q_flag = 0 then 1 else 0 end + case when ssc_flag = 0 then 1 else 0 end + case when ssl_flag = 0 then 1 else 0 end)"
_V = "(case when q_flag between 0 and 3 then 1 else 0 end + case when ssc_flag between 0 and 3 then 1 else 0 end + case when ssl_flag between 0 and 3 then 1 else 0 end)"
_QL = f"{OBS}, pb as (select * from obs where ssc is not null or ssl is not null), ql as (select cluster_uid, source_station_uid, count(*) n_rows, sum({_G}) good, sum({_V}) valid, coalesce(round(sum({_G}) / nullif(cast(sum({_V}) as double), 0), 9), 0.0) score from pb group by 1, 2)"
_RK = f"{_QL}, rk as (select *, row_number() over (partition by cluster_uid order by score desc, source_station_uid) quality_rank, count(*) over (partition by cluster_uid) n_candidates from ql)"


@query(f"with {_QL} select cluster_uid, source_station_uid, n_rows, cast(good as bigint) as good, cast(valid as bigint) as valid, score from ql")
def quality_metrics(spark: S, sf: str) -> DataFrame:
    return quality(publishable(observations(spark, sf)), ["cluster_uid", "source_station_uid"])


@query(f"with {_RK} select cluster_uid, source_station_uid, score, quality_rank, n_candidates, quality_rank = 1 as is_top from rk")
def quality_rank(spark: S, sf: str) -> DataFrame:
    q = ranked(quality(publishable(observations(spark, sf)), ["cluster_uid", "source_station_uid"]), ["cluster_uid"], "source_station_uid")
    return q.select("cluster_uid", "source_station_uid", "score", "quality_rank", "n_candidates", "is_top")


@query(f"with {_RK} select cluster_uid, obs_date, record_id, source_station_uid, quality_rank, q, ssc, ssl, n_rows, n_rows > 1 as is_overlap from (select pb.*, rk.quality_rank, row_number() over (partition by pb.cluster_uid, obs_date order by quality_rank, record_id) k, count(*) over (partition by pb.cluster_uid, obs_date) n_rows from pb join rk on rk.cluster_uid = pb.cluster_uid and rk.source_station_uid = pb.source_station_uid) where k = 1")
def best_row_per_day(spark: S, sf: str) -> DataFrame:
    """The flagship: of each cluster and day the row of the best source, with its provenance and overlap."""
    o = observations(spark, sf, ("cluster_uid", "obs_date")).filter("cluster_uid is not null")
    b = best_rows_per_day(o, "cluster_uid", "source_station_uid", "obs_date", "record_id")
    return b.select("cluster_uid", "obs_date", "record_id", "source_station_uid", "quality_rank", "q", "ssc", "ssl", "n_rows", "is_overlap")


@query(f"with {OBS} select cluster_uid, obs_date, count(*) as n, count(*) > 1 as is_overlap from obs where ssc is not null or ssl is not null group by 1, 2")
def overlap_flag(spark: S, sf: str) -> DataFrame:
    return publishable(observations(spark, sf, ("cluster_uid", "obs_date"))).groupBy("cluster_uid", "obs_date").agg(F.count("*").alias("n"), (F.count("*") > 1).alias("is_overlap"))


@query(f"with {OBS} select coalesce(source, 'ALL') as source, count(*) as n_rows, count(*) filter (ssc is not null or ssl is not null) as n_published, count(*) filter (q is not null and ssc is null and ssl is null) as n_q_only, count(distinct cluster_uid) as n_clusters from obs group by rollup (source)")
def publish_filter_funnel(spark: S, sf: str) -> DataFrame:
    sed = F.col("ssc").isNotNull() | F.col("ssl").isNotNull()
    o = observations(spark, sf).rollup("source").agg(F.count("*").alias("n_rows"), F.count_if(sed).alias("n_published"), F.count_if(F.col("q").isNotNull() & ~sed).alias("n_q_only"), F.countDistinct("cluster_uid").alias("n_clusters"))
    return o.withColumn("source", F.coalesce("source", F.lit("ALL")))


@query(f"with {CATALOG} select cluster_uid, count(*) as n_rows, array_to_string(list_sort(list_distinct(list(station_name))), '|') as names, round(avg(lat), 4) as lat_mean, round(min(lat), 6) as lat_min, round(max(lat), 6) as lat_max from cat group by 1")
def cluster_report(spark: S, sf: str) -> DataFrame:
    g = catalog(spark, sf).groupBy("cluster_uid")
    return g.agg(F.count("*").alias("n_rows"), F.array_join(F.sort_array(F.collect_set("station_name")), "|").alias("names"), F.round(F.avg("lat"), 4).alias("lat_mean"), F.round(F.min("lat"), 6).alias("lat_min"), F.round(F.max("lat"), 6).alias("lat_max"))


@query("select cluster_uid, array_to_string(list_sort(list_distinct(list(source))), '|') as sources, count(distinct source) as n from daily_matrix group by 1")
def sources_per_cluster(spark: S, sf: str) -> DataFrame:
    d = table(spark, sf, "daily_matrix", "cluster_uid", "source").distinct()
    return d.groupBy("cluster_uid").agg(F.array_join(F.sort_array(F.collect_list("source")), "|").alias("sources"), F.count("source").alias("n"))


@query(f"with {STATIONS} select source_key, substr(coalesce(string_agg(distinct country, '|' order by country), ''), 1, 64) as countries, min(station_id) as first_station, max(station_id) as last_station from st group by 1")
def source_text_aggregate(spark: S, sf: str) -> DataFrame:
    g = stations(spark, sf).groupBy("source_key")
    return g.agg(F.substring(F.array_join(F.sort_array(F.collect_set("country")), "|"), 1, 64).alias("countries"), F.min("station_id").alias("first_station"), F.max("station_id").alias("last_station"))


@query(f"with {CATALOG} select cluster_uid, catalog_row_id, station_name from (select *, row_number() over (partition by cluster_uid order by basin_area desc nulls last, catalog_row_id) k from cat) where k = 1")
def representative_row(spark: S, sf: str) -> DataFrame:
    c = catalog(spark, sf)
    g = c.groupBy("cluster_uid").agg(F.min_by(F.struct("catalog_row_id", "station_name"), F.struct(-F.coalesce("basin_area", F.lit(-1.0)), "catalog_row_id")).alias("b"))
    return g.select("cluster_uid", "b.*")


@query(f"with {OBS} select source_station_uid, {', '.join(f'count({v}) as n_{v}, min(case when {v} is not null then obs_date end) as first_{v}, max(case when {v} is not null then obs_date end) as last_{v}' for v in ('q', 'ssc', 'ssl'))} from obs group by 1")
def station_stats(spark: S, sf: str) -> DataFrame:
    day = lambda v: F.when(F.col(v).isNotNull(), F.col("obs_date"))
    aggs = [a for v in ("q", "ssc", "ssl") for a in (F.count(v).alias(f"n_{v}"), F.min(day(v)).alias(f"first_{v}"), F.max(day(v)).alias(f"last_{v}"))]
    return observations(spark, sf).groupBy("source_station_uid").agg(*aggs)


_RES = f"""{STATIONS}, rs as (select source_key, count(*) filter (resolution = 'daily') daily, count(*) filter (resolution = 'monthly') monthly, count(*) filter (resolution = 'annual') annual from st group by 1)"""


@query(f"with {_RES} select source_key, daily, monthly, annual, array_to_string(list_filter([case when daily > 0 then 'daily' end, case when monthly > 0 then 'monthly' end, case when annual > 0 then 'annual' end], lambda x: x is not null), '|') as available from rs")
def available_resolutions(spark: S, sf: str) -> DataFrame:
    names = ("daily", "monthly", "annual")
    g = stations(spark, sf).groupBy("source_key").agg(*[F.count_if(F.col("resolution") == r).alias(r) for r in names])
    return g.withColumn("available", F.array_join(F.array_compact(F.array(*[F.when(F.col(r) > 0, r) for r in names])), "|"))


@query(f"with {_RES} select * from (select source_key, 'daily' as resolution, daily as n from rs union all select source_key, 'monthly', monthly from rs union all select source_key, 'annual', annual from rs) where n > 0")
def resolution_catalog(spark: S, sf: str) -> DataFrame:
    g = stations(spark, sf).groupBy("source_key").agg(*[F.count_if(F.col("resolution") == r).alias(r) for r in ("daily", "monthly", "annual")])
    return g.unpivot("source_key", ["daily", "monthly", "annual"], "resolution", "n").filter("n > 0")


@query(f"with {STATIONS} select source_key, count(*) as n_stations, count(distinct river_name) as n_rivers, count(distinct country) as n_countries, string_agg(distinct resolution, '|' order by resolution) as resolutions, round(avg(reported_area), 4) as area_mean from st group by 1")
def source_dataset_catalog(spark: S, sf: str) -> DataFrame:
    g = stations(spark, sf).groupBy("source_key")
    return g.agg(F.count("*").alias("n_stations"), F.countDistinct("river_name").alias("n_rivers"), F.countDistinct("country").alias("n_countries"), F.array_join(F.sort_array(F.collect_set("resolution")), "|").alias("resolutions"), F.round(F.avg("reported_area"), 4).alias("area_mean"))


@query(f"with {CATALOG} select cluster_uid, coalesce(max(case when basin_status = 'resolved' then country end), max(country), 'unknown') as country, bool_or(basin_status = 'resolved') as any_resolved from cat group by 1")
def geo_rollup(spark: S, sf: str) -> DataFrame:
    g = catalog(spark, sf).groupBy("cluster_uid")
    return g.agg(F.coalesce(F.max(F.when(F.col("basin_status") == "resolved", F.col("country"))), F.max("country"), F.lit("unknown")).alias("country"), F.bool_or(F.col("basin_status") == "resolved").alias("any_resolved"))


@query(f"with {_RK} select cluster_uid, obs_date, source_station_uid, record_id, n_rows as n_candidate_rows, case when k = 1 then 1 else 0 end as selected_flag from (select pb.*, row_number() over (partition by pb.cluster_uid, obs_date order by quality_rank, record_id) k, count(*) over (partition by pb.cluster_uid, obs_date) n_rows from pb join rk on rk.cluster_uid = pb.cluster_uid and rk.source_station_uid = pb.source_station_uid) where n_rows > 1")
def overlap_candidates(spark: S, sf: str) -> DataFrame:
    """Every row of days with several candidates, the selected one marked."""
    p = publishable(observations(spark, sf, ("cluster_uid", "obs_date")).filter("cluster_uid is not null"))
    best = best_rows_per_day(p, "cluster_uid", "source_station_uid", "obs_date", "record_id").filter("is_overlap").select("cluster_uid", "obs_date", F.col("record_id").alias("chosen"), F.col("n_rows").alias("n_candidate_rows"))
    j = p.join(best, ["cluster_uid", "obs_date"])
    return j.select("cluster_uid", "obs_date", "source_station_uid", "record_id", "n_candidate_rows", F.when(F.col("record_id") == F.col("chosen"), 1).otherwise(0).alias("selected_flag"))


_STR = f"{PAIRED}, px as (select *, case when y < 50 then 'low' when y < 500 then 'mid' else 'high' end as bin from pr)"
_STRATA = ("satellite_source", "insitu_source", "bin")
_SETS = ((), ("satellite_source",), ("insitu_source",), ("bin",), ("satellite_source", "insitu_source"), ("satellite_source", "bin"), ("satellite_source", "insitu_source", "bin"))


def _in_sets(p: DataFrame, sets: tuple[tuple[str, ...], ...]) -> DataFrame:
    """Each row once for each set of strata; strata outside the set read ALL."""
    rows = F.array(*[F.struct(*[(F.col(c) if c in s else F.lit("ALL")).alias(c) for c in _STRATA]) for s in sets])
    return p.select(F.explode(rows).alias("_s"), "x", "y").select("_s.*", "x", "y")


@query(f"with {_STR} select coalesce(satellite_source, 'ALL') as satellite_source, coalesce(insitu_source, 'ALL') as insitu_source, coalesce(bin, 'ALL') as bin, {error_metrics_sql('x', 'y')} from px group by grouping sets ((), (satellite_source), (insitu_source), (bin), (satellite_source, insitu_source), (satellite_source, bin), (satellite_source, insitu_source, bin))")
def metrics_grouping_sets(spark: S, sf: str) -> DataFrame:
    """Metrics of seven sets of strata; each row goes to its seven strata, so that medians are found like the means."""
    p = paired(spark, sf).withColumn("bin", F.when(F.col("y") < 50, "low").when(F.col("y") < 500, "mid").otherwise("high"))
    return error_metrics_by(_in_sets(p, _SETS), list(_STRATA), "x", "y")


@query(f"with {PAIRED} select satellite_source, {error_metrics_sql('x', 'y')} from pr group by 1")
def error_metrics_by_source(spark: S, sf: str) -> DataFrame:
    return error_metrics_by(paired(spark, sf), ["satellite_source"], "x", "y")


@query(f"with {PAIRED} select satellite_source, count(r) as n_positive, round(median(r), 6) as median_ratio, round(median(log10(r)), 6) as median_log_ratio, round(avg(case when r is not null then cast(r between 0.5 and 2 as int) end), 6) as within_2, round(avg(case when r is not null then cast(r between 0.1 and 10 as int) end), 6) as within_10 from (select *, case when x > 0 and y > 0 then x / y end r from pr) group by 1")
def ratio_metrics_by_source(spark: S, sf: str) -> DataFrame:
    return ratio_metrics_by(paired(spark, sf), ["satellite_source"], "x", "y")


@query(f"with {PAIRED}, e as (select satellite_source, abs(x - y) / y e, x / y r from pr where x > 0 and y > 0) select satellite_source, round(quantile_cont(e, 0.75), 6) as p75, round(quantile_cont(e, 0.9), 6) as p90, round(quantile_cont(e, 0.95), 6) as p95, round(quantile_cont(r, 0.05), 6) as r05, round(quantile_cont(r, 0.95), 6) as r95, round(pow(10, avg(abs(log10(r)))), 6) as typical_factor, round(100.0 * count(*) filter (e <= 0.2) / count(*), 6) as within_20_pct from e group by 1")
def error_percentiles(spark: S, sf: str) -> DataFrame:
    e = paired(spark, sf).filter("x > 0 and y > 0").withColumn("e", F.abs(F.col("x") - F.col("y")) / F.col("y")).withColumn("r", F.col("x") / F.col("y"))
    g = e.groupBy("satellite_source").agg(F.round(F.pow(F.lit(10.0), F.avg(F.abs(F.log10("r")))), 6).alias("typical_factor"), F.round(100.0 * F.count_if(F.col("e") <= 0.2) / F.count("*"), 6).alias("within_20_pct"))
    at = {"p75": ("e", 0.75), "p90": ("e", 0.9), "p95": ("e", 0.95), "r05": ("r", 0.05), "r95": ("r", 0.95)}
    return with_quantiles(g, e, ["satellite_source"], {n: (F.col(c), p) for n, (c, p) in at.items()})


@query(f"with {PAIRED} select satellite_source, count(*) as n, round(sqrt(avg((x - y) * (x - y))), 6) as rmse, round(avg(x - y), 6) as bias, round(1 - sum((x - y) * (x - y)) / nullif(var_pop(y) * count(*), 0), 6) as nse from pr group by 1")
def model_efficiency(spark: S, sf: str) -> DataFrame:
    d = F.col("x") - F.col("y")
    return paired(spark, sf).groupBy("satellite_source").agg(F.count("*").alias("n"), F.round(F.sqrt(F.avg(d * d)), 6).alias("rmse"), F.round(F.avg(d), 6).alias("bias"), F.round(1 - F.sum(d * d) / F.nullif(F.var_pop("y") * F.count("*"), F.lit(0.0)), 6).alias("nse"))


@query(f"with {PAIRED} select cluster_uid, count(*) as n, round(median(100 * abs(x - y) / nullif(y, 0)), 6) as mdape, round(corr(x, y), 5) as r from pr group by 1 having count(*) >= 3 and stddev_pop(x) > 0 and stddev_pop(y) > 0")
def pair_stats(spark: S, sf: str) -> DataFrame:
    p = paired(spark, sf)
    g = p.groupBy("cluster_uid").agg(F.count("*").alias("n"), F.round(F.corr("x", "y"), 5).alias("r"), F.stddev_pop("x").alias("a"), F.stddev_pop("y").alias("b")).filter("n >= 3 and a > 0 and b > 0").drop("a", "b")
    return with_quantiles(g, p, ["cluster_uid"], {"mdape": (100 * F.abs(F.col("x") - F.col("y")) / F.nullif(F.col("y"), F.lit(0.0)), 0.5)})


_PROFILE = {"p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


@query(f"with {OBS} select source, count(ssc) as n, cast(sum(cast(round(ssc * 1000000) as bigint)) as double) / (count(ssc) * 1000000.0) as mean, round(stddev_pop(ssc), 4) as sd, min(ssc) as lo, max(ssc) as hi, round(avg(case when ssc > 0 then log10(ssc) end), 4) as log_mean, round(median(case when ssc > 0 then log10(ssc) end), 6) as log_median, {', '.join(f'round(quantile_cont(ssc, {p}), 6) as {n}' for n, p in _PROFILE.items())} from obs group by 1")
def numeric_profile(spark: S, sf: str) -> DataFrame:
    """Distribution of a variable by source. The mean is of whole millionths, added exactly: no order of rows changes it."""
    o = observations(spark, sf).select("source", "ssc")
    log = F.when(F.col("ssc") > 0, F.log10("ssc"))
    mean = F.sum(F.round(F.col("ssc") * 1_000_000).cast("decimal(20,0)")).cast("double") / (F.count("ssc") * 1_000_000.0)
    g = o.groupBy("source").agg(F.count("ssc").alias("n"), mean.alias("mean"), F.round(F.stddev_pop("ssc"), 4).alias("sd"), F.min("ssc").alias("lo"), F.max("ssc").alias("hi"), F.round(F.avg(log), 4).alias("log_mean"))
    return with_quantiles(g, o, ["source"], {n: (F.col("ssc"), p) for n, p in _PROFILE.items()} | {"log_median": (log, 0.5)})


@query("select l_returnflag, min(l_extendedprice) as lo, round(median(l_extendedprice), 6) as median, round(quantile_cont(l_extendedprice, 0.9), 6) as p90, round(quantile_cont(l_extendedprice, 0.99), 6) as p99, max(l_extendedprice) as hi from lineitem group by 1")
def quantile_stats(spark: S, sf: str) -> DataFrame:
    c = "l_extendedprice"
    l = table(spark, sf, "lineitem", "l_returnflag", c)
    g = l.groupBy("l_returnflag").agg(F.min(c).alias("lo"), F.max(c).alias("hi"))
    return with_quantiles(g, l, ["l_returnflag"], {"median": (F.col(c), 0.5), "p90": (F.col(c), 0.9), "p99": (F.col(c), 0.99)})


@query(f"with {OBS} select source, count(*) as n, count(q) as n_q, count(ssc) as n_ssc, count(ssl) as n_ssl, count(distinct case when ssc is not null then cluster_uid end) as clusters_ssc, round(100.0 * count(ssc) / count(*), 6) as pct_ssc from obs group by 1")
def variable_coverage(spark: S, sf: str) -> DataFrame:
    g = observations(spark, sf).groupBy("source")
    return g.agg(F.count("*").alias("n"), F.count("q").alias("n_q"), F.count("ssc").alias("n_ssc"), F.count("ssl").alias("n_ssl"), F.countDistinct(F.when(F.col("ssc").isNotNull(), F.col("cluster_uid"))).alias("clusters_ssc"), percent(F.count("ssc"), F.count("*")).alias("pct_ssc"))


@query(f"with {OBS} select combo, count(*) as n from (select case when q is null and ssc is null and ssl is null then 'none' else array_to_string(list_filter([case when q is not null then 'Q' end, case when ssc is not null then 'SSC' end, case when ssl is not null then 'SSL' end], lambda x: x is not null), '+') end combo from obs) group by 1")
def colocation_combos(spark: S, sf: str) -> DataFrame:
    parts = F.array_compact(F.array(*[F.when(F.col(v).isNotNull(), v.upper()) for v in ("q", "ssc", "ssl")]))
    c = F.when(F.size(parts) == 0, "none").otherwise(F.array_join(parts, "+"))
    return observations(spark, sf).groupBy(c.alias("combo")).agg(F.count("*").alias("n"))


@query(f"with {OBS} select source, count(*) filter (q = 0) as q_zero, count(*) filter (q > 0) as q_positive, count(*) filter (q = 0 and ssl > 0) as load_without_flow from obs group by 1")
def zero_audit(spark: S, sf: str) -> DataFrame:
    return observations(spark, sf).groupBy("source").agg(F.count_if(F.col("q") == 0).alias("q_zero"), F.count_if(F.col("q") > 0).alias("q_positive"), F.count_if((F.col("q") == 0) & (F.col("ssl") > 0)).alias("load_without_flow"))


_FL = f"{OBS}, fl as (select 'q' as variable, q_flag flag, year(obs_date) yr, source, source_station_uid from obs union all select 'ssc', ssc_flag, year(obs_date), source, source_station_uid from obs union all select 'ssl', ssl_flag, year(obs_date), source, source_station_uid from obs)"


def _flags(spark: S, sf: str) -> DataFrame:
    o = observations(spark, sf).select("source", "source_station_uid", F.year("obs_date").alias("yr"), F.col("q_flag").alias("q"), F.col("ssc_flag").alias("ssc"), F.col("ssl_flag").alias("ssl"))
    return o.unpivot(["source", "source_station_uid", "yr"], ["q", "ssc", "ssl"], "variable", "flag")


@query(f"with {_FL} select variable, flag, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (partition by variable), 6) as pct from fl group by 1, 2")
def flag_histogram_pct(spark: S, sf: str) -> DataFrame:
    g = _flags(spark, sf).groupBy("variable", "flag").agg(F.count("*").alias("n"))
    return g.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy("variable")), 6))


@query(f"with {_FL} select variable, source, round(100.0 * count(*) filter (flag = 0) / count(*), 6) as good_pct, round(100.0 * count(*) filter (flag in (2, 3)) / count(*), 6) as doubtful_pct, round(100.0 * count(*) filter (flag = 9) / count(*), 6) as missing_pct from fl group by 1, 2")
def flag_health(spark: S, sf: str) -> DataFrame:
    n = F.count("*")
    return _flags(spark, sf).groupBy("variable", "source").agg(percent(F.count_if(F.col("flag") == 0), n).alias("good_pct"), percent(F.count_if(F.col("flag").isin(2, 3)), n).alias("doubtful_pct"), percent(F.count_if(F.col("flag") == 9), n).alias("missing_pct"))


@query(f"with {_FL}, y as (select yr, variable, count(*) n, round(100.0 * count(*) filter (flag = 0) / count(*), 6) good_pct from fl group by 1, 2) select yr, variable, n, good_pct, round(good_pct - lag(good_pct) over (partition by variable order by yr), 6) as change from y")
def yearly_flag_trend(spark: S, sf: str) -> DataFrame:
    y = _flags(spark, sf).groupBy("yr", "variable").agg(F.count("*").alias("n"), percent(F.count_if(F.col("flag") == 0), F.count("*")).alias("good_pct"))
    return y.withColumn("change", F.round(F.col("good_pct") - F.lag("good_pct").over(W.partitionBy("variable").orderBy("yr")), 6))


@query(f"with {_FL} select source_station_uid, count(*) filter (flag in (2, 3)) as n_bad, count(*) as n from fl group by 1 order by n_bad desc, source_station_uid limit 20")
def problem_series(spark: S, sf: str) -> DataFrame:
    """Report of the twenty series with the most doubtful flags."""
    g = _flags(spark, sf).groupBy("source_station_uid").agg(F.count_if(F.col("flag").isin(2, 3)).alias("n_bad"), F.count("*").alias("n"))
    return g.orderBy(F.col("n_bad").desc(), "source_station_uid").limit(20)


@query("select source, count(*) as n from (select distinct record_id, source, ssl, ssl_flag, q, ssc from daily_matrix) where ssl_flag = 0 and (q is null or ssc is null or q = -9999 or ssc = -9999) group by 1")
def good_without_inputs(spark: S, sf: str) -> DataFrame:
    """Loads flagged good whose discharge or concentration is missing."""
    d = table(spark, sf, "daily_matrix", "record_id", "source", "ssl_flag", "q", "ssc").dropDuplicates(["record_id"])
    return d.filter("ssl_flag = 0 and (q is null or ssc is null or q = -9999 or ssc = -9999)").groupBy("source").agg(F.count("*").alias("n"))


@query(f"with {OBS} select year(obs_date) as yr, count(*) as n, count(distinct source_station_uid) as n_series from obs group by 1")
def activity_by_year(spark: S, sf: str) -> DataFrame:
    o = observations(spark, sf).groupBy(F.year("obs_date").alias("yr"), "source_station_uid").agg(F.count("*").alias("k"))
    return o.groupBy("yr").agg(F.sum("k").alias("n"), F.count("*").alias("n_series"))


_BINS = "(values ('0'), ('1-10'), ('11-100'), ('101-1000'), ('1001-3650'), ('>3650')) b(bin)"


@query(f"with {OBS}, s as (select source_station_uid, count(ssc) n from obs group by 1), c as (select case when n = 0 then '0' when n <= 10 then '1-10' when n <= 100 then '11-100' when n <= 1000 then '101-1000' when n <= 3650 then '1001-3650' else '>3650' end bin, count(*) n from s group by 1) select b.bin, coalesce(c.n, 0) as n_series from {_BINS} left join c on c.bin = b.bin")
def length_distribution(spark: S, sf: str) -> DataFrame:
    s = observations(spark, sf).groupBy("source_station_uid").agg(F.count("ssc").alias("n"))
    b = F.when(F.col("n") == 0, "0").when(F.col("n") <= 10, "1-10").when(F.col("n") <= 100, "11-100").when(F.col("n") <= 1000, "101-1000").when(F.col("n") <= 3650, "1001-3650").otherwise(">3650")
    c = s.groupBy(b.alias("bin")).agg(F.count("*").alias("n_series"))
    bins = spark.createDataFrame([(x,) for x in ("0", "1-10", "11-100", "101-1000", "1001-3650", ">3650")], "bin string")
    return bins.join(c, "bin", "left").na.fill(0, ["n_series"])


@query(f"with {OBS}, c as (select source, count(*) n from obs where ssc is not null group by 1) select source, n, row_number() over (order by n desc, source) as rank, cast(sum(n) over (order by n desc, source rows unbounded preceding) as bigint) as running, round(100.0 * sum(n) over (order by n desc, source rows unbounded preceding) / sum(n) over (), 6) as running_pct from c")
def source_contribution_cumulative(spark: S, sf: str) -> DataFrame:
    """Sources by size with running totals; the window sees a row a source."""
    c = observations(spark, sf).filter("ssc is not null").groupBy("source").agg(F.count("*").alias("n"))
    w = W.orderBy(F.col("n").desc(), "source")
    run = F.sum("n").over(w.rowsBetween(W.unboundedPreceding, 0))
    return c.select("source", "n", F.row_number().over(w).alias("rank"), run.alias("running"), F.round(100.0 * run / F.sum("n").over(W.partitionBy()), 6).alias("running_pct"))


@query(f"with {CATALOG} select cluster_uid, country as mode_country, n, conflict from (select cluster_uid, country, count(*) n, count(*) over (partition by cluster_uid) > 1 as conflict, row_number() over (partition by cluster_uid order by count(*) desc, country) k from cat where country is not null group by 1, 2) where k = 1")
def geo_canonical(spark: S, sf: str) -> DataFrame:
    """Most frequent country of each cluster (ties: the first in order) and whether its rows disagree."""
    g = catalog(spark, sf).filter("country is not null").groupBy("cluster_uid", "country").agg(F.count("*").alias("n"))
    m = g.groupBy("cluster_uid").agg(F.min(F.struct((-F.col("n")).alias("m"), "country")).alias("t"), (F.count("*") > 1).alias("conflict"))
    return m.select("cluster_uid", F.col("t.country").alias("mode_country"), (-F.col("t.m")).alias("n"), "conflict")


@query(f"with {CATALOG} select case when basin_area <= 100 then '<=100' when basin_area <= 1000 then '100-1000' when basin_area <= 10000 then '1000-10000' else '>10000' end as class, count(*) as n, round(median(basin_area), 6) as median from cat where basin_area is not null group by 1")
def area_distribution(spark: S, sf: str) -> DataFrame:
    a = F.col("basin_area")
    c = F.when(a <= 100, "<=100").when(a <= 1000, "100-1000").when(a <= 10000, "1000-10000").otherwise(">10000")
    x = catalog(spark, sf).filter("basin_area is not null").select(c.alias("class"), "basin_area")
    return with_quantiles(x.groupBy("class").agg(F.count("*").alias("n")), x, ["class"], {"median": (F.col("basin_area"), 0.5)})


@query(f"with {CATALOG} select basin_status, basin_match_quality, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 6) as pct from cat group by 1, 2")
def basin_diagnostics(spark: S, sf: str) -> DataFrame:
    g = catalog(spark, sf).groupBy("basin_status", "basin_match_quality").agg(F.count("*").alias("n"))
    return g.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy()), 6))


@query("select * from (select 'source_stations' as layer, trim(source) as source, count(distinct station_id) as n from source_stations group by 2 union all select 'climatology', trim(source), count(distinct station_uid) from climatology_stations group by 2 union all select 'satellite', trim(satellite_source), count(distinct satellite_station_id) from satellite_links group by 2)")
def layer_rollup(spark: S, sf: str) -> DataFrame:
    out = None
    for layer, name, src, key in (("source_stations", "source_stations", "source", "station_id"), ("climatology", "climatology_stations", "source", "station_uid"), ("satellite", "satellite_links", "satellite_source", "satellite_station_id")):
        g = table(spark, sf, name, src, key).groupBy(F.trim(src).alias("source")).agg(F.countDistinct(key).alias("n")).select(F.lit(layer).alias("layer"), "source", "n")
        out = g if out is None else out.unionByName(g)
    return out


_PR = f"{OBS}, mo as (select source_station_uid u, date_trunc('month', obs_date) m, avg(ssc) v, count(ssc) n, count(distinct obs_date) d, string_agg(distinct cast(ssc_flag as varchar), '|' order by cast(ssc_flag as varchar)) flags from obs where ssc is not null group by 1, 2)"


@query(f"with {_PR} select u as source_station_uid, cast(m as date) as month, round(v, 6) as mean, n, d as n_days, round(d / cast(day(last_day(cast(m as date))) as double), 6) as support, case when d / cast(day(last_day(cast(m as date))) as double) >= 0.8 then 'full' when d / cast(day(last_day(cast(m as date))) as double) >= 0.5 then 'partial' else 'sparse' end as support_class, flags from mo")
def period_rollup(spark: S, sf: str) -> DataFrame:
    o = observations(spark, sf).filter("ssc is not null").groupBy("source_station_uid", F.trunc("obs_date", "MM").alias("month"))
    g = o.agg(F.avg("ssc").alias("v"), F.count("ssc").alias("n"), F.countDistinct("obs_date").alias("n_days"), F.array_join(F.sort_array(F.collect_set(F.col("ssc_flag").cast("string"))), "|").alias("flags"))
    s = F.col("n_days") / F.day(F.last_day("month")).cast("double")
    return g.select("source_station_uid", "month", F.round("v", 6).alias("mean"), "n", "n_days", F.round(s, 6).alias("support"), F.when(s >= 0.8, "full").when(s >= 0.5, "partial").otherwise("sparse").alias("support_class"), "flags")


@query(f"with {_PR} select u as source_station_uid, year(m) as yr, count(*) as n_months, round(sum(v * day(last_day(cast(m as date)))) / sum(day(last_day(cast(m as date)))), 6) as days_weighted, round(avg(v), 6) as plain from mo group by 1, 2")
def days_weighted_annual(spark: S, sf: str) -> DataFrame:
    m = observations(spark, sf).filter("ssc is not null").groupBy("source_station_uid", F.trunc("obs_date", "MM").alias("m")).agg(F.avg("ssc").alias("v")).withColumn("w", F.day(F.last_day("m")))
    return m.groupBy("source_station_uid", F.year("m").alias("yr")).agg(F.count("*").alias("n_months"), F.round(F.sum(F.col("v") * F.col("w")) / F.sum("w"), 6).alias("days_weighted"), F.round(F.avg("v"), 6).alias("plain"))


@query(f"with {OBS}, y as (select source_station_uid u, year(obs_date) yr, avg(ssc) v from obs where ssc is not null group by 1, 2) select u as source_station_uid, count(*) as n_years, round(avg(v), 6) as mean, round(stddev_pop(v), 6) as sd, round(min(v), 6) as lo, round(max(v), 6) as hi from y group by 1 having count(*) >= 3")
def climatology_match(spark: S, sf: str) -> DataFrame:
    y = observations(spark, sf).filter("ssc is not null").groupBy("source_station_uid", F.year("obs_date").alias("yr")).agg(F.avg("ssc").alias("v"))
    g = y.groupBy("source_station_uid").agg(F.count("*").alias("n_years"), F.round(F.avg("v"), 6).alias("mean"), F.round(F.stddev_pop("v"), 6).alias("sd"), F.round(F.min("v"), 6).alias("lo"), F.round(F.max("v"), 6).alias("hi"))
    return g.filter("n_years >= 3")


@query(f"with {PAIRED}, c as (select cluster_uid, satellite_source, median(x / y) r from pr where x > 0 and y > 0 group by 1, 2) select satellite_source, count(*) as n_clusters, round(median(r), 6) as balanced_median from c group by 1")
def cluster_balanced_median(spark: S, sf: str) -> DataFrame:
    c = exact_quantiles(paired(spark, sf).filter("x > 0 and y > 0"), ["cluster_uid", "satellite_source"], {"r": (F.col("x") / F.col("y"), 0.5)})
    return with_quantiles(c.groupBy("satellite_source").agg(F.count("*").alias("n_clusters")), c, ["satellite_source"], {"balanced_median": (F.col("r"), 0.5)})


_PART = "pt as (select distinct station_id, lower(trim(source)) a, split_part(path, '/', 1) b from source_stations where path is not null and source is not null)"


@query(f"""with {_PART}, c as (select a, b, count(*) n from pt group by 1, 2), t as (select sum(n * (n - 1) / 2.0) bt from c), ta as (select sum(n * (n - 1) / 2.0) s from (select sum(n) n from c group by a)), tb as (select sum(n * (n - 1) / 2.0) s from (select sum(n) n from c group by b)), nn as (select sum(n) n from c)
select round(bt / nullif(ta.s + tb.s - bt, 0), 6) as jaccard, round((nn.n * (nn.n - 1) / 2.0 + 2 * bt - ta.s - tb.s) / (nn.n * (nn.n - 1) / 2.0), 6) as rand, round((bt - ta.s * tb.s / (nn.n * (nn.n - 1) / 2.0)) / nullif((ta.s + tb.s) / 2.0 - ta.s * tb.s / (nn.n * (nn.n - 1) / 2.0), 0), 6) as ari from t, ta, tb, nn""")
def partition_agreement(spark: S, sf: str) -> DataFrame:
    """Jaccard, Rand and adjusted Rand of two partitions of the stations, from their contingency table alone."""
    p = table(spark, sf, "source_stations", "station_id", "source", "path").filter("path is not null and source is not null").select("station_id", F.lower(F.trim("source")).alias("a"), F.split_part("path", F.lit("/"), F.lit(1)).alias("b")).distinct()
    c = p.groupBy("a", "b").agg(F.count("*").alias("n"))
    pairs = lambda d: d.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2.0).alias("s"))
    both, sa, sb = pairs(c).withColumnRenamed("s", "both"), pairs(c.groupBy("a").agg(F.sum("n").alias("n"))).withColumnRenamed("s", "sa"), pairs(c.groupBy("b").agg(F.sum("n").alias("n"))).withColumnRenamed("s", "sb")
    one = both.join(sa).join(sb).join(c.agg(F.sum("n").alias("n")))  # one row each
    t = F.col("n") * (F.col("n") - 1) / 2.0
    expected = F.col("sa") * F.col("sb") / t
    return one.select(F.round(F.col("both") / F.nullif(F.col("sa") + F.col("sb") - F.col("both"), F.lit(0.0)), 6).alias("jaccard"), F.round((t + 2 * F.col("both") - F.col("sa") - F.col("sb")) / t, 6).alias("rand"), F.round((F.col("both") - expected) / F.nullif((F.col("sa") + F.col("sb")) / 2.0 - expected, F.lit(0.0)), 6).alias("ari"))


@query(f"with {CATALOG} select size, count(*) as n_clusters from (select cluster_uid, count(distinct source_station_id) size from cat group by 1) group by 1")
def partition_summary(spark: S, sf: str) -> DataFrame:
    return catalog(spark, sf).groupBy("cluster_uid").agg(F.countDistinct("source_station_id").alias("size")).groupBy("size").agg(F.count("*").alias("n_clusters"))


@query("with l as (select distinct satellite_station_id, representative_point_distance_m d, linked_cluster_id c from satellite_links), s as (select * from (values (300), (1000), (3000), (5000)) t(threshold)) select threshold, count(*) filter (c is not null and d <= threshold) as n_linked, round(100.0 * count(*) filter (c is not null and d <= threshold) / count(*), 6) as pct from l, s group by 1")
def threshold_sweep(spark: S, sf: str) -> DataFrame:
    l = table(spark, sf, "satellite_links", "satellite_station_id", "representative_point_distance_m", "linked_cluster_id").distinct()
    ok = F.col("linked_cluster_id").isNotNull()
    levels = (300, 1000, 3000, 5000)
    g = l.agg(F.count("*").alias("n"), *[F.count_if(ok & (F.col("representative_point_distance_m") <= t)).alias(str(t)) for t in levels])
    return g.unpivot(["n"], [str(t) for t in levels], "threshold", "n_linked").select(F.col("threshold").cast("int").alias("threshold"), "n_linked", F.round(100.0 * F.col("n_linked") / F.col("n"), 6).alias("pct"))


@query("with l as (select distinct satellite_station_id, link_status, linked_cluster_id, link_confidence from satellite_links) select 'stations' as step, count(distinct satellite_station_id) as n from l union all select 'with_status', count(distinct satellite_station_id) from l where link_status is not null union all select 'linked', count(distinct satellite_station_id) from l where linked_cluster_id is not null union all select 'high_confidence', count(distinct satellite_station_id) from l where linked_cluster_id is not null and link_confidence = 'high'")
def match_funnel(spark: S, sf: str) -> DataFrame:
    l = table(spark, sf, "satellite_links", "satellite_station_id", "link_status", "linked_cluster_id", "link_confidence")
    s = l.groupBy("satellite_station_id").agg(F.bool_or(F.col("link_status").isNotNull()).alias("with_status"), F.bool_or(F.col("linked_cluster_id").isNotNull()).alias("linked"), F.coalesce(F.bool_or(F.col("linked_cluster_id").isNotNull() & (F.col("link_confidence") == "high")), F.lit(False)).alias("high_confidence"))
    g = s.agg(F.count("*").alias("stations"), *[F.count_if(c).alias(c) for c in ("with_status", "linked", "high_confidence")])
    return g.unpivot([], ["stations", "with_status", "linked", "high_confidence"], "step", "n")


@query(f"with {OBS}, y as (select distinct cluster_uid c, source_station_uid u, year(obs_date) yr from obs where ssc is not null), k as (select c, yr, count(*) n from y group by 1, 2) select c as cluster_uid, max(n) as most_series_in_a_year, count(*) filter (n > 1) as shared_years, case when max(n) = 1 then 'disjoint' when count(*) filter (n > 1) = count(*) then 'always' else 'some' end as overlap_class from k group by 1")
def overlap_class(spark: S, sf: str) -> DataFrame:
    y = observations(spark, sf).filter("ssc is not null").select("cluster_uid", "source_station_uid", F.year("obs_date").alias("yr")).distinct().groupBy("cluster_uid", "yr").agg(F.count("*").alias("n"))
    g = y.groupBy("cluster_uid").agg(F.max("n").alias("most_series_in_a_year"), F.count_if(F.col("n") > 1).alias("shared_years"), F.count("*").alias("k"))
    return g.withColumn("overlap_class", F.when(F.col("most_series_in_a_year") == 1, "disjoint").when(F.col("shared_years") == F.col("k"), "always").otherwise("some")).drop("k")


@query("select 'link_status' as grp, coalesce(link_status, 'null') as metric, count(*) as n from satellite_links group by 2 union all select 'link_method', coalesce(link_method, 'null'), count(*) from satellite_links group by 2 union all select 'link_confidence', coalesce(link_confidence, 'null'), count(*) from satellite_links group by 2")
def link_report(spark: S, sf: str) -> DataFrame:
    cols = ["link_status", "link_method", "link_confidence"]
    l = table(spark, sf, "satellite_links", *cols).select(*[F.coalesce(c, F.lit("null")).alias(c) for c in cols])
    return l.unpivot([], cols, "grp", "metric").groupBy("grp", "metric").agg(F.count("*").alias("n"))


@query(f"with {CATALOG} select cluster_uid, sum(coalesce(n_source_stations_in_cluster, 0)) as n_stations, string_agg(distinct river_name, '|' order by river_name) as rivers, min(station_name) as first_name from cat group by 1")
def merged_catalog(spark: S, sf: str) -> DataFrame:
    g = catalog(spark, sf).groupBy("cluster_uid").agg(F.sum(F.coalesce("n_source_stations_in_cluster", F.lit(0))).alias("n_stations"), F.sort_array(F.collect_set("river_name")).alias("r"), F.min("station_name").alias("first_name"))
    return g.select("cluster_uid", "n_stations", F.when(F.size("r") > 0, F.array_join("r", "|")).alias("rivers"), "first_name")


@query(f"with {OBS}, g as (select source_station_uid u, obs_date, q, lag(q) over (partition by source_station_uid order by obs_date, record_id) p from obs where q is not null) select u as source_station_uid, count(p) as n_steps, round(avg(abs(q - p)), 6) as mean_step from g group by 1")
def successive_difference(spark: S, sf: str) -> DataFrame:
    o = observations(spark, sf).filter("q is not null").withColumn("p", F.lag("q").over(W.partitionBy("source_station_uid").orderBy("obs_date", "record_id")))
    return o.groupBy("source_station_uid").agg(F.count("p").alias("n_steps"), F.round(F.avg(F.abs(F.col("q") - F.col("p"))), 6).alias("mean_step"))


@query(f"with {PAIRED}, r as (select satellite_source, rank() over (partition by satellite_source order by x) + (count(*) over (partition by satellite_source, x) - 1) / 2.0 rx, rank() over (partition by satellite_source order by y) + (count(*) over (partition by satellite_source, y) - 1) / 2.0 ry from pr) select satellite_source, round(corr(rx, ry), 6) as spearman from r group by 1")
def spearman(spark: S, sf: str) -> DataFrame:
    p = paired(spark, sf).select("satellite_source", "x", "y")
    r = average_rank(average_rank(p, ["satellite_source"], "x", "rx"), ["satellite_source"], "y", "ry")
    return r.groupBy("satellite_source").agg(F.round(F.corr("rx", "ry"), 6).alias("spearman"))


@query("select satellite_record_id, satellite_time, satellite_ssc, ingested_at from (select *, row_number() over (partition by satellite_record_id order by ingested_at desc nulls last, satellite_time desc nulls last, satellite_ssc desc nulls last) k from satellite_obs) where k = 1")
def dedup_keep_last(spark: S, sf: str) -> DataFrame:
    """The row of each record that was loaded last (null loads first), whole."""
    s = table(spark, sf, "satellite_obs", "satellite_record_id", "satellite_time", "satellite_ssc", "ingested_at")
    return s.groupBy("satellite_record_id").agg(F.max(F.struct("ingested_at", "satellite_time", "satellite_ssc")).alias("l")).select("satellite_record_id", "l.*")


@query("select source_station_id, count(*) as n from source_stations group by 1 having count(*) > 1")
def duplicate_keys(spark: S, sf: str) -> DataFrame:
    return table(spark, sf, "source_stations", "source_station_id").groupBy("source_station_id").agg(F.count("*").alias("n")).filter("n > 1")


@query(f"with {OBS} select cluster_uid, rank, record_id, ssc from (select cluster_uid, record_id, ssc, row_number() over (partition by cluster_uid order by ssc desc, record_id) rank from obs where ssc is not null) where rank <= 5")
def topk_extremes(spark: S, sf: str) -> DataFrame:
    """The five largest concentrations of each cluster. A rank limit over a window keeps five rows a group on the map side first."""
    o = observations(spark, sf).filter("ssc is not null").select("cluster_uid", "record_id", "ssc")
    return o.withColumn("rank", F.row_number().over(W.partitionBy("cluster_uid").orderBy(F.col("ssc").desc(), "record_id"))).filter("rank <= 5").select("cluster_uid", "rank", "record_id", "ssc")


@query(f"with {OBS} select cluster_uid, max(ssc) as ssc, max_by(record_id, (ssc, -record_id)) as record_id from (select * from obs where ssc is not null) group by 1")
def argmax_row(spark: S, sf: str) -> DataFrame:
    o = observations(spark, sf).filter("ssc is not null").groupBy("cluster_uid")
    return o.agg(F.max("ssc").alias("ssc"), F.max_by("record_id", F.struct("ssc", -F.col("record_id"))).alias("record_id"))


@query("select o_orderkey from orders where cast(('0x' || substr(md5(o_orderkey || ':42'), 1, 8)) as bigint) % 20 = 0")
def hash_sample(spark: S, sf: str) -> DataFrame:
    """A one-in-twenty sample by hash: the sampling operator itself."""
    from fluvion.operators import ordering

    return ordering.hash_sample(table(spark, sf, "orders", "o_orderkey"), "o_orderkey", 20)


@query("select o_orderpriority, o_orderkey from (select *, row_number() over (partition by o_orderpriority order by md5(o_orderkey || ':7'), o_orderkey) k from orders) where k <= 25")
def stratified_sample(spark: S, sf: str) -> DataFrame:
    """Twenty-five orders of each priority, in the order of a seeded hash."""
    o = table(spark, sf, "orders", "o_orderkey", "o_orderpriority")
    h = F.md5(F.concat(F.col("o_orderkey").cast("string"), F.lit(":7")))
    return o.withColumn("k", F.row_number().over(W.partitionBy("o_orderpriority").orderBy(h, "o_orderkey"))).filter("k <= 25").select("o_orderpriority", "o_orderkey")


@query(f"with {STATIONS} select resolution, n, row_number() over (order by case resolution when 'daily' then 0 when 'monthly' then 1 when 'annual' then 2 else 3 end, resolution) as position from (select resolution, count(*) n from st group by 1)")
def enum_order(spark: S, sf: str) -> DataFrame:
    g = stations(spark, sf).groupBy("resolution").agg(F.count("*").alias("n"))
    o = F.when(F.col("resolution") == "daily", 0).when(F.col("resolution") == "monthly", 1).when(F.col("resolution") == "annual", 2).otherwise(3)
    return g.withColumn("position", F.row_number().over(W.orderBy(o, "resolution")))


@query(None)
def bootstrap_ci(spark: S, sf: str) -> DataFrame:
    """Bootstrap interval of the median ratio of each source, resampling clusters."""
    from fluvion.operators.resample import bootstrap_median

    c = exact_quantiles(paired(spark, sf).filter("x > 0 and y > 0"), ["satellite_source", "cluster_uid"], {"r": (F.col("x") / F.col("y"), 0.5)})
    return bootstrap_median(c, "satellite_source", "cluster_uid", "r")
