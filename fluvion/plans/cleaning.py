"""Projections, cleaning rules, keys and scalar functions over the station tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluvion.functions import domain as D
from fluvion.functions.geo import haversine_m, symmetric_relative_error
from fluvion.functions.text import clean_text
from fluvion.plans.common import CATALOG, MISSING_SQL, STATIONS, catalog, clean_sql, stations
from fluvion.plans.registry import query
from fluvion.sources.tables import table

S = SparkSession


@query(f"select station_id, {clean_sql('station_name')} station_name, substr({clean_sql('river_name')}, 1, 5) river_head from (select distinct station_id, station_name, river_name from source_stations)")
def text_clean(spark: S, sf: str) -> DataFrame:
    s = table(spark, sf, "source_stations", "station_id", "station_name", "river_name").distinct()
    return s.select("station_id", clean_text("station_name").alias("station_name"), clean_text("river_name", 5).alias("river_head"))


@query(f"with {CATALOG} select catalog_row_id, coalesce(station_name, river_name, source_station_id, '') as label from cat")
def first_nonempty_alias(spark: S, sf: str) -> DataFrame:
    return catalog(spark, sf).select("catalog_row_id", F.coalesce("station_name", "river_name", "source_station_id", F.lit("")).alias("label"))


@query(f"with {STATIONS} select station_id, array_to_string(list_distinct_ordered, ' | ') as merged from (select station_id, list_filter([source, station_name, river_name, country], lambda x: x is not null) list_distinct_ordered from st)")
def merge_prefixed_text(spark: S, sf: str) -> DataFrame:
    parts = F.array_compact(F.array("source", "station_name", "river_name", "country"))
    return stations(spark, sf).select("station_id", F.array_join(parts, " | ").alias("merged"))


@query("select value_id, try_cast(trim(raw_text) as double) as number from (select distinct value_id, raw_text from source_values) where raw_text is not null")
def scalar_coerce(spark: S, sf: str) -> DataFrame:
    v = table(spark, sf, "source_values", "value_id", "raw_text").filter("raw_text is not null").distinct()
    return v.select("value_id", F.trim("raw_text").try_cast("double").alias("number"))


@query("select lower(trim(decision)) as decision, count(*) as n, coalesce(lower(trim(decision)) in ('1','true','yes','y','t'), false) as truth from station_pairs group by 1")
def bool_coerce(spark: S, sf: str) -> DataFrame:
    return table(spark, sf, "station_pairs", "decision").groupBy(F.lower(F.trim("decision")).alias("decision")).agg(F.count("*").alias("n")).withColumn("truth", D.truthy(F.col("decision")))


@query("select flag, count(*) as n from (select case when q_flag = -127 then 9 else coalesce(q_flag, 9) end as flag from daily_matrix) group by flag")
def flag_normalise(spark: S, sf: str) -> DataFrame:
    flag = F.when(F.col("q_flag") == -127, 9).otherwise(F.coalesce("q_flag", F.lit(9))).alias("flag")
    return table(spark, sf, "daily_matrix", "q_flag").groupBy(flag).agg(F.count("*").alias("n"))


_UNIT_SQL = "lower(regexp_replace(trim(raw_unit), '[\\[\\]()]', '', 'g'))"


@query(f"select field_id, case when {_UNIT_SQL} ~ '(m3|m\\^3).*(/s| s)' then 'discharge' when {_UNIT_SQL} ~ '(mg|g|kg)/(l|m3)' then 'concentration' when {_UNIT_SQL} ~ 'km-?2' then 'yield' when {_UNIT_SQL} ~ '^(mg|g|kg|t|kt|mt|lb|short|metric|us|tonne|ton|mill|thou|mega|kilo|gram|pound|10|1000|×)' then 'load' else 'unknown' end as kind from (select distinct field_id, raw_unit from source_fields)")
def unit_classify(spark: S, sf: str) -> DataFrame:
    u = F.lower(F.regexp_replace(F.trim("raw_unit"), r"[\[\]()]", ""))
    kind = F.when(u.rlike(r"(m3|m\^3).*(/s| s)"), "discharge").when(u.rlike("(mg|g|kg)/(l|m3)"), "concentration").when(u.rlike("km-?2"), "yield").when(u.rlike("^(mg|g|kg|t|kt|mt|lb|short|metric|us|tonne|ton|mill|thou|mega|kilo|gram|pound|10|1000|×)"), "load").otherwise("unknown")
    return table(spark, sf, "source_fields", "field_id", "raw_unit").distinct().select("field_id", kind.alias("kind"))


@query("select station_id, case when r like '%climatolog%' then 'climatology' when r like '%quarter%' or r like '%month%' then 'monthly' when r like '%annual%' or r like '%year%' then 'annual' when r like '%daily%' or r like '%hour%' then 'daily' when r = 'single_point' then 'single_point' end as resolution from (select distinct station_id, lower(trim(resolution)) r from source_stations)")
def resolution_normalise(spark: S, sf: str) -> DataFrame:
    return table(spark, sf, "source_stations", "station_id", "resolution").dropDuplicates(["station_id"]).select("station_id", D.resolution_name(F.col("resolution")).alias("resolution"))


_KEY_SQL = "regexp_replace(regexp_replace(translate(lower(trim({0})), '- ', '__'), '_+', '_', 'g'), '^_|_$', '', 'g')"


@query(f"select {_KEY_SQL.format('source')} as source_key, count(*) as n_rows, count(distinct source) as n_spellings from source_stations group by 1")
def source_key_normalise(spark: S, sf: str) -> DataFrame:
    s = table(spark, sf, "source_stations", "source")
    return s.groupBy(D.source_key(F.col("source")).alias("source_key")).agg(F.count("*").alias("n_rows"), F.countDistinct("source").alias("n_spellings"))


_FAMILY_SQL = f"""case when k in ('riversed','river_sed','gsed','dethier','satellite','remote_sensing') then 'satellite' when k in ('milliman','hma','ali_de_boer','vanmaercke') then 'climatology'
 when t like '%satellite%' or t like '%remote%' then 'satellite' when t like '%climatolog%' then 'climatology' when t like '%situ%' or t like '%station%' or t like '%gauge%' then 'in_situ' else 'other' end"""
_FAM = f"f as (select station_id, {_FAMILY_SQL} as family from (select distinct station_id, {_KEY_SQL.format('source')} k, {_KEY_SQL.format('observation_type')} t from source_stations))"


def _families(spark: S, sf: str) -> DataFrame:
    s = table(spark, sf, "source_stations", "station_id", "source", "resolution", "observation_type").dropDuplicates(["station_id"])
    return s.select("station_id", D.source_family(F.col("source"), F.col("resolution"), F.col("observation_type")).alias("family"))


@query(f"with {_FAM} select family, count(*) as n_stations from f group by family")
def source_family(spark: S, sf: str) -> DataFrame:
    return _families(spark, sf).groupBy("family").agg(F.count("*").alias("n_stations"))


@query(f"with {_FAM} select station_id, case family when 'satellite' then 'validation_only' when 'climatology' then 'excluded_from_main_merge' else 'merge_candidate' end as policy, family not in ('satellite','climatology') as eligible, case when family in ('satellite','climatology') then 'source_family=' || family || ' excluded from default main merge' else '' end as reason from f")
def merge_policy(spark: S, sf: str) -> DataFrame:
    out = F.col("family").isin("satellite", "climatology")
    reason = F.when(out, F.concat(F.lit("source_family="), "family", F.lit(" excluded from default main merge"))).otherwise("")
    return _families(spark, sf).select("station_id", D.merge_policy(F.col("family")).alias("policy"), (~out).alias("eligible"), reason.alias("reason"))


_LINKS = "lk as (select distinct satellite_station_id, satellite_key, satellite_source, satellite_lat, satellite_lon, satellite_comid, satellite_uparea_merit, linked_cluster_id, link_status, link_method, representative_point_distance_m d, rejection_reason from satellite_links)"


@query(f"""with {_LINKS}, q as (select *, case when link_method = 'same_reach' then 'area_matched' when link_method is null then 'failed' else 'distance_only' end ql from lk)
select satellite_station_id, linked_cluster_id, d as distance_m, case when linked_cluster_id is null or ql = 'failed' then 'unresolved' when d <= 300 or (d <= 1000 and ql = 'area_matched') then 'resolved' else 'unresolved' end as basin_status,
case when linked_cluster_id is null or ql = 'failed' then 'no_match' when d <= 300 or (d <= 1000 and ql = 'area_matched') then 'ok' when d > 1000 then 'large_offset' else 'geometry_inconsistent' end as basin_flag from q""")
def basin_policy(spark: S, sf: str) -> DataFrame:
    l = table(spark, sf, "satellite_links").drop("created_at", "linked_lat", "linked_lon", "linked_cluster_uid", "link_confidence", "linked_source", "satellite_resolution").distinct()
    quality = F.when(F.col("link_method") == "same_reach", "area_matched").when(F.col("link_method").isNull(), "failed").otherwise("distance_only")
    r = D.basin_result(F.col("linked_cluster_id"), quality, F.col("representative_point_distance_m"), F.col("satellite_source"), F.lit(False), F.lit(False))
    return l.select("satellite_station_id", "linked_cluster_id", F.col("representative_point_distance_m").alias("distance_m"), r.alias("r")).select("satellite_station_id", "linked_cluster_id", "distance_m", "r.*")


@query(f"with {CATALOG} select coalesce(case when basin_match_quality in ('distance_only','area_matched','area_approximate','area_mismatch','failed') then basin_match_quality end, 'unknown') as quality, count(*) as n from cat group by 1")
def match_quality_vocabulary(spark: S, sf: str) -> DataFrame:
    return catalog(spark, sf).groupBy(D.match_quality(F.col("basin_match_quality")).alias("quality")).agg(F.count("*").alias("n"))


@query(f"with {CATALOG} select catalog_row_id, case when basin_status = 'resolved' then basin_area end as basin_area, case when basin_status = 'resolved' then pfaf_code end as pfaf_code from cat")
def unresolved_mask(spark: S, sf: str) -> DataFrame:
    ok = F.col("basin_status") == "resolved"
    return catalog(spark, sf).select("catalog_row_id", F.when(ok, F.col("basin_area")).alias("basin_area"), F.when(ok, F.col("pfaf_code")).alias("pfaf_code"))


@query("select source, count(*) filter (ssc_flag = 0) as good, count(*) filter (ssc_flag in (0, 1)) as analysis_ready from (select distinct record_id, source, ssc_flag from daily_matrix) group by source")
def allowed_flags(spark: S, sf: str) -> DataFrame:
    d = table(spark, sf, "daily_matrix", "record_id", "source", "ssc_flag").dropDuplicates(["record_id"])
    return d.groupBy("source").agg(F.count_if(F.col("ssc_flag") == 0).alias("good"), F.count_if(F.col("ssc_flag").isin(0, 1)).alias("analysis_ready"))


@query(f"with {STATIONS} select country, count(*) as n, count(lat) as n_valid from st group by country")
def coordinate_validity(spark: S, sf: str) -> DataFrame:
    return stations(spark, sf).groupBy("country").agg(F.count("*").alias("n"), F.count("lat").alias("n_valid"))


@query("select distinct path, split_part(path, '/', 1) as resolution, split_part(path, '/', 2) as source, regexp_extract(path, '([^/]+)[.]nc$', 1) as stem from source_stations where path is not null")
def path_parse(spark: S, sf: str) -> DataFrame:
    p = F.split("path", "/")
    return table(spark, sf, "source_stations", "path").filter("path is not null").distinct().select("path", F.try_element_at(p, F.lit(1)).alias("resolution"), F.try_element_at(p, F.lit(2)).alias("source"), F.regexp_extract("path", r"([^/]+)[.]nc$", 1).alias("stem"))


@query("select distinct '/archive/' || regexp_replace(path, '^(daily|monthly|annual)/', '') as path from source_stations where path is not null")
def path_reroot(spark: S, sf: str) -> DataFrame:
    return table(spark, sf, "source_stations", "path").filter("path is not null").select(F.concat(F.lit("/archive/"), F.regexp_replace("path", "^(daily|monthly|annual)/", "")).alias("path")).distinct()


@query("select field_id, case when k = 1 then stem else stem || '_' || k end as file_name from (select field_id, stem, row_number() over (partition by dataset, stem order by field_id) k from (select distinct field_id, dataset, lower(regexp_replace(ssl_field, '[^A-Za-z]+', '_', 'g')) stem from source_fields))")
def unique_filenames(spark: S, sf: str) -> DataFrame:
    f = table(spark, sf, "source_fields", "field_id", "dataset", "ssl_field").distinct().withColumn("stem", F.lower(F.regexp_replace("ssl_field", "[^A-Za-z]+", "_")))
    k = F.row_number().over(W.partitionBy("dataset", "stem").orderBy("field_id"))
    return f.withColumn("k", k).select("field_id", F.when(F.col("k") == 1, F.col("stem")).otherwise(F.concat_ws("_", "stem", "k")).alias("file_name"))


@query("select distinct station_id, 'S3_' || substr(sha256(lower(trim(source)) || chr(10) || lower(trim(resolution)) || chr(10) || path), 1, 24) as station_key from source_stations where path is not null")
def station_key_hash(spark: S, sf: str) -> DataFrame:
    s = table(spark, sf, "source_stations", "station_id", "source", "resolution", "path").filter("path is not null")
    key = F.concat(F.lit("S3_"), F.substring(F.sha2(F.concat(F.lower(F.trim("source")), F.lit("\n"), F.lower(F.trim("resolution")), F.lit("\n"), "path"), 256), 1, 24))
    return s.select("station_id", key.alias("station_key")).distinct()


@query("select distinct satellite_station_id, 'SATV2' || upper(substr(sha256(satellite_station_id || chr(31) || trim(satellite_source) || chr(31) || trim(satellite_resolution)), 1, 16)) as key from satellite_links where satellite_source is not null and satellite_resolution is not null")
def satellite_key_hash(spark: S, sf: str) -> DataFrame:
    s = table(spark, sf, "satellite_links", "satellite_station_id", "satellite_source", "satellite_resolution").filter("satellite_source is not null and satellite_resolution is not null")
    return s.select("satellite_station_id", F.concat(F.lit("SATV2"), F.upper(F.substring(F.sha2(F.concat_ws("\u001f", F.col("satellite_station_id").cast("string"), F.trim("satellite_source"), F.trim("satellite_resolution")), 256), 1, 16))).alias("key")).distinct()


@query("select path, row_number() over (order by lower(trim(resolution)), lower(trim(source)), path) - 1 as station_no from (select distinct path, resolution, source from (select path, min(resolution) resolution, min(source) source from source_stations where path is not null group by path))")
def station_numbers(spark: S, sf: str) -> DataFrame:
    """0-based numbers in the order of resolution, source and path, without sorting all rows in one task: a range-partitioned
    sort gives each partition its rows, and the sizes of the partitions before give the rest."""
    s = table(spark, sf, "source_stations", "path", "resolution", "source").filter("path is not null").groupBy("path").agg(F.min("resolution").alias("resolution"), F.min("source").alias("source"))
    from fluvion.operators.ordering import global_number

    return global_number(s, [F.lower(F.trim("resolution")), F.lower(F.trim("source")), F.col("path")], "station_no").select("path", "station_no")


@query("select event_id, try_cast(json_extract_string(props, '$.k') as int) as k from events")
def json_props(spark: S, sf: str) -> DataFrame:
    return table(spark, sf, "events", "event_id", "props").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


_GRAMS = "list_distinct(list_transform(range(1, greatest(length({0}), 1)), lambda i: substr({0}, i, 2)))"


@query(f"""with n as (select distinct lower(trim(station_name)) a, lower(trim(river_name)) b from source_stations where station_name is not null and river_name is not null)
select a, b, round(coalesce(2.0 * len(list_intersect({_GRAMS.format('a')}, {_GRAMS.format('b')})) / nullif(len({_GRAMS.format('a')}) + len({_GRAMS.format('b')}), 0), 0), 6) as dice from n""")
def bigram_dice(spark: S, sf: str) -> DataFrame:
    grams = lambda c: F.when(F.length(c) < 2, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.substring(F.col(c), i, 2))))
    n = table(spark, sf, "source_stations", "station_name", "river_name").filter("station_name is not null and river_name is not null").select(F.lower(F.trim("station_name")).alias("a"), F.lower(F.trim("river_name")).alias("b")).distinct()
    n = n.withColumn("ga", grams("a")).withColumn("gb", grams("b"))
    dice = 2.0 * F.size(F.array_intersect("ga", "gb")) / F.nullif((F.size("ga") + F.size("gb")).cast("double"), F.lit(0.0))
    return n.select("a", "b", F.round(F.coalesce(dice, F.lit(0.0)), 6).alias("dice"))


@query("select record_id, round(abs(q - ssc) / greatest(abs(q), abs(ssc)), 6) as rel, round(log10(least(greatest(q / ssc, 0.001), 1000)), 6) as log_ratio from (select distinct record_id, q, ssc from daily_matrix) where q > 0 and ssc > 0 and not isnan(q) and not isnan(ssc)")
def relative_error(spark: S, sf: str) -> DataFrame:
    d = table(spark, sf, "daily_matrix", "record_id", "q", "ssc").filter("q > 0 and ssc > 0 and not isnan(q) and not isnan(ssc)").distinct()
    return d.select("record_id", F.round(symmetric_relative_error(F.col("q"), F.col("ssc")), 6).alias("rel"), F.round(F.log10(F.least(F.greatest(F.col("q") / F.col("ssc"), F.lit(0.001)), F.lit(1000.0))), 6).alias("log_ratio"))


@query(f"with {_LINKS} select satellite_station_id, d as distance_m, linked_cluster_id, round(d / 5000 + abs(log10(satellite_uparea_merit / 1000)), 6) as score from lk where d is not null and satellite_uparea_merit > 0")
def weighted_score(spark: S, sf: str) -> DataFrame:
    l = table(spark, sf, "satellite_links", "satellite_station_id", "satellite_key", "satellite_source", "satellite_lat", "satellite_lon", "satellite_comid", "satellite_uparea_merit", "linked_cluster_id", "link_status", "link_method", "representative_point_distance_m", "rejection_reason").distinct().withColumnRenamed("representative_point_distance_m", "distance_m").filter("distance_m is not null and satellite_uparea_merit > 0")
    return l.select("satellite_station_id", "distance_m", "linked_cluster_id", F.round(F.col("distance_m") / 5000 + F.abs(F.log10(F.col("satellite_uparea_merit") / 1000)), 6).alias("score"))


@query("select case when ssc < 10 then '<10' when ssc < 100 then '10-100' when ssc < 1000 then '100-1000' else '>=1000' end as bin, count(*) as n from (select distinct record_id, ssc from daily_matrix) where ssc >= 0 and not isnan(ssc) group by 1")
def value_bins(spark: S, sf: str) -> DataFrame:
    d = table(spark, sf, "daily_matrix", "record_id", "ssc").filter("ssc >= 0 and not isnan(ssc)").distinct()
    b = F.when(F.col("ssc") < 10, "<10").when(F.col("ssc") < 100, "10-100").when(F.col("ssc") < 1000, "100-1000").otherwise(">=1000")
    return d.groupBy(b.alias("bin")).agg(F.count("*").alias("n"))


@query("select insitu_record_id, case ssc_flag when 0 then 0 when 1 then 1 when 2 then 2 when 3 then 3 else 9 end as flag_rank from (select distinct insitu_record_id, ssc_flag from insitu_obs)")
def flag_rank(spark: S, sf: str) -> DataFrame:
    i = table(spark, sf, "insitu_obs", "insitu_record_id", "ssc_flag").distinct()
    return i.select("insitu_record_id", F.when(F.col("ssc_flag").isin(0, 1, 2, 3), F.col("ssc_flag")).otherwise(9).alias("flag_rank"))


@query("""select source, case when abs(r - 1) <= 0.1 then '1' when abs(r - 10) <= 1 then '10' when abs(r - 0.1) <= 0.01 then '0.1' when abs(r - 1000) <= 100 then '1000' when abs(r - 0.001) <= 0.0001 then '0.001' else 'other' end as ratio_class, count(*) as n
from (select source, ssl / (q * ssc * 0.0864) r from (select distinct record_id, source, q, ssc, ssl from daily_matrix) where q > 0 and ssc > 0 and ssl > 0 and not isnan(q) and not isnan(ssc) and not isnan(ssl)) group by 1, 2""")
def load_formula_check(spark: S, sf: str) -> DataFrame:
    d = table(spark, sf, "daily_matrix", "record_id", "source", "q", "ssc", "ssl").filter("q > 0 and ssc > 0 and ssl > 0 and not isnan(q) and not isnan(ssc) and not isnan(ssl)").distinct()
    r = F.col("ssl") / (F.col("q") * F.col("ssc") * 0.0864)
    near = lambda x: F.abs(r - x) <= x / 10
    c = F.when(F.abs(r - 1) <= 0.1, "1").when(F.abs(r - 10) <= 1, "10").when(F.abs(r - 0.1) <= 0.01, "0.1").when(F.abs(r - 1000) <= 100, "1000").when(F.abs(r - 0.001) <= 0.0001, "0.001").otherwise("other")
    return d.groupBy("source", c.alias("ratio_class")).agg(F.count("*").alias("n"))


@query("select distinct field_id as record_no, dataset as source_dataset, regexp_replace(file_path, '^.*/', '') as file_name from source_fields")
def public_names(spark: S, sf: str) -> DataFrame:
    f = table(spark, sf, "source_fields", "field_id", "dataset", "file_path").distinct()
    return f.withColumn("file_path", F.regexp_replace("file_path", "^.*/", "")).withColumnsRenamed({"field_id": "record_no", "dataset": "source_dataset", "file_path": "file_name"})


@query(f"with {STATIONS} select station_id, case when lat >= 84 then 32661 when lat <= -80 then 32761 else (case when lat >= 0 then 32600 else 32700 end) + least(60, cast(floor((lon + 180) / 6) as int) + 1) end as epsg, round(sqrt(reported_area * 1e6 / pi()), 4) as buffer_m from st where lat is not null")
def local_projection(spark: S, sf: str) -> DataFrame:
    zone = F.least(F.lit(60), F.floor((F.col("lon") + 180) / 6).cast("int") + 1)
    epsg = F.when(F.col("lat") >= 84, 32661).when(F.col("lat") <= -80, 32761).otherwise(F.when(F.col("lat") >= 0, 32600).otherwise(32700) + zone)
    return stations(spark, sf).filter("lat is not null").select("station_id", epsg.alias("epsg"), F.round(F.sqrt(F.col("reported_area") * 1e6 / F.pi()), 4).alias("buffer_m"))


@query(f"""with {STATIONS}, b as (select station_id, lon - 50 / (111.195 * cos(radians(lat))) w, lon + 50 / (111.195 * cos(radians(lat))) e from st where lat is not null and abs(lat) < 80)
select station_id, round(w, 5) as west, round(e, 5) as east from b where w >= -180 and e <= 180 union all select station_id, round(w + 360, 5), 180.0 from b where w < -180 union all select station_id, -180.0, round(e, 5) from b where w < -180
union all select station_id, round(w, 5), 180.0 from b where e > 180 union all select station_id, -180.0, round(e - 360, 5) from b where e > 180""")
def metric_boxes(spark: S, sf: str) -> DataFrame:
    b = stations(spark, sf).filter("lat is not null and abs(lat) < 80").withColumn("h", 50 / (111.195 * F.cos(F.radians("lat"))))
    w, e = F.col("lon") - F.col("h"), F.col("lon") + F.col("h")
    box = lambda x, y: F.struct(x.alias("west"), y.alias("east"))
    boxes = F.when(w < -180, F.array(box(w + 360, F.lit(180.0)), box(F.lit(-180.0), e))).when(e > 180, F.array(box(w, F.lit(180.0)), box(F.lit(-180.0), e - 360))).otherwise(F.array(box(w, e)))
    return b.select("station_id", F.explode(boxes).alias("x")).select("station_id", F.round("x.west", 5).alias("west"), F.round("x.east", 5).alias("east"))


@query("select distinct obs_date, cast(date_trunc('month', obs_date) as date) as month_start, last_day(obs_date) as month_end, day(last_day(obs_date)) as days_in_month, year(obs_date) as y, (year(obs_date) % 4 = 0 and (year(obs_date) % 100 <> 0 or year(obs_date) % 400 = 0)) as leap from daily_matrix")
def date_scalars(spark: S, sf: str) -> DataFrame:
    y = F.year("obs_date")
    return table(spark, sf, "daily_matrix", "obs_date").distinct().select("obs_date", F.trunc("obs_date", "MM").alias("month_start"), F.last_day("obs_date").alias("month_end"), F.day(F.last_day("obs_date")).cast("bigint").alias("days_in_month"), y.cast("bigint").alias("y"), ((y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))).alias("leap"))


@query(f"with {CATALOG} select catalog_row_id, len(list_distinct(string_split(sources_used, '|'))) as n_sources, array_to_string(list_sort(list_distinct(string_split(sources_used, '|')))[1:2], '|') as first_two from cat where sources_used is not null")
def source_arrays(spark: S, sf: str) -> DataFrame:
    a = F.array_sort(F.array_distinct(F.split("sources_used", r"\|")))
    return catalog(spark, sf).filter("sources_used is not null").select("catalog_row_id", F.size(a).cast("bigint").alias("n_sources"), F.array_join(F.slice(a, 1, 2), "|").alias("first_two"))


@query(f"with {STATIONS} select station_id, country, to_json(struct_pack(lat := lat, lon := lon)) is not null as has_payload, coalesce(station_name, '') || '|' || coalesce(river_name, '') as promoted from st")
def payload_promotion(spark: S, sf: str) -> DataFrame:
    """Attributes carried as a map and promoted to fields again."""
    m = F.map_filter(F.create_map(F.lit("station"), F.col("station_name"), F.lit("river"), F.col("river_name")), lambda k, v: v.isNotNull())
    s = stations(spark, sf).withColumn("m", m)
    at = lambda k: F.coalesce(F.element_at("m", F.lit(k)), F.lit(""))
    return s.select("station_id", "country", F.to_json(F.struct("lat", "lon")).isNotNull().alias("has_payload"), F.concat(at("station"), F.lit("|"), at("river")).alias("promoted"))


@query("select count(*) filter (path like '/%') as absolute_paths, count(*) filter (regexp_matches(path, '^[A-Za-z]:')) as drive_paths, count(*) as n from (select distinct path from source_stations where path is not null)")
def path_leaks(spark: S, sf: str) -> DataFrame:
    return table(spark, sf, "source_stations", "path").filter("path is not null").distinct().agg(F.count_if(F.col("path").startswith("/")).alias("absolute_paths"), F.count_if(F.col("path").rlike("^[A-Za-z]:")).alias("drive_paths"), F.count("*").alias("n"))
