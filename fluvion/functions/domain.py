"""Vocabularies and rules of the observation domain as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source names of each family, in the form of source_key.
IN_SITU = ("glorise", "gfqa_v2", "gfqa", "usgs", "usgs_nwis", "hydat", "bayern", "eusedcollab", "eurasian_river", "hybam", "rhine", "mekong_delta", "myanmar", "yajiang", "chao_phraya_river", "robotham", "nerc", "fukushima", "shashi_jianli", "huanghe")
CLIMATOLOGY = ("milliman", "hma", "ali_de_boer", "vanmaercke")
SATELLITE = ("riversed", "river_sed", "gsed", "dethier")
# Other spellings of source names.
SOURCE_ALIASES = {"ali_&_de_boer": "ali_de_boer", "ali_and_de_boer": "ali_de_boer", "ali_de_boer_(upper_indus)": "ali_de_boer", "high_mountain_asia": "hma", "high_mountain_asia_(hma)": "hma", "milliman_&_farnsworth": "milliman", "milliman_and_farnsworth": "milliman", "milliman_farnsworth": "milliman", "vanmaercke_et_al": "vanmaercke", "vanmaercke_et_al.": "vanmaercke", "vanmaercke_africa": "vanmaercke", "riversed_(usa)": "riversed", "rivsed": "riversed", "aquasat": "riversed", "huanghe_(yellow_river)": "huanghe", "yellow_river": "huanghe", "chao_phraya": "chao_phraya_river", "nerc_avon": "nerc", "nerc_hampshire_avon": "nerc", "hampshire_avon": "nerc"}
# Observation types that name a family themselves.
TYPE_WORDS = {"satellite": ("satellite", "remote_sensing", "remote_sensing_observation", "satellite_observation"), "in_situ": ("in_situ", "insitu", "in_situ_observation", "station", "station_observation", "gauge", "gauge_observation", "in_situ_station_data"), "secondary_compilation": ("secondary_compilation", "compiled", "compilation", "secondary", "secondary_dataset")}
MATCH_QUALITIES = ("distance_only", "area_matched", "area_approximate", "area_mismatch", "failed")


def source_key(c: Column) -> Column:
    """Lower case, blanks and hyphens as single underscores, other spellings resolved."""
    k = F.regexp_replace(F.translate(F.lower(F.trim(c)), "- ", "__"), "_+", "_")
    k = F.regexp_replace(k, "^_|_$", "")
    return F.coalesce(F.create_map(*[F.lit(x) for kv in SOURCE_ALIASES.items() for x in kv])[k], k)


def source_family(source: Column, resolution: Column, observation_type: Column) -> Column:
    """The first that fits: satellite, huanghe by resolution, climatology, in situ, compilation, then the type's words."""
    k, r = source_key(source), source_key(resolution)
    t = source_key(observation_type)
    out = F.when(k.isin(*SATELLITE, *TYPE_WORDS["satellite"]), "satellite")
    out = out.when((k == "huanghe") & r.isin("climatology", "annually_climatology"), "climatology").when(k == "huanghe", "in_situ")
    out = out.when(k.isin(*CLIMATOLOGY), "climatology").when(k.isin(*IN_SITU, *TYPE_WORDS["in_situ"]), "in_situ").when(k.isin(*TYPE_WORDS["secondary_compilation"]), "secondary_compilation")
    out = out.when(t.rlike("satellite|remote"), "satellite").when(t.rlike("climatolog"), "climatology").when(t.rlike("situ|station|gauge"), "in_situ")
    return out.otherwise("other")


def merge_policy(family: Column) -> Column:
    return F.when(family == "satellite", "validation_only").when(family == "climatology", "excluded_from_main_merge").otherwise("merge_candidate")


def match_quality(c: Column) -> Column:
    t = F.lower(F.trim(c))
    return F.when(t.isin(*MATCH_QUALITIES), t).otherwise("unknown")


def truthy(c: Column) -> Column:
    """True for 1, true, yes, y, t; false for everything else, null too."""
    return F.coalesce(F.lower(F.trim(c)).isin("1", "true", "yes", "y", "t"), F.lit(False))


def basin_result(basin_id: Column, quality: Column, distance: Column, source: Column, in_local: Column, in_basin: Column) -> Column:
    """struct<basin_status, basin_flag> of a basin match; reach-scale products (gsed, riversed) have their own rule."""
    q, local = match_quality(quality), F.coalesce(in_local, F.lit(False))
    d = F.when(~F.isnan(distance), distance)
    reach = F.coalesce(F.lower(F.trim(source)).isin("gsed", "riversed"), F.lit(False))
    answer = lambda s, f: F.struct(F.lit(s).alias("basin_status"), F.lit(f).alias("basin_flag"))
    ok, far, odd = answer("resolved", "ok"), answer("unresolved", "large_offset"), answer("unresolved", "geometry_inconsistent")
    near = (d <= 300) | ((d <= 1000) & local)
    out = F.when(basin_id.isNull() | (q == "failed"), answer("unresolved", "no_match"))
    out = out.when(reach & near, ok).when(reach & (d > 1000), far).when(reach, odd)
    out = out.when(q == "area_mismatch", answer("unresolved", "area_mismatch"))
    return out.when(near | ((d <= 1000) & q.isin("area_matched", "area_approximate")), ok).when(d > 1000, far).otherwise(odd)


def resolution_name(c: Column) -> Column:
    """Declared resolution in the vocabulary daily, monthly, annual, climatology, single_point; else null."""
    t = F.lower(F.trim(c))
    return F.when(t.rlike("climatolog"), "climatology").when(t.rlike("quarter|month"), "monthly").when(t.rlike("annual|year"), "annual").when(t.rlike(r"daily|^1\s*day$|hour"), "daily").when(t == "single_point", "single_point")


def frequency(hours: Column, n: Column) -> Column:
    """Frequency of a series from the median step in hours and the number of times."""
    return F.when(n < 2, "single_point").when(hours < 2, "hourly").when(hours < 36, "daily").when(hours < 24 * 45, "monthly").when(hours < 24 * 120, "quarterly").when(hours < 24 * 500, "annual").otherwise("irregular")


def semantics(freq: Column, words: Column) -> Column:
    """Resolution that a frequency stands for, with what the file says of single or yearly values."""
    w = F.lower(F.coalesce(words, F.lit("")))
    return (
        F.when(freq.isin("hourly", "daily"), "daily")
        .when(freq.isin("monthly", "quarterly"), "monthly")
        .when((freq == "annual") & w.rlike("climatology|long_term_average|long-term average|historical average"), "climatology")
        .when(freq == "annual", "annual")
        .when((freq == "single_point") & w.rlike("climatology|average|mean"), "climatology")
        .when(freq == "single_point", "daily")
        .when(freq.isin("irregular", "no_time_var"), freq)
        .otherwise("other")
    )


def percent(part: Column, whole: Column, digits: int = 6) -> Column:
    """100 * part / whole, 0 where the whole is 0."""
    return F.coalesce(F.round(F.lit(100.0) * part / F.nullif(whole.cast("double"), F.lit(0.0)), digits), F.lit(0.0))
