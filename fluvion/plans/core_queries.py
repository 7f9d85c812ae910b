"""Queries of the general problems: points near points (p2), implausible readings (p3), units (p4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvion.functions.geo import valid_position
from fluvion.functions.text import canonical_uid
from fluvion.operators.spatial import within_distance
from fluvion.operators.spikes import implausible_readings
from fluvion.operators.units import loads_in_kg_per_day, unit_changes
from fluvion.sources.tables import table


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    links = table(spark, sf, "satellite_links", "satellite_key", "satellite_lat", "satellite_lon", "linked_cluster_id", "linked_cluster_uid", "linked_lat", "linked_lon")
    stations = links.select("satellite_key", "satellite_lat", "satellite_lon").filter(F.col("satellite_key").isNotNull() & valid_position(F.col("satellite_lat"), F.col("satellite_lon"))).distinct()
    clusters = links.select(canonical_uid(F.col("linked_cluster_uid"), F.col("linked_cluster_id")).alias("linked_cluster_uid"), "linked_lat", "linked_lon")
    clusters = clusters.filter(F.col("linked_cluster_uid").isNotNull() & valid_position(F.col("linked_lat"), F.col("linked_lon"))).distinct()
    near = within_distance(stations, "satellite_lat", "satellite_lon", clusters, "linked_lat", "linked_lon", 2000.0)
    return near.select("satellite_key", "linked_cluster_uid").distinct()


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    daily = table(spark, sf, "daily_matrix", "record_id", "source_station_uid", "obs_date", "q", "ssc", "ssl")
    return implausible_readings(daily, "record_id", "source_station_uid", "obs_date", ["q", "ssc", "ssl"]).select("record_id", "variable")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    values = table(spark, sf, "source_values", "value_id", "field_id", "obs_date", "raw_value", "raw_text")
    fields = table(spark, sf, "source_fields", "field_id", "raw_unit", "ssl_field", "notes", "normalized_unit")
    return loads_in_kg_per_day(values, fields).select("value_id", F.round("load").cast("bigint").alias("load_kg_per_day"))


def p4_unit_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of level in each field's recorded values, with the known factor that explains them."""
    values = table(spark, sf, "source_values", "value_id", "field_id", "obs_date", "raw_value").dropDuplicates(["value_id"])
    seg = unit_changes(values.filter(F.col("raw_value") > 0), "field_id", "obs_date", "raw_value")
    return seg.select("field_id", "segment", "starts_at", "ends_at", "n_values", F.round("level", 6).alias("level"), F.round("shift", 6).alias("shift"), F.round("factor", 6).alias("factor"))


QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p4_found": p4_found, "p4_unit_changes": p4_unit_changes}

_D = "2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin(radians(c.la - s.la) / 2), 2) + cos(radians(s.la)) * cos(radians(c.la)) * pow(sin(radians(c.lo - s.lo) / 2), 2))))"
_POS = "{0}_lat between -90 and 90 and {0}_lon between -180 and 360 and not isnan({0}_lat) and not isnan({0}_lon)"
_MASS = "milligrams?|mg|kilograms?|kg|grams?|g|(?:us )?short tons?|metric tons?|megatonnes?|mt|kilotonnes?|kt|tonnes?|tonnen|toneladas?|tons?|t|pounds?|lbs?"
_TIME = "seconds?|sec|s|hours?|hr|h|days?|dia|jour|tag|d|months?|month|mois|mo|years?|yr|annually|an|a"
_UNIT = f"(?:^|[^a-z0-9^.,])(?:x ?)?(10\\^3|10\\^6|1000|thousand|million)? ?({_MASS}) ?(?:/| per | pro | par | por |[ .]) ?({_TIME})[.]?(?: ?\\^?-1)?(?:[^a-z0-9]|$)"

ORACLE = {
    "p4_found": f"""
with fx as (select distinct field_id, raw_unit, ssl_field, notes, normalized_unit from source_fields),
vx as (select distinct value_id, field_id, obs_date, raw_value, raw_text, regexp_extract(raw_text, '^(?:ca[.] ?|approx[.] ?|load: ?|~ ?)?(-?[0-9][0-9,]*[.]?[0-9]*(?:e[+-]?[0-9]+)?)', 1) num from source_values),
vn as (select *, try_cast(replace(num, ',', '') as double) number, ' ' || replace(coalesce(raw_text, ''), num, ' ') rest from vx),
texts as (select raw_unit t from fx union select ssl_field from fx union select notes from fx union select normalized_unit from fx union select rest from vn),
norm as (select t, ' ' || regexp_replace(regexp_replace(replace(replace(replace(replace(strip_accents(lower(t)), '⁻¹', '-1'), '³', '^3'), '×', 'x '), '·', ' '), '[^a-z0-9^/.,-]', ' ', 'g'), ' +', ' ', 'g') || ' ' n from texts where t is not null),
hit as (select t, regexp_extract(n, '{_UNIT}', 1) k, regexp_extract(n, '{_UNIT}', 2) m, regexp_extract(n, '{_UNIT}', 3) d from norm),
unit as (select t, case when k in ('10^3', '1000', 'thousand') then 1e3 when k in ('10^6', 'million') then 1e6 else 1 end * case when m in ('mg', 'milligram', 'milligrams') then 1e-6 when m in ('g', 'gram', 'grams') then 1e-3 when m like 'kg%' or m like 'kilogram%' then 1 when m like 'lb%' or m like 'pound%' then 0.45359237 when m like '%short%' then 907.18474 when m like 'kt' or m like 'kilot%' then 1e6 when m = 'mt' or m like 'megat%' then 1e9 else 1e3 end kg,
 case when d in ('s', 'sec') or d like 'second%' then 1 / 86400.0 when d in ('h', 'hr') or d like 'hour%' then 1 / 24.0 when d in ('mo', 'mois') or d like 'month%' then 0 when d in ('a', 'an', 'yr', 'annually') or d like 'year%' then 365.25 else 1 end nd from hit where m <> ''),
fu as (select field_id, min_by(kg, p) kg, min_by(nd, p) nd from (select field_id, 1 p, raw_unit t from fx union all select field_id, 2, ssl_field from fx union all select field_id, 3, notes from fx union all select field_id, 4, normalized_unit from fx) x join unit using (t) group by 1),
a as (select vn.*, u.kg ukg, u.nd und, fu.kg fkg, fu.nd fnd, coalesce(case when isnan(raw_value) or raw_value = -9999 then null else raw_value end, case when u.kg is not null or trim(rest) = '' then case when number <> -9999 then number end end) amount from vn left join unit u on u.t = vn.rest left join fu using (field_id))
select value_id, cast(round(amount * coalesce(ukg, fkg) / (case when coalesce(und, fnd) = 0 then day(last_day(obs_date)) else coalesce(und, fnd) end)) as bigint) as load_kg_per_day from a where amount is not null and coalesce(ukg, fkg) is not null""",
    "p2_found": f"""
with s as (select distinct satellite_key k, satellite_lat la, satellite_lon lo from satellite_links where satellite_key is not null and {_POS.format('satellite')}),
c as (select distinct 'SED' || lpad(cast(coalesce(cast(linked_cluster_id as bigint), try_cast(regexp_extract(upper(trim(linked_cluster_uid)), '([0-9]+)$', 1) as bigint)) as varchar), 6, '0') u, linked_lat la, linked_lon lo from satellite_links where {_POS.format('linked')} and (linked_cluster_id is not null or linked_cluster_uid is not null))
select distinct k as satellite_key, u as linked_cluster_uid from s, c where abs(s.la - c.la) < 0.02 and {_D} <= 2000""",
}
