"""Queries of the problems tagged llm, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvion.functions.text import MISSING_WORDS, canonical_uid, clean_text, cluster_number, key_text, strip
from fluvion.llm.components import connected_components
from fluvion.llm.golden import best_rows, golden_records
from fluvion.llm.matching import match_sites
from fluvion.llm.mixing import mix, topics
from fluvion.llm.nearest_time import nearest_in_time
from fluvion.llm.pii import find_pii, mask_pii
from fluvion.llm.tokenizer import count_tokens, encode_corpus
from fluvion.session import materialize
from fluvion.sources.tables import table

# --- p1: entities across sources ---------------------------------------------------------------


def p1_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Each linked climatology station with its cluster and confidence."""
    clim = table(spark, sf, "climatology_stations", "station_uid", "station_name", "river_name", "lat", "lon", "reported_area").filter("station_uid is not null")
    cat = table(spark, sf, "station_catalog", "cluster_uid", "cluster_id", "station_name", "river_name", "lat", "lon", "basin_area")
    first = clim.select(F.trim("station_uid").alias("id"), F.col("station_name").alias("name"), F.col("river_name").alias("river"), "lat", "lon", F.when(F.col("reported_area") > 0, F.col("reported_area")).alias("area")).distinct()
    second = cat.select(canonical_uid(F.col("cluster_uid"), F.col("cluster_id")).alias("id"), F.col("station_name").alias("name"), F.col("river_name").alias("river"), "lat", "lon", F.col("basin_area").alias("area")).filter("id is not null").distinct()
    return match_sites(first, second).select(F.col("a").alias("station_uid"), F.col("b").alias("cluster_uid"), "confidence")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return p1_matches(spark, sf).select("station_uid", "cluster_uid")


# --- p5: best representative -------------------------------------------------------------------


def _ranked_catalog(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    cat = table(spark, sf, "station_catalog", "catalog_row_id", "cluster_uid", "cluster_id", "export_tier", "exported_at", *columns)
    tiers = table(spark, sf, "export_tiers").select(key_text("tier").alias("tier"), "trust_rank").groupBy("tier").agg(F.min("trust_rank").alias("trust_rank"))
    cat = cat.withColumn("cluster_id", cluster_number(F.col("cluster_uid"), F.col("cluster_id"))).withColumn("tier", key_text("export_tier"))
    return cat.join(F.broadcast(tiers), "tier", "left")  # four tiers, fixed


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    cat = _ranked_catalog(spark, sf, "sources_used", "n_source_stations_in_cluster")
    fields = {"sources_used": clean_text("sources_used"), "n_source_stations_in_cluster": F.when(F.col("n_source_stations_in_cluster") > 0, F.col("n_source_stations_in_cluster"))}
    return best_rows(cat, "cluster_id", "catalog_row_id", fields, F.col("trust_rank"), "exported_at").select("cluster_id", "field_name", "catalog_row_id")


def p5_golden(spark: SparkSession, sf: str) -> DataFrame:
    """One record built from votes for each cluster."""
    cat = _ranked_catalog(spark, sf, "sources_used", "n_source_stations_in_cluster", "station_name", "river_name", "country")
    fields = {c: clean_text(c) for c in ("station_name", "river_name", "country", "sources_used")}
    fields["n_source_stations_in_cluster"] = F.when(F.col("n_source_stations_in_cluster") > 0, F.col("n_source_stations_in_cluster").cast("int"))
    return golden_records(cat, "cluster_id", "catalog_row_id", fields, 1.0 / F.col("trust_rank"), "exported_at")


# --- p6: groups from pairs ---------------------------------------------------------------------


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    key = lambda c: F.upper(strip(c))
    stations = table(spark, sf, "source_stations", "station_id", "source_station_id").filter("source_station_id is not null and station_id is not null")
    ids = stations.groupBy(key("source_station_id").alias("k")).agg(F.min("station_id").alias("station_id"))
    pairs = table(spark, sf, "station_pairs", "left_source_station_id", "right_source_station_id", "decision").filter(key_text("decision") == "match")
    pairs = pairs.select(key("left_source_station_id").alias("a"), key("right_source_station_id").alias("b")).filter("a is not null and b is not null and a <> b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = pairs.join(ids.toDF("a", "x"), "a").join(ids.toDF("b", "y"), "b").select("x", "y").filter("x <> y")
    groups = connected_components(edges, "x", "y")
    names = stations.groupBy("station_id").agg(F.min("source_station_id").alias("source_station_id"))
    return names.join(groups, names["station_id"] == groups["vertex"]).select("source_station_id", F.col("component").alias("cluster_id"))


# --- p7: nearest in time -----------------------------------------------------------------------


def _usable(df: DataFrame, id_: str, time: str, ssc: str) -> DataFrame:
    ok = F.col(ssc).isNotNull() & ~F.isnan(ssc) & (F.col(ssc) >= 0) & ~F.coalesce(F.col("ssc_flag").isin(3, 9), F.lit(False))
    return df.filter(ok).select(canonical_uid(F.col("cluster_uid")).alias("cluster_uid"), id_, time)


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    sat = _usable(table(spark, sf, "satellite_obs", "satellite_record_id", "cluster_uid", "satellite_time", "satellite_ssc", "ssc_flag"), "satellite_record_id", "satellite_time", "satellite_ssc")
    ins = _usable(table(spark, sf, "insitu_obs", "insitu_record_id", "cluster_uid", "insitu_time", "insitu_ssc", "ssc_flag"), "insitu_record_id", "insitu_time", "insitu_ssc")
    pairs = nearest_in_time(sat, ins, "cluster_uid", "satellite_record_id", "satellite_time", "insitu_record_id", "insitu_time", 86_400)
    return pairs.select("insitu_record_id", "satellite_record_id")


# --- p8: token ids -----------------------------------------------------------------------------


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encode_corpus(table(spark, sf, "documents", "doc_id", "text")).select("doc_id", "ids")


# --- p9: mix -----------------------------------------------------------------------------------

def _mixed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf, "documents", "doc_id", "text", "lang", "source")
    docs = docs.select("doc_id", "text", key_text("source").alias("source"), F.substring(key_text("lang"), 1, 2).alias("language"))
    docs = topics(docs.filter("source is not null"), "doc_id", "text")
    sized = materialize(count_tokens(docs).drop("text"))  # counted once, used several times
    return mix(sized, table(spark, sf, "mix_targets"), "doc_id", F.col("source"), "n_tokens", F.col("language"), F.col("topic"))


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    return _mixed(spark, sf)[0]


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    return _mixed(spark, sf)[1]


# --- p10: personal information -----------------------------------------------------------------


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return find_pii(table(spark, sf, "documents", "doc_id", "text"))


def p10_masked(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its personal data replaced."""
    return mask_pii(table(spark, sf, "documents", "doc_id", "text"))


QUERIES = {"p1_found": p1_found, "p1_matches": p1_matches, "p5_found": p5_found, "p5_golden": p5_golden, "p6_found": p6_found, "p7_found": p7_found, "p8_ids": p8_ids, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found, "p10_masked": p10_masked}

_MISSING = ", ".join("'" + w.replace("'", "''") + "'" for w in MISSING_WORDS)
_TRIM = "trim({0}, ' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(8203) || chr(65279))"
_CLUSTER = "coalesce(case when cluster_id >= 0 then cast(cluster_id as bigint) end, try_cast(regexp_extract(upper(trim(cluster_uid)), '([0-9]+)$', 1) as bigint))"

ORACLE = {
    "p5_found": f"""
with t as (select lower(trim(tier)) tier, min(trust_rank) trust_rank from export_tiers group by 1),
c as (select {_CLUSTER} cid, s.catalog_row_id rid, s.exported_at, t.trust_rank, s.sources_used su, s.n_source_stations_in_cluster n
      from station_catalog s left join t on lower({_TRIM.format('s.export_tier')}) = t.tier),
many as (select cid from c group by cid having count(distinct rid) >= 2),
l as (select cid, rid, exported_at, trust_rank, 'sources_used' f from c where lower({_TRIM.format('su')}) not in ({_MISSING})
      union all select cid, rid, exported_at, trust_rank, 'n_source_stations_in_cluster' from c where n > 0),
r as (select *, row_number() over (partition by cid, f order by trust_rank asc nulls last, exported_at desc nulls last, rid) k from l where cid in (select cid from many))
select cid as cluster_id, f as field_name, rid as catalog_row_id from r where k = 1""",
    "p6_found": """
with recursive ids as (select upper(trim(source_station_id)) k, min(station_id) station_id, min(source_station_id) name from source_stations where source_station_id is not null group by 1),
e0 as (select distinct x.station_id a, y.station_id b from station_pairs p join ids x on upper(trim(p.left_source_station_id)) = x.k join ids y on upper(trim(p.right_source_station_id)) = y.k
       where lower(trim(p.decision)) = 'match' and x.station_id <> y.station_id),
e as (select a, b from e0 union select b, a from e0),
reach(v, w) as (select a, b from e union select r.v, e.b from reach r join e on r.w = e.a)
select i.name as source_station_id, least(r.v, min(r.w)) as cluster_id from reach r join ids i on i.station_id = r.v group by i.name, r.v""",
    "p7_found": """
with s as (select distinct satellite_record_id sid, upper(trim(cluster_uid)) c, satellite_time t from satellite_obs where satellite_ssc >= 0 and not isnan(satellite_ssc) and coalesce(ssc_flag, 0) not in (3, 9) and cluster_uid is not null),
i as (select distinct insitu_record_id iid, upper(trim(cluster_uid)) c, insitu_time t from insitu_obs where insitu_ssc >= 0 and not isnan(insitu_ssc) and coalesce(ssc_flag, 0) not in (3, 9) and cluster_uid is not null),
p as (select sid, iid, row_number() over (partition by sid order by abs(epoch_us(s.t) - epoch_us(i.t)), i.t, iid) k from s join i on s.c = i.c and i.t between s.t - interval 24 hour and s.t + interval 24 hour)
select iid as insitu_record_id, sid as satellite_record_id from p where k = 1""",
}
