"""Temporal semantics of series: frequency, resolution, evidence, coverage and regularity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluvion.functions import domain as D
from fluvion.functions.text import clean_text
from fluvion.plans.common import OBS, STATIONS, observations, stations
from fluvion.plans.registry import query
from fluvion.sources.tables import table

S = SparkSession
_FREQ = """dt as (select distinct source_station_uid u, obs_date from daily_matrix), df as (select u, obs_date, 24.0 * date_diff('day', lag(obs_date) over (partition by u order by obs_date), obs_date) h from dt),
fr as (select u, count(*) n, median(h) h from df group by u), fq as (select u, n, h, case when n < 2 then 'single_point' when h < 2 then 'hourly' when h < 36 then 'daily' when h < 1080 then 'monthly' when h < 2880 then 'quarterly' when h < 12000 then 'annual' else 'irregular' end frequency from fr)"""


def _frequencies(spark: S, sf: str) -> DataFrame:
    d = table(spark, sf, "daily_matrix", "source_station_uid", "obs_date").distinct()
    h = d.withColumn("h", 24.0 * F.datediff("obs_date", F.lag("obs_date").over(W.partitionBy("source_station_uid").orderBy("obs_date"))))
    g = h.groupBy("source_station_uid").agg(F.count("*").alias("n"), F.median("h").alias("median_hours"))
    return g.withColumn("frequency", D.frequency(F.col("median_hours"), F.col("n")))


@query(f"with {_FREQ} select u as source_station_uid, n, h as median_hours, frequency from fq")
def frequency_classify(spark: S, sf: str) -> DataFrame:
    return _frequencies(spark, sf)


@query(f"with {_FREQ} select u as source_station_uid, case frequency when 'hourly' then 'daily' when 'daily' then 'daily' when 'monthly' then 'monthly' when 'quarterly' then 'monthly' when 'annual' then 'annual' when 'single_point' then 'daily' else 'irregular' end as resolution from fq")
def resolution_semantics(spark: S, sf: str) -> DataFrame:
    return _frequencies(spark, sf).select("source_station_uid", D.semantics(F.col("frequency"), F.lit("")).alias("resolution"))


@query("select user_id, bool_and(extract('hour' from ts) = 0 and extract('minute' from ts) = 0 and floor(extract('second' from ts)) = 0) as as_daily from events where ts is not null group by user_id")
def irregular_as_daily(spark: S, sf: str) -> DataFrame:
    e = table(spark, sf, "events", "user_id", "ts").filter("ts is not null")
    return e.groupBy("user_id").agg(F.bool_and((F.hour("ts") == 0) & (F.minute("ts") == 0) & (F.second("ts") == 0)).alias("as_daily"))


def _as_daily(spark: S, sf: str, unit: str) -> DataFrame:
    o = observations(spark, sf).filter("ssc is not null or ssl is not null")
    g = o.groupBy("source_station_uid", F.date_trunc(unit, "obs_date").alias("p")).agg(F.countDistinct("obs_date").alias("k"))
    return g.groupBy("source_station_uid").agg(F.max("k").alias("most"), (F.max("k") >= 2).alias("as_daily"))


@query(f"with {OBS} select source_station_uid, max(k) as most, max(k) >= 2 as as_daily from (select source_station_uid, date_trunc('month', obs_date) p, count(distinct obs_date) k from obs where ssc is not null or ssl is not null group by 1, 2) group by 1")
def monthly_as_daily(spark: S, sf: str) -> DataFrame:
    return _as_daily(spark, sf, "month")


@query(f"with {OBS} select source_station_uid, max(k) as most, max(k) >= 2 as as_daily from (select source_station_uid, date_trunc('year', obs_date) p, count(distinct obs_date) k from obs where ssc is not null or ssl is not null group by 1, 2) group by 1")
def annual_as_daily(spark: S, sf: str) -> DataFrame:
    return _as_daily(spark, sf, "year")


_SPAN = r"(1[89]\d\d|20\d\d)\D{1,4}(1[89]\d\d|20\d\d)"


@query(r"select doc_id, cast(a as int) as year_start, cast(b as int) as year_end from (select doc_id, regexp_extract(text, '(1[89][0-9]{2}|20[0-9]{2})[^0-9]{1,4}(1[89][0-9]{2}|20[0-9]{2})', 1) a, regexp_extract(text, '(1[89][0-9]{2}|20[0-9]{2})[^0-9]{1,4}(1[89][0-9]{2}|20[0-9]{2})', 2) b from documents) where a <> ''")
def span_parse(spark: S, sf: str) -> DataFrame:
    """The first span of years in a text, such as 1990-1995."""
    d = table(spark, sf, "documents", "doc_id", "text")
    p = "(1[89][0-9]{2}|20[0-9]{2})[^0-9]{1,4}(1[89][0-9]{2}|20[0-9]{2})"
    return d.select("doc_id", F.regexp_extract("text", p, 1).alias("a"), F.regexp_extract("text", p, 2).alias("b")).filter("a <> ''").select("doc_id", F.col("a").cast("int").alias("year_start"), F.col("b").cast("int").alias("year_end"))


@query("select station_uid, year_start, year_end, q is not null and (year_start + year_end) / 2.0 between year_start and year_end as centre_inside from (select distinct station_uid, year_start, year_end, q from climatology_stations) where year_start is not null")
def span_containment(spark: S, sf: str) -> DataFrame:
    c = table(spark, sf, "climatology_stations", "station_uid", "year_start", "year_end", "q").distinct().filter("year_start is not null")
    return c.select("station_uid", "year_start", "year_end", (F.col("q").isNotNull() & ((F.col("year_start") + F.col("year_end")) / 2.0).between(F.col("year_start"), F.col("year_end"))).alias("centre_inside"))


@query(f"""with {STATIONS}, {_FREQ}, ov as (select station_id, 'annual' o from st where station_id % 97 = 0),
ev as (select st.station_id, o.o, split_part(path, '/', 1) p, resolution m from st left join ov o on o.station_id = st.station_id)
select station_id, coalesce(o, p, m, 'unknown') as resolution, case when o is not null then 'override' when p is not null then 'path' when m is not null then 'metadata' else 'none' end as evidence, coalesce(p <> m, false) as review from ev""")
def evidence_arbitration(spark: S, sf: str) -> DataFrame:
    """Resolution of each station by the strongest evidence: an override, then the path, then the metadata; conflicts are for review."""
    s = stations(spark, sf)
    o = s.filter("station_id % 97 = 0").select("station_id", F.lit("annual").alias("o"))
    e = s.join(o, "station_id", "left").withColumn("p", F.split_part("path", F.lit("/"), F.lit(1)))
    why = F.when(F.col("o").isNotNull(), "override").when(F.col("p").isNotNull(), "path").when(F.col("resolution").isNotNull(), "metadata").otherwise("none")
    return e.select("station_id", F.coalesce("o", "p", "resolution", F.lit("unknown")).alias("resolution"), why.alias("evidence"), F.coalesce(F.col("p") != F.col("resolution"), F.lit(False)).alias("review"))


@query(f"with {STATIONS} select resolution, count(*) as n, coalesce(resolution in ('daily','monthly','annual','climatology'), false) as known from st group by resolution")
def override_vocabulary(spark: S, sf: str) -> DataFrame:
    known = F.coalesce(F.col("resolution").isin("daily", "monthly", "annual", "climatology"), F.lit(False))
    return stations(spark, sf).groupBy("resolution").agg(F.count("*").alias("n")).withColumn("known", known)


@query(f"with {STATIONS} select station_id, coalesce(case split_part(path, '/', 1) when 'daily' then resolution in ('daily', 'hourly') when 'monthly' then resolution in ('monthly', 'quarterly') when 'annual' then resolution in ('annual', 'climatology') end, false) as consistent from st")
def resolution_consistency(spark: S, sf: str) -> DataFrame:
    allowed = F.create_map(F.lit("daily"), F.array(F.lit("daily"), F.lit("hourly")), F.lit("monthly"), F.array(F.lit("monthly"), F.lit("quarterly")), F.lit("annual"), F.array(F.lit("annual"), F.lit("climatology")))
    p = F.split_part("path", F.lit("/"), F.lit(1))
    return stations(spark, sf).select("station_id", F.coalesce(F.array_contains(F.element_at(allowed, p), F.col("resolution")), F.lit(False)).alias("consistent"))


@query("select source_station_uid, strftime(min(obs_date), '%Y-%m-%d') as coverage_start, strftime(max(obs_date), '%Y-%m-%d') as coverage_end, strftime(min(obs_date), '%Y-%m-%d') || ' to ' || strftime(max(obs_date), '%Y-%m-%d') as span from daily_matrix group by 1")
def time_coverage_text(spark: S, sf: str) -> DataFrame:
    g = table(spark, sf, "daily_matrix", "source_station_uid", "obs_date").groupBy("source_station_uid").agg(F.min("obs_date").alias("a"), F.max("obs_date").alias("b"))
    a, b = F.date_format("a", "yyyy-MM-dd"), F.date_format("b", "yyyy-MM-dd")
    return g.select("source_station_uid", a.alias("coverage_start"), b.alias("coverage_end"), F.concat(a, F.lit(" to "), b).alias("span"))


@query("select distinct obs_date, cast(date_trunc('month', obs_date) as date) as month_start, last_day(obs_date) as month_end, cast(date_trunc('month', obs_date) as date) + cast((day(last_day(obs_date)) - 1) // 2 as int) as month_centre, make_date(year(obs_date), 7, 1) as year_centre from daily_matrix")
def period_bounds(spark: S, sf: str) -> DataFrame:
    first, last = F.trunc("obs_date", "MM"), F.last_day("obs_date")
    centre = F.date_add(first, F.floor((F.day(last) - 1) / 2).cast("int"))
    return table(spark, sf, "daily_matrix", "obs_date").distinct().select("obs_date", first.alias("month_start"), last.alias("month_end"), centre.alias("month_centre"), F.make_date(F.year("obs_date"), F.lit(7), F.lit(1)).alias("year_centre"))


@query("select distinct satellite_station_id, case when lower(trim(satellite_source)) like 'river%' then 'composite' when lower(trim(satellite_resolution)) = 'monthly' then 'period_mean' else 'instant' end as support from satellite_links")
def time_support_class(spark: S, sf: str) -> DataFrame:
    s = table(spark, sf, "satellite_links", "satellite_station_id", "satellite_source", "satellite_resolution")
    c = F.when(F.lower(F.trim("satellite_source")).startswith("river"), "composite").when(F.lower(F.trim("satellite_resolution")) == "monthly", "period_mean").otherwise("instant")
    return s.select("satellite_station_id", c.alias("support")).distinct()


@query("select strftime(obs_date, '%Y-%m') as month, count(*) as n from daily_matrix group by 1")
def time_bucketing(spark: S, sf: str) -> DataFrame:
    return table(spark, sf, "daily_matrix", "obs_date").groupBy(F.date_format("obs_date", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


@query("select source_station_uid, date_diff('day', min(obs_date), max(obs_date)) + 1 as expected, count(distinct obs_date) as found, count(*) - count(distinct obs_date) as duplicates, round(100.0 * count(distinct obs_date) / (date_diff('day', min(obs_date), max(obs_date)) + 1), 6) as pct from daily_matrix group by 1")
def axis_regularity(spark: S, sf: str) -> DataFrame:
    # one pass by (series, day), then by series: no list of distinct days is ever held
    d = table(spark, sf, "daily_matrix", "source_station_uid", "obs_date").groupBy("source_station_uid", "obs_date").agg(F.count("*").alias("k"))
    expected = (F.datediff(F.max("obs_date"), F.min("obs_date")) + 1).cast("bigint")
    g = d.groupBy("source_station_uid").agg(expected.alias("expected"), F.count("*").alias("found"), (F.sum("k") - F.count("*")).alias("duplicates"))
    return g.withColumn("pct", F.round(100.0 * F.col("found") / F.col("expected"), 6))


@query("select source_station_uid, max(n) as most_in_a_month, count(*) filter (n > 1) as months_with_several, count(*) as months from (select source_station_uid, date_trunc('month', obs_date) m, count(distinct record_id) n from daily_matrix group by 1, 2) group by 1")
def period_duplicates_audit(spark: S, sf: str) -> DataFrame:
    d = table(spark, sf, "daily_matrix", "record_id", "source_station_uid", "obs_date").dropDuplicates(["record_id"])
    m = d.groupBy("source_station_uid", F.date_trunc("month", "obs_date").alias("m")).agg(F.count("*").alias("n"))
    return m.groupBy("source_station_uid").agg(F.max("n").alias("most_in_a_month"), F.count_if(F.col("n") > 1).alias("months_with_several"), F.count("*").alias("months"))


@query("with s as (select cluster_uid, source_station_uid u, min(obs_date) a, max(obs_date) b from daily_matrix where cluster_uid is not null group by 1, 2) select x.cluster_uid, x.u as source_station_uid, (select count(*) from s y where y.cluster_uid = x.cluster_uid and y.u <> x.u and y.a <= x.b and x.a <= y.b) as n_overlapping from s x")
def interval_overlap(spark: S, sf: str) -> DataFrame:
    """How many other series of its cluster each series overlaps in time. Counted, not listed: those that begin by its end
    less those that ended before its begin, from two running counts, so a crowded cluster costs a sort and no pairs."""
    s = table(spark, sf, "daily_matrix", "cluster_uid", "source_station_uid", "obs_date").filter("cluster_uid is not null").groupBy("cluster_uid", "source_station_uid").agg(F.min("obs_date").alias("a"), F.max("obs_date").alias("b"))
    # the points of the timeline; at one date ends are looked up after begins (<=) and begins before ends (<)
    points = F.array(F.struct(F.col("a").alias("at"), F.lit(0).alias("kind")), F.struct(F.col("b").alias("at"), F.lit(1).alias("kind")))
    e = s.select("cluster_uid", "source_station_uid", F.explode(points).alias("p")).select("cluster_uid", "source_station_uid", "p.*")
    before = W.partitionBy("cluster_uid").orderBy("at", "kind").rangeBetween(W.unboundedPreceding, W.currentRow)
    e = e.withColumn("begun", F.sum(1 - F.col("kind")).over(before)).withColumn("ended", F.sum("kind").over(W.partitionBy("cluster_uid").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, -1)))
    # ended counts earlier rows only: at a begin (kind 0) no end of the same date comes before it
    g = e.groupBy("cluster_uid", "source_station_uid").agg(F.max(F.when(F.col("kind") == 1, F.col("begun"))).alias("begun"), F.max(F.when(F.col("kind") == 0, F.coalesce("ended", F.lit(0)))).alias("ended"))
    return g.select("cluster_uid", "source_station_uid", (F.col("begun") - F.col("ended") - 1).alias("n_overlapping"))


@query("select user_id, session_no, min(ts) as starts_at, max(ts) as ends_at, count(*) as n from (select *, sum(case when ts - prev > interval 30 minute or prev is null then 1 else 0 end) over (partition by user_id order by ts, event_id) session_no from (select user_id, ts, event_id, lag(ts) over (partition by user_id order by ts, event_id) prev from events)) group by 1, 2")
def overlap_runs(spark: S, sf: str) -> DataFrame:
    """Runs of times without a gap of more than half an hour, as of intervals that overlap."""
    e = table(spark, sf, "events", "user_id", "ts", "event_id").withColumn("ts", F.col("ts").cast("timestamp"))
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    e = e.withColumn("prev", F.lag("ts").over(w)).withColumn("new", F.when(F.col("prev").isNull() | (F.unix_micros("ts") - F.unix_micros("prev") > 1_800_000_000), 1).otherwise(0))
    return e.withColumn("session_no", F.sum("new").over(w)).groupBy("user_id", "session_no").agg(F.min("ts").alias("starts_at"), F.max("ts").alias("ends_at"), F.count("*").alias("n"))
