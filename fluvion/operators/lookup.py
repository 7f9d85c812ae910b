"""Point look-ups: everything a product holds of given clusters, stations by native id, name or path, and stations near places.

Keys come as values or as a frame; the look-up is a filter or a semi join that reaches the scan, so a product partitioned or
sorted by its key is read in part.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvion.functions.geo import haversine_m
from fluvion.operators.spatial import within_distance
from fluvion.session import fits_broadcast, materialize


def rows_of(df: DataFrame, key: str, wanted: Iterable | DataFrame) -> DataFrame:
    """Rows whose ``key`` is among ``wanted``: values, or the first column of a frame (of any size; a small one is broadcast)."""
    if not isinstance(wanted, DataFrame):
        values = [w for w in wanted if w is not None]
        return df.filter(F.col(key).isin(values)) if values else df.limit(0)
    keys = wanted.select(F.col(wanted.columns[0]).alias(key)).filter(F.col(key).isNotNull()).distinct()
    return df.join(F.broadcast(keys) if fits_broadcast(keys) else keys, key, "left_semi")


def series_of(observations: DataFrame, key: str, wanted: Iterable | DataFrame, day: str, variables: list[str], first=None, last=None) -> DataFrame:
    """The readings of the wanted keys in long form (key, day, variable, value), without missing ones, between two days."""
    rows = rows_of(observations, key, wanted)
    if first is not None:
        rows = rows.filter(F.col(day) >= F.lit(first))
    if last is not None:
        rows = rows.filter(F.col(day) <= F.lit(last))
    long = rows.unpivot([key, day], variables, "variable", "value")
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def availability(observations: DataFrame, key: str, day: str, variables: list[str]) -> DataFrame:
    """Of each key and variable: readings, share of all its days in percent, first and last day."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for v in variables:
        on = F.when(F.col(v).isNotNull(), F.col(day))
        aggs += [F.count(v).alias(f"n_{v}"), F.min(on).alias(f"first_{v}"), F.max(on).alias(f"last_{v}")]
    g = observations.groupBy(key).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"n_{v}").alias("n"), F.round(100.0 * F.col(f"n_{v}") / F.col("_n"), 6).alias("pct"), F.col(f"first_{v}").alias("first_day"), F.col(f"last_{v}").alias("last_day")) for v in variables])
    return g.select(key, F.explode(rows).alias("r")).select(key, "r.*")


def stations_by_name(stations: DataFrame, requests: DataFrame, request: str, source: str, asked: str, native: str, name: str, path: str, of_source: str) -> DataFrame:
    """Stations of a source that a request means: by native id; where none has it by name (without case and padding); else by a path
    that holds it as a part between separators. Columns of ``stations`` plus ``request`` and matched_by.

    ``requests``: request (an id of its own), source, asked (text). Blank requests find nothing.
    """
    key = lambda c: F.upper(F.trim(c))
    q = requests.select(request, key(source).alias("_s"), key(asked).alias("_a")).filter("_a <> ''")
    s = stations.withColumn("_src", key(of_source))
    found, todo = None, q
    parts = F.split(F.upper(path), r"[^\p{L}\p{N}-]+")
    for how, names in (("id", F.array(key(native))), ("name", F.array(key(name))), ("path", F.array_distinct(F.concat(parts, F.flatten(F.transform(parts, lambda p: F.split(p, "-"))))))):
        keyed = s.withColumn("_a", F.explode(names)).filter("_a <> ''")
        hit = keyed.join(todo, (keyed["_src"] == todo["_s"]) & (keyed["_a"] == todo["_a"])).drop("_a", "_s", "_src").withColumn("matched_by", F.lit(how))
        found = hit if found is None else found.unionByName(hit)
        todo = todo.join(hit.select(request), request, "left_anti")
    return found


def nearest_stations(stations: DataFrame, lat: str, lon: str, station: str, places: DataFrame, place_lat: str, place_lon: str, place: str, k: int, radius_m: float = 50_000.0) -> DataFrame:
    """The ``k`` nearest stations of each place: place, station, distance_m, rank (ties: smallest station).

    Circles grow fourfold until they hold ``k`` stations or reach around the globe; a place that has its ``k`` is settled, so the few
    lonely ones alone see the wide circles. The stations and what is left of the places are written down, so that no round's plan holds
    those before it. Unusable positions take no part; repeated places count once.
    """
    from pyspark.sql import Window as W

    p = places.select(F.col(place).alias("_place"), F.col(place_lat).alias("_pla"), F.col(place_lon).alias("_plo")).dropDuplicates(["_place"])
    s = stations.select(F.col(station).alias("_st"), F.col(lat).alias("_sla"), F.col(lon).alias("_slo")).distinct()
    s = materialize(s)
    done, at, around = None, radius_m, 20_100_000.0
    w = W.partitionBy("_place").orderBy("distance_m", "_st")
    while True:
        j = within_distance(s, "_sla", "_slo", p, "_pla", "_plo", at).withColumn("distance_m", haversine_m(F.col("_pla"), F.col("_plo"), F.col("_sla"), F.col("_slo")))
        j = j.select("_place", "_st", "distance_m").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        last = at >= around
        if not last:
            full = j.groupBy("_place").agg(F.count("*").alias("n")).filter(F.col("n") >= k)
            j = materialize(j.join(full.select("_place"), "_place", "left_semi"))
            p = materialize(p.join(j.select("_place").distinct(), "_place", "left_anti"))
        done = j if done is None else done.unionByName(j)
        if last or p.isEmpty():
            return done.select(F.col("_place").alias(place), F.col("_st").alias(station), "distance_m", "rank")
        at = min(at * 4, around)
