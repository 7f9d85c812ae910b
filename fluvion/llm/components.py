"""Connected components by hash-to-min over a table of (vertex, member) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvion.session import materialize


def connected_components(edges: DataFrame, left: str, right: str, max_rounds: int = 60, hot_rows: int = 1_000_000) -> DataFrame:
    """Columns ``vertex`` and ``component`` (the smallest vertex of its component) for each end of an edge.

    Hash-to-min: each vertex holds a set of members; every round it sends the whole set to the smallest of them
    and that smallest to all others, until nothing changes (rounds grow with the logarithm of the longest chain).
    Sets are rows, never lists, so a component of any size spreads over tasks; the minimum of a set is a partial
    aggregate; vertices with more than ``hot_rows`` members, of which there are at most rows / hot_rows, get their
    minimum by broadcast, so that no join key is hot. Each round is written to the shared folder. Edges with a null end are
    left out, self edges give a component of one, repeated edges change nothing, no edges give no rows. Raises if
    it has not settled after ``max_rounds``.
    """
    e = edges.select(F.col(left).alias("v"), F.col(right).alias("c")).filter("v is not null and c is not null")
    state = e.union(e.select("c", "v")).union(e.select("v", "v")).union(e.select("c", "c")).toDF("v", "c").distinct()
    state = materialize(state)
    mark = _fingerprint(state)
    for _ in range(max_rounds):
        mins = state.groupBy("v").agg(F.min("c").alias("m"), F.count("*").alias("n"))
        if mark[0] <= hot_rows:
            sent = state.join(mins.drop("n"), "v")
        else:
            hot = mins.filter(F.col("n") > hot_rows).select("v", "m")
            some = state.join(F.broadcast(hot.withColumnRenamed("m", "hm")), "v", "left")
            sent = some.filter("hm is not null").select("v", "c", F.col("hm").alias("m")).unionByName(some.filter("hm is null").drop("hm").join(mins.drop("n"), "v"))
        pair = F.explode(F.array(F.struct(F.col("m").alias("v"), F.col("c").alias("c")), F.struct(F.col("c").alias("v"), F.col("m").alias("c"))))
        new = materialize(sent.select(pair.alias("p")).select("p.v", "p.c").distinct(), drop=[state.fluvion_path])
        seen = _fingerprint(new)
        state = new
        if seen == mark:
            return state.groupBy(F.col("v").alias("vertex")).agg(F.min("c").alias("component"))
        mark = seen
    raise RuntimeError(f"components have not settled after {max_rounds} rounds")


def _fingerprint(state: DataFrame) -> tuple:
    r = state.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "c")), F.sum(F.xxhash64("c", "v") % 1_000_003)).first()
    return tuple(r)
