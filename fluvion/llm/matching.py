"""Entities matched across tables without a common key.

Sorted neighbourhood: every record is sorted by several composite keys, and records within a window of each other
under any key are compared by weighted field similarities. Pairs that are alike go into a one-to-one
assignment of largest total confidence.

All keys are sorted in one range-partitioned sort. Positions in that order are cut into blocks with an overlap of
one window, so each task compares a bounded number of rows whatever a key's frequency; keys end in fields that
differ (position, name), so a frequent value is spread over many places of the order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvion.functions.geo import valid_position, wrap_lon
from fluvion.llm.components import connected_components
from fluvion.llm.names import alike, site, water
from fluvion.session import drop_tables, materialize

WINDOW = 32
BLOCK = 4096
NEAR_KM = 3.0
LEAST = 0.64
#: Weights of the fields; a field that one side lacks takes no part.
WEIGHTS = {"name": 0.5, "place": 0.25, "river": 0.15, "qualifier": 0.1, "area": 0.1}


def normalised(df: DataFrame, name: str, river: str) -> DataFrame:
    """Adds own, qual, rv (own name, qualifiers, river) and own2, qual2, rv2 (name and river exchanged)."""

    @F.pandas_udf("struct<own: string, qual: string, rv: string, own2: string, qual2: string, rv2: string>")
    def parts(n: pd.Series, r: pd.Series) -> pd.DataFrame:
        rows = []
        for a, b in zip(n, r):
            own, q, with_river = site(a)
            own2, q2, _ = site(b)
            rows.append((own, " ".join(q), water(b) or with_river, own2, " ".join(q2), water(a)))
        return pd.DataFrame(rows, columns=["own", "qual", "rv", "own2", "qual2", "rv2"])

    return df.withColumn("_p", parts(F.col(name), F.col(river))).select("*", "_p.*").drop("_p")


def placed(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Adds la, lo: the position where it is usable (latitude and longitude exchanged where only that is possible)."""
    a, o = F.col(lat), F.col(lon)
    turned = ~valid_position(a, o) & valid_position(o, a) & (F.abs(a) <= 180)
    la, lo = F.when(turned, o).otherwise(a), F.when(turned, a).otherwise(o)
    ok = valid_position(la, lo) & ~((la == 0) & (lo == 0))
    return df.withColumn("la", F.when(ok, la)).withColumn("lo", F.when(ok, wrap_lon(lo)))


def _interleaved(shift: float) -> Column:
    """The Z-order of a position, in cells of about a kilometre, as sortable text."""
    y = F.floor((F.col("la") + 90.0) * 100 + shift).cast("bigint")
    x = F.floor((F.col("lo") + 180.0) * 100 * F.cos(F.radians(F.round(F.col("la"), 0))) + shift).cast("bigint")
    spread = F.lit(0).cast("bigint")
    for bit in range(16):
        spread = spread.bitwiseOR(F.shiftleft(F.shiftright(y, bit).bitwiseAND(F.lit(1)), 2 * bit + 1)).bitwiseOR(F.shiftleft(F.shiftright(x, bit).bitwiseAND(F.lit(1)), 2 * bit))
    return F.lpad(F.hex(spread), 9, "0")


def _keys() -> Column:
    """The composite sort keys of a record, as an array of struct<k, key>; a key whose first field is missing is left out."""
    lat, lon = F.format_string("%09.5f", F.coalesce(F.col("la"), F.lit(0.0)) + 90), F.format_string("%09.5f", F.coalesce(F.col("lo"), F.lit(0.0)) + 180)
    named, has_river, has_place = F.col("own") != "", F.col("rv") != "", F.col("la").isNotNull()
    bar = lambda *c: F.concat_ws("|", *c)
    keys = [
        F.when(named, bar("own", "rv", lat, lon)),
        F.when(named, bar(F.reverse("own"), "qual", "rv", lat)),
        F.when(named, bar(F.regexp_replace("own", "[aeiou]", ""), "qual", lat, lon)),
        F.when(has_river & has_place, bar("rv", lat, lon)),
        F.when(has_river, bar("rv", F.substring("own", 1, 3), lat)),
        F.when(has_place, bar(_interleaved(0.0), lat, lon)),
        F.when(has_place, bar(_interleaved(0.5), lat, lon)),
    ]
    # a variant of a record is sorted by its name only: its plain form stands for it under the other keys
    rows = [F.struct(F.lit(k).alias("k"), (v if k < 3 else F.when(~F.col("turned"), v)).alias("key")) for k, v in enumerate(keys)]
    return F.filter(F.array(*rows), lambda s: s["key"].isNotNull())


def confidence(own_a, q_a, rv_a, la_a, lo_a, area_a, own_b, q_b, rv_b, la_b, lo_b, area_b, turned: bool) -> float:
    """Confidence 0..1 that two records are one site; 0 where a field rules it out.

    Names with different qualifiers (upper and lower, left and right) are neighbours, not one site; so are
    records whose positions are more than NEAR_KM apart, or whose areas differ by a factor of two or more
    unless they stand on the same spot. Without a name or a position on one side the other fields must agree closely.
    """
    got, weight = 0.0, 0.0
    named = bool(own_a and own_b)
    same = 0.0
    if named:
        if q_a != q_b:
            return 0.0
        same = alike(own_a, own_b)
        if same < 0.5:
            return 0.0
        got += WEIGHTS["name"] * same
        weight += WEIGHTS["name"]
        if q_a:
            got += WEIGHTS["qualifier"]
            weight += WEIGHTS["qualifier"]
    near = None
    if la_a == la_a and la_b == la_b:
        dx = ((lo_a - lo_b + 540.0) % 360.0 - 180.0) * 111.195 * np.cos(np.radians((la_a + la_b) / 2))
        near = float(np.hypot((la_a - la_b) * 111.195, dx))
        if near > NEAR_KM:
            return 0.0
        got += WEIGHTS["place"] * (1 - near / NEAR_KM)
        weight += WEIGHTS["place"]
    river = None
    if rv_a and rv_b:
        river = alike(rv_a, rv_b)
        got += WEIGHTS["river"] * river
        weight += WEIGHTS["river"]
    area = None
    if area_a > 0 and area_b > 0:
        area = abs(np.log(area_a / area_b))
        if area > 0.7 and (near is None or near > 0.3 or same < 0.9):
            return 0.0
        got += WEIGHTS["area"] * max(0.0, 1 - area / 0.5)
        weight += WEIGHTS["area"]
    if near is None:
        # no position: the name nearly the same, and the river or the area to support it
        if same < 0.8 or not ((river is not None and river >= 0.8) or (area is not None and area < 0.12)) or (river is not None and river < 0.6):
            return 0.0
    if not named and turned:
        return 0.0
    if not named:
        # no name: the same spot, and nothing against it
        if near is None or near > 0.6 or (river is not None and river < 0.6) or (area is not None and area > 0.3) or (river is None and area is None and near > 0.2):
            return 0.0
        return round(min(0.9, 0.66 + 0.2 * (1 - near / 0.6) + (0.04 if area is not None else 0.0)), 6)
    if turned and (same < 0.85 or (river is not None and river < 0.6) or (area is not None and area > 0.3)):
        return 0.0
    return round(got / weight, 6)


_FIELDS = "side int, id string, own string, qual string, rv string, la double, lo double, area double, turned boolean"


def _windows(records: DataFrame, window: int, least: float) -> DataFrame:
    """Pairs within the window of any key: kind (0 across the tables, 1 within the first), a, b, confidence."""
    spark = records.sparkSession
    rows = records.withColumn("_k", F.explode(_keys())).select("_k.k", "_k.key", *[c.split()[0] for c in _FIELDS.split(", ")]).distinct()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, "k", "key", "side", "id").sortWithinPartitions("k", "key", "side", "id", "own", "turned")
    rows = materialize(rows.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    # rows of each partition: as many numbers as partitions
    sizes = dict(rows.groupBy(part.alias("p")).agg((F.max(F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))) + 1).alias("n")).collect())
    start, offsets = 0, []
    for p in sorted(sizes):
        offsets.append((int(p), start))
        start += sizes[p]
    if not offsets:
        return spark.createDataFrame([], "kind int, a string, b string, confidence double")
    base = F.broadcast(spark.createDataFrame(offsets, "p bigint, base bigint"))
    rows = rows.withColumn("p", part).join(base, "p").withColumn("pos", F.col("base") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("p", "base", "_at")
    block = F.floor(F.col("pos") / BLOCK)
    rows = rows.withColumn("block", F.explode(F.when((F.col("pos") % BLOCK < window) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))))

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos", kind="stable")
        side, k, at = pdf["side"].to_numpy(), pdf["k"].to_numpy(), pdf["pos"].to_numpy()
        la, lo = pdf["la"].to_numpy(float), pdf["lo"].to_numpy(float)
        own_rows = (at // BLOCK) == key[0]
        cols = [pdf[c].tolist() for c in ("id", "own", "qual", "rv", "area", "turned")]
        ids, own, qual, rv, area, turned = cols
        code, _ = pd.factorize(pdf["id"].astype(str))
        seen: dict = {}
        cos = np.cos(np.radians(np.where(np.isfinite(la), la, 0.0)))
        for d in range(1, min(window, len(pdf) - 1) + 1):
            i = np.flatnonzero(own_rows[:-d] & (k[:-d] == k[d:]) & (side[:-d] + side[d:] < 2) & (code[:-d] != code[d:]))
            j = i + d
            dx = ((lo[i] - lo[j] + 540.0) % 360.0 - 180.0) * 111.195 * cos[i]
            far = np.hypot((la[i] - la[j]) * 111.195, dx) > NEAR_KM * 1.05  # False where a part is missing
            for x, y in zip(i[~far].tolist(), j[~far].tolist()):
                if side[x] == side[y] and (turned[x] and turned[y] or not own[x] or not own[y]):
                    continue  # one site among the first table's: with names, and one of them as it stands
                if side[x] > side[y] or (side[x] == side[y] and ids[x] > ids[y]):
                    x, y = y, x
                c = confidence(own[x], qual[x], rv[x], la[x], lo[x], area[x] or 0.0, own[y], qual[y], rv[y], la[y], lo[y], area[y] or 0.0, turned[x] or turned[y])
                if c >= least:
                    p = (int(side[x] == side[y]), ids[x], ids[y])
                    if c > seen.get(p, 0.0):
                        seen[p] = c
        return pd.DataFrame([(*p, c) for p, c in seen.items()], columns=["kind", "a", "b", "confidence"])

    pairs = rows.groupBy("block").applyInPandas(compare, "kind int, a string, b string, confidence double")
    return pairs.groupBy("kind", "a", "b").agg(F.max("confidence").alias("confidence"))


def _alikes(records: DataFrame) -> DataFrame:
    """Each id with the first of the ids whose rows have the same fields: id, first_id."""
    fields = F.to_json(F.sort_array(F.collect_set(F.struct("own", "qual", "rv", "own2", "qual2", "rv2", "la", "lo", "area"))))
    ids = records.groupBy("id").agg(F.sha2(fields, 256).alias("_f"))  # an id has few rows
    return ids.join(ids.groupBy("_f").agg(F.min("id").alias("first_id")), "_f").select("id", "first_id")


def _compared(pairs: DataFrame, first: DataFrame, second: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) that are alike by any of the rows of their two ids, with that confidence."""

    @F.pandas_udf("double")
    def conf(own_a: pd.Series, q_a: pd.Series, rv_a: pd.Series, la_a: pd.Series, lo_a: pd.Series, ar_a: pd.Series, own_b: pd.Series, q_b: pd.Series, rv_b: pd.Series, la_b: pd.Series, lo_b: pd.Series, ar_b: pd.Series, turned: pd.Series) -> pd.Series:
        return pd.Series([confidence(*r) for r in zip(own_a, q_a, rv_a, la_a, lo_a, ar_a, own_b, q_b, rv_b, la_b, lo_b, ar_b, turned)], dtype=float)

    parts = ("own", "qual", "rv", "la", "lo", "area")
    x = first.select(F.col("id").alias("a"), *[F.col(c).alias(f"{c}_a") for c in parts], "turned")
    y = second.select(F.col("id").alias("b"), *[F.col(c).alias(f"{c}_b") for c in parts])
    j = pairs.join(x, "a").join(y, "b").withColumn("confidence", conf(*[f"{c}_a" for c in parts], *[f"{c}_b" for c in parts], "turned"))
    return j.filter(F.col("confidence") >= least).groupBy("a", "b").agg(F.max("confidence").alias("confidence"))


#: Weights and prices of the auction are whole numbers of this; so is its step, and every engine that runs it gives the same choice.
UNIT = 1_000_000
STEP = 5_000
#: Edges of a component that one task runs the auction over (about 100 bytes each); larger components run it as table joins.
IN_ONE_TASK = 1_000_000


def auction(edges: list[tuple[str, str, float]]) -> list[tuple[str, str, float]]:
    """One-to-one choice of the edges (a, b, w) with the largest sum of w, within ``STEP`` / ``UNIT`` a pair of the largest.

    In each round every free bidder a offers for its best partner what that is worth to it beyond its second best (or
    beyond staying alone), and a step; each partner keeps the highest offer (ties: the larger id on either side). Prices
    only rise and no bidder pays more than the edge is worth, so it ends.
    """
    best: dict[tuple[str, str], float] = {}
    for a, b, w in edges:
        best[a, b] = max(w, best.get((a, b), 0.0))
    if not best:
        return []
    keys = sorted(best)
    names_a, a = np.unique(np.array([k[0] for k in keys], object), return_inverse=True)
    names_b, b = np.unique(np.array([k[1] for k in keys], object), return_inverse=True)
    w = np.round(np.array([best[k] for k in keys]) * UNIT).astype(np.int64)
    price = np.zeros(len(names_b), np.int64)
    owner, held = np.full(len(names_b), -1), np.full(len(names_a), -1)
    live = np.ones(len(keys), bool)  # edges still worth their price
    while True:
        e = np.flatnonzero(live & (held[a] < 0))
        net = w[e] - price[b[e]]
        live[e[net <= 0]] = False
        e, net = e[net > 0], net[net > 0]
        if not len(e):
            break
        order = np.lexsort((b[e], net, a[e]))
        e, net = e[order], net[order]
        top = np.flatnonzero(np.r_[a[e][1:] != a[e][:-1], True])  # the last of a bidder is its best
        second = np.where((top > 0) & (a[e][top - 1] == a[e][top]), net[top - 1], 0)
        bidder, target, more = a[e][top], b[e][top], net[top] - second + STEP
        order = np.lexsort((bidder, more, target))
        bidder, target, more = bidder[order], target[order], more[order]
        won = np.flatnonzero(np.r_[target[1:] != target[:-1], True])
        out = owner[target[won]]
        held[out[out >= 0]] = -1
        owner[target[won]] = bidder[won]
        held[bidder[won]] = target[won]
        price[target[won]] += more[won]
    return [(x, names_b[k], best[x, names_b[k]]) for x, k in zip(names_a, held) if k >= 0]


def _auction(edges: DataFrame, max_rounds: int = 100_000) -> DataFrame:
    """The same auction round for round as joins over tables, for components too large for one task. Raises if it has not
    ended after ``max_rounds``; of each round only the prices stay."""
    spark = edges.sparkSession
    e = materialize(edges.select("a", "b", "w", F.round(F.col("w") * UNIT).cast("bigint").alias("n")))
    held = materialize(spark.createDataFrame([], "a string, b string, price bigint"))
    for _ in range(max_rounds):
        open_ = e.join(held.filter("a is not null").select("a"), "a", "left_anti").join(held.select("b", "price"), "b", "left").withColumn("net", F.col("n") - F.coalesce("price", F.lit(0)))
        # the two best of each bidder: the best by (net, b), and the best net among the others
        open_ = open_.filter("net > 0").select("a", "b", "net")
        top = open_.groupBy("a").agg(F.max(F.struct("net", "b")).alias("top"))
        second = open_.join(top, "a").filter(F.col("b") != F.col("top.b")).groupBy("a").agg(F.max("net").alias("second"))
        bids = top.join(second, "a", "left").select("a", F.col("top.b").alias("b"), (F.col("top.net") - F.coalesce("second", F.lit(0)) + STEP).alias("more"))
        won = materialize(bids.groupBy("b").agg(F.max(F.struct("more", "a")).alias("t")).select("b", F.col("t.a").alias("na"), F.col("t.more").alias("more")))
        if won.isEmpty():
            drop_tables(won)
            return held.join(e, ["a", "b"]).select("a", "b", "w")
        # who wins a partner gives up none (it was free); who held the partner is free again
        new = held.join(won, "b", "full").select(F.coalesce("na", "a").alias("a"), "b", (F.coalesce("price", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("price"))
        held = materialize(new, drop=[held.fluvion_path])
        drop_tables(won)
    raise RuntimeError(f"the assignment has not settled after {max_rounds} rounds")


def assign(edges: DataFrame, in_one_task: int = IN_ONE_TASK) -> DataFrame:
    """One-to-one choice of the edges (a, b, w) that maximises the sum of w, within STEP / UNIT a pair: columns a, b, w.

    Edges whose two ends have no other edge are chosen at once. The others are cut into connected components, and an auction
    runs over each: inside a task up to ``in_one_task`` edges, as joins beyond. Both run the same rounds in whole numbers, so
    the choice does not depend on where a component is solved.
    """
    da, db = edges.groupBy("a").agg(F.count("*").alias("na")), edges.groupBy("b").agg(F.count("*").alias("nb"))
    e = materialize(edges.join(da, "a").join(db, "b"))
    clear = e.filter("na = 1 and nb = 1").select("a", "b", "w")
    rest = e.filter("na > 1 or nb > 1").select("a", "b", "w")
    if rest.isEmpty():
        return clear
    groups = connected_components(rest.select(F.concat(F.lit("a"), "a").alias("x"), F.concat(F.lit("b"), "b").alias("y")), "x", "y")
    marked = rest.withColumn("x", F.concat(F.lit("a"), "a")).join(groups, F.col("x") == groups["vertex"]).select("a", "b", "w", "component")
    marked = materialize(marked)
    sizes = marked.groupBy("component").agg(F.count("*").alias("n"))
    marked = marked.join(sizes, "component")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(auction(list(zip(pdf["a"], pdf["b"], pdf["w"]))), columns=["a", "b", "w"])

    out = clear.unionByName(marked.filter(F.col("n") <= in_one_task).groupBy("component").applyInPandas(solve, "a string, b string, w double"))
    large = marked.filter(F.col("n") > in_one_task).select("a", "b", "w")
    return out if large.isEmpty() else out.unionByName(_auction(large))


def match_sites(first: DataFrame, second: DataFrame, window: int = WINDOW, least: float = LEAST) -> DataFrame:
    """Records of ``first`` linked to the entities of ``second``: a, b, confidence (0..1).

    Both: id (string), name, river, lat, lon, area; ``second`` may have several rows an id, as the same entity is written in
    several ways. Null, blank and missing-word fields take no part in a comparison; a record without name and
    without position has no match. Records of ``first`` that are one site among themselves are assigned together, and such
    sites and the entities are assigned one to one with the largest total confidence. Every member of a site is compared with the
    site's entity, also where no window brought the two together; a record that this leaves without entity joins that of
    a matched site with whose members it is alike, if it is like the entity too. Each record has at most one. Repeated
    rows count once. Empty inputs give no rows.
    """
    need = ("id", "name", "river", "lat", "lon", "area")  # other columns take no part, whatever their names
    first, second = first.select(*need).filter("id is not null"), second.select(*need).filter("id is not null")
    a = materialize(placed(normalised(first, "name", "river"), "lat", "lon").drop("name", "river", "lat", "lon"))
    # records of equal fields are one record to the windows, which they would fill otherwise
    alikes = materialize(_alikes(a))
    a = a.join(alikes.filter("id = first_id").select("id"), "id", "left_semi").withColumn("side", F.lit(0))
    plain = a.select("side", "id", "own", "qual", "rv", "la", "lo", "area", F.lit(False).alias("turned"))
    # the same record with name and river exchanged
    other = a.filter("own2 <> ''").select("side", "id", F.col("own2").alias("own"), F.col("qual2").alias("qual"), F.col("rv2").alias("rv"), "la", "lo", "area", F.lit(True).alias("turned"))
    # positions with latitude and longitude exchanged, or with the sign of one of them lost
    wrong = F.array(F.struct(F.when(F.abs("lo") <= 90, F.col("lo")).alias("la"), F.col("la").alias("lo")), F.struct(F.col("la").alias("la"), (-F.col("lo")).alias("lo")), F.struct((-F.col("la")).alias("la"), F.col("lo").alias("lo")))
    flipped = a.filter("own <> '' and la is not null").withColumn("w", F.explode(wrong)).filter("w.la is not null").select("side", "id", "own", "qual", "rv", "w.la", "w.lo", "area", F.lit(True).alias("turned"))
    b = placed(normalised(second, "name", "river"), "lat", "lon").withColumn("area", F.when(F.col("area") > 0, F.col("area")))
    # of an entity: one position, area and river (each by the smallest of what its rows have), every spelling of its name
    whole = b.groupBy("id").agg(F.min(F.when(F.col("la").isNotNull(), F.struct("la", "lo"))).alias("p"), F.percentile_approx("area", 0.5).alias("area"), F.min_by("rv", F.struct(-F.length("rv"), "rv")).alias("rv"))
    names = b.select("id", "own", "qual").distinct()
    some = names.filter("own <> ''").select("id").distinct()
    names = names.filter("own <> ''").unionByName(names.filter("own = ''").join(some, "id", "left_anti"))
    b = names.join(whole, "id").select(F.lit(1).alias("side"), "id", "own", "qual", "rv", F.col("p.la").alias("la"), F.col("p.lo").alias("lo"), "area", F.lit(False).alias("turned"))
    variants = plain.unionByName(other).unionByName(flipped)
    records = materialize(variants.unionByName(b))
    variants, b = records.filter("side = 0"), records.filter("side = 1")
    plain_rows = variants.filter("not turned")
    pairs = materialize(_windows(records, window, least))
    across = pairs.filter("kind = 0").select("a", "b", F.col("confidence").alias("w"))
    within = pairs.filter("kind = 1 and confidence >= 0.75")
    # what several joins below refer to is written down, which keeps their plans small
    sites = materialize(connected_components(within, "a", "b").select(F.col("vertex").alias("a"), F.col("component").alias("site")))
    across = materialize(across.join(sites, "a", "left").withColumn("site", F.coalesce("site", "a")))
    chosen = materialize(assign(across.groupBy(F.col("site").alias("a"), "b").agg(F.max("w").alias("w"))))
    own = materialize(across.groupBy("a", "site", "b").agg(F.max("w").alias("confidence")))
    entity = chosen.select(F.col("a").alias("site"), "b")
    met = own.join(entity, ["site", "b"]).select("a", "b", "confidence")
    # the other members of a site need not have met its entity in a window: each is compared with it
    members = materialize(sites.unionByName(own.select("a", "site")).distinct().join(met.select("a"), "a", "left_anti"))
    linked = materialize(met.unionByName(_compared(members.join(entity, "site").select("a", "b"), variants, b, least)))
    # a record that the assignment leaves out is a further record of a matched site if it is like one of that site's members, and
    # then of its entity, with which it is compared like them
    alike_pairs = pairs.filter("kind = 1")
    beside = alike_pairs.select("a", F.col("b").alias("m")).unionByName(alike_pairs.select(F.col("b").alias("a"), F.col("a").alias("m")))
    rest = materialize(members.join(linked.select("a"), "a", "left_anti").select("a").distinct())
    matched = linked.select(F.col("a").alias("m"), "b")
    further = materialize(beside.join(rest, "a").join(matched, "m").select("a", "b").distinct())
    # records that no window brought beside a member are compared with one of them, that most like the entity
    foremost = linked.groupBy("b").agg(F.max(F.struct("confidence", "a")).alias("m")).select("b", F.col("m.a").alias("m"))
    met_other = materialize(own.join(rest, "a", "left_semi").join(further, ["a", "b"], "left_anti").join(foremost, "b").select("a", "b", "m"))
    like = _compared(met_other.select("a", F.col("m").alias("b")).distinct(), variants, plain_rows, least).select("a", F.col("b").alias("m"))
    further = materialize(further.unionByName(met_other.join(like, ["a", "m"], "left_semi").select("a", "b")).distinct())
    seen = own.select("a", "b", "confidence").join(further, ["a", "b"], "left_semi")
    left = seen.unionByName(_compared(further.join(seen.select("a", "b"), ["a", "b"], "left_anti"), variants, b, least))
    left = left.groupBy("a").agg(F.max(F.struct("confidence", "b")).alias("m"))
    out = linked.unionByName(left.select("a", "m.b", "m.confidence"))
    return out.withColumnRenamed("a", "first_id").join(alikes, "first_id").select(F.col("id").alias("a"), "b", "confidence")
