import itertools

import numpy as np

from fluvion.llm import matching as M
from fluvion.llm.names import alike, distance, latin, site, water

COLS = "id string, name string, river string, lat double, lon double, area double, own string"


def run(spark, a, b, **kw):
    fill = lambda rows: [(*r, *([None] * (6 - len(r))), "extra") for r in rows]
    out = M.match_sites(spark.createDataFrame(fill(a), COLS), spark.createDataFrame(fill(b), COLS), **kw)
    return {r["a"]: r["b"] for r in out.collect()}


def test_names_in_comparable_form():
    assert site("DORVORVAN R. BK / WERNEVIK")[:2] == ("dorvorvan", ("bank", "right"))
    assert site("left bank, dorvorvan")[:2] == ("dorvorvan", ("bank", "left"))
    assert site("Скухиба Ловер Веир")[:2] == site("Skuhiba Lower Weir")[:2]
    assert site("dirskunstan b/ dam")[1] == site("Dirskunstan below Dam")[1] == ("below", "dam")
    assert site("G.S. Trekrirli")[0] == site("Station Trekrirli")[0] == "trekrirli"
    assert site(None) == site("nan") == site("") == ("", (), "")
    assert water("Rio Osama") == water("Osama River") == water("osama R.") == "osama"
    assert latin("ZemÃ¡lane") == "zemalane"
    assert distance("abcd", "abdc") == 1 and alike("nertebor", "nertebro") > 0.8 and alike("", "x") == 0


def test_sites_are_told_apart_by_place_qualifier_and_name(spark):
    b = [("up", "Norra Upper Bridge", "Elde", 10.0, 20.0), ("lo", "Norra Lower Bridge", "Elde", 10.01, 20.01), ("far", "Norra Upper Bridge", "Tove", 40.0, 20.0), ("by", "Stanvik", "Elde", 10.012, 20.0)]
    a = [("1", "norra upr br", "elde river", 10.001, 20.0), ("2", "LWR BR, NORRA", None, 10.01, 20.0), ("3", "Norra Upper Bridge", "Tove", 40.001, 20.001), ("4", "Stanvikk", "R. Elde", 10.01, 20.0), ("5", "Norra Upper Bridge", "Elde", 60.0, 20.0), ("6", None, "Elde", 10.0121, 20.0), ("7", None, None, None, None)]
    assert run(spark, a, b) == {"1": "up", "2": "lo", "3": "far", "4": "by", "6": "by"}


def test_exchanged_fields_lost_signs_and_records_of_one_site(spark):
    b = [("s", "Gelmivu Weir", "Lorisor", 42.5, -92.8, 100.0)]
    a = [("sign", "Gelmivu Weir", "Lorisor", 42.5, 92.8, 101.0), ("swap", "Gelmivu Weir", "Lorisor", -92.8, 42.5, None), ("names", "Lorisor", "Gelmivu Weir", 42.5, -92.8, None), ("again", "gelmivu wr.", None, 42.501, -92.8, 99.0), ("none", "Gelmivu Weir", "Lorisor", -9999.0, -9999.0, None), ("size", "Gelmivu Weir", "Lorisor", 42.52, -92.8, 900.0)]
    assert run(spark, a, b) == {k: "s" for k in ("sign", "swap", "names", "again", "none")}


def test_repeats_nulls_and_empty(spark):
    b = [("s", "Gelmivu", "L", 1.0, 2.0), ("s", "Gelmivu", "L", 1.0, 2.0), (None, "Gelmivu", "L", 1.0, 2.0)]
    a = [("1", "Gelmivu", "L", 1.0, 2.0), ("1", "Gelmivu", "L", 1.0, 2.0), (None, "Gelmivu", "L", 1.0, 2.0), ("2", "x" * 5000, "y" * 5000, None, None)]
    assert run(spark, a, b) == {"1": "s"}
    assert run(spark, [], b) == {} and run(spark, a, []) == {}


def test_windows_find_the_pairs_of_all_pairs(spark):
    rng = np.random.default_rng(0)
    syl = ["ka", "ro", "min", "tel", "vor", "sun", "pe", "dri"]
    name = lambda: "".join(rng.choice(syl, 4)).capitalize()
    b = [(f"c{i}", name(), f"River{i % 7}", float(rng.uniform(0, 2)), float(rng.uniform(0, 2))) for i in range(300)]
    a = [(f"s{i}", (n[:3] + n[4] + n[3] + n[5:]) if i % 3 == 0 else n.upper(), r if i % 4 else None, la + rng.normal(0, 0.002), lo + rng.normal(0, 0.002)) for i, (c, n, r, la, lo) in enumerate(b[:200])]
    got = run(spark, a, b)
    assert sum(got.get(f"s{i}") == f"c{i}" for i in range(200)) >= 196


def test_assignment_is_the_best_of_all_but_for_the_step():
    rng = np.random.default_rng(5)
    for _ in range(30):
        edges = [(f"a{i}", f"b{j}", float(rng.uniform(0.1, 1))) for i in range(4) for j in range(4) if rng.random() < 0.7]
        w = {(a, b): x for a, b, x in edges}
        best = 0.0
        for k in range(5):
            for left in itertools.permutations([f"a{i}" for i in range(4)], k):
                for right in itertools.combinations([f"b{j}" for j in range(4)], k):
                    if all((x, y) in w for x, y in zip(left, right)):
                        best = max(best, sum(w[p] for p in zip(left, right)))
        got = M.auction(edges)
        assert len({a for a, _, _ in got}) == len(got) == len({b for _, b, _ in got})
        assert sum(x for _, _, x in got) >= best - len(got) * M.STEP / M.UNIT - 1e-9


def test_auction_comes_near_the_best(spark):
    edges = [("a1", "b1", 0.9), ("a1", "b2", 0.8), ("a2", "b1", 0.85), ("a3", "b2", 0.3), ("a3", "b3", 0.2)]
    df = spark.createDataFrame(edges, "a string, b string, w double")
    for limit in (100, 1):
        got = M.assign(df, in_one_task=limit).collect()
        assert {(r["a"], r["b"]) for r in got} == {("a1", "b2"), ("a2", "b1"), ("a3", "b3")}


def test_the_choice_does_not_depend_on_where_a_component_is_solved(spark):
    rng = np.random.default_rng(8)
    edges = sorted({(f"a{i}", f"b{rng.integers(12)}"): float(np.round(rng.uniform(0.6, 1), 3)) for i in range(14) for _ in range(3)}.items())
    df = spark.createDataFrame([(*k, w) for k, w in edges], "a string, b string, w double")
    inside = {(r["a"], r["b"]) for r in M.assign(df, in_one_task=10_000).collect()}
    assert inside == {(a, b) for a, b, _ in M.auction([(*k, w) for k, w in edges])}


def test_a_large_balanced_component_ends_and_is_whole():
    rng = np.random.default_rng(1)
    edges = [(f"a{i}", f"b{j}", float(np.round(rng.uniform(0.64, 1), 6))) for i in range(1000) for j in {*rng.integers(0, 1000, 8)}]
    got = M.auction(edges)
    assert len(edges) > 5_000 and len({a for a, _, _ in got}) == len(got) == len({b for _, b, _ in got}) and len(got) >= 990


def test_members_of_a_crowded_site_are_linked_without_meeting_its_entity(spark):
    b = [("s", "Gelmivu Weir", "Lorisor", 42.5, -92.8)]
    crowd = [(f"m{i:03}", "Gelmivu Weir", "Lorisor", 42.5 + i * 1e-4, -92.8) for i in range(60)]
    equal = [(f"e{i:03}", "Gelmivu Weir", "Lorisor", 42.5005, -92.8) for i in range(60)]
    bare = [(f"n{i:03}", "Gelmivu Weir", "Lorisor", None, None) for i in range(60)]
    assert run(spark, crowd + equal + bare, b, window=3) == {r[0]: "s" for r in crowd + equal + bare}
