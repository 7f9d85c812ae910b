import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluvion.functions.units import after_number, leading_number, parse_mass_rate
from fluvion.operators.units import _optimal_partition, known_factors, level_segments, loads_in_kg_per_day, unit_changes

T, Y, M = 1000.0, 365.25, 0.0
CASES = {
    "t/d": (T, 1), "T/DAY": (T, 1), "t day^-1": (T, 1), "t·d⁻¹": (T, 1), "Tonnen pro Tag": (T, 1), "toneladas/día": (T, 1), "tonne/jour": (T, 1), "metric tons/day": (T, 1), "kg s-1": (1, 1 / 86400), "KG/SEC": (1, 1 / 86400), "kg/sec.": (1, 1 / 86400),
    "kilograms per second": (1, 1 / 86400), "mg s-1": (1e-6, 1 / 86400), "kg/h": (1, 1 / 24), "10^3 t/yr": (1e6, Y), "×10³ t yr⁻¹": (1e6, Y), "1000 t/yr": (1e6, Y), "10^6 t/yr": (1e9, Y), "million t/a": (1e9, Y), "Mt a⁻¹": (1e9, Y),
    "megatonnes/year": (1e9, Y), "kt a-1": (1e6, Y), "thousand tonnes per month": (1e6, M), "t/mois": (T, M), "t mo-1": (T, M), "tonnes annually": (T, Y), "t/an": (T, Y), "short ton/d": (907.18474, 1), "US short tons per day": (907.18474, 1), "lbs/d": (0.45359237, 1),
    "SSL_short_tons_day": (907.18474, 1), "flux_kg_per_s": (1, 1 / 86400), "load (10^3 t/yr)": (1e6, Y), "SedLoad_tonnes_per_day": (T, 1), "[t/d]": (T, 1), "Loads are given in pounds per day.": (0.45359237, 1), "Mg/d": (T, 1), "吨/天": (T, 1), "кг/с": (1, 1 / 86400),
    "mg/L": None, "t km-2 yr-1": None, "t/event": None, "m3/s": None, "NTU": None, "code": None, "1": None, "": None, "unknown": None, "see file header": None, "two gauges merged": None,
}


def test_units(spark):
    df = spark.createDataFrame([(k,) for k in CASES] + [(None,)], "u string").select("u", parse_mass_rate(F.col("u")).alias("p"))
    for r in df.collect():
        want = CASES.get(r["u"])
        assert (r["p"] is None) == (want is None), r
        if want:
            assert r["p"]["kg"] == pytest.approx(want[0]) and r["p"]["days"] == pytest.approx(want[1]), r


def test_numbers(spark):
    cases = {"219.7 tonne/jour": 219.7, "2.429e-01 kg/sec.": 0.2429, "11,250 kg d-1": 11250.0, "ca. 12 t/d": 12.0, "load: 53.37 g/s": 53.37, "1.234,5 t/d": 1234.5, "0,5 t/d": 0.5, "-3 t/d": -3.0, "high flow": None, "~ 7 t/d": 7.0, None: None, "": None}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", leading_number(F.col("t")).alias("n"), after_number(F.col("t")).alias("rest"))
    for r in df.collect():
        assert r["n"] == (pytest.approx(cases[r["t"]]) if cases[r["t"]] is not None else None), r


def test_value_unit_goes_before_field_unit_and_missing_values_give_no_row(spark):
    d = datetime.date(2020, 2, 10)
    f = spark.createDataFrame([(1, "t/d", "SSL", None, None), (1, "t/d", "SSL", None, None), (2, None, "SSL_t_month", None, None), (3, "mg/L", "load", None, None), (4, None, "x", "Loads are given in kg/h", None), (5, "-", "y", None, "kg s-1"), (6, "mg/L", "SSL_t_d", None, None)], "field_id int, raw_unit string, ssl_field string, notes string, normalized_unit string")
    v = spark.createDataFrame(
        [(1, 1, d, 2.0, None), (2, 1, d, 2.0, "2 kg/d"), (3, 2, d, 29.0, None), (4, 3, d, 1.0, None), (5, 1, d, float("nan"), None), (6, 1, d, -9999.0, None), (7, 1, d, None, "3"), (8, 1, d, None, "2 samples"), (9, 4, d, 1.0, None), (10, 5, d, 1.0, "estimated"), (11, 2, None, 1.0, None), (12, None, d, 1.0, "1 lb/d"), (1, 1, d, 2.0, None), (13, 1, d, 5.0, "5 mg/L"), (14, 6, d, 5.0, None), (15, 1, d, 7.0, "2 samples")],
        "value_id int, field_id int, obs_date date, raw_value double, raw_text string",
    )
    got = {r["value_id"]: r["load"] for r in loads_in_kg_per_day(v, f).collect()}
    assert got == pytest.approx({1: 2000.0, 2: 2.0, 3: 1000.0, 7: 3000.0, 9: 24.0, 10: 86400.0, 15: 7000.0, 12: 0.45359237})
    assert loads_in_kg_per_day(v.limit(0), f).count() == 0 and loads_in_kg_per_day(v, f.limit(0)).count() == 2


def test_partition_is_optimal():
    rng = np.random.default_rng(2)
    for _ in range(20):
        x = np.concatenate([rng.normal(m, 0.3, rng.integers(4, 9)) for m in rng.normal(0, 2, 3)])
        n, least, pen = len(x), 3, 1.0
        cost = lambda i, j: ((x[i:j] - x[i:j].mean()) ** 2).sum()
        best = [0.0] + [np.inf] * n
        for t in range(least, n + 1):
            best[t] = min((best[s] + cost(s, t) + pen for s in range(0, t - least + 1)), default=np.inf)
        starts = _optimal_partition(x, pen, least)
        ends = [*starts[1:], n]
        assert sum(cost(s, e) + pen for s, e in zip(starts, ends)) == pytest.approx(best[n])


def test_unit_change_is_located_and_named(spark):
    rng = np.random.default_rng(4)
    d0 = datetime.date(2001, 1, 1)
    rows = [("a", d0 + datetime.timedelta(days=i), float(10 ** (1 + rng.normal(0, 0.05)) * (1000 if i >= 60 else 1))) for i in range(100)] + [("b", d0 + datetime.timedelta(days=i), 5.0) for i in range(30)] + [("c", d0, None), (None, d0, 1.0)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    seg = {(r["k"], r["segment"]): r for r in unit_changes(df, "k", "d", "v").collect()}
    assert set(seg) == {("a", 0), ("a", 1), ("b", 0)}
    assert seg["a", 1]["starts_at"] == d0 + datetime.timedelta(days=60) and seg["a", 1]["factor"] == pytest.approx(1e-3) and seg["a", 0]["factor"] == pytest.approx(1.0)
    cut = {(r["k"], r["segment"]): r["n_values"] for r in level_segments(df, "k", "d", "v", block_rows=40).collect()}
    assert cut == {("a", 0): 60, ("a", 1): 40, ("b", 0): 30}
    assert unit_changes(df.filter("false"), "k", "d", "v").count() == 0
    assert 3.0 in known_factors()


def test_other_quantities(spark):
    from fluvion.functions.units import other_quantity

    yes, no = ["mg/L", "5 g/m3", "t km-2 yr-1", "t/event", "m3/s", "NTU", "mg l^-1"], ["t/d", "kg/s", "2 samples", "estimated", "", None, "lb/day", "10^3 t/month", "Mt a⁻¹"]
    df = spark.createDataFrame([(x,) for x in yes + no], "u string")
    assert [r[0] for r in df.select(other_quantity(F.col("u"))).collect()] == [True] * len(yes) + [False] * len(no)
