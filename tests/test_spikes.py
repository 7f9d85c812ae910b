import datetime

import numpy as np
import pytest

from fluvion.operators.spikes import implausible_readings

D0 = datetime.date(2000, 1, 1)


def series(spark, values, name="s", **more):
    rows = [(i, name, D0 + datetime.timedelta(days=i), None if v is None else float(v), None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "record_id bigint, uid string, day date, q double, ssc double")


def flags(df, **kw):
    return {(r["record_id"], r["variable"]): r["reason"] for r in implausible_readings(df, "record_id", "uid", "day", ["q", "ssc"], **kw).collect()}


def noisy(n, seed=1):
    rng = np.random.default_rng(seed)
    x = np.zeros(n)
    for i in range(1, n):
        x[i] = 0.95 * x[i - 1] + rng.normal(0, 0.02)
    return np.round(100 * 10**x, 2)


def test_spikes_of_one_to_three_days_are_found_and_floods_are_not(spark):
    v = noisy(600)
    v[100] *= 30
    v[200:203] /= 40
    v[300] *= 8
    flood = 100 * (1 + 20 * np.exp(-np.arange(40) / 6.0))
    v[400:440] = np.maximum(v[400:440], flood)
    assert flags(series(spark, v)) == {(k, "q"): "spike" for k in (100, 200, 201, 202, 300)}


def test_a_lasting_change_of_level_is_no_spike(spark):
    v = noisy(400)
    v[200:] *= 50
    assert flags(series(spark, v)) == {}


def test_stuck_runs_with_the_first_reading_but_not_the_habit_of_a_coarse_series(spark):
    v = noisy(500)
    v[250:262] = v[250]
    assert flags(series(spark, v)) == {(k, "q"): "stuck" for k in range(250, 262)}
    coarse = np.repeat(np.arange(1, 40) % 4 + 2, 12)
    assert flags(series(spark, coarse)) == {}


def test_dry_spells_are_usual_and_single_zeros_are_not(spark):
    v = noisy(700)
    dry = np.concatenate([np.linspace(2, -0.5, 20), np.full(90, -np.inf), np.linspace(-0.5, 2, 20)])
    v[300:430] = np.where(np.isneginf(dry), 0, 10.0**dry)
    assert flags(series(spark, v)) == {}
    w = noisy(300)
    w[150] = 0
    assert flags(series(spark, w)) == {(150, "q"): "spike"}


def test_impossible_missing_fill_repeats_nulls_and_empty(spark):
    v = list(noisy(120))
    v[10], v[20], v[30], v[40] = -5, None, -9999, float("nan")
    df = series(spark, v)
    twice = df.unionByName(df.filter("record_id = 10")).unionByName(spark.createDataFrame([(None, "s", D0, 1.0, 1.0), (900, None, D0, -1.0, 1.0), (901, "s", None, -1.0, 1.0)], df.schema))
    assert flags(twice) == {(10, "q"): "impossible"}
    assert flags(df.filter("false")) == {}


def test_results_do_not_depend_on_how_series_are_cut(spark):
    v = noisy(1500, 5)
    for k in (300, 511, 512, 513, 900):
        v[k] *= 25
    v[1000:1015] = v[1000]
    df = series(spark, v)
    assert flags(df) == flags(df, span_days=512, margin_days=128)


def test_many_series_in_one_task(spark):
    rows, want = [], set()
    for s in range(40):
        v = noisy(60, s)
        v[30] *= 20
        rows += [(s * 100 + i, f"s{s}", D0 + datetime.timedelta(days=i), float(x), None) for i, x in enumerate(v)]
        want.add((s * 100 + 30, "q"))
    df = spark.createDataFrame(rows, "record_id bigint, uid string, day date, q double, ssc double")
    assert want <= set(flags(df)) and len(flags(df)) <= len(want) + 2


def test_the_model_decides(spark):
    """The same jump is a spike in a quiet series and no case in one whose innovations are as large."""
    quiet, loud = noisy(400), noisy(400)
    rng = np.random.default_rng(3)
    loud = np.round(loud * 10 ** rng.normal(0, 0.3, 400), 2)
    quiet[200] *= 5
    loud[200] *= 5
    assert flags(series(spark, quiet)) == {(200, "q"): "spike"}
    assert flags(series(spark, loud)) == {}
    assert flags(series(spark, quiet), sigmas=1000.0) == {}


def test_long_runs_in_a_long_coarse_series_are_quick(spark):
    v = np.repeat(np.arange(3000) % 7 + 1, 6)
    import time

    from fluvion.operators.spikes import flag_readings

    t = time.time()
    f = flag_readings(np.zeros(len(v), int), np.arange(len(v)), {"q": v.astype(float)}, {"q": 5e5})
    assert not (f["q"] == 2).any() and time.time() - t < 5


def test_a_load_that_follows_from_a_flood_is_none():
    from fluvion.operators.spikes import LIMITS, flag_readings

    q, ssc = noisy(500, 1), noisy(500, 2)
    q[250:253] *= (4, 5, 4)
    ssc[250:253] *= (4, 5, 4)
    ssl = q * ssc * 0.0864
    ssl[100] *= 30
    f = flag_readings(np.zeros(500, int), np.arange(500), {"q": q, "ssc": ssc, "ssl": ssl}, LIMITS)
    assert f["ssl"][100] == 1
    g = flag_readings(np.zeros(500, int), np.arange(500), {"q": np.where(np.arange(500) // 3 == 83, np.nan, q), "ssc": ssc, "ssl": ssl}, LIMITS)
    assert g["ssl"][100] == 1
