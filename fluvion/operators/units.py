"""Quantities recorded in different units: stated units, and unit changes inside a history."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvion.functions.text import clean_text
from fluvion.functions.units import MASS_KG, TIME_DAYS, after_number, leading_number, other_quantity, parse_mass_rate, per_day
from fluvion.session import fits_broadcast

FILL = -9999.0


def present(value: Column) -> Column:
    return F.when(value.isNull() | F.isnan(value) | (F.abs(value - FILL) < 1e-5), None).otherwise(value)


def loads_in_kg_per_day(values: DataFrame, fields: DataFrame) -> DataFrame:
    """Each load in kilograms a day, by the unit stated with the value, else by that of its field.

    ``values``: value_id, field_id, obs_date, raw_value, raw_text. ``fields``: field_id, raw_unit, ssl_field, notes,
    normalized_unit; the first of these that states a mass per time gives the field's unit. A raw_unit that states
    another kind of quantity (a concentration, a yield) means that the field has no such unit, whatever its name; a
    number written with such a unit gives no row.
    Result: value_id, field_id, obs_date, unit_from, load (double, kg per day). Values that are null, NaN or -9999,
    or without a stated unit of mass per time, give no row; so does a monthly unit without a date. Rows delivered
    twice come out once (the table is deduplicated by value_id); a field delivered twice counts once.
    """
    units = F.coalesce(*[F.when(clean_text(c).isNotNull(), parse_mass_rate(F.col(c))) for c in ("raw_unit", "ssl_field", "notes", "normalized_unit")])
    units = F.when(~other_quantity(F.col("raw_unit")), units)
    f = fields.select("field_id", units.alias("field_unit")).filter("field_unit is not null").dropDuplicates(["field_id"])
    v = values.select("value_id", "field_id", "obs_date", "raw_value", "raw_text").dropDuplicates(["value_id"])
    number = leading_number(F.col("raw_text"))
    # text is parsed only where there is one; most rows have none
    v = v.withColumn("text_number", F.when(F.col("raw_text").isNotNull(), number))
    v = v.withColumn("text_unit", F.when(F.col("raw_text").isNotNull(), parse_mass_rate(F.when(F.col("text_number").isNotNull(), after_number(F.col("raw_text"))).otherwise(F.col("raw_text")))))
    v = v.filter(~(F.col("raw_text").isNotNull() & F.col("text_number").isNotNull() & F.col("text_unit").isNull() & other_quantity(F.col("raw_text"))))
    bare = F.trim(after_number(F.col("raw_text"))) == ""
    amount = F.coalesce(present(F.col("raw_value")), present(F.when(F.col("text_unit").isNotNull() | bare, F.col("text_number"))))
    v = v.withColumn("amount", amount).filter("amount is not null").select("value_id", "field_id", "obs_date", "amount", "text_unit")
    # the inventory is usually small: then the values, of which one field may hold a third, stay where they are; a
    # larger one is joined by key, and AQE splits the partitions of a frequent field
    j = v.join(F.broadcast(f) if fits_broadcast(f) else f, "field_id", "left").withColumn("unit", F.coalesce("text_unit", "field_unit")).filter("unit is not null")
    out = j.select("value_id", "field_id", "obs_date", F.when(F.col("text_unit").isNotNull(), "value").otherwise("field").alias("unit_from"), (F.col("amount") * per_day(F.col("unit"), F.col("obs_date"))).alias("load"))
    return out.filter("load is not null")


def _optimal_partition(x: np.ndarray, penalty: float, least: int) -> list[int]:
    """Starts of the segments with the least sum of squares plus ``penalty`` a segment (exact, with pruning)."""
    n = len(x)
    s, s2 = np.r_[0, np.cumsum(x)], np.r_[0, np.cumsum(x * x)]
    best, last, open_ = np.full(n + 1, np.inf), np.zeros(n + 1, int), np.array([0])
    best[0] = -penalty
    for t in range(least, n + 1):
        m = t - open_
        ok = m >= least
        o, m = open_[ok], m[ok]
        cost = best[o] + s2[t] - s2[o] - (s[t] - s[o]) ** 2 / m
        k = int(np.argmin(cost))
        best[t], last[t] = cost[k] + penalty, o[k]
        kept = o[cost <= best[t]]
        open_ = np.r_[kept, open_[~ok], t - least + 1 if t - least + 1 >= least else np.array([], int)].astype(int)
        open_ = np.unique(open_)
    starts, t = [], n
    while t > 0:
        t = last[t]
        starts.append(int(t))
    return starts[::-1]


def level_segments(df: DataFrame, key: str, order: str, value: str, penalty: float = 12.0, least: int = 5, block_rows: int = 4096) -> DataFrame:
    """Segments of constant level in each history of log10(value), by exact penalised changepoint search.

    Result: key, segment (from 0), starts_at, ends_at, n_values, level (mean log10), shift (against the segment
    before). The penalty is in units of the history's own noise variance (from differences of neighbours).
    A history longer than ``block_rows`` is cut at its quantiles of ``order`` into blocks of about that size, each
    searched exactly, and neighbouring segments of equal level are joined again over the cuts, so no history is
    ever held whole in one task. Null, NaN and non-positive values are left out; empty input gives no rows.
    """
    kind, when = df.schema[key].dataType.simpleString(), df.schema[order].dataType.simpleString()
    x = df.select(F.col(key).alias("k"), F.col(order).alias("o"), F.unix_date(F.col(order).cast("date")).cast("double").alias("p"), F.log10(F.when(F.col(value) > 0, F.col(value))).alias("x")).filter("k is not null and o is not null and x is not null and not isnan(x)")
    sizes = x.groupBy("k").agg(F.count("*").alias("n")).filter(F.col("n") > block_rows)
    cuts = x.join(sizes, "k").groupBy("k").agg(F.max("n").alias("n"), F.percentile_approx("p", F.array(*[F.lit(i / 256) for i in range(1, 256)]), 2000).alias("q"))
    cuts = cuts.select("k", F.array_distinct(F.filter("q", lambda v, i: F.pmod(i + 1, F.greatest(F.lit(1), F.floor(F.lit(256) * block_rows / F.col("n")).cast("int"))) == 0)).alias("cuts"))
    x = x.join(cuts, "k", "left").withColumn("b", F.when(F.col("cuts").isNull(), 0).otherwise(F.size(F.filter("cuts", lambda c: c < F.col("p"))))).drop("cuts")

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["o", "x"], kind="stable")
        v = pdf["x"].to_numpy()
        noise = max(np.median(np.abs(np.diff(v))) / 0.954 if len(v) > 2 else 0.0, 1e-3) ** 2
        starts = _optimal_partition(v, penalty * noise * np.log(max(len(v), 2)), least) if len(v) >= 2 * least else [0]
        ends = [*starts[1:], len(v)]
        o = pdf["o"].to_numpy()
        return pd.DataFrame({"k": pdf["k"].iloc[0], "b": pdf["b"].iloc[0], "starts_at": o[starts], "ends_at": o[[e - 1 for e in ends]], "n": [e - s for s, e in zip(starts, ends)], "level": [v[s:e].mean() for s, e in zip(starts, ends)], "noise": noise})

    parts = x.groupBy("k", "b").applyInPandas(search, f"k {kind}, b int, starts_at {when}, ends_at {when}, n bigint, level double, noise double")

    def join_again(pdf: pd.DataFrame) -> pd.DataFrame:
        rows: list = []
        for r in pdf.sort_values(["starts_at", "b"], kind="stable").itertuples(index=False):
            if rows and rows[-1][5] != r.b and abs(rows[-1][4] - r.level) < 4 * np.sqrt(r.noise * (1 / rows[-1][3] + 1 / r.n)):
                a = rows[-1]
                rows[-1] = [a[0], a[1], r.ends_at, a[3] + r.n, (a[4] * a[3] + r.level * r.n) / (a[3] + r.n), r.b]
            else:
                rows.append([r.k, r.starts_at, r.ends_at, r.n, r.level, r.b])
        out = pd.DataFrame(rows, columns=["k", "starts_at", "ends_at", "n_values", "level", "b"]).drop(columns="b")
        out.insert(1, "segment", np.arange(len(out)))
        out["shift"] = out["level"].diff()
        return out

    out = parts.groupBy("k").applyInPandas(join_again, f"k {kind}, segment int, starts_at {when}, ends_at {when}, n_values bigint, level double, shift double")
    return out.withColumnRenamed("k", key)


def known_factors() -> list[float]:
    """log10 of the factors between any two units of mass per time that the tables know (a month of 30.4375 days)."""
    days = [d or 365.25 / 12 for d in TIME_DAYS]
    rates = [m / d for m in MASS_KG for d in days]
    return sorted({round(float(np.log10(a / b)), 4) for a in rates for b in rates if a > b})


def unit_changes(df: DataFrame, key: str, order: str, value: str, factors: tuple[float, ...] = (86.4, 1000.0, 1e6, 365.25, 30.4375, 1.10231131, 2204.62262), tolerance: float = 0.08, **search) -> DataFrame:
    """Level segments, each with the factor that brings it back to the level of the history's longest segment.

    ``factor`` is the known factor (or its inverse) within ``tolerance`` (log10) of the shift against the longest
    segment, 1.0 where the segments agree, null where no known factor explains the shift.
    """
    seg = level_segments(df, key, order, value, **search)
    base = seg.groupBy(key).agg(F.max_by("level", F.struct(F.col("n_values"), -F.col("segment"))).alias("base_level"))
    logs = F.array(*[F.lit(s * float(np.log10(f))) for f in factors for s in (1, -1)], F.lit(0.0))
    off = F.col("level") - F.col("base_level")
    near = F.array_min(F.transform(logs, lambda g: F.struct(F.abs(off - g).alias("d"), g.alias("g"))))
    seg = seg.join(base, key).withColumn("near", near)
    return seg.withColumn("factor", F.when(F.col("near.d") <= tolerance, F.pow(F.lit(10.0), -F.col("near.g")))).drop("near")
