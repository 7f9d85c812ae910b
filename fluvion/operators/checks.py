"""Integrity checks as relational queries: (check, status, details)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Each check names a condition that no row may meet; one pass counts them all."""
    names = list(checks)
    g = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    return g.unpivot([], names, "check", "n_bad").select("check", F.when(F.col("n_bad") == 0, "pass").otherwise("fail").alias("status"), F.col("n_bad").cast("bigint").alias("details"))


def unique(df: DataFrame, check: str, *keys: str) -> DataFrame:
    """No key (or tuple of keys) may occur twice."""
    g = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("n_bad"))
    return g.select(F.lit(check).alias("check"), F.when(F.col("n_bad") == 0, "pass").otherwise("fail").alias("status"), F.col("n_bad").cast("bigint").alias("details"))


def contained(df: DataFrame, other: DataFrame, check: str, key: str) -> DataFrame:
    """Every key of ``df`` must occur in ``other``."""
    g = df.select(key).filter(F.col(key).isNotNull()).distinct().join(other.select(key), key, "left_anti").agg(F.count("*").alias("n_bad"))
    return g.select(F.lit(check).alias("check"), F.when(F.col("n_bad") == 0, "pass").otherwise("fail").alias("status"), F.col("n_bad").cast("bigint").alias("details"))


def together(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def require(checks: DataFrame) -> None:
    """Raise with the names of the checks that failed (a handful of rows)."""
    bad = [r["check"] for r in checks.filter("status = 'fail'").select("check").collect()]
    if bad:
        raise ValueError("failed checks: " + ", ".join(sorted(bad)))


def one_to_one(left: DataFrame, right: DataFrame, key: str, same: list[str] = (), close: dict[str, float] | None = None) -> DataFrame:
    """Inner join of two frames that must hold the same keys, each once, and agree on ``same`` columns exactly and on ``close`` ones within
    a tolerance (null agrees with null). Raises with the number of rows that break each rule; else gives ``left`` with the
    columns of ``right`` that it lacks.
    """
    close = close or {}
    marked = lambda d, n: d.groupBy(key).agg(F.count("*").alias(n))
    k = marked(left, "_a").join(marked(right, "_b"), key, "full")
    rules = {f"{key}: repeated left": F.col("_a") > 1, f"{key}: repeated right": F.col("_b") > 1, f"{key}: missing right": F.col("_b").isNull(), f"{key}: missing left": F.col("_a").isNull(), f"{key}: null": F.col(key).isNull()}
    bad = counted(k, rules)
    both = left.select(key, *[F.col(c).alias(f"_l_{c}") for c in (*same, *close)]).join(right.select(key, *[F.col(c).alias(f"_r_{c}") for c in (*same, *close)]), key)
    differ = {f"{c}: differs": ~F.col(f"_l_{c}").eqNullSafe(F.col(f"_r_{c}")) for c in same}
    for c, t in close.items():
        a, b = F.col(f"_l_{c}"), F.col(f"_r_{c}")
        differ[f"{c}: differs by more than {t}"] = ~(a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= t, F.lit(False)))
    require(together(bad, counted(both, differ)) if differ else bad)
    return left.join(right.select(key, *[c for c in right.columns if c not in left.columns]), key)


def unique_nonempty(df: DataFrame, key: str, whole: bool = False) -> DataFrame:
    """Checks that ``key`` is there in every row, not blank, a whole number where ``whole``, and occurs once."""
    c = F.col(key)
    rules = {f"{key}_present": c.isNull() | (F.trim(c.cast("string")) == "")}
    if whole:
        rules[f"{key}_whole"] = c.isNotNull() & ~c.cast("string").rlike(r"^\s*-?\d+(\.0+)?\s*$")
    return together(counted(df, rules), unique(df.filter(c.isNotNull()), f"{key}_unique", key))


def many_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join to a frame whose ``key`` must be unique; raises otherwise."""
    require(unique(right.filter(F.col(key).isNotNull()), f"{key}_unique_in_dimension", key))
    return left.join(right, key, "left")
