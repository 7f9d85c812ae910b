"""Error metrics of paired values as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvion.operators.quantiles import with_quantiles


def correlation(x: str, y: str) -> Column:
    """Pearson's r of the rows that have both; null where either is the same in all of them, for which ``corr`` divides by zero."""
    both = lambda c: F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), F.col(c))
    varies = (F.min(both(x)) < F.max(both(x))) & (F.min(both(y)) < F.max(both(y)))
    return F.when(varies, F.covar_pop(x, y) / F.nullif(F.sqrt(F.var_pop(both(x))) * F.sqrt(F.var_pop(both(y))), F.lit(0.0)))


def error_metrics(x: str, y: str, digits: int = 6) -> list[Column]:
    """Of value x against reference y: n, bias, rmse, mae, mape (over y <> 0), r and r2."""
    d = F.col(x) - F.col(y)
    r = correlation(x, y)
    made = {
        "bias": F.avg(d),
        "rmse": F.sqrt(F.avg(d * d)),
        "mae": F.avg(F.abs(d)),
        "mape": F.avg(F.when(F.col(y) != 0, 100.0 * F.abs(d / F.nullif(F.col(y), F.lit(0.0))))),
        "r": r,
        "r2": r * r,
    }
    return [F.count("*").alias("n"), *[F.round(c, digits).alias(k) for k, c in made.items()]]


def error_metrics_by(df: DataFrame, keys: list[str], x: str, y: str, digits: int = 6) -> DataFrame:
    """The error metrics of each group and its median absolute error, which is found without gathering the group."""
    g = df.groupBy(*keys).agg(*error_metrics(x, y, digits))
    return with_quantiles(g, df, keys, {"median_ae": (F.abs(F.col(x) - F.col(y)), 0.5)}, digits)


def error_metrics_sql(x: str, y: str, digits: int = 6) -> str:
    d = f"({x} - {y})"
    made = {"bias": f"avg({d})", "rmse": f"sqrt(avg({d} * {d}))", "mae": f"avg(abs({d}))", "mape": f"avg(case when {y} <> 0 then 100.0 * abs({d} / {y}) end)", "median_ae": f"median(abs({d}))", "r": f"corr({x}, {y})", "r2": f"corr({x}, {y}) * corr({x}, {y})"}
    return "count(*) as n, " + ", ".join(f"round({v}, {digits}) as {k}" for k, v in made.items())


def ratio_metrics_by(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Of each group, over pairs of positive values: n_positive, median ratio, median log10 ratio, shares within a factor of 2 and 10."""
    ok = (F.col(x) > 0) & (F.col(y) > 0)
    q = F.when(ok, F.col(x) / F.nullif(F.col(y), F.lit(0.0)))
    within = lambda lo, hi, name: F.round(F.avg(F.when(q.isNotNull(), q.between(lo, hi).cast("double"))), 6).alias(name)
    g = df.groupBy(*keys).agg(F.count(q).alias("n_positive"), within(0.5, 2.0, "within_2"), within(0.1, 10.0, "within_10"))
    return with_quantiles(g, df, keys, {"median_ratio": (q, 0.5), "median_log_ratio": (F.log10(q), 0.5)})
