"""Seasonal forecasts with changepoints, by ridge least squares.

A series is a sum of a straight trend, hinges that bend it at evenly spaced changepoints in
the first four fifths of its span, and Fourier terms for the year and the week. The moments
of these terms (X'X, X'y and y'y of every series in one aggregate) are all that the fit
needs: each row gives its products, partial sums are merged, and one small matrix a series
is left, which a Cholesky factor solves. Hinges and Fourier terms are shrunk by a ridge; the
trend is not. The number of rows that reach a solve is bounded by the terms, whatever the
length of the series.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions.exprs import col

#: Fixed day from which the phases of year and week are counted; days of a year.
EPOCH, YEAR_DAYS = "2000-01-01", 365.25
#: Share of the span in which changepoints lie; quantile of the interval.
BENT, INTERVAL_Z = 0.8, 1.96


@dataclass(frozen=True)
class Basis:
    """Numbers of hinges and of Fourier pairs, and the ridge on either kind."""
    hinges: int
    yearly: int
    weekly: int = 0
    hinge_ridge: float = 10.0
    season_ridge: float = 1.0
    trend_ridge: float = 1e-6

    @property
    def ridge(self) -> list[float]:
        return ([self.trend_ridge] * 2 + [self.hinge_ridge] * self.hinges
                + [self.season_ridge] * 2 * (self.yearly + self.weekly))

    def terms(self, ds: Column, first: Column, last: Column) -> Column:
        """Values of all terms on a day, as an array."""
        t = F.datediff(ds, first) / F.greatest(F.datediff(last, first), F.lit(1)).cast("double")
        bent = [F.greatest(F.lit(0.0), t - BENT * (j + 1) / (self.hinges + 1)) for j in range(self.hinges)]
        days = F.datediff(ds, F.lit(EPOCH).cast("date")).cast("double")
        waves = [f(F.lit(2 * np.pi * k) * days / period) for n, period in ((self.yearly, YEAR_DAYS), (self.weekly, 7.0))
                 for k in range(1, n + 1) for f in (F.sin, F.cos)]
        return F.array(F.lit(1.0), t, *bent, *waves)


MONTHLY = Basis(hinges=3, yearly=4, hinge_ridge=0.1, season_ridge=0.1)
DAILY = Basis(hinges=8, yearly=6, weekly=3, season_ridge=10.0)


def moments(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, i, j (i >= j), v: sums of the products of all terms of ``z``, the last of which is y."""
    products = F.flatten(F.transform("z", lambda a, i: F.transform(
        F.slice("z", F.lit(1), i + 1), lambda b, j: F.struct(i.alias("i"), j.alias("j"), (a * b).alias("v")))))
    return (rows.select(*keys, F.explode(products).alias("p")).groupBy(*keys, "p.i", "p.j")
            .agg(F.sum("p.v").alias("v")))


def fit(series: DataFrame, keys: Sequence[str], basis: Basis, least: int = 12) -> DataFrame:
    """keys, first, last, beta (array) and sigma (residual spread) of every series with at least
    ``least`` rows. ``series``: keys, ds (date), y."""
    w = Window.partitionBy(*keys)  # a series has one row a day at most
    rows = (series.filter(F.col("ds").isNotNull() & F.col("y").isNotNull())
            .withColumns({"first": F.min("ds").over(w), "last": F.max("ds").over(w), "n": F.count("y").over(w)}).filter(F.col("n") >= least)
            .select(*keys, "first", "last", F.array_append(basis.terms(F.col("ds"), F.col("first"), F.col("last")), F.col("y").cast("double")).alias("z")))
    keys = [*keys, "first", "last"]
    ridge = np.array(basis.ridge)
    p = len(ridge)

    def solve(m: pd.DataFrame) -> pd.DataFrame:
        a = np.zeros((p + 1, p + 1))
        i, j, v = m["i"].to_numpy(), m["j"].to_numpy(), m["v"].to_numpy()
        a[i, j] = a[j, i] = v
        x, y = a[:p, :p], a[:p, p]
        low = np.linalg.cholesky(x + np.diag(ridge))
        beta = np.linalg.solve(low.T, np.linalg.solve(low, y))
        rest = max(0.0, a[p, p] - 2 * beta @ y + beta @ x @ beta)
        return pd.DataFrame({**{k: [m[k].iloc[0]] for k in keys}, "beta": [beta.tolist()], "sigma": [np.sqrt(rest / max(1.0, x[0, 0] - 1))]})

    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "beta array<double>", "sigma double"])
    return moments(rows, keys).groupBy(*keys).applyInPandas(solve, schema)


def predict(models: DataFrame, keys: Sequence[str], basis: Basis, days: Column, as_of: Column, digits: int, ds: str, names: Sequence[str]) -> DataFrame:
    """Forecast with its interval for ``days`` (an array of dates from first and last) up to the end
    of the year after ``as_of``; values below 0 become 0."""
    cap = F.make_date(F.year(col(as_of)) + 1, F.lit(12), F.lit(31))
    at = models.select("*", F.explode(days).alias(ds)).filter(F.col(ds) <= cap)
    x = basis.terms(F.col(ds), F.col("first"), F.col("last"))
    yhat = F.aggregate(F.zip_with(x, "beta", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    at = at.select(*keys, ds, yhat.alias("_y"), (F.col("sigma") * INTERVAL_Z).alias("_band"))
    value = lambda v: F.round(F.greatest(v, F.lit(0.0)), digits)
    middle, low, high = names
    return at.select(*keys, ds, value(F.col("_y")).alias(middle), value(F.col("_y") - F.col("_band")).alias(low),
                     value(F.col("_y") + F.col("_band")).alias(high))


def _months_after(last: Column, steps: int) -> Column:
    return F.sequence(F.add_months(last, 1), F.add_months(last, steps), F.expr("INTERVAL 1 MONTH"))


def revenue_forecast(category_months: DataFrame, as_of: Column, basis: Basis = MONTHLY, steps: int = 24) -> DataFrame:
    """Monthly revenue by category for the months after its last one. ``category_months``:
    sales_month, category, total_revenue."""
    series = category_months.select("category", F.col("sales_month").alias("ds"), F.col("total_revenue").cast("double").alias("y"))
    return predict(fit(series, ["category"], basis), ["category"], basis, _months_after(F.col("last"), steps), as_of, 0,
                   "forecast_date", ("revenue_forecast", "revenue_lower", "revenue_upper"))


def traffic_forecast(daily: DataFrame, as_of: Column, basis: Basis = DAILY, steps: int = 24) -> DataFrame:
    """Daily visits at the month starts after the last day. ``daily``: event_date, total_visits."""
    series = daily.select(F.lit("visits").alias("series"), F.col("event_date").alias("ds"), F.col("total_visits").cast("double").alias("y"))
    return predict(fit(series, ["series"], basis), [], basis, _months_after(F.trunc("last", "MM"), steps), as_of, 1,
                   "prediction_date", ("predicted_visits", "visits_lower", "visits_upper"))
