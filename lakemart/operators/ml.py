"""ML jobs as Spark aggregates: anomaly flags, seasonal forecasts, ridge cells.

No model object leaves the cluster and nothing is collected: every fit is a
grouped aggregate (``regr_slope``/``regr_intercept``, ``avg``,
``stddev_samp``) and every prediction a join against those aggregates.

The forecasts are a closed-form multiplicative model — linear trend times
seasonal indices with a normal 95 % band — chosen because it runs as plain
SQL at any scale. It keeps the contract of the original solver-based job
(grain, columns, minimum history, horizon cap, clamp at zero), **not** its
numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions.exprs import col, month_diff
from lakemart.session import materialize, shuffled

# Fixed model settings.
Z_THRESHOLD = 2.0              # |z| above this flags an anomaly
MIN_PERIODS = 3                # entities with fewer periods are not scored
MIN_MONTHS = 12                # categories with less history get no forecast
HORIZON_STEPS = 24             # future month starts generated
INTERVAL_Z = 1.96              # 95 % band
TREND_FLOOR = 100              # trend is floored at the series mean over this before dividing by it
RIDGE_LAMBDA = 3.0             # default shrinkage of hour x weekday cells


# ---------------------------------------------------------------------------
# ML-02 anomaly flags
# ---------------------------------------------------------------------------

def anomaly_inputs(traffic_by_product: DataFrame, addon_perf: DataFrame) -> DataFrame:
    """Product conversion rates and employee attach rates as one tagged series table."""
    prod = traffic_by_product.filter(F.col("conversion_rate_pct").isNotNull()).select(
        F.lit("PRODUCT").alias("entity_type"),
        F.col("product_id").cast("string").alias("entity_id"),
        F.col("product_name").alias("entity_name"),
        F.col("category"),
        F.lit("CONVERSION_RATE_PCT").alias("metric_name"),
        F.col("traffic_month").alias("period"),
        F.col("conversion_rate_pct").cast("double").alias("metric_value"))
    emp = addon_perf.filter(F.col("addon_attach_rate_pct").isNotNull()).select(
        F.lit("EMPLOYEE").alias("entity_type"),
        F.col("employee_id").cast("string").alias("entity_id"),
        F.col("employee_name").alias("entity_name"),
        F.lit(None).cast("string").alias("category"),
        F.lit("ADDON_ATTACH_RATE_PCT").alias("metric_name"),
        F.col("performance_month").alias("period"),
        F.col("addon_attach_rate_pct").cast("double").alias("metric_value"))
    return prod.unionByName(emp)


def anomaly_flags(series: DataFrame, generated_at: Column | None = None,
                  threshold: float = Z_THRESHOLD, min_periods: int = MIN_PERIODS) -> DataFrame:
    """Z-score of every row against its entity's mean and sample std.

    An entity has one row per period, so a window per entity is small and reads
    the series once. The metrics are percentages with two decimals; sums of their
    hundredths are exact whole numbers, so the statistics do not depend on the order
    of rows, and the mean is rounded by whole-number division. Entities with
    < ``min_periods`` rows or a constant metric are skipped; a NULL entity id is
    not an entity.
    """
    w = Window.partitionBy("entity_type", "entity_id")
    x, n, sx, sxx = (F.col(c) for c in ("_x", "_n", "_sx", "_sxx"))
    spread = n * sxx - sx * sx  # n squared times the variance, in hundredths
    j = (series.filter(F.col("entity_id").isNotNull())
         .withColumn("_x", F.round(F.col("metric_value") * 100).cast("bigint"))
         .withColumn("_n", F.count(x).over(w)).withColumn("_sx", F.sum(x).over(w)).withColumn("_sxx", F.sum(x * x).over(w))
         .filter((n >= min_periods) & (spread != 0)))
    z = (x * n - sx).cast("double") / F.sqrt(n.cast("double") * spread.cast("double") / (n - 1).cast("double"))
    out = j.select(
        F.md5(F.concat_ws("|", "entity_type", "entity_id", "metric_name",
                          F.col("period").cast("string"))).alias("anomaly_id"),
        "entity_type", "entity_id", "entity_name", "metric_name", "period", "metric_value",
        (F.expr("(_sx * 20000 + _n) div (2 * _n)").cast("double") / F.lit(1e6)).alias("baseline_mean"),
        F.round(F.sqrt(spread.cast("double") / (n * (n - 1)).cast("double")) / F.lit(100.0), 6).alias("baseline_std"),
        F.round(z, 4).alias("z_score"),
        (F.abs(z) > threshold).alias("is_anomaly"),
        F.when(z > 0, "HIGH").otherwise("LOW").alias("anomaly_direction"))
    if generated_at is not None:
        out = out.withColumn("generated_at", generated_at)
    return out


# ---------------------------------------------------------------------------
# Seasonal trend model shared by ML-01 / ML-03
# ---------------------------------------------------------------------------

def _trend(a: Column, b: Column, t: Column, mean: Column) -> Column:
    return F.greatest(a + b * t, F.abs(mean) / TREND_FLOOR)


def category_month_revenue(monthly_sales: DataFrame) -> DataFrame:
    """Month x category revenue rolled down from the product mart."""
    return (monthly_sales.groupBy(F.col("sales_month"), "category")
            .agg(F.sum("total_revenue").alias("total_revenue")))


def revenue_forecast(monthly_sales: DataFrame, as_of: Column, generated_at: Column | None = None,
                     min_months: int = MIN_MONTHS, steps: int = HORIZON_STEPS,
                     drop_partial_last: bool = False) -> DataFrame:
    """Per-category monthly revenue forecast for the month starts after the last
    actual, up to 31 Dec of the year after ``as_of``; values clamped at 0.

    The fit runs as window aggregates partitioned by category over the
    month x category series (one exchange; a category holds at most one row
    per month, so no partition grows with the fact volume): linear trend by
    ``regr_intercept``/``regr_slope`` on the month index, a month-of-year
    index normalised over the months present, and the residual spread.

    ``drop_partial_last`` leaves the month of ``as_of`` (still running) out
    of the training data; by default it trains like a complete month.
    """
    y = (category_month_revenue(monthly_sales.filter(F.col("sales_month").isNotNull()))
         .select("category", F.col("sales_month").alias("ds"), F.col("total_revenue").cast("double").alias("y")))
    if drop_partial_last:
        y = y.filter(F.col("ds") < F.trunc(col(as_of), "MM"))
    wc = Window.partitionBy("category")
    wcm = Window.partitionBy("category", "moy")
    d = (y.withColumn("_n", F.count("y").over(wc))
         .filter(F.col("_n") >= min_months)
         .withColumn("_first", F.min("ds").over(wc))
         .withColumn("_last", F.max("ds").over(wc))
         .withColumn("t", month_diff("_first", "ds").cast("double"))
         .withColumn("moy", F.month("ds"))
         .withColumn("_a", F.regr_intercept("y", "t").over(wc))
         .withColumn("_b", F.regr_slope("y", "t").over(wc))
         .withColumn("_y", F.avg("y").over(wc))
         .withColumn("_tr", _trend(F.col("_a"), F.col("_b"), F.col("t"), F.col("_y")))
         .withColumn("_raw", F.avg(F.col("y") / F.col("_tr")).over(wcm))
         .withColumn("_n_m", F.count("y").over(wcm))
         # mean of the per-month indices over the months present
         .withColumn("_mean_raw", F.sum(F.col("_raw") / F.col("_n_m")).over(wc)
                     / F.size(F.collect_set("moy").over(wc)))
         .withColumn("_s", F.col("_raw") / F.col("_mean_raw"))
         .withColumn("_sigma", F.stddev_samp(F.col("y") / (F.col("_tr") * F.col("_s")) - 1).over(wc)))
    d = materialize(d.select("category", "moy", "_first", "_last", "_a", "_b", "_y", "_s", "_sigma"))
    season = d.select("category", "moy", "_s").distinct()
    model = d.select("category", "_first", "_last", "_a", "_b", "_y", "_sigma").distinct()
    fut = model.select(
        "category", "_first", "_a", "_b", "_y", "_sigma",
        F.explode(F.sequence(F.add_months("_last", 1), F.add_months("_last", steps),
                             F.expr("INTERVAL 1 MONTH"))).alias("forecast_date"))
    cap = F.make_date(F.year(col(as_of)) + 1, F.lit(12), F.lit(31))
    fut = fut.filter(F.col("forecast_date") <= cap).withColumn("moy", F.month("forecast_date"))
    fut = fut.join(shuffled(season), ["category", "moy"], "left")
    t = month_diff("_first", "forecast_date").cast("double")
    yhat = _trend(F.col("_a"), F.col("_b"), t, F.col("_y")) * F.coalesce(F.col("_s"), F.lit(1.0))
    band = F.coalesce(F.col("_sigma"), F.lit(0.0)) * INTERVAL_Z
    out = fut.select(
        F.md5(F.concat_ws("|", "category", F.col("forecast_date").cast("string"))).alias("forecast_id"),
        "forecast_date", "category",
        F.round(F.greatest(yhat, F.lit(0.0)), 2).alias("revenue_forecast"),
        F.round(F.greatest(yhat * (1 - band), F.lit(0.0)), 2).alias("revenue_lower"),
        F.round(F.greatest(yhat * (1 + band), F.lit(0.0)), 2).alias("revenue_upper"))
    if generated_at is not None:
        out = out.withColumn("generated_at", generated_at)
    return out


def daily_visits(hourly: DataFrame) -> DataFrame:
    """Daily training series: the sum of hourly distinct visitors (not a daily distinct)."""
    return (hourly.filter(F.col("total_visits").isNotNull())
            .groupBy("event_date").agg(F.sum("total_visits").alias("total_visits")))


def _season(df: DataFrame, season: str, ratio: Column, name: str) -> DataFrame:
    """avg(ratio) per season over the single series, normalised by its mean: at most 12
    (month) or 7 (weekday) rows, kept, so that later steps do not repeat the steps before."""
    idx = materialize(df.groupBy(season).agg(F.avg(ratio).alias("_raw")))
    return F.broadcast(idx.select(season, (F.col("_raw") / idx.agg(F.avg("_raw")).scalar()).alias(name)))


def traffic_forecast(hourly: DataFrame, as_of: Column, generated_at: Column | None = None,
                     steps: int = HORIZON_STEPS) -> DataFrame:
    """Visits predicted at the next ``steps`` month starts after the last day
    with traffic, capped at 31 Dec of the year after ``as_of``; rounded to
    whole visits and clamped at 0. Trend on the day index, multiplied by a
    month-of-year index and a weekday index fitted on what the month index
    leaves over. The series, its fit (one row) and both indices are each
    checkpointed, so every step reads small stored results."""
    # One row per day, read by every fit below.
    y = materialize(daily_visits(hourly.filter(F.col("event_date").isNotNull())).select(
        F.col("event_date").alias("ds"), F.col("total_visits").cast("double").alias("y")))
    first = y.agg(F.min("ds")).scalar()
    d = (y.withColumn("t", F.datediff("ds", first).cast("double"))
         .withColumn("moy", F.month("ds")).withColumn("dow", F.dayofweek("ds")))
    kept = materialize(d.agg(F.struct(F.regr_intercept("y", "t").alias("a"), F.regr_slope("y", "t").alias("b"),
                                      F.avg("y").alias("mean"), F.min("ds").alias("first")).alias("fit")))
    fit = kept.scalar()
    a, b, mean, first = (fit.getField(n) for n in ("a", "b", "mean", "first"))
    d = d.withColumn("_tr", _trend(a, b, F.col("t"), mean))
    s_m = _season(d, "moy", F.col("y") / F.col("_tr"), "_sm")
    d = d.join(s_m, "moy")
    s_w = _season(d, "dow", F.col("y") / (F.col("_tr") * F.col("_sm")), "_sw")
    d = d.join(s_w, "dow")
    sigma = materialize(d.agg(F.stddev_samp(F.col("y") / (F.col("_tr") * F.col("_sm") * F.col("_sw")) - 1).alias("_sigma"))).scalar()
    # Future month starts: derived from the series' last day (one row, exploded).
    fut = y.agg(F.max("ds").alias("_last")).select(
        "_last", F.explode(F.sequence(F.add_months(F.trunc("_last", "MM"), 1),
                                      F.add_months(F.trunc("_last", "MM"), steps),
                                      F.expr("INTERVAL 1 MONTH"))).alias("prediction_date"))
    cap = F.make_date(F.year(col(as_of)) + 1, F.lit(12), F.lit(31))
    fut = (fut.filter((F.col("prediction_date") > F.col("_last")) & (F.col("prediction_date") <= cap))
           .withColumn("moy", F.month("prediction_date")).withColumn("dow", F.dayofweek("prediction_date"))
           .join(s_m, "moy", "left").join(s_w, "dow", "left"))
    t = F.datediff("prediction_date", first).cast("double")
    yhat = (_trend(a, b, t, mean) * F.coalesce(F.col("_sm"), F.lit(1.0))
            * F.coalesce(F.col("_sw"), F.lit(1.0)))
    band = F.coalesce(sigma, F.lit(0.0)) * INTERVAL_Z
    out = fut.select(
        "prediction_date",
        F.round(F.greatest(yhat, F.lit(0.0)), 0).alias("predicted_visits"),
        F.round(F.greatest(yhat * (1 - band), F.lit(0.0)), 0).alias("visits_lower"),
        F.round(F.greatest(yhat * (1 + band), F.lit(0.0)), 0).alias("visits_upper"))
    if generated_at is not None:
        out = out.withColumn("generated_at", generated_at)
    return out


# ---------------------------------------------------------------------------
# ML-04 hour x weekday ridge cells
# ---------------------------------------------------------------------------

def hour_weekday_ridge(hourly: DataFrame, lam: float = RIDGE_LAMBDA) -> DataFrame:
    """Visits per hour-of-day x weekday cell, shrunk toward the grand mean.

    One-hot ridge with the intercept fixed at the grand mean ``m`` has the
    closed form ``m + n/(n + lam) * (cell_mean - m)``; cells without data
    predict ``m``. The 168-cell grid is generated (``range``), not a cross
    join, and the grand mean is a scalar subquery.
    """
    h = hourly.select(F.col("hour_of_day").cast("int").alias("hour_of_day"),
                      F.dayofweek("event_date").alias("weekday"),
                      F.col("total_visits").cast("double").alias("v"))
    cells = h.groupBy("hour_of_day", "weekday").agg(F.count("v").alias("n_obs"), F.avg("v").alias("cell_mean"))
    m = h.agg(F.avg("v").alias("_m")).scalar()
    spark = hourly.sparkSession
    grid = spark.range(0, 24 * 7).select((F.col("id") % 24).cast("int").alias("hour_of_day"),
                                        (F.col("id") / 24).cast("int").alias("_w")) \
        .select("hour_of_day", (F.col("_w") + 1).alias("weekday"))
    j = grid.join(cells, ["hour_of_day", "weekday"], "left")
    n = F.coalesce(F.col("n_obs"), F.lit(0)).cast("double")
    pred = m + n / (n + F.lit(lam)) * (F.coalesce(F.col("cell_mean"), m) - m)
    return j.select("hour_of_day", "weekday",
                    F.coalesce(F.col("n_obs"), F.lit(0).cast("bigint")).alias("n_obs"),
                    F.round("cell_mean", 4).alias("cell_mean"),
                    F.round(pred, 4).alias("predicted_visits"))
