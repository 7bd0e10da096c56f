"""Order-side business operators: candidates, active staff, add-on rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions.exprs import ADDON_CATEGORIES, ADDON_PRICE_SHARE, whole_years
from lakemart.operators.incremental import id_watermark_delta


def order_candidates(raw_traffic: DataFrame, processed: DataFrame | None) -> DataFrame:
    """Purchase events not yet turned into orders: ``order_id IS NOT NULL AND
    order_id > MAX(processed.order_id)`` (all purchases on the first run)."""
    d = id_watermark_delta(raw_traffic, processed, "order_id")
    return d.select("order_id", "product_id", F.col("event_time").alias("order_time"))


def active_staff_per_day(days: DataFrame, employees: DataFrame, day_col: str = "_d",
                         exit_inclusive: bool = False) -> DataFrame:
    """Staff employed on each day of ``days`` when hire/exit are calendar dates.

    With day-granular bounds, ``hire <= ts AND (exit IS NULL OR exit > ts)``
    depends only on the day of ``ts``. The count is a prefix sum over staff
    change points: +1 on the hire day, -1 on the first day no longer
    employed (the exit day, or the day after it when the exit day itself
    still counts). The running sum is taken over (change days + asked days)
    only — a set bounded by the calendar, not by the fact volume — so no
    order x staff pairs are ever formed, and no step orders the whole
    timeline in one task.
    """
    hire, exit_ = F.col("hire_date").cast("date"), F.col("exit_date").cast("date")
    gone = F.greatest(hire, exit_)
    if exit_inclusive:
        gone = F.date_add(gone, 1)
    asked = days.select(F.col(day_col).alias("_cd")).distinct()
    last_asked = asked.agg(F.max("_cd")).scalar()
    changes = employees.select(hire.alias("_cd"), F.lit(1).alias("_delta")).unionByName(
        employees.filter(hire.isNotNull() & exit_.isNotNull()).select(gone.alias("_cd"), F.lit(-1).alias("_delta")))
    # Change points after the last asked day cannot affect any answer.
    changes = changes.filter(F.col("_cd").isNotNull() & (F.col("_cd") <= last_asked))
    timeline = (changes.unionByName(asked.withColumn("_delta", F.lit(0)))
                .groupBy("_cd").agg(F.sum("_delta").alias("_delta"))
                .withColumn("_y", F.year("_cd")))
    # Running sum in two levels, with no window over the whole timeline:
    # within each year (a window partitioned by year, <= 366 rows) plus the
    # carry of all earlier years, spread to later years by exploding each
    # yearly total over the years after it (<= years^2 / 2 small rows).
    yearly = timeline.groupBy("_y").agg(F.sum("_delta").alias("_ys"))
    last_year = F.year(last_asked)
    carry = (yearly.filter(F.col("_y") < last_year)
             .select(F.explode(F.sequence(F.col("_y") + 1, last_year)).alias("_y"), "_ys")
             .groupBy("_y").agg(F.sum("_ys").alias("_carry")))
    w = Window.partitionBy("_y").orderBy("_cd").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = timeline.withColumn("_run", F.sum("_delta").over(w))
    return (within.join(carry, "_y", "left")
            .select(F.col("_cd").alias(day_col),
                    (F.coalesce(F.col("_carry"), F.lit(0)) + F.col("_run")).cast("bigint")
                    .alias("active_staff_count")))


def active_staff_per_order(orders: DataFrame, employees: DataFrame, ts_col: str = "order_timestamp") -> DataFrame:
    """Number of staff employed on each order's day (``hire <= day < exit``, calendar dates).

    Orders without any active staff, or without a time, get 0. The count comes from a per-day
    prefix sum joined to the orders on their day: linear in orders, no interval join.
    """
    o = orders.select("order_id", ts_col).withColumn("_d", F.col(ts_col).cast("date"))
    per_day = active_staff_per_day(o, employees.select("employee_id", "hire_date", "exit_date"))
    # One row per calendar day: the DATE domain caps it at ~3.65M rows
    # (~60 MB), and real spans are a few thousand days, so it is broadcast.
    return (o.join(F.broadcast(per_day), "_d", "left")
            .select("order_id", ts_col,
                    F.coalesce(F.col("active_staff_count"), F.lit(0)).cast("bigint").alias("active_staff_count")))


def addon_eligibility(fact_orders: DataFrame, products: DataFrame, employees: DataFrame) -> DataFrame:
    """Per order: seller tenure in whole years, whether the product category may carry an add-on and its price
    (12 % of the base price, rounded half-to-even)."""
    p = products.select("product_id", "category", "base_price")
    e = employees.select("employee_id", "hire_date")
    j = (fact_orders.select("order_id", "order_timestamp", "employee_id", "product_id")
         .join(p, "product_id", "left").join(e, "employee_id", "left"))
    years = whole_years("hire_date", F.col("order_timestamp").cast("date"))
    return j.select(
        "order_id", "employee_id", "product_id", "category",
        years.cast("bigint").alias("tenure_years"),
        F.coalesce(F.col("category").isin(*ADDON_CATEGORIES), F.lit(False)).alias("addon_eligible"),
        F.bround(F.col("base_price") * ADDON_PRICE_SHARE, 0).cast("bigint").alias("addon_price"),
    )
