"""Gold layer: dimensions, the order fact and the six marts.

Plans are declared so that the large fact side is aggregated map-side
before it meets a dimension wherever the dimension only contributes
per-key constants (price, cost, names): the shuffle then carries
partial aggregates, not fact rows, and the dimension join runs on the
small aggregate. Dimensions grow with the input, and their compressed files
promise far fewer bytes than their rows take, so no join with one is a
broadcast through the driver: both sides are shuffled (``shuffled``), and AQE
splits hot keys.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.exprs import (city_region, month_diff, pct, round_fixed, safe_ratio,
                                      surrogate_key, tenure_bracket, trunc_date,
                                      trunc_ts)
from lakemart.session import shuffled

# Fixed values of the date dimension: first day and number of days.
DIM_DATE_START = _dt.date(2021, 1, 1)
DIM_DATE_DAYS = 4000


def _date_attributes(spine: DataFrame) -> DataFrame:
    d = F.col("date_day")
    return spine.select(
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.concat(F.date_format(d, "yyyy"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.date_format(d, "MMM").alias("month_name"),
    )


def dim_date(spark: SparkSession, start: _dt.date = DIM_DATE_START,
             days: int = DIM_DATE_DAYS) -> DataFrame:
    """Calendar spine: one row per day from ``start`` for ``days`` days."""
    spine = spark.range(0, days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day"))
    return _date_attributes(spine)


def dim_date_span(facts: DataFrame, ts_col: str) -> DataFrame:
    """Calendar spine covering every day from the first to the last ``ts_col``
    of ``facts`` (the two bounds are one aggregate row; the days are exploded)."""
    span = facts.agg(F.min(F.col(ts_col).cast("date")).alias("_lo"),
                     F.max(F.col(ts_col).cast("date")).alias("_hi"))
    spine = span.filter(F.col("_lo").isNotNull()).select(
        F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias("date_day"))
    return _date_attributes(spine)


def dim_employees_gold(stg_employees: DataFrame) -> DataFrame:
    return stg_employees.select("employee_id", "employee_name", "gender", "current_age",
                                "hire_date", "exit_date")


def dim_payroll_gold(stg_payroll: DataFrame) -> DataFrame:
    return stg_payroll.select("employee_id", "monthly_salary", "payroll_month")


def fact_orders_gold(stg_orders: DataFrame, stg_products: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Order grain. Orders with an unknown product keep NULL money columns. ``carry`` names
    further columns of the orders to keep."""
    p = stg_products.select("product_id", F.col("base_price").alias("_price"))
    j = stg_orders.join(shuffled(p), "product_id", "left")
    revenue = F.col("quantity") * F.col("_price")
    return j.select(
        "order_id", "order_timestamp",
        F.col("order_timestamp").cast("date").alias("order_date"),
        "employee_id", "product_id", "quantity",
        F.col("_price").alias("unit_price"),
        revenue.alias("product_revenue"),
        F.col("service_price").alias("addon_revenue"),
        (revenue + F.col("service_price")).alias("total_order_value"),
        "service_type", "city", "review", *carry,
    )


def dim_products_gold(stg_products: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Products with their all-time average review (0 when never reviewed).

    The review average is aggregated first (partial aggregation before the
    shuffle), so the join meets one row per product; the aggregate output is
    already hash-partitioned on ``product_id``, so only the product side moves.
    """
    reviews = (fact_orders.filter(F.col("review").isNotNull())
               .groupBy("product_id")
               .agg(round_fixed(F.avg("review"), 2).alias("_avg")))
    j = stg_products.join(shuffled(reviews), "product_id", "left")
    return j.select("product_id", "product_name", "category", "subcategory", "brand",
                    "base_price", "unit_cost",
                    F.coalesce(F.col("_avg"), F.lit(0.0)).alias("avg_review_score"))


def review_totals(fact_orders: DataFrame) -> DataFrame:
    """Per (month, product): sum and count of non-NULL reviews. A stored,
    month-partitioned helper so the all-time review score can be refreshed
    from the months a delta touches instead of the whole fact."""
    f = fact_orders.filter(F.col("review").isNotNull())
    return (f.groupBy(trunc_date("month", "order_timestamp").alias("review_month"), "product_id")
            .agg(F.sum("review").alias("review_sum"), F.count("review").alias("review_n")))


def dim_products_from_totals(stg_products: DataFrame, totals: DataFrame) -> DataFrame:
    """``dim_products_gold`` from stored review totals; equal to the direct
    form because AVG of integers is their (exact) sum divided by the count."""
    per_product = totals.groupBy("product_id").agg(
        round_fixed(F.sum("review_sum").cast("double") / F.sum("review_n"), 2).alias("_avg"))
    j = stg_products.join(shuffled(per_product), "product_id", "left")
    return j.select("product_id", "product_name", "category", "subcategory", "brand",
                    "base_price", "unit_cost",
                    F.coalesce(F.col("_avg"), F.lit(0.0)).alias("avg_review_score"))


def mart_monthly_product_sales(stg_orders: DataFrame, stg_products: DataFrame) -> DataFrame:
    """Month x product sales. Price and cost are per-product constants, so
    ``SUM(qty * price) = price * SUM(qty)``: orders are reduced to one row per
    (month, product) before the inner join with products."""
    o = stg_orders.select(trunc_date("month", "order_timestamp").alias("sales_month"),
                          "product_id", "quantity", "service_price")
    agg = o.groupBy("sales_month", "product_id").agg(
        F.sum("quantity").alias("_qty"),
        F.count("quantity").alias("_nq"),
        # Only rows whose product term is non-NULL reach SUM(qty*price + sp).
        F.sum(F.when(F.col("quantity").isNotNull(), F.col("service_price"))).alias("_sp_q"),
        F.sum("service_price").alias("_sp"),
    )
    p = stg_products.select("product_id", "category", "subcategory", "product_name",
                            "base_price", "unit_cost")
    j = agg.join(shuffled(p), "product_id", "inner")
    prod_rev = F.col("_qty") * F.col("base_price")
    return j.select(
        surrogate_key("sales_month", "product_id").alias("month_prod_id"),
        "sales_month", "product_id", "category", "subcategory", "product_name",
        F.col("_qty").alias("total_qty"),
        prod_rev.alias("product_revenue"),
        F.col("_sp").alias("addon_revenue"),
        F.when(F.col("_nq") > 0, prod_rev + F.col("_sp_q")).alias("total_revenue"),
        (F.col("_qty") * (F.col("base_price") - F.col("unit_cost"))).alias("product_margin"),
    )


def mart_hourly_traffic_conversion(stg_traffic: DataFrame) -> DataFrame:
    """Hour grain: distinct visitors, cart rows, distinct orders."""
    t = stg_traffic.select(trunc_ts("hour", "event_timestamp").alias("event_hour"),
                           "traffic_id", "item_in_cart", "order_id")
    agg = t.groupBy("event_hour").agg(
        F.countDistinct("traffic_id").alias("total_visits"),
        F.count_if(F.col("item_in_cart") == "yes").alias("total_carts"),
        F.countDistinct("order_id").alias("total_orders"),
    )
    return agg.select(
        "event_hour",
        F.col("event_hour").cast("date").alias("event_date"),
        F.hour("event_hour").alias("hour_of_day"),
        "total_visits", "total_carts", "total_orders")


def mart_traffic_conversion_by_product(stg_traffic: DataFrame, stg_products: DataFrame) -> DataFrame:
    """Month x product funnel. Traffic is aggregated per (month, product_id)
    first; product attributes are attached afterwards (left join, so traffic
    of unknown products stays with NULL attributes)."""
    t = stg_traffic.select(trunc_date("month", "event_timestamp").alias("traffic_month"),
                           "product_id", "traffic_id", "item_in_cart", "order_id")
    agg = t.groupBy("traffic_month", "product_id").agg(
        F.countDistinct("traffic_id").alias("total_views"),
        F.count_if(F.col("item_in_cart") == "yes").alias("total_carts"),
        F.countDistinct("order_id").alias("total_orders"),
    )
    p = stg_products.select("product_id", "product_name", "category", "subcategory")
    j = agg.join(shuffled(p), "product_id", "left")
    return j.select(
        surrogate_key("traffic_month", "product_id").alias("month_product_id"),
        "traffic_month", "product_id", "product_name", "category", "subcategory",
        "total_views", "total_carts", "total_orders",
        pct("total_carts", "total_views").alias("cart_rate_pct"),
        pct("total_orders", "total_views").alias("conversion_rate_pct"),
    )


def mart_city_sales(fact_orders: DataFrame, stg_products: DataFrame) -> DataFrame:
    """City x day sales; the margin uses the current product price and cost.

    The fact has one row per order, so orders are counted. Rows are reduced to
    (city, day, product) before the join with products, and the small result is
    rolled up; month and year follow from the day.
    """
    per_product = (fact_orders.select("city", trunc_date("day", "order_timestamp").alias("sales_day"), "product_id", "order_id",
                                      "quantity", "product_revenue", "addon_revenue", "total_order_value")
                   .groupBy("city", "sales_day", "product_id")
                   .agg(F.count("order_id").alias("_orders"), F.sum("quantity").alias("_qty"),
                        F.sum("product_revenue").alias("_goods"), F.sum("addon_revenue").alias("_addon"),
                        F.sum("total_order_value").alias("_value")))
    p = stg_products.select("product_id", (F.col("base_price") - F.col("unit_cost")).alias("_unit_margin"))
    agg = (per_product.join(shuffled(p), "product_id", "inner").groupBy("city", "sales_day").agg(
        F.sum("_orders").alias("total_orders"),
        F.sum("_qty").alias("total_qty"),
        F.sum("_goods").alias("product_revenue"),
        F.sum("_addon").alias("addon_revenue"),
        F.sum("_value").alias("total_revenue"),
        F.sum(F.col("_qty") * F.col("_unit_margin")).alias("total_margin")))
    return agg.select(
        surrogate_key("sales_day", "city").alias("city_day_id"),
        "city", city_region("city").alias("region"),
        F.trunc("sales_day", "YEAR").alias("sales_year"), F.trunc("sales_day", "MM").alias("sales_month"), "sales_day",
        "total_orders", "total_qty", "product_revenue", "addon_revenue", "total_revenue",
        "total_margin")


def mart_product_reviews(fact_orders: DataFrame, stg_products: DataFrame) -> DataFrame:
    """Month x product review statistics (``review_count`` counts orders).

    ``pct_positive`` is the share of reviews >= 4 among orders, signed
    negative when the average review is below 4 (or unknown); ``+ 0.0``
    turns a negative zero into zero.
    """
    f = fact_orders.select(trunc_date("month", "order_timestamp").alias("review_month"),
                           "product_id", "order_id", "review", "total_order_value")
    r = F.col("review")
    agg = f.groupBy("review_month", "product_id").agg(
        F.count("order_id").alias("review_count"),
        F.avg(r).alias("_avg"),
        F.min(r).alias("min_review"),
        F.max(r).alias("max_review"),
        F.sum(F.when(r == 5, 1).otherwise(0)).alias("five_star_count"),
        F.sum(F.when(r == 1, 1).otherwise(0)).alias("one_star_count"),
        F.sum(F.when(r >= 4, 1).otherwise(0)).alias("_pos"),
        F.sum("total_order_value").alias("total_revenue"),
    )
    p = stg_products.select("product_id", "product_name", "category", "subcategory")
    j = agg.join(shuffled(p), "product_id", "inner")
    share = safe_ratio("_pos", "review_count")
    signed = F.when(F.col("_avg") >= 4, share).otherwise(-share)
    return j.select(
        surrogate_key("review_month", "product_id").alias("month_prod_id"),
        "review_month", "product_id", "product_name", "category", "subcategory",
        "review_count",
        round_fixed("_avg", 2).alias("avg_review"),
        "min_review", "max_review",
        F.col("five_star_count").cast("bigint").alias("five_star_count"),
        F.col("one_star_count").cast("bigint").alias("one_star_count"),
        (round_fixed(signed, 4) + F.lit(0.0)).alias("pct_positive"),
        "total_revenue")


def mart_employee_addon_performance(fact_orders: DataFrame, dim_employees: DataFrame) -> DataFrame:
    """Month x employee add-on attach rate with tenure at the month's first day.

    Orders are reduced to one row per (month, employee) before the left join
    with the employee dimension; the unassigned employee 0 (no dimension row,
    often the hottest key) collapses in the map-side partial aggregate and
    lands in the '3+ years' bracket with NULL tenure.
    """
    f = fact_orders.select(trunc_date("month", "order_timestamp").alias("performance_month"),
                           "employee_id", "order_id", "service_type", "addon_revenue")
    agg = f.groupBy("performance_month", "employee_id").agg(
        F.count("order_id").alias("total_orders"),
        F.count_if(F.col("service_type").isNotNull()).alias("addon_orders"),
        F.sum("addon_revenue").alias("total_addon_revenue"),
    )
    e = dim_employees.select("employee_id", "employee_name", "gender", "hire_date")
    j = agg.join(shuffled(e), "employee_id", "left")
    tenure = month_diff("hire_date", "performance_month")
    return j.select(
        surrogate_key("performance_month", "employee_id").alias("month_employee_id"),
        "performance_month", "employee_id", "employee_name", "gender", "hire_date",
        tenure.alias("tenure_months"),
        tenure_bracket(tenure).alias("tenure_bracket"),
        "total_orders", "addon_orders",
        pct("addon_orders", "total_orders").alias("addon_attach_rate_pct"),
        "total_addon_revenue",
        round_fixed(safe_ratio("total_addon_revenue", "addon_orders"), 2).alias("avg_addon_value"),
    )
