"""Report queries on the gold layer (KPI cards, trends, funnel, distributions).

Period-over-period values use a self-join on the shifted period rather than
``lag`` over an unpartitioned window: a missing month yields NULL instead of
silently comparing with an older month, and no step needs one task to see
the whole series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.exprs import pct, round_fixed, safe_ratio


def city_kpi(city_sales: DataFrame) -> DataFrame:
    """Per city: revenue, orders, quantity, margin, selling days, average order value."""
    agg = city_sales.groupBy("city", "region").agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_qty").alias("total_qty"),
        F.sum("total_margin").alias("total_margin"),
        F.count("sales_day").alias("selling_days"),
    )
    return agg.withColumn("avg_order_value", round_fixed(safe_ratio("total_revenue", "total_orders"), 2))


def mom_yoy(city_sales: DataFrame) -> DataFrame:
    """City x month revenue with the previous month and the same month a year earlier."""
    m = city_sales.groupBy("city", "sales_month").agg(F.sum("total_revenue").alias("revenue"))
    prev_m = m.select(F.col("city").alias("_pm_city"), F.add_months("sales_month", 1).alias("_pm_month"),
                      F.col("revenue").alias("prev_month_revenue"))
    prev_y = m.select(F.col("city").alias("_py_city"), F.add_months("sales_month", 12).alias("_py_month"),
                      F.col("revenue").alias("prev_year_revenue"))
    j = m.join(prev_m, F.col("city").eqNullSafe(F.col("_pm_city")) & (F.col("sales_month") == F.col("_pm_month")),
               "left")
    j = j.join(prev_y, F.col("city").eqNullSafe(F.col("_py_city")) & (F.col("sales_month") == F.col("_py_month")),
               "left")
    return j.select(
        "city", "sales_month", "revenue", "prev_month_revenue",
        pct(F.col("revenue") - F.col("prev_month_revenue"), "prev_month_revenue").alias("mom_pct"),
        "prev_year_revenue",
        pct(F.col("revenue") - F.col("prev_year_revenue"), "prev_year_revenue").alias("yoy_pct"))


def category_margin(monthly_sales: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Revenue and margin per category and product, with the product's review score."""
    s = monthly_sales.groupBy("category", "product_id", "product_name").agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("product_revenue").alias("product_revenue"),
        F.sum("product_margin").alias("product_margin"))
    j = s.join(dim_products.select("product_id", "avg_review_score"), "product_id", "left")
    return j.select("category", "product_id", "product_name", "total_revenue", "product_margin",
                    pct("product_margin", "product_revenue").alias("margin_pct"), "avg_review_score")


def funnel(traffic_by_product: DataFrame) -> DataFrame:
    """Views -> carts -> orders per month and category; rates recomputed from sums."""
    agg = traffic_by_product.groupBy("traffic_month", "category").agg(
        F.sum("total_views").alias("views"),
        F.sum("total_carts").alias("carts"),
        F.sum("total_orders").alias("orders"))
    return agg.select("traffic_month", "category", "views", "carts", "orders",
                      pct("carts", "views").alias("cart_rate_pct"),
                      pct("orders", "views").alias("conversion_rate_pct"))


def review_distribution(fact_orders: DataFrame) -> DataFrame:
    """Orders per review score (NULL = no review)."""
    return fact_orders.groupBy("review").agg(F.count(F.lit(1)).alias("orders"))
