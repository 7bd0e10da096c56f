"""Silver layer: cleaned, renamed and typed views of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.exprs import OPEN_EXIT_DATE


def stg_products(raw_products: DataFrame) -> DataFrame:
    return raw_products.select(
        "product_id", F.col("name").alias("product_name"), "category", "subcategory",
        "brand", "base_price", "unit_cost")


def stg_employees(raw_employees: DataFrame) -> DataFrame:
    """Dates as ``date``; an open-ended employment ends on 9999-12-31."""
    return raw_employees.select(
        "employee_id", F.col("name").alias("employee_name"), "gender", "current_age",
        F.to_date("hire_date").alias("hire_date"),
        F.coalesce(F.to_date("exit_date"), F.lit(OPEN_EXIT_DATE)).alias("exit_date"))


def stg_payroll(raw_payroll: DataFrame) -> DataFrame:
    return raw_payroll.select(
        "employee_id", "monthly_salary", F.col("month_year").cast("date").alias("payroll_month"))


def stg_traffic(raw_traffic: DataFrame) -> DataFrame:
    return raw_traffic.select(
        "traffic_id", F.col("event_time").cast("timestamp_ntz").alias("event_timestamp"),
        "item_in_cart", "product_id", "order_id")


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    """'None' (a literal string in the landed file) -> NULL; missing price -> 0."""
    st = F.col("service_type")
    return raw_orders.select(
        "order_id", "product_id", "quantity",
        F.when(st == "None", F.lit(None).cast("string")).otherwise(st).alias("service_type"),
        F.coalesce(F.col("service_price"), F.lit(0).cast("bigint")).alias("service_price"),
        "employee_id",
        F.col("order_date").cast("timestamp_ntz").alias("order_timestamp"),
        "city", "review")
