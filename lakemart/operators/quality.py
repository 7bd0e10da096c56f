"""Data-quality checks: key uniqueness and not-null, one summary row per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Gold tables and their keys.
KEYS = {
    "fact_orders_gold": "order_id",
    "dim_products_gold": "product_id",
    "dim_employees_gold": "employee_id",
    "dim_date": "date_day",
    "mart_monthly_product_sales": "month_prod_id",
    "mart_hourly_traffic_conversion": "event_hour",
    "mart_traffic_conversion_by_product": "month_product_id",
    "mart_city_sales": "city_day_id",
    "mart_product_reviews": "month_prod_id",
    "mart_employee_addon_performance": "month_employee_id",
}


def unique_key_check(table_name: str, df: DataFrame, key: str) -> DataFrame:
    """rows, distinct keys (NULL counts as one key) and keys occurring more than once."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    return per_key.agg(
        F.sum("_c").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("_c") > 1).alias("duplicate_keys"),
    ).select(F.lit(table_name).alias("table_name"), F.lit(key).alias("key_column"),
             F.coalesce(F.col("row_count"), F.lit(0).cast("bigint")).alias("row_count"),
             "distinct_keys", "duplicate_keys")


def not_null_check(table_name: str, df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.count_if(F.col(column).isNull()).alias("null_count")) \
        .select(F.lit(table_name).alias("table_name"), F.lit(column).alias("column_name"),
                "row_count", "null_count")


def run_checks(check, tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Union of one check row per (table, column)."""
    return reduce(DataFrame.unionByName, [check(n, df, c) for n, (df, c) in tables.items()])
