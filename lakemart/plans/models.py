"""Model wiring: which raw tables feed which silver/gold model.

``Models`` resolves the model dependency order (raw -> silver -> gold -> ML)
lazily: asking for a gold model builds the DataFrames it depends on. Nothing
is executed until an action runs; Catalyst sees one plan per output.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lakemart.operators import gold, silver
from lakemart.sources.fixtures import RawTables


class Models:
    """Silver and gold models over one set of raw tables.

    ``traffic`` selects the traffic adapter: ``raw_traffic`` (one month of
    second-level events, for hourly and streaming work) or
    ``raw_traffic_hist`` (about 80 months, for month marts and forecasts).
    """

    def __init__(self, spark: SparkSession, sf_dir: str, traffic: str = "raw_traffic_hist"):
        self.spark, self.sf_dir = spark, sf_dir
        self.raw = RawTables(spark, sf_dir)
        self.traffic_source = traffic

    # -- silver ------------------------------------------------------------
    @cached_property
    def stg_products(self) -> DataFrame:
        return silver.stg_products(self.raw.raw_products)

    @cached_property
    def stg_employees(self) -> DataFrame:
        return silver.stg_employees(self.raw.raw_employees)

    @cached_property
    def stg_payroll(self) -> DataFrame:
        return silver.stg_payroll(self.raw.raw_payroll)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return silver.stg_orders(self.raw.raw_orders)

    @cached_property
    def stg_traffic(self) -> DataFrame:
        return silver.stg_traffic(getattr(self.raw, self.traffic_source))

    # -- gold --------------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        """Calendar over the span of the order history."""
        return gold.dim_date_span(self.stg_orders, "order_timestamp")

    @cached_property
    def dim_employees_gold(self) -> DataFrame:
        return gold.dim_employees_gold(self.stg_employees)

    @cached_property
    def dim_payroll_gold(self) -> DataFrame:
        return gold.dim_payroll_gold(self.stg_payroll)

    @cached_property
    def fact_orders_gold(self) -> DataFrame:
        return gold.fact_orders_gold(self.stg_orders, self.stg_products)

    @cached_property
    def dim_products_gold(self) -> DataFrame:
        return gold.dim_products_gold(self.stg_products, self.fact_orders_gold)

    @cached_property
    def mart_monthly_product_sales(self) -> DataFrame:
        return gold.mart_monthly_product_sales(self.stg_orders, self.stg_products)

    @cached_property
    def mart_hourly_traffic_conversion(self) -> DataFrame:
        return gold.mart_hourly_traffic_conversion(self.stg_traffic)

    @cached_property
    def mart_traffic_conversion_by_product(self) -> DataFrame:
        return gold.mart_traffic_conversion_by_product(self.stg_traffic, self.stg_products)

    @cached_property
    def mart_city_sales(self) -> DataFrame:
        return gold.mart_city_sales(self.fact_orders_gold, self.stg_products)

    @cached_property
    def mart_product_reviews(self) -> DataFrame:
        return gold.mart_product_reviews(self.fact_orders_gold, self.stg_products)

    @cached_property
    def mart_employee_addon_performance(self) -> DataFrame:
        return gold.mart_employee_addon_performance(self.fact_orders_gold, self.dim_employees_gold)

    def get(self, name: str) -> DataFrame:
        return getattr(self, name)

    MODEL_NAMES = ("stg_products", "stg_employees", "stg_payroll", "stg_orders", "stg_traffic",
                   "dim_date", "dim_employees_gold", "dim_payroll_gold", "fact_orders_gold",
                   "dim_products_gold", "mart_monthly_product_sales", "mart_hourly_traffic_conversion",
                   "mart_traffic_conversion_by_product", "mart_city_sales", "mart_product_reviews",
                   "mart_employee_addon_performance")

    def register_views(self) -> None:
        """Expose the raw adapters and every silver/gold model as temp views,
        so models can be queried with ``spark.sql`` (lazily; nothing runs)."""
        self.raw.register()
        for name in self.MODEL_NAMES:
            self.get(name).createOrReplaceTempView(name)
