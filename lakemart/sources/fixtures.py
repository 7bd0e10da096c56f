"""Adapter views: the driver's TPC-H-style tables presented as the raw layer.

The driver ships ``part supplier orders lineitem events ...`` parquet files.
These functions derive ``raw_products raw_employees raw_payroll raw_orders
raw_traffic raw_traffic_hist`` from them with plain DataFrame expressions,
so every downstream query reads whole driver tables and its work grows with
them. Keys spread over the whole dimensions. Integer arithmetic only, so Spark
and DuckDB agree row for row (the SQL text in ``lakemart.plans.oracle`` states
its fixed values on its own).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.exprs import CITY_REGION

# Fixed values of the adapter: the city list in map order, then the fallback.
ADAPTER_CITIES = list(CITY_REGION.keys())
ADAPTER_OTHER_CITY = "Jinde"
ADAPTER_UNKNOWN_PRODUCT = 999999999
ADAPTER_PAYROLL_MONTHS = [_dt.date(1999, 1, 1), _dt.date(1999, 2, 1), _dt.date(1999, 3, 1)]
ADAPTER_HIRE_EPOCH = _dt.date(1995, 1, 1)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def key_count(spark: SparkSession, sf_dir: str, table: str) -> Column:
    """Number of rows of a dimension as a lazy scalar; its keys are 0 .. n - 1."""
    return _read(spark, sf_dir, table).agg(F.count(F.lit(1))).scalar()


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    mult = F.lit(1) + F.col("p_partkey") % 40
    base = F.floor("p_retailprice").cast("bigint") * mult
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.concat(F.col("p_type"), F.lit("-"), (F.col("p_size") % 3).cast("string")).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        base.alias("base_price"),
        (base - F.lit(200) * mult).alias("unit_cost"),
    )


def raw_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey") + 1  # 0 stands for no employee
    hire_off = (k * 137) % 2000
    return s.select(
        k.alias("employee_id"),
        F.col("s_name").alias("name"),
        F.when(k % 2 == 0, "M").otherwise("F").alias("gender"),
        (F.lit(18) + (k * 7) % 45).cast("int").alias("current_age"),
        F.date_add(F.lit(ADAPTER_HIRE_EPOCH), hire_off.cast("int")).alias("hire_date"),
        F.when(k % 2 == 1, F.date_add(F.lit(ADAPTER_HIRE_EPOCH),
                                      (hire_off + 180 + (k * 53) % 920).cast("int"))).alias("exit_date"),
    )


def raw_payroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey") + 1
    months = F.array(*[F.lit(m) for m in ADAPTER_PAYROLL_MONTHS])
    return s.select(
        k.alias("employee_id"),
        (F.lit(28000) + (k * 97) % 5000).alias("monthly_salary"),
        F.explode(months).alias("month_year"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_from_driver(_read(spark, sf_dir, "orders"), key_count(spark, sf_dir, "part"),
                              key_count(spark, sf_dir, "supplier"))


def orders_from_driver(o: DataFrame, products: Column, employees: Column) -> DataFrame:
    """The raw-orders projection of a driver ``orders`` frame; keys spread over all
    ``products`` and ``employees``, and one order in 509 has lost its time."""
    ok, ck, prio = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")
    city = None
    for i, name in enumerate(ADAPTER_CITIES):
        city = F.when(ck % 21 == i, name) if city is None else city.when(ck % 21 == i, name)
    city = city.otherwise(ADAPTER_OTHER_CITY)
    return o.select(
        ok.alias("order_id"),
        F.when(ok % 97 == 0, F.lit(ADAPTER_UNKNOWN_PRODUCT).cast("bigint")).otherwise(ok % products).alias("product_id"),
        (F.lit(1) + ok % 2).cast("int").alias("quantity"),
        F.when(prio == "1-URGENT", "Warranty+1").when(prio == "2-HIGH", "Insurance")
         .otherwise("None").alias("service_type"),
        F.when(prio.isin("1-URGENT", "2-HIGH"), F.lit(100) + (ok * 13) % 900)
         .when(prio == "5-LOW", F.lit(None).cast("bigint"))
         .otherwise(F.lit(0).cast("bigint")).alias("service_price"),
        F.when(ck % 20 < 11, F.lit(0).cast("bigint")).otherwise(F.lit(1) + ck % employees).alias("employee_id"),
        F.when(ok % 509 != 0, F.col("o_orderdate").cast("timestamp_ntz")
               + F.make_dt_interval(hours=(ok % 24).cast("int"))).alias("order_date"),
        F.when(ok % 211 == 0, F.lit(None).cast("string")).otherwise(city).alias("city"),
        F.when(ok % 17 == 0, F.lit(None).cast("int"))
         .otherwise((F.lit(1) + (ok * ok) % 5).cast("int")).alias("review"),
    )


def raw_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month of second-level events: hourly and streaming work."""
    return traffic_from_events(_read(spark, sf_dir, "events"), key_count(spark, sf_dir, "part"))


def traffic_from_events(e: DataFrame, products: Column) -> DataFrame:
    """The raw-traffic projection of an events frame: a visitor has three events in a row."""
    eid = F.col("event_id")
    return e.select(
        F.col("ts").cast("timestamp_ntz").alias("event_time"),
        F.concat(F.lit("T-"), (eid - eid % 3).cast("string")).alias("traffic_id"),
        F.when(F.col("event_type").isin("click", "purchase"), "yes").otherwise("no").alias("item_in_cart"),
        (eid % products).alias("product_id"),
        F.when(F.col("event_type") == "purchase", F.lit(800001) + eid).alias("order_id"),
    )


def raw_traffic_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About 80 months of midnight events: month marts, anomalies, forecasts."""
    li = _read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_shipdate").cast("timestamp_ntz").alias("event_time"),
        F.concat(F.lit("T-"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")).alias("traffic_id"),
        F.when(F.col("l_returnflag") != "N", "yes").otherwise("no").alias("item_in_cart"),
        F.col("l_partkey").alias("product_id"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"),
               F.col("l_orderkey")).alias("order_id"),
    )


ADAPTERS = {
    "raw_products": raw_products,
    "raw_employees": raw_employees,
    "raw_payroll": raw_payroll,
    "raw_orders": raw_orders,
    "raw_traffic": raw_traffic,
    "raw_traffic_hist": raw_traffic_hist,
}


class RawTables:
    """Lazy accessor for the adapter views of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in ADAPTERS:
            return ADAPTERS[name](self.spark, self.sf_dir)
        raise AttributeError(name)

    def register(self) -> None:
        """Expose every adapter as a temp view (for SQL users)."""
        for name, fn in ADAPTERS.items():
            fn(self.spark, self.sf_dir).createOrReplaceTempView(name)
