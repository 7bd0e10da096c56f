"""The ordered raw -> silver -> gold -> ML pipeline (one run = one call).

Every gold table is written to ``<warehouse>/gold/<name>`` and read back by
the steps after it, so each step's plan starts from stored files (lineage is
cut at table boundaries; a lost executor only repeats its current step).

Changes are told by content, not by time: a ledger keeps a digest of every day
of the raw orders and the raw traffic, and a run looks into the days whose
digest differs. In those, a row hash stored with the fact tells the orders
that are new, corrected in place, moved or gone; late orders, orders tied with
the newest stored time and orders without a time are found like any other. The
months that they touch (and those they leave) are then rebuilt from the stored
fact in every mart. Traffic has no key; its changed days and their months are
rebuilt.

What a run must rebuild is written to a journal before the first table changes
and struck out table by table, so a run that breaks off anywhere is completed
by the next one (``lakemart.plans.journal``). Tables are staged and swapped in.

Build order follows the model references: silver views; employee and
payroll dimensions; the order fact; month, hour and product-funnel marts;
then the product dimension, city, review and add-on marts that read the
fact; the date dimension; finally the three ML outputs.
"""

from __future__ import annotations

import contextlib
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators import changes, gold, ml, silver
from lakemart.operators.incremental import latest_per_key
from lakemart.plans.journal import Journal
from lakemart.sources.sinks import (distinct_values, one_of, publish, replace_partitions, replace_table, table_exists,
                                    upsert_table)


@dataclass
class MartSpec:
    """How a gold table is stored: its key and the period column it is partitioned by."""
    keys: list[str]
    partition: str | None


SPECS = {
    "fact_orders_gold": MartSpec(["order_id"], "order_month"),
    "mart_monthly_product_sales": MartSpec(["month_prod_id"], "sales_month"),
    "mart_hourly_traffic_conversion": MartSpec(["event_hour"], "event_date"),
    "mart_traffic_conversion_by_product": MartSpec(["month_product_id"], "traffic_month"),
    "mart_city_sales": MartSpec(["city", "sales_day"], "sales_month"),
    "mart_product_reviews": MartSpec(["month_prod_id"], "review_month"),
    "mart_employee_addon_performance": MartSpec(["month_employee_id"], "performance_month"),
    "dim_date": MartSpec(["date_day"], None),
    # Internal helper: review sums per (month, product) behind dim_products_gold.
    "review_totals": MartSpec(["review_month", "product_id"], "review_month"),
}
UNSPECIFIED = ("dim_employees_gold", "dim_payroll_gold", "dim_products_gold", "ml_anomaly_flags", "ml_revenue_forecast",
               "ml_traffic_prediction")

#: Tables derived from the fact and from the raw traffic: what the journal names.
ORDER_TABLES = ("mart_monthly_product_sales", "review_totals", "mart_city_sales", "mart_product_reviews",
                "mart_employee_addon_performance", "dim_date")
HOURLY, FUNNEL = "mart_hourly_traffic_conversion", "mart_traffic_conversion_by_product"
FACT = "fact_orders_gold"
#: Tables that are rebuilt at the same time.
TOGETHER = 4
#: Outputs that are derived whole from marts, by the side of the run that changes those.
ORDER_OUTPUTS, TRAFFIC_OUTPUTS = ("ml_anomaly_flags", "ml_revenue_forecast"), ("ml_anomaly_flags", "ml_traffic_prediction")


class Pipeline:
    """One warehouse folder; ``run(raw)`` performs a full or delta run. ``after_step`` is called
    with the name of each step that has ended (progress, tests)."""

    def __init__(self, spark: SparkSession, warehouse: str, after_step: Callable[[str], None] | None = None):
        self.spark, self.root = spark, warehouse.rstrip("/")
        self.after_step = after_step or (lambda name: None)
        # Schema of every model written in this run: a partitioned write of
        # zero rows leaves no file to read a schema from.
        self._schemas: dict = {}
        # Wall seconds per step of the last run (driver-side clock).
        self.timings: dict[str, float] = {}

    @contextlib.contextmanager
    def _step(self, name: str):
        t0 = time.perf_counter()
        yield
        self.timings[name] = round(time.perf_counter() - t0, 3)
        self.after_step(name)

    def path(self, name: str, layer: str = "gold") -> str:
        return f"{self.root}/{layer}/{name}"

    def _read(self, name: str) -> DataFrame:
        if table_exists(self.spark, self.path(name)):
            return self.spark.read.parquet(self.path(name))
        if name not in self._schemas:
            raise FileNotFoundError(self.path(name))
        return self.spark.createDataFrame([], self._schemas[name])

    def gold(self, name: str) -> DataFrame:
        df = self._read(name)
        return df.drop("order_month", changes.ROW_HASH) if name == FACT else df

    def _put(self, name: str, df: DataFrame, values: list | None = None) -> None:
        """Replace the table, or the partitions of the given period values."""
        part = SPECS[name].partition if name in SPECS else None
        self._schemas[name] = df.schema
        with self._step(name):
            if values is None or not table_exists(self.spark, self.path(name)):
                replace_table(df, self.path(name), [part] if part else None)
            else:
                replace_partitions(df, self.path(name), part, values)

    # -- changes ---------------------------------------------------------------
    def _changed_days(self, name: str, rows: DataFrame, day: Column) -> list | None:
        """Days of a raw table whose digest differs from the ledger's; None without a ledger. The new
        ledger is stored by ``_keep_ledger``."""
        path, new = self.path(f"{name}_ledger", "silver"), self.path(f"{name}_ledger_next", "silver")
        replace_table(changes.period_digests(rows, day), new)
        if not table_exists(self.spark, path):
            return None
        return distinct_values(changes.changed_periods(self.spark.read.parquet(new), self.spark.read.parquet(path)), "period")

    def _keep_ledger(self, name: str) -> None:
        with self._step(f"{name}_ledger"):
            replace_table(self.spark.read.parquet(self.path(f"{name}_ledger_next", "silver")), self.path(f"{name}_ledger", "silver"))

    def _rebuild(self, journal: Journal, makers: dict[str, Callable[[list | None], DataFrame]]) -> None:
        """Rebuild what the journal asks of some tables that do not depend on each other, together, and
        strike them out one by one."""
        def one(name: str) -> None:
            wanted, periods = journal.todo(name)
            if wanted:
                self._put(name, makers[name](periods), periods)
                journal.done(name)

        with ThreadPoolExecutor(TOGETHER) as pool:  # the work is Spark's; a thread waits for a job
            for done in [pool.submit(one, name) for name in makers]:
                done.result()

    # -- orders ----------------------------------------------------------------
    @staticmethod
    def _fact(orders: DataFrame, s_products: DataFrame) -> DataFrame:
        fact = gold.fact_orders_gold(orders, s_products, carry=(changes.ROW_HASH,))
        return fact.withColumn("order_month", F.trunc("order_date", "MM"))

    @staticmethod
    def _order_plan(months: list | None) -> dict[str, list | None]:
        """What changed months of the fact make due; some tables are always rebuilt whole."""
        return {**{t: months for t in ORDER_TABLES}, "dim_date": None, **{t: None for t in ORDER_OUTPUTS}}

    def _load_fact(self, journal: Journal, s_orders: DataFrame, s_products: DataFrame) -> None:
        """Load what is new, corrected, moved or gone since the last run; the journal gets the
        months before the fact changes."""
        path, key, ts = self.path(FACT), ["order_id"], "order_timestamp"
        days = self._changed_days("orders", s_orders, F.col(ts).cast("date"))
        hashed = s_orders.withColumn(changes.ROW_HASH, changes.row_hash(s_orders.columns))
        plan = lambda months: journal.plan(self._order_plan(months))
        self._schemas[FACT] = self._fact(hashed, s_products).schema
        with self._step(FACT):
            if days is None or not table_exists(self.spark, path):
                plan(None)
                replace_table(self._fact(latest_per_key(hashed, key, [ts]), s_products), path, ["order_month"])
            elif days:
                held = self.spark.read.parquet(path).filter(one_of("order_month", sorted({d and d.replace(day=1) for d in days}, key=str)))
                changed, current = changes.source_changes(hashed, held, self._on_days(ts, days), key, ts)
                upsert_table(self.spark, path, self._fact(current, s_products), key, "order_month", keys_fixed_to_partition=False,
                             dedupe=False, replaced=changed, before_swap=plan)
        self._keep_ledger("orders")

    def _order_marts(self, journal: Journal, s_products: DataFrame) -> None:
        """Rebuild the marts of the fact, as far as the journal asks."""
        dim_emp = self.gold("dim_employees_gold")

        def fact(months):
            rows = self._read(FACT)
            return (rows if months is None else rows.filter(one_of("order_month", months))).drop("order_month", changes.ROW_HASH)

        def orders(months):
            return fact(months).select("order_timestamp", "product_id", "quantity", F.col("addon_revenue").alias("service_price"))

        makers = {
            "mart_monthly_product_sales": lambda m: gold.mart_monthly_product_sales(orders(m), s_products),
            "review_totals": lambda m: gold.review_totals(fact(m)),
            "mart_city_sales": lambda m: gold.mart_city_sales(fact(m), s_products),
            "mart_product_reviews": lambda m: gold.mart_product_reviews(fact(m), s_products),
            "mart_employee_addon_performance": lambda m: gold.mart_employee_addon_performance(fact(m), dim_emp),
            "dim_date": lambda _: gold.dim_date_span(fact(None), "order_timestamp"),
        }
        self._rebuild(journal, makers)

    # -- traffic ---------------------------------------------------------------
    def _traffic_marts(self, journal: Journal, s_traffic: DataFrame, s_products: DataFrame) -> None:
        """Rebuild the days and months of the traffic marts that the journal asks for."""
        def of(periods, unit):
            if periods is None:
                return s_traffic
            stamp = F.col("event_timestamp").cast("date")
            return (self._between(s_traffic, periods, unit)
                    .withColumn("_period", stamp if unit == "day" else F.trunc(stamp, "MM"))
                    .filter(one_of("_period", periods)).drop("_period", "_day"))

        self._rebuild(journal, {
            HOURLY: lambda days: gold.mart_hourly_traffic_conversion(of(days, "day")),
            FUNNEL: lambda months: gold.mart_traffic_conversion_by_product(of(months, "month"), s_products)})

    @staticmethod
    def _on_days(ts_col: str, days: list) -> Column:
        """A time lies on one of the days (NULL among them: it has none); with plain bounds for the scan."""
        given = [d for d in days if d is not None]
        stamp, found = F.col(ts_col), F.lit(False)
        if given:
            low, high = F.lit(min(given)).cast("timestamp_ntz"), F.date_add(F.lit(max(given)), 1).cast("timestamp_ntz")
            found = (stamp >= low) & (stamp < high) & stamp.cast("date").isin(*given)
        return found | stamp.isNull() if None in days else found

    @staticmethod
    def _between(df: DataFrame, periods: list, unit: str) -> DataFrame:
        """Rows from the first to the last of the periods (first days), by plain bounds on the time that
        a scan can use; rows without a time only if asked for."""
        stamp = F.col("event_timestamp")
        given = [p for p in periods if p is not None]
        keep = F.lit(False)
        if given:
            low = F.lit(min(given)).cast("timestamp_ntz")
            high = F.add_months(F.lit(max(given)), 1) if unit == "month" else F.date_add(F.lit(max(given)), 1)
            keep = (stamp >= low) & (stamp < high.cast("timestamp_ntz"))
        if None in periods:
            keep = keep | stamp.isNull()
        return df.filter(keep).withColumn("_day", stamp.cast("date"))

    # -- outputs ---------------------------------------------------------------
    def _outputs(self, journal: Journal) -> None:
        """The ML outputs whose marts have changed; the data's own newest period stands for the time of the run."""
        def newest(mart, column):
            return self.gold(mart).agg(F.max(column)).scalar()

        def flags(_):
            series = ml.anomaly_inputs(self.gold(FUNNEL), self.gold("mart_employee_addon_performance"))
            return ml.anomaly_flags(series, generated_at=newest("mart_monthly_product_sales", "sales_month").cast("timestamp_ntz"))

        def revenue(_):
            as_of = newest("mart_monthly_product_sales", "sales_month")
            return ml.revenue_forecast(self.gold("mart_monthly_product_sales"), as_of, generated_at=as_of.cast("timestamp_ntz"))

        def visits(_):
            as_of = newest(HOURLY, "event_date")
            return ml.traffic_forecast(self.gold(HOURLY), as_of, generated_at=as_of.cast("timestamp_ntz"))

        self._rebuild(journal, {"ml_anomaly_flags": flags, "ml_revenue_forecast": revenue, "ml_traffic_prediction": visits})

    # -- runs ------------------------------------------------------------------
    @staticmethod
    def _table(raw, name: str) -> DataFrame:
        return raw.table(name) if hasattr(raw, "table") else getattr(raw, name)

    def rebuild_months(self, raw, months: list) -> None:
        """Recompute the fact and every mart for ``months`` (first days, None for orders without a
        time) from the raw tables and replace exactly those partitions; a month without rows loses
        its partition. The repair path for damaged tables; a run finds changes of the source itself."""
        s_products = silver.stg_products(self._table(raw, "raw_products"))
        s_orders = silver.stg_orders(self._table(raw, "raw_orders"))
        s_traffic = silver.stg_traffic(self._table(raw, "raw_traffic"))
        hashed = latest_per_key(s_orders.withColumn(changes.ROW_HASH, changes.row_hash(s_orders.columns)), ["order_id"], ["order_timestamp"])
        of_months = self._between(s_traffic, months, "month")
        stored = self._read(HOURLY).select(F.col("event_date").alias("_day"))
        days = distinct_values(of_months.select("_day").union(stored).withColumn("_month", F.trunc("_day", "MM"))
                               .filter(one_of("_month", months)), "_day")
        journal = self._journal()
        journal.plan({**self._order_plan(months), HOURLY: days, FUNNEL: months, **{t: None for t in TRAFFIC_OUTPUTS}})
        self._put(FACT, self._fact(hashed, s_products).filter(one_of("order_month", months)), months)
        self._order_marts(journal, s_products)
        self._put("dim_products_gold", gold.dim_products_from_totals(s_products, self.gold("review_totals")))
        self._traffic_marts(journal, s_traffic, s_products)
        self._outputs(journal)

    def _journal(self) -> Journal:
        return Journal(self.spark, f"{self.root}/_journal")

    def run(self, raw) -> dict[str, str]:
        """``raw`` exposes ``raw_products raw_employees raw_payroll raw_orders
        raw_traffic`` DataFrames (e.g. ``RawTables`` or ``SourceCatalog``)."""
        s_products = silver.stg_products(self._table(raw, "raw_products"))
        s_employees = silver.stg_employees(self._table(raw, "raw_employees"))
        s_payroll = silver.stg_payroll(self._table(raw, "raw_payroll"))
        s_orders = silver.stg_orders(self._table(raw, "raw_orders"))
        s_traffic = silver.stg_traffic(self._table(raw, "raw_traffic"))
        for n, df in [("stg_products", s_products), ("stg_employees", s_employees), ("stg_payroll", s_payroll),
                      ("stg_orders", s_orders), ("stg_traffic", s_traffic)]:
            df.createOrReplaceTempView(n)

        # Dimensions that are replaced whole on every run.
        self.timings = {}
        journal = self._journal()
        self._put("dim_employees_gold", gold.dim_employees_gold(s_employees))
        self._put("dim_payroll_gold", gold.dim_payroll_gold(s_payroll))

        self._load_fact(journal, s_orders, s_products)
        self._order_marts(journal, s_products)
        self._put("dim_products_gold", gold.dim_products_from_totals(s_products, self.gold("review_totals")))

        days = self._changed_days("traffic", s_traffic, F.col("event_timestamp").cast("date"))
        if days is None or days:
            months = None if days is None else sorted({d and d.replace(day=1) for d in days}, key=str)
            journal.plan({HOURLY: days, FUNNEL: months, **{t: None for t in TRAFFIC_OUTPUTS}})
        self._keep_ledger("traffic")
        self._traffic_marts(journal, s_traffic, s_products)

        self._outputs(journal)
        return {n: self.path(n) for n in [*SPECS, *UNSPECIFIED]}

    def publish(self) -> list[str]:
        """Make the stored tables catalog tables of the ``gold`` database."""
        return [publish(self.spark, self.path(n), "gold", n) for n in [*SPECS, *UNSPECIFIED] if table_exists(self.spark, self.path(n))]
