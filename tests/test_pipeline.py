"""Pipeline: a first run on history plus a delta run equals one full run."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from lakemart.plans.pipeline import SPECS, Pipeline
from lakemart.sources.fixtures import RawTables

CUTS = {"raw_orders": ("order_date", dt.datetime(1996, 3, 10, 7, 0, 0)),
        "raw_traffic": ("event_time", dt.datetime(2024, 1, 15, 12, 30, 0))}


class HistoryRaw:
    """Raw tables as they stood at ``cut`` (facts filtered, dimensions whole)."""

    def __init__(self, raw, cuts):
        self.raw, self.cuts = raw, cuts

    def __getattr__(self, name):
        df = getattr(self.raw, name)
        if name not in self.cuts:
            return df
        ts, cut = self.cuts[name]
        return df.filter(F.col(ts).isNull() | (F.col(ts) <= F.lit(cut).cast("timestamp_ntz")))


def _rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_delta_run_equals_full_run(spark, scratch):
    raw = RawTables(spark, SF001)
    inc = Pipeline(spark, f"{scratch}/inc")
    inc.run(HistoryRaw(raw, CUTS))
    inc.run(raw)
    inc.run(raw)  # re-running with no new data is a no-op
    full = Pipeline(spark, f"{scratch}/full")
    full.run(raw)
    for name in list(SPECS) + ["dim_products_gold", "ml_anomaly_flags", "ml_revenue_forecast"]:
        a, b = inc.gold(name), full.gold(name)
        assert a.count() == b.count(), name
        assert _rows(a) == _rows(b), name


def test_first_run_on_empty_traffic(spark, scratch):
    """No traffic yet: the hourly mart is empty but typed, and a later run fills it."""
    raw = RawTables(spark, SF001)
    p = Pipeline(spark, f"{scratch}/wh")
    p.run(HistoryRaw(raw, {"raw_traffic": ("event_time", dt.datetime(2000, 1, 1))}))
    assert p.gold("mart_hourly_traffic_conversion").count() == 0
    p.run(raw)
    assert p.gold("mart_hourly_traffic_conversion").count() > 0


def test_pipeline_from_csv_landing_equals_parquet_models(spark, scratch):
    """Raw tables landed as CSV (text dates, float ids) through SourceCatalog
    produce the same gold tables as the in-memory models."""
    from lakemart.plans.models import Models
    from lakemart.sources.files import FLOAT_IDS, SourceCatalog
    from lakemart.sources.sinks import write_csv

    raw = RawTables(spark, SF001)
    landing = f"{scratch}/landing"
    for name in ("raw_products", "raw_employees", "raw_payroll", "raw_orders", "raw_traffic"):
        df = getattr(raw, name)
        for c in FLOAT_IDS.get(name, ()):
            df = df.withColumn(c, F.col(c).cast("double"))
        write_csv(df, f"{landing}/{name}", mode="overwrite", timestamp_format="yyyy-MM-dd HH:mm:ss.SSSSSS")
    p = Pipeline(spark, f"{scratch}/wh")
    p.run(SourceCatalog(spark, landing, fmt="csv"))
    m = Models(spark, SF001, traffic="raw_traffic")
    for name in ("fact_orders_gold", "mart_city_sales", "mart_hourly_traffic_conversion",
                 "mart_employee_addon_performance", "dim_products_gold"):
        assert _rows(p.gold(name)) == _rows(m.get(name)), name


def test_rebuild_months_repairs_damaged_partitions(spark, scratch):
    from lakemart.operators import gold, silver
    from lakemart.sources.sinks import write_table

    raw = RawTables(spark, SF001)
    p = Pipeline(spark, f"{scratch}/wh")
    p.run(raw)
    names = ["mart_monthly_product_sales", "mart_city_sales", "mart_product_reviews", "dim_products_gold"]
    before = {n: _rows(p.gold(n)) for n in names}
    month = dt.date(1997, 5, 1)
    # Damage one stored month of the monthly mart, as a stale correction would.
    orders = silver.stg_orders(raw.raw_orders).filter(F.trunc("order_timestamp", "MM") == F.lit(month))
    damaged = gold.mart_monthly_product_sales(orders, silver.stg_products(raw.raw_products)) \
        .withColumn("total_qty", F.lit(0).cast("bigint"))
    write_table(damaged, p.path("mart_monthly_product_sales"), "overwrite", ["sales_month"], dynamic=True)
    assert _rows(p.gold("mart_monthly_product_sales")) != before["mart_monthly_product_sales"]
    p.rebuild_months(raw, [month])
    for n in names:
        assert _rows(p.gold(n)) == before[n], n


class _TinyRaw:
    def __init__(self, spark, orders):
        from lakemart import schemas as S
        T = dt.datetime
        self.raw_products = spark.createDataFrame([(1, "p", "c", "s", "b", 1000, 600)], S.RAW_PRODUCTS)
        self.raw_employees = spark.createDataFrame([(5, "e", "F", 30, dt.date(2020, 1, 1), None)], S.RAW_EMPLOYEES)
        self.raw_payroll = spark.createDataFrame([(5, 30000, dt.date(2024, 1, 1))], S.RAW_PAYROLL)
        self.raw_orders = spark.createDataFrame(orders, S.RAW_ORDERS)
        self.raw_traffic = spark.createDataFrame([(T(2024, 3, 1, 9), "T-1", "yes", 1, None)], S.RAW_TRAFFIC)


T = dt.datetime
EARLY = [(1, 1, 1, "None", 0, 5, T(2024, 2, 1, 0, 0, 0), "Brno", 5), (2, 1, 1, "None", 0, 5, T(2024, 3, 5, 10), "Brno", 3)]
LATE = [(3, 1, 1, "None", 0, 5, T(2024, 3, 2, 10), "Brno", 4),    # late within the month
        (4, 1, 1, "None", 0, 5, T(2024, 2, 20, 10), "Brno", 4),   # late, in the month before
        (5, 1, 1, "None", 0, 5, T(2024, 3, 5, 10), "Brno", 4),    # tied with the newest stored time
        (6, 1, 1, "None", 0, 5, None, None, 4)]                   # no time


def _agree(p, orders):
    """Fact and marts hold exactly these orders."""
    fact = p.gold("fact_orders_gold")
    assert sorted(r.order_id for r in fact.collect()) == sorted(o[0] for o in orders)
    month = lambda o: o[6] and o[6].date().replace(day=1)
    want = Counter(month(o) for o in orders)
    assert {r.review_month: r.review_count for r in p.gold("mart_product_reviews").collect()} == want
    assert {r.sales_month: r.total_qty for r in p.gold("mart_monthly_product_sales").collect()} == want
    assert Counter({r.performance_month: r.total_orders for r in p.gold("mart_employee_addon_performance").collect()}) == want
    city = Counter()
    for r in p.gold("mart_city_sales").collect():
        city[r.sales_month] += r.total_orders
    assert city == want


def test_late_tied_and_untimed_orders_reach_fact_and_marts(spark, scratch):
    p = Pipeline(spark, f"{scratch}/wh")
    p.run(_TinyRaw(spark, EARLY))
    _agree(p, EARLY)
    for _ in range(2):
        p.run(_TinyRaw(spark, EARLY + LATE))
        _agree(p, EARLY + LATE)
    moved = EARLY[:1] + [(2, 1, 1, "None", 0, 5, T(2024, 4, 1, 9), "Brno", 3)]  # a newer version in another month
    p.run(_TinyRaw(spark, moved + LATE))
    _agree(p, moved + LATE)


def test_rebuild_months_removes_what_the_source_no_longer_has(spark, scratch):
    p = Pipeline(spark, f"{scratch}/wh")
    p.run(_TinyRaw(spark, EARLY + LATE))
    rest = [o for o in EARLY + LATE if o[0] in (2, 3)]  # February and the order without a time are gone
    p.rebuild_months(_TinyRaw(spark, rest), [dt.date(2024, 2, 1), dt.date(2024, 3, 1), None])
    _agree(p, rest)


def test_late_traffic_is_noticed_and_ml_tables_are_dated(spark, scratch):
    raw = _TinyRaw(spark, EARLY)
    p = Pipeline(spark, f"{scratch}/wh")
    p.run(raw)
    from lakemart import schemas as S
    raw.raw_traffic = spark.createDataFrame([(T(2024, 3, 1, 9), "T-1", "yes", 1, None), (T(2024, 3, 1, 9), "T-2", "no", 1, 7),
                                             (T(2024, 2, 1, 8), "T-3", "no", 1, None)], S.RAW_TRAFFIC)
    p.run(raw)
    assert sorted((str(r.event_hour), r.total_visits) for r in p.gold("mart_hourly_traffic_conversion").collect()) == [
        ("2024-02-01 08:00:00", 1), ("2024-03-01 09:00:00", 2)]
    assert {str(r.traffic_month): r.total_views for r in p.gold("mart_traffic_conversion_by_product").collect()} == {
        "2024-02-01": 1, "2024-03-01": 2}
    for name in ("ml_anomaly_flags", "ml_revenue_forecast", "ml_traffic_prediction"):
        assert "generated_at" in p.gold(name).columns
    assert "gold.fact_orders_gold" in p.publish() and spark.table("gold.fact_orders_gold").count() == 2
