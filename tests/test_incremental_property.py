"""For any cut point, first run + delta run (default rule) == full rebuild."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from lakemart.operators import gold
from lakemart.operators.incremental import bucket_delta, high_watermark_delta, upsert
from lakemart.plans.models import Models


def _rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def _upto(df, col, cut):
    return df.filter(F.col(col).isNull() | (F.col(col) <= F.lit(cut).cast("timestamp_ntz")))


cuts = st.datetimes(min_value=dt.datetime(1995, 2, 1), max_value=dt.datetime(2001, 7, 1)) \
    .map(lambda t: t.replace(microsecond=0))


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(cut=cuts)
def test_month_and_city_marts(spark, cut):
    m = Models(spark, SF001)
    o, p = m.stg_orders, m.stg_products
    first = gold.mart_monthly_product_sales(_upto(o, "order_timestamp", cut), p)
    merged = upsert(first, gold.mart_monthly_product_sales(
        bucket_delta(o, first, "order_timestamp", "sales_month"), p), ["month_prod_id"])
    assert _rows(merged) == _rows(m.mart_monthly_product_sales)

    fact = m.fact_orders_gold
    first_c = gold.mart_city_sales(_upto(fact, "order_timestamp", cut), p)
    merged_c = upsert(first_c, gold.mart_city_sales(
        bucket_delta(fact, first_c, "order_timestamp", "sales_day"), p), ["city", "sales_day"])
    assert _rows(merged_c) == _rows(m.mart_city_sales)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(cut=cuts)
def test_fact_append(spark, cut):
    m = Models(spark, SF001)
    first = gold.fact_orders_gold(_upto(m.stg_orders, "order_timestamp", cut), m.stg_products)
    delta = gold.fact_orders_gold(high_watermark_delta(m.stg_orders, first, "order_timestamp"), m.stg_products)
    assert _rows(upsert(first, delta, ["order_id"])) == _rows(m.fact_orders_gold)
