"""Physical-plan properties every registered query must keep (scale guards)."""

import contextlib
import io

import pytest

from conftest import SF001
from lakemart.operators import gold
from lakemart.plans.catalog import QUERIES
from lakemart.plans.models import Models

# Queries whose construction runs a job with side effects (a stream, a CSV landing write).
SIDE_EFFECT_BUILDS = {"stream_hourly_traffic", "stream_stateful_hourly", "stream_fact_orders", "quarantine_late_orders",
                      "csv_landing_orders", "csv_landing_traffic", "csv_landing_mixed_dates", "append_load_orders",
                      "upsert_stored_orders", "dq_unique_keys", "dq_not_null",
                      *(n for n in QUERIES if n.startswith("pipeline_"))}

# Queries that solve one small matrix per series in Python; their rows are aggregated before.
SOLVED = {"seasonal_revenue_forecast", "seasonal_traffic_forecast"}

# Columns of the driver tables that no query needs: they must never be scanned.
NEVER_READ = ["l_extendedprice", "l_discount", "l_tax", "l_quantity", "o_totalprice", "o_orderstatus",
              "s_acctbal", "s_nationkey", "user_id", "props"]


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECT_BUILDS))
def test_plan_is_scale_safe(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    assert "CartesianProduct" not in plan, name
    assert "BroadcastNestedLoopJoin" not in plan, name  # no all-pairs joins
    for python_node in {"BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"} - ({"FlatMapGroupsInPandas"} if name in SOLVED else set()):
        assert python_node not in plan, (name, python_node)
    read_schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema:")]
    for col in NEVER_READ:
        assert not any(col in line for line in read_schemas), (name, col)


def _count(plan: str, node: str) -> int:
    return sum(line.strip().startswith(f"({i}) {node}") or f") {node}" in line for i, line in enumerate(plan.splitlines())
               if line.startswith("("))


# Upper bounds of scans and exchanges in the initial plans.
BOUNDS = {
    "mart_city_sales": {"Scan parquet": 4, "Exchange": 8},
    "anomaly_flags": {"Scan parquet": 8, "Exchange": 20},
    "traffic_forecast": {"Scan parquet": 2, "Exchange": 30},
}


@pytest.mark.parametrize("name", sorted(BOUNDS))
def test_plan_size_is_bounded(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    for node, most in BOUNDS[name].items():
        assert _count(plan, node) <= most, (name, node, _count(plan, node))


def test_a_delta_reads_only_new_files(spark, scratch):
    """A one-day delta over data in many months reads the files of the last month only."""
    import datetime as dt

    from pyspark.sql import functions as F

    from lakemart.operators.incremental import bucket_delta, high_watermark_delta

    days = spark.range(0, 400).select(F.date_add(F.lit(dt.date(2023, 1, 1)), F.col("id").cast("int")).alias("d"))
    rows = days.select(F.col("d").cast("timestamp_ntz").alias("ts"), F.trunc("d", "MM").alias("month"))
    rows.write.partitionBy("month").parquet(f"{scratch}/source")
    source = spark.read.parquet(f"{scratch}/source")
    stored = spark.createDataFrame([(dt.datetime(2024, 2, 2), dt.date(2024, 2, 1))], "ts timestamp_ntz, month date")
    for delta, n in ((high_watermark_delta(source, stored, "ts", date_col="month"), 2),
                     (bucket_delta(source, stored, "ts", "month", date_col="month"), 4)):
        assert delta.count() == n
        scan = delta._jdf.queryExecution().executedPlan()
        delta.collect()
        text = scan.toString()
        assert "PartitionFilters" in text and "month" in text.split("PartitionFilters")[1].split("]")[0], text
        files = {r[0].rsplit("/", 2)[1] for r in delta.select(F.input_file_name()).collect()}
        assert files == {"month=2024-02-01"}


def test_marts_aggregate_before_joining_products(spark):
    """Monthly sales: the partial aggregate sits below the join with products."""
    plan = _plan(QUERIES["mart_monthly_product_sales"](spark, SF001))
    tree = plan.split("\n\n")[0]
    join_at = min(i for i, line in enumerate(tree.splitlines()) if "Join" in line)
    agg_at = [i for i, line in enumerate(tree.splitlines()) if "HashAggregate" in line]
    assert agg_at and max(agg_at) > join_at  # aggregates are children (lower) of the join


def test_no_growing_side_of_a_join_is_broadcast(spark, scratch):
    """Dimensions and key lists grow with the input: their joins pass nothing through the driver."""
    from lakemart.operators import changes
    from lakemart.sources import sinks

    m = Models(spark, SF001)
    keys = m.stg_orders.select("order_id").limit(5)
    frames = [m.fact_orders_gold, m.dim_products_gold, m.mart_monthly_product_sales, m.mart_traffic_conversion_by_product, m.mart_city_sales,
              m.mart_product_reviews, m.mart_employee_addon_performance,
              gold.dim_products_from_totals(m.stg_products, gold.review_totals(m.fact_orders_gold)),
              changes.rows_of_keys(m.stg_orders, keys, ["order_id"]), sinks._merged(m.stg_orders, m.stg_orders, keys, ["order_id"])]
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "Broadcast" not in plan


def test_revenue_forecast_broadcasts_no_table_by_category(spark):
    plan = QUERIES["revenue_forecast"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan
