"""Registry of named queries (Spark) and their DuckDB oracles.

Every query takes ``(spark, sf_dir)``, reads whole driver tables through
the adapter views and returns a DataFrame; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakemart.functions.exprs import trunc_ts
from lakemart.operators import gold
from lakemart.operators import intervals as IV
from lakemart.operators import hr as H
from lakemart.operators import ml as ML
from lakemart.operators import orders as OR
from lakemart.operators import quality as Q
from lakemart.operators import reports as RP
from lakemart.operators import seasonal as SE
from lakemart.plans import oracle as O
from lakemart.plans import runs as R
from lakemart.plans.models import Models
from lakemart.plans.pipeline import Pipeline
from lakemart.sources.files import FLOAT_IDS, read_csv
from lakemart.sources.fixtures import RawTables
from lakemart.sources.sinks import write_csv
from lakemart.streaming import hourly as ST
from lakemart.streaming import stateful as SF

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _model(name: str, traffic: str = "raw_traffic_hist") -> QueryFn:
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Models(spark, sf_dir, traffic=traffic).get(name)
    fn.__name__ = name
    return fn


# -- silver ------------------------------------------------------------------
for _name in ("stg_products", "stg_employees", "stg_payroll", "stg_orders"):
    register(_name, O.model_sql(_name))(_model(_name))
register("stg_traffic", O.model_sql("stg_traffic_events"))(_model("stg_traffic", traffic="raw_traffic"))

# -- gold --------------------------------------------------------------------
register("dim_date", O.with_models("SELECT * FROM dim_date_span"))(_model("dim_date"))
for _name in ("dim_employees_gold", "dim_payroll_gold", "fact_orders_gold", "dim_products_gold",
              "mart_monthly_product_sales", "mart_traffic_conversion_by_product",
              "mart_city_sales", "mart_product_reviews", "mart_employee_addon_performance"):
    register(_name, O.model_sql(_name))(_model(_name))
register("mart_hourly_traffic_conversion", O.model_sql("mart_hourly_traffic_conversion"))(
    _model("mart_hourly_traffic_conversion", traffic="raw_traffic"))


# -- incremental runs ----------------------------------------------------------

register("inc_fact_append", O.model_sql("fact_orders_gold"))(R.inc_fact_append)
register("inc_hourly_merge", O.model_sql("mart_hourly_traffic_conversion"))(R.inc_hourly_merge)
register("inc_monthly_merge", O.model_sql("mart_monthly_product_sales"))(R.inc_monthly_merge)
register("inc_city_merge", O.model_sql("mart_city_sales"))(R.inc_city_merge)
register("inc_traffic_product_merge", O.model_sql("mart_traffic_conversion_by_product"))(R.inc_traffic_product_merge)
register("inc_addon_merge", O.model_sql("mart_employee_addon_performance"))(R.inc_addon_merge)
register("inc_reviews_merge", O.model_sql("mart_product_reviews"))(R.inc_reviews_merge)
register("inc_strict_reviews", O.with_models(O.STRICT_REVIEWS_SQL, O.STRICT_REVIEWS_CTES))(R.inc_strict_reviews)
register("inc_dim_date", O.with_models("SELECT * FROM dim_date_span"))(R.inc_dim_date)
register("inc_id_watermark", O.with_models(O.INC_ID_SQL))(R.inc_id_watermark)
register("inc_next_period", O.with_models(O.NEXT_PERIOD_SQL))(R.inc_next_period)

# -- HR and order operators ----------------------------------------------------


@register("payroll_expand", O.with_models(O.PAYROLL_EXPAND_SQL))
def payroll_expand(spark, sf_dir):
    m = Models(spark, sf_dir)
    as_of = H.last_activity_month(m.stg_orders)
    return H.payroll_expand(m.stg_employees, H.first_hire_month(m.stg_employees), as_of, as_of)


@register("age_at_hire", O.with_models(O.AGE_SQL))
def age_at_hire(spark, sf_dir):
    m = Models(spark, sf_dir)
    as_of = H.last_activity_month(m.stg_orders)
    return H.with_age_at_hire(m.stg_employees, as_of).select(
        "employee_id", "hire_date", "current_age", "age_at_hire")


@register("order_candidates", O.with_models(O.ORDER_CANDIDATES_SQL))
def order_candidates(spark, sf_dir):
    m = Models(spark, sf_dir, traffic="raw_traffic")
    return OR.order_candidates(m.raw.raw_traffic, None)


@register("active_staff_per_order", O.with_models(O.ACTIVE_STAFF_SQL))
def active_staff_per_order(spark, sf_dir):
    m = Models(spark, sf_dir)
    return OR.active_staff_per_order(m.stg_orders, m.stg_employees)


def _staff_instants(m: Models) -> DataFrame:
    """Employment that begins and ends within a day, at seconds that the employee's number gives."""
    at = lambda day, k: (F.col(day).cast("timestamp_ntz") + F.make_dt_interval(
        secs=((F.col("employee_id") * k) % 86400).cast("decimal(18,6)")))
    return m.stg_employees.select("employee_id", at("hire_date", 3607).alias("hire_at"), at("exit_date", 7919).alias("exit_at"))


@register("order_rosters", O.with_models(f"SELECT * FROM ({O.ORDER_ROSTERS_SQL.strip()})"))
def order_rosters(spark, sf_dir):
    """Roster class, active staff and the sum of their ids for every order, at its instant."""
    m = Models(spark, sf_dir)
    return IV.rosters_of_orders(m.stg_orders, _staff_instants(m), start="hire_at", end="exit_at")


@register("staff_of_last_orders", O.with_models(f"SELECT * FROM ({O.STAFF_OF_LAST_ORDERS_SQL.strip()})"))
def staff_of_last_orders(spark, sf_dir):
    """The staff list of the last order of each month."""
    m = Models(spark, sf_dir)
    last = (m.stg_orders.filter("order_timestamp IS NOT NULL").groupBy(F.trunc("order_timestamp", "MM").alias("month"))
            .agg(F.max(F.struct("order_timestamp", "order_id")).alias("o")).select("o.order_id", "o.order_timestamp"))
    return IV.staff_at(last, _staff_instants(m), start="hire_at", end="exit_at")


@register("addon_eligibility", O.with_models(O.ADDON_SQL))
def addon_eligibility(spark, sf_dir):
    m = Models(spark, sf_dir)
    return OR.addon_eligibility(m.fact_orders_gold, m.stg_products, m.stg_employees)


# -- ML --------------------------------------------------------------------------

@register("anomaly_flags", O.with_models(f"SELECT * FROM ({O.ANOMALY_SQL.strip()})"))
def anomaly_flags(spark, sf_dir):
    m = Models(spark, sf_dir)
    series = ML.anomaly_inputs(m.mart_traffic_conversion_by_product, m.mart_employee_addon_performance)
    return ML.anomaly_flags(series)


@register("revenue_forecast", O.with_models(f"SELECT * FROM ({O.REVENUE_FORECAST_SQL.strip()})"))
def revenue_forecast(spark, sf_dir):
    m = Models(spark, sf_dir)
    sales = m.mart_monthly_product_sales
    as_of = sales.agg(F.max("sales_month")).scalar()
    return ML.revenue_forecast(sales, as_of)


@register("traffic_forecast", O.with_models(f"SELECT * FROM ({O.TRAFFIC_FORECAST_SQL.strip()})"))
def traffic_forecast(spark, sf_dir):
    hourly = Models(spark, sf_dir, traffic="raw_traffic_hist").mart_hourly_traffic_conversion
    as_of = hourly.agg(F.max("event_date")).scalar()
    return ML.traffic_forecast(hourly, as_of)


@register("seasonal_revenue_forecast", O.with_recursive(O.SEASONAL_REVENUE_SQL, O.SEASONAL_REVENUE_CTES))
def seasonal_revenue_forecast(spark, sf_dir):
    """Trend with changepoints and yearly Fourier terms for each category."""
    sales = Models(spark, sf_dir).mart_monthly_product_sales
    as_of = sales.agg(F.max("sales_month")).scalar()
    return SE.revenue_forecast(ML.category_month_revenue(sales), as_of)


@register("seasonal_traffic_forecast", O.with_recursive(O.SEASONAL_TRAFFIC_SQL, O.SEASONAL_TRAFFIC_CTES))
def seasonal_traffic_forecast(spark, sf_dir):
    """Trend with changepoints, yearly and weekly Fourier terms over daily visits."""
    hourly = Models(spark, sf_dir, traffic="raw_traffic_hist").mart_hourly_traffic_conversion
    as_of = hourly.agg(F.max("event_date")).scalar()
    return SE.traffic_forecast(ML.daily_visits(hourly), as_of)


@register("hour_weekday_ridge", O.with_models(f"SELECT * FROM ({O.RIDGE_SQL.strip()})"))
def hour_weekday_ridge(spark, sf_dir):
    return ML.hour_weekday_ridge(Models(spark, sf_dir, traffic="raw_traffic").mart_hourly_traffic_conversion)


@register("daily_visits", O.with_models(O.DAILY_VISITS_SQL))
def daily_visits(spark, sf_dir):
    return ML.daily_visits(Models(spark, sf_dir, traffic="raw_traffic_hist").mart_hourly_traffic_conversion)


@register("category_month_revenue", O.with_models(O.CATEGORY_MONTH_REVENUE_SQL))
def category_month_revenue(spark, sf_dir):
    return ML.category_month_revenue(Models(spark, sf_dir).mart_monthly_product_sales)


# -- reports -------------------------------------------------------------------

@register("rpt_city_kpi", O.with_models(O.RPT_CITY_KPI_SQL))
def rpt_city_kpi(spark, sf_dir):
    return RP.city_kpi(Models(spark, sf_dir).mart_city_sales)


@register("rpt_mom_yoy", O.with_models(f"SELECT * FROM ({O.RPT_MOM_YOY_SQL.strip()})"))
def rpt_mom_yoy(spark, sf_dir):
    return RP.mom_yoy(Models(spark, sf_dir).mart_city_sales)


@register("rpt_category_margin", O.with_models(O.RPT_CATEGORY_MARGIN_SQL))
def rpt_category_margin(spark, sf_dir):
    m = Models(spark, sf_dir)
    return RP.category_margin(m.mart_monthly_product_sales, m.dim_products_gold)


@register("rpt_funnel", O.with_models(O.RPT_FUNNEL_SQL))
def rpt_funnel(spark, sf_dir):
    return RP.funnel(Models(spark, sf_dir).mart_traffic_conversion_by_product)


@register("rpt_review_distribution", O.with_models(O.RPT_REVIEW_DIST_SQL))
def rpt_review_distribution(spark, sf_dir):
    return RP.review_distribution(Models(spark, sf_dir).fact_orders_gold)


# -- the stored pipeline -------------------------------------------------------

def _stored(name: str, runs: Callable[[SparkSession, str], Pipeline] = R.stored_pipeline) -> QueryFn:
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return runs(spark, sf_dir).gold(name)
    fn.__name__ = f"{runs.__name__}_{name}"
    return fn


for _name in ("fact_orders_gold", "dim_products_gold", "dim_employees_gold", "dim_payroll_gold", "dim_date",
              "mart_monthly_product_sales", "mart_hourly_traffic_conversion", "mart_traffic_conversion_by_product",
              "mart_city_sales", "mart_product_reviews", "mart_employee_addon_performance"):
    register(f"pipeline_late_{_name}", O.with_models(f"SELECT * FROM {O.STORED_AS.get(_name, _name)}"))(_stored(_name))
register("pipeline_late_ml_revenue_forecast", O.with_models(f"SELECT * FROM ({O.STORED_REVENUE_SQL.strip()})"))(
    _stored("ml_revenue_forecast"))


# Warehouses whose runs broke off, and whose source was corrected: they must equal a full run too.
for _name in ("fact_orders_gold", "dim_products_gold", "dim_date", "mart_monthly_product_sales", "mart_hourly_traffic_conversion",
              "mart_traffic_conversion_by_product", "mart_city_sales", "mart_product_reviews", "mart_employee_addon_performance"):
    for _kind, _runs in (("crash", R.crashed_pipeline), ("corrected", R.corrected_pipeline)):
        register(f"pipeline_{_kind}_{_name}", O.with_models(f"SELECT * FROM {O.STORED_AS.get(_name, _name)}"))(_stored(_name, _runs))


register("upsert_stored_orders", O.with_models(O.UPSERT_SQL))(R.upsert_stored)
register("append_load_orders", O.with_models("SELECT * FROM raw_orders"))(R.append_load_orders)


# -- data quality --------------------------------------------------------------

def _dq_tables(spark, sf_dir):
    stored = R.stored_pipeline(spark, sf_dir)
    return {t: (stored.gold(t), k) for t, k in Q.KEYS.items()}


@register("dq_unique_keys", O.with_models(O.dq_unique_sql()))
def dq_unique_keys(spark, sf_dir):
    return Q.run_checks(Q.unique_key_check, _dq_tables(spark, sf_dir))


@register("dq_not_null", O.with_models(O.dq_not_null_sql()))
def dq_not_null(spark, sf_dir):
    return Q.run_checks(Q.not_null_check, _dq_tables(spark, sf_dir))


# -- streaming -------------------------------------------------------------------

def _deliver(df: DataFrame, folder: str, parts: list, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """The rows of ``df`` as a file stream: the parts (conditions) arrive one after another. The query is
    restarted for each and takes all its files in one micro-batch: a batch rewrites the periods that it
    touches, so batches that grow in number with the files would rewrite the table once for each."""
    for i, part in enumerate(parts):
        df.filter(part).write.parquet(f"{folder}/{i}")
        start(df.sparkSession.readStream.schema(df.schema).option("recursiveFileLookup", True).parquet(folder)).awaitTermination()


@register("stream_hourly_traffic", O.model_sql("mart_hourly_traffic_conversion"))
def stream_hourly_traffic(spark, sf_dir):
    """Exact hourly mart built by Structured Streaming (availableNow) over the
    events in several micro-batches, the last of them late; must equal the batch mart."""
    root = R.scratch(spark, "stream")
    early, late = F.col("event_time") <= F.lit(R.TRAFFIC_CUT).cast("timestamp_ntz"), F.substring("traffic_id", -1, 1) == "7"
    _deliver(RawTables(spark, sf_dir).raw_traffic, f"{root}/in", [early & ~late, ~early & ~late, late],
             lambda src: ST.hourly_mart_stream(spark, src, f"{root}/silver", f"{root}/mart", f"{root}/_checkpoint"))
    return ST.read_hourly_mart(spark, f"{root}/mart")


def stateful_runs(traffic: DataFrame, root: str) -> None:
    """The stateful hourly stream over four deliveries, restarted for each: rows up to the cut, newer
    ones, rows that were held back, and one far in the future that closes all hours."""
    spark = traffic.sparkSession
    early, held = F.col("event_time") <= F.lit(R.TRAFFIC_CUT).cast("timestamp_ntz"), F.substring("traffic_id", -1, 1) == "7"
    last = traffic.agg((F.max("event_time") + F.expr("INTERVAL 10 DAYS")).alias("event_time"))
    end = last.select(*(F.col(f.name) if f.name == "event_time" else F.lit(None).cast(f.dataType).alias(f.name) for f in traffic.schema))
    for k, rows in enumerate((traffic.filter(early & ~held), traffic.filter(~early & ~held), traffic.filter(held), end)):
        rows.write.parquet(f"{root}/in/{k}")
        src = spark.readStream.schema(traffic.schema).option("recursiveFileLookup", True).parquet(f"{root}/in")
        SF.stateful_hourly_stream(spark, src, f"{root}/hours", f"{root}/late", f"{root}/_checkpoint").awaitTermination()


@register("stream_stateful_hourly", O.with_models(f"SELECT * FROM ({O.STATEFUL_HOURLY_SQL.strip()})"))
def stream_stateful_hourly(spark, sf_dir):
    """Hours closed by event-time timers over four restarted runs, and the number of rows that came
    after their hour was closed and left by the side output."""
    root = R.scratch(spark, "stateful")
    stateful_runs(RawTables(spark, sf_dir).raw_traffic, root)
    late = SF.read_late(spark, f"{root}/late").groupBy(trunc_ts("hour", "event_time").alias("event_hour")).agg(F.count("*").alias("late_rows"))
    return SF.read_hours(spark, f"{root}/hours").join(late, "event_hour", "full").select(
        "event_hour", "total_visits", "total_carts", "total_orders", F.coalesce("late_rows", F.lit(0)).alias("late_rows"))


# -- CSV landing round trip (sources) ----------------------------------------------


def _landed(spark, sf_dir, table):
    """Write a raw table the way the landing files carry it (nullable ids as
    floats, timestamps as text, 'None' as a literal) and read it back."""
    raw = getattr(RawTables(spark, sf_dir), table)
    for c in FLOAT_IDS.get(table, ()):
        raw = raw.withColumn(c, F.col(c).cast("double"))
    path = f"{R.scratch(spark, 'landing')}/{table}"
    write_csv(raw, path, mode="overwrite", timestamp_format="yyyy-MM-dd HH:mm:ss.SSSSSS")
    return read_csv(spark, path, table)


@register("csv_landing_orders", O.with_models("SELECT * FROM raw_orders"))
def csv_landing_orders(spark, sf_dir):
    return _landed(spark, sf_dir, "raw_orders")


@register("csv_landing_traffic", O.with_models("SELECT * FROM raw_traffic"))
def csv_landing_traffic(spark, sf_dir):
    return _landed(spark, sf_dir, "raw_traffic")


@register("csv_landing_mixed_dates", O.with_models("SELECT * FROM raw_orders"))
def csv_landing_mixed_dates(spark, sf_dir):
    """Landing files whose dates come in several spellings, with fractions and zone offsets."""
    ts, n = F.col("order_date"), F.col("order_id") % 5
    text = (F.when(n == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"))
            .when(n == 1, F.concat(F.date_format(ts + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd HH:mm:ss"), F.lit("+02:00")))
            .when(n == 2, F.date_format(ts, "d.M.yyyy H:mm:ss"))
            .when(n == 3, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
            .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")))
    raw = RawTables(spark, sf_dir).raw_orders.withColumn("order_date", text)
    path = f"{R.scratch(spark, 'landing')}/raw_orders"
    write_csv(raw, path, mode="overwrite")
    return read_csv(spark, path, "raw_orders")


@register("stream_fact_orders", O.model_sql("fact_orders_gold"))
def stream_fact_orders(spark, sf_dir):
    """Order fact loaded by Structured Streaming (availableNow) in several micro-batches, the last of
    them late, with a per-batch upsert by order_id into month partitions; must equal the batch fact."""
    root, m = R.scratch(spark, "stream"), Models(spark, sf_dir)
    early = R._before("order_date", R.ORDERS_CUT)
    _deliver(m.raw.raw_orders, f"{root}/in", [early & ~R.late_order(), ~early & ~R.late_order(), R.late_order()],
             lambda src: ST.fact_upsert_stream(src, f"{root}/fact", m.stg_products, f"{root}/_checkpoint"))
    return spark.read.parquet(f"{root}/fact").drop("order_month")


@register("quarantine_late_orders", O.with_models(f"SELECT * FROM ({O.QUARANTINE_SQL.strip()})"))
def quarantine_late_orders(spark, sf_dir):
    """Orders that arrive at or below the stored fact's high watermark, or without a time, and that the
    fact does not hold go to a quarantine table instead of vanishing; the batch is delivered twice."""
    root, m = R.scratch(spark, "quarantine"), Models(spark, sf_dir)
    loaded = m.stg_orders.filter(R._before("order_timestamp", R.ORDERS_CUT) & ~R.late_order())
    gold.fact_orders_gold(loaded, m.stg_products).write.parquet(f"{root}/fact")
    for _ in range(2):
        ST.quarantine_late_rows(spark, m.stg_orders, f"{root}/fact", "order_timestamp", ["order_id"], f"{root}/quarantine", 1)
    return spark.read.parquet(f"{root}/quarantine").drop("batch_id")


@register("dim_products_gold_via_totals", O.model_sql("dim_products_gold"))
def dim_products_gold_via_totals(spark, sf_dir):
    """The product dimension as the pipeline refreshes it: from per-month review totals."""
    m = Models(spark, sf_dir)
    return gold.dim_products_from_totals(m.stg_products, gold.review_totals(m.fact_orders_gold))
