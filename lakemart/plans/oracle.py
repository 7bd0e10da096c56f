"""DuckDB SQL oracles for the registered queries.

Each oracle is plain SQL over the driver's pre-registered tables
(``part supplier orders lineitem events ...``). The adapter views and the
silver/gold models are inlined as CTEs and written the direct way (join,
then aggregate), independent of the Spark plans, which aggregate before
joining. Casts pin the result types to Spark's (``year()`` is INT, sums of
integers are BIGINT).
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Fixed values, written out here apart from the tables that the Spark side reads.
# --------------------------------------------------------------------------

# City number of the adapter, city, region.
CITIES = """
SELECT * FROM (VALUES
    (0, 'Praha', 'Praha'), (1, 'Brno', 'Jihomoravský'), (2, 'Ostrava', 'Moravskoslezský'), (3, 'Plzeň', 'Plzeňský'),
    (4, 'Liberec', 'Liberecký'), (5, 'Olomouc', 'Olomoucký'), (6, 'České Budějovice', 'Jihočeský'),
    (7, 'Hradec Králové', 'Královéhradecký'), (8, 'Pardubice', 'Pardubický'), (9, 'Ústí nad Labem', 'Ústecký'),
    (10, 'Havířov', 'Moravskoslezský'), (11, 'Zlín', 'Zlínský'), (12, 'Kladno', 'Středočeský'), (13, 'Most', 'Ústecký'),
    (14, 'Frýdek-Místek', 'Moravskoslezský'), (15, 'Opava', 'Moravskoslezský'), (16, 'Karviná', 'Moravskoslezský'),
    (17, 'Jihlava', 'Vysočina'), (18, 'Děčín', 'Ústecký'), (19, 'Teplice', 'Ústecký'), (20, 'Jinde', NULL)
) AS c(city_no, city, region)"""

# Gold tables and their keys.
KEYED_TABLES = {
    "fact_orders_gold": "order_id", "dim_products_gold": "product_id", "dim_employees_gold": "employee_id",
    "dim_date": "date_day", "mart_monthly_product_sales": "month_prod_id", "mart_hourly_traffic_conversion": "event_hour",
    "mart_traffic_conversion_by_product": "month_product_id", "mart_city_sales": "city_day_id",
    "mart_product_reviews": "month_prod_id", "mart_employee_addon_performance": "month_employee_id",
}

# --------------------------------------------------------------------------
# Adapter views
# --------------------------------------------------------------------------

ADAPTERS = {
    "raw_products": """
SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
       concat(p_type, '-', CAST(p_size % 3 AS string)) AS subcategory, p_brand AS brand,
       CAST(floor(p_retailprice) AS bigint) * (1 + p_partkey % 40) AS base_price,
       CAST(floor(p_retailprice) AS bigint) * (1 + p_partkey % 40) - 200 * (1 + p_partkey % 40) AS unit_cost
FROM part""",
    "raw_employees": """
SELECT k AS employee_id, s_name AS name, CASE WHEN k % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
       CAST(18 + (k * 7) % 45 AS int) AS current_age,
       DATE '1995-01-01' + CAST((k * 137) % 2000 AS int) AS hire_date,
       CASE WHEN k % 2 = 1 THEN DATE '1995-01-01'
            + CAST((k * 137) % 2000 + 180 + (k * 53) % 920 AS int) END AS exit_date
FROM (SELECT s_suppkey + 1 AS k, s_name FROM supplier)""",
    "raw_payroll": """
SELECT s_suppkey + 1 AS employee_id, 28000 + ((s_suppkey + 1) * 97) % 5000 AS monthly_salary, m.month_year
FROM supplier CROSS JOIN (VALUES (DATE '1999-01-01'), (DATE '1999-02-01'), (DATE '1999-03-01')) AS m(month_year)""",
    "raw_orders": """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderkey % 97 = 0 THEN 999999999 ELSE o_orderkey % (SELECT count(*) FROM part) END AS product_id,
       CAST(1 + o_orderkey % 2 AS int) AS quantity,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Warranty+1' WHEN '2-HIGH' THEN 'Insurance' ELSE 'None' END AS service_type,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 100 + (o_orderkey * 13) % 900
            WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 0 END AS service_price,
       CASE WHEN o_custkey % 20 < 11 THEN 0 ELSE 1 + o_custkey % (SELECT count(*) FROM supplier) END AS employee_id,
       CASE WHEN o_orderkey % 509 <> 0 THEN o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS int) END AS order_date,
       CASE WHEN o_orderkey % 211 <> 0 THEN c.city END AS city,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(1 + (o_orderkey * o_orderkey) % 5 AS int) END AS review
FROM orders JOIN cities c ON c.city_no = o_custkey % 21""",
    "raw_traffic": """
SELECT ts AS event_time, concat('T-', CAST(event_id - event_id % 3 AS string)) AS traffic_id,
       CASE WHEN event_type IN ('click', 'purchase') THEN 'yes' ELSE 'no' END AS item_in_cart,
       event_id % (SELECT count(*) FROM part) AS product_id,
       CASE WHEN event_type = 'purchase' THEN 800001 + event_id END AS order_id
FROM events""",
    "raw_traffic_hist": """
SELECT l_shipdate AS event_time, concat('T-', CAST(l_orderkey * 10 + l_linenumber AS string)) AS traffic_id,
       CASE WHEN l_returnflag <> 'N' THEN 'yes' ELSE 'no' END AS item_in_cart, l_partkey AS product_id,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_orderkey END AS order_id
FROM lineitem""",
}

# --------------------------------------------------------------------------
# Silver
# --------------------------------------------------------------------------
SILVER = {
    "stg_products": "SELECT product_id, name AS product_name, category, subcategory, brand, base_price, unit_cost FROM raw_products",
    "stg_employees": ("SELECT employee_id, name AS employee_name, gender, current_age, CAST(hire_date AS DATE) AS hire_date, "
                      "COALESCE(CAST(exit_date AS DATE), DATE '9999-12-31') AS exit_date FROM raw_employees"),
    "stg_payroll": "SELECT employee_id, monthly_salary, CAST(month_year AS DATE) AS payroll_month FROM raw_payroll",
    "stg_traffic": ("SELECT traffic_id, CAST(event_time AS TIMESTAMP) AS event_timestamp, item_in_cart, product_id, order_id "
                    "FROM raw_traffic_hist"),
    "stg_traffic_events": ("SELECT traffic_id, CAST(event_time AS TIMESTAMP) AS event_timestamp, item_in_cart, product_id, order_id "
                           "FROM raw_traffic"),
    "stg_orders": """
SELECT order_id, product_id, quantity,
       CASE WHEN service_type = 'None' THEN NULL ELSE service_type END AS service_type,
       COALESCE(service_price, 0) AS service_price, employee_id,
       CAST(order_date AS TIMESTAMP) AS order_timestamp, city, review
FROM raw_orders""",
}


def key_sql(period: str, ident: str) -> str:
    return f"md5(CAST(CAST({period} AS DATE) AS VARCHAR) || '|' || CAST({ident} AS VARCHAR))"


def fixed_sql(expr: str, digits: int) -> str:
    """ROUND on the 6-digit fixed-point value of ``expr``, as DOUBLE."""
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38, 6)), {digits}) AS DOUBLE)"


def pct_sql(num: str, den: str) -> str:
    return f"CAST(ROUND(CAST(({num}) / NULLIF({den}, 0) AS DECIMAL(38, 6)) * 100, 2) AS DOUBLE)"


# --------------------------------------------------------------------------
# Gold
# --------------------------------------------------------------------------

def hourly_sql(source: str) -> str:
    return f"""
WITH hours AS (
    SELECT date_trunc('hour', event_timestamp) AS event_hour, count(DISTINCT traffic_id) AS total_visits,
           count(*) FILTER (WHERE item_in_cart = 'yes') AS total_carts, count(DISTINCT order_id) AS total_orders
    FROM {source} GROUP BY event_hour)
SELECT event_hour, CAST(event_hour AS DATE) AS event_date, CAST(hour(event_hour) AS INTEGER) AS hour_of_day,
       total_visits, total_carts, total_orders
FROM hours"""


def reviews_sql(fact: str) -> str:
    return f"""
WITH months AS (
    SELECT CAST(date_trunc('month', order_timestamp) AS DATE) AS review_month, product_id,
           count(order_id) AS review_count, avg(review) AS mean_review, min(review) AS min_review, max(review) AS max_review,
           count(*) FILTER (WHERE review = 5) AS five_star_count, count(*) FILTER (WHERE review = 1) AS one_star_count,
           count(*) FILTER (WHERE review >= 4) AS good, CAST(sum(total_order_value) AS BIGINT) AS total_revenue
    FROM {fact} GROUP BY ALL),
shares AS (SELECT *, good / NULLIF(review_count, 0) AS share FROM months)
SELECT {key_sql("review_month", "s.product_id")} AS month_prod_id, review_month, s.product_id, product_name, category, subcategory,
       review_count, {fixed_sql("mean_review", 2)} AS avg_review, min_review, max_review, five_star_count, one_star_count,
       {fixed_sql("CASE WHEN mean_review >= 4 THEN share ELSE -share END", 4)} + 0.0 AS pct_positive, total_revenue
FROM shares s JOIN stg_products p ON p.product_id = s.product_id"""


def funnel_sql(source: str) -> str:
    return f"""
WITH funnel AS (
    SELECT CAST(date_trunc('month', event_timestamp) AS DATE) AS traffic_month, product_id,
           count(DISTINCT traffic_id) AS total_views, count(*) FILTER (WHERE item_in_cart = 'yes') AS total_carts,
           count(DISTINCT order_id) AS total_orders
    FROM {source} GROUP BY ALL)
SELECT {key_sql("traffic_month", "f.product_id")} AS month_product_id, traffic_month, f.product_id,
       product_name, category, subcategory, total_views, total_carts, total_orders,
       {pct_sql("total_carts", "total_views")} AS cart_rate_pct, {pct_sql("total_orders", "total_views")} AS conversion_rate_pct
FROM funnel f LEFT JOIN stg_products p ON p.product_id = f.product_id"""


GOLD = {
    "dim_employees_gold": "SELECT * FROM stg_employees",
    "dim_payroll_gold": "SELECT * FROM stg_payroll",
    "fact_orders_gold": """
WITH priced AS (SELECT o.*, p.base_price, o.quantity * p.base_price AS goods
                FROM stg_orders o LEFT JOIN stg_products p ON p.product_id = o.product_id)
SELECT order_id, order_timestamp, CAST(order_timestamp AS DATE) AS order_date, employee_id, product_id, quantity,
       base_price AS unit_price, goods AS product_revenue, service_price AS addon_revenue,
       goods + service_price AS total_order_value, service_type, city, review
FROM priced""",
    # Points and votes of each product, from its counted scores.
    "dim_products_gold": f"""
SELECT stg_products.*, CASE WHEN votes > 0 THEN {fixed_sql("points / votes", 2)} ELSE 0 END AS avg_review_score
FROM stg_products LEFT JOIN (
  SELECT product_id, SUM(review * n)::DOUBLE AS points, SUM(n) AS votes
  FROM (SELECT product_id, review, COUNT(*) AS n FROM fact_orders_gold GROUP BY product_id, review)
  WHERE review IS NOT NULL GROUP BY product_id) USING (product_id)""",
    # Price and cost are constants of a product: quantities are summed before they meet them.
    "mart_monthly_product_sales": f"""
SELECT {key_sql("sales_month", "product_id")} AS month_prod_id,
       sales_month, product_id, category, subcategory, product_name, CAST(units AS BIGINT) AS total_qty,
       CAST(units * base_price AS BIGINT) AS product_revenue, CAST(services AS BIGINT) AS addon_revenue,
       CAST(units * base_price + sold_services AS BIGINT) AS total_revenue,
       CAST(units * base_price - units * unit_cost AS BIGINT) AS product_margin
FROM (SELECT CAST(date_trunc('month', order_timestamp) AS DATE) AS sales_month, product_id, SUM(quantity) AS units,
             SUM(service_price) AS services, SUM(service_price) FILTER (quantity IS NOT NULL) AS sold_services
      FROM stg_orders GROUP BY ALL) JOIN stg_products USING (product_id)""",
    "mart_hourly_traffic_conversion": hourly_sql("stg_traffic_events"),
    "mart_hourly_traffic_hist": hourly_sql("stg_traffic"),
    "mart_traffic_conversion_by_product": funnel_sql("stg_traffic"),
    "mart_traffic_events_by_product": funnel_sql("stg_traffic_events"),
    "mart_city_sales": f"""
WITH sold AS (
    SELECT f.*, CAST(f.order_timestamp AS DATE) AS sales_day, f.quantity * (p.base_price - p.unit_cost) AS margin
    FROM fact_orders_gold f JOIN stg_products p ON p.product_id = f.product_id),
days AS (
    SELECT city, sales_day, count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_qty,
           CAST(sum(product_revenue) AS BIGINT) AS product_revenue, CAST(sum(addon_revenue) AS BIGINT) AS addon_revenue,
           CAST(sum(total_order_value) AS BIGINT) AS total_revenue, CAST(sum(margin) AS BIGINT) AS total_margin
    FROM sold GROUP BY ALL)
SELECT {key_sql("sales_day", "d.city")} AS city_day_id, d.city, c.region,
       CAST(date_trunc('year', sales_day) AS DATE) AS sales_year, CAST(date_trunc('month', sales_day) AS DATE) AS sales_month,
       sales_day, total_orders, total_qty, product_revenue, addon_revenue, total_revenue, total_margin
FROM days d LEFT JOIN cities c ON c.city = d.city""",
    "mart_product_reviews": reviews_sql("fact_orders_gold"),
    "mart_employee_addon_performance": f"""
WITH months AS (
    SELECT CAST(date_trunc('month', order_timestamp) AS DATE) AS performance_month, employee_id,
           count(order_id) AS total_orders, count(service_type) AS addon_orders,
           CAST(sum(addon_revenue) AS BIGINT) AS total_addon_revenue
    FROM fact_orders_gold GROUP BY ALL),
staffed AS (
    SELECT m.*, e.employee_name, e.gender, e.hire_date,
           CAST(date_diff('month', e.hire_date, m.performance_month) AS INTEGER) AS tenure_months
    FROM months m LEFT JOIN dim_employees_gold e ON e.employee_id = m.employee_id)
SELECT {key_sql("performance_month", "employee_id")} AS month_employee_id, performance_month, employee_id, employee_name,
       gender, hire_date, tenure_months,
       CASE WHEN tenure_months >= 36 OR tenure_months IS NULL THEN '3+ years' WHEN tenure_months >= 12 THEN '1-3 years'
            WHEN tenure_months >= 6 THEN '6-12 months' ELSE '0-6 months' END AS tenure_bracket,
       total_orders, addon_orders, {pct_sql("addon_orders", "total_orders")} AS addon_attach_rate_pct, total_addon_revenue,
       {fixed_sql("total_addon_revenue / NULLIF(addon_orders, 0)", 2)} AS avg_addon_value
FROM staffed""",
}

# Definition order of every CTE a query may reference.
_CTE_ORDER = [("cities", CITIES)] + list(ADAPTERS.items()) + list(SILVER.items()) + [
    (k, GOLD[k]) for k in ("dim_employees_gold", "dim_payroll_gold", "fact_orders_gold", "dim_products_gold",
                           "mart_monthly_product_sales", "mart_hourly_traffic_conversion",
                           "mart_hourly_traffic_hist", "mart_traffic_conversion_by_product", "mart_traffic_events_by_product",
                           "mart_city_sales", "mart_product_reviews", "mart_employee_addon_performance")]


def with_models(final_sql: str, extra_ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``final_sql`` with every adapter/silver/gold model as a CTE."""
    ctes = _CTE_ORDER + [("dim_date_span", DIM_DATE_SPAN_SQL), ASOF_CTE] + list(extra_ctes or [])
    body = ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in ctes)
    return f"WITH {body}\n{final_sql.strip()}"


def with_recursive(final_sql: str, extra_ctes: list[tuple[str, str]]) -> str:
    return with_models(final_sql, extra_ctes).replace("WITH ", "WITH RECURSIVE ", 1)


def model_sql(name: str) -> str:
    return with_models(f"SELECT * FROM {name}")


# --------------------------------------------------------------------------
# Incremental runs (equal to a full rebuild, except the strict legacy rule)
# --------------------------------------------------------------------------
ORDERS_CUT_SQL = "TIMESTAMP '1998-06-15 12:00:00'"
TRAFFIC_CUT_SQL = "TIMESTAMP '2024-01-15 12:30:00'"

DIM_DATE_SPAN_SQL = """
SELECT date_day,
       CAST(year(date_day) AS INTEGER) AS year, CAST(quarter(date_day) AS INTEGER) AS quarter,
       CAST(month(date_day) AS INTEGER) AS month, CAST(day(date_day) AS INTEGER) AS day,
       strftime(date_day, '%Y') || '-Q' || CAST(quarter(date_day) AS VARCHAR) AS year_quarter,
       strftime(date_day, '%Y-%m') AS year_month,
       strftime(date_day, '%b') AS month_name
FROM (SELECT CAST(unnest(generate_series(CAST(min(CAST(order_timestamp AS DATE)) AS TIMESTAMP),
                                         CAST(max(CAST(order_timestamp AS DATE)) AS TIMESTAMP),
                                         INTERVAL 1 DAY)) AS DATE) AS date_day
      FROM stg_orders)"""

STRICT_REVIEWS_SQL = f"""
SELECT * FROM hist_r h
WHERE NOT EXISTS (SELECT 1 FROM delta_r d WHERE d.month_prod_id IS NOT DISTINCT FROM h.month_prod_id)
UNION ALL
SELECT * FROM delta_r"""


STRICT_REVIEWS_CTES = [
    ("fact_hist", f"SELECT * FROM fact_orders_gold WHERE order_timestamp <= {ORDERS_CUT_SQL} OR order_timestamp IS NULL"),
    ("hist_r", reviews_sql("fact_hist")),
    ("fact_delta", "SELECT * FROM fact_orders_gold WHERE order_timestamp > "
                   "(SELECT CAST(max(review_month) AS TIMESTAMP) FROM hist_r)"),
    ("delta_r", reviews_sql("fact_delta")),
]

# --------------------------------------------------------------------------
# HR and order operators
# --------------------------------------------------------------------------
ASOF_CTE = ("run_asof", "SELECT CAST(date_trunc('month', max(order_timestamp)) AS DATE) AS a FROM stg_orders")


def salary_sql(age: str, hire: str, month: str) -> str:
    n = f"(year({month}) - 2021)"
    lo = f"(28000 * pow(1.04, {n}))"
    hi = f"(33000 * pow(1.04, {n}))"
    e = f"floor(date_diff('day', {hire}, {month}) / 365)"
    base = f"(CASE WHEN {age} < 20 THEN {lo} WHEN {age} <= 25 THEN {lo} + ({age} - 20) * (({hi} - {lo}) / 5) ELSE {hi} END)"
    adj = f"(CASE WHEN {e} >= 1 THEN greatest({base} * pow(1.04, {e}), {hi}) ELSE {base} * pow(1.04, {e}) END)"
    return (f"CAST(round_even(CASE WHEN {e} >= 3 THEN {hi} * pow(1.05, 3) ELSE {adj} * pow(1.05, {e}) END, 0) "
            f"AS BIGINT)")


AGE_AT_HIRE_SQL = "CAST(greatest(18, e.current_age - floor(date_diff('day', e.hire_date, ao.a) / 365)) AS BIGINT)"


def payroll_sql(start_sql: str) -> str:
    return f"""
SELECT e.employee_id, {salary_sql('ah', 'e.hire_date', 'mm.m')} AS monthly_salary, mm.m AS payroll_month
FROM (SELECT e.*, {AGE_AT_HIRE_SQL} AS ah FROM stg_employees e, run_asof ao) e
JOIN (SELECT CAST(unnest(generate_series(CAST(({start_sql}) AS TIMESTAMP), CAST(ao.a AS TIMESTAMP),
                                         INTERVAL 1 MONTH)) AS DATE) AS m FROM run_asof ao) mm
  ON e.hire_date <= mm.m AND (e.exit_date IS NULL OR e.exit_date >= mm.m)"""


PAYROLL_EXPAND_SQL = payroll_sql("SELECT CAST(date_trunc('month', min(hire_date)) AS DATE) FROM stg_employees")
NEXT_PERIOD_SQL = payroll_sql("SELECT CAST(date_trunc('month', max(payroll_month)) + INTERVAL 1 MONTH AS DATE) "
                              "FROM stg_payroll")

AGE_SQL = f"""
SELECT e.employee_id, e.hire_date, e.current_age, {AGE_AT_HIRE_SQL} AS age_at_hire
FROM stg_employees e, run_asof ao"""

ORDER_CANDIDATES_SQL = ("SELECT CAST(order_id AS BIGINT) AS order_id, product_id, event_time AS order_time "
                        "FROM raw_traffic WHERE order_id IS NOT NULL")
INC_ID_SQL = (ORDER_CANDIDATES_SQL + " AND order_id > (SELECT COALESCE(max(order_id), 0) FROM raw_traffic "
              f"WHERE order_id IS NOT NULL AND event_time <= {TRAFFIC_CUT_SQL})")

ACTIVE_STAFF_SQL = """
SELECT o.order_id, o.order_timestamp, COUNT(e.employee_id) AS active_staff_count
FROM stg_orders o LEFT JOIN stg_employees e
  ON e.hire_date <= o.order_timestamp AND (e.exit_date IS NULL OR e.exit_date > o.order_timestamp)
GROUP BY 1, 2"""

# Staff whose employment begins and ends within a day: seconds that the employee's number gives.
STAFF_INSTANTS_SQL = """
SELECT employee_id, CAST(hire_date AS TIMESTAMP) + to_seconds((employee_id * 3607) % 86400) AS hire_at,
       CAST(exit_date AS TIMESTAMP) + to_seconds((employee_id * 7919) % 86400) AS exit_at FROM stg_employees"""
ORDER_ROSTERS_SQL = f"""
WITH staff AS ({STAFF_INSTANTS_SQL}),
held AS (
  SELECT o.order_id, COUNT(e.employee_id) AS n, COALESCE(SUM(e.employee_id), 0) AS ids
  FROM stg_orders o LEFT JOIN staff e ON e.hire_at <= o.order_timestamp AND (e.exit_at IS NULL OR e.exit_at > o.order_timestamp)
  GROUP BY 1
), points AS (SELECT hire_at AS point FROM staff WHERE exit_at IS NULL OR exit_at > hire_at
              UNION SELECT exit_at FROM staff WHERE exit_at > hire_at)
SELECT o.order_id, o.order_timestamp, (SELECT MAX(point) FROM points WHERE point <= o.order_timestamp) AS roster_class,
       CAST(n AS BIGINT) AS active_staff_count, CAST(ids AS BIGINT) AS employee_id_sum
FROM stg_orders o JOIN held USING (order_id)"""
STAFF_OF_LAST_ORDERS_SQL = f"""
WITH staff AS ({STAFF_INSTANTS_SQL}),
last_orders AS (
  SELECT order_id, order_timestamp FROM stg_orders WHERE order_timestamp IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY date_trunc('month', order_timestamp) ORDER BY order_timestamp DESC, order_id DESC) = 1
)
SELECT order_id, order_timestamp, employee_id FROM last_orders JOIN staff
  ON hire_at <= order_timestamp AND (exit_at IS NULL OR exit_at > order_timestamp)"""

ADDON_SQL = """
SELECT order_id, employee_id, product_id, category, CAST(yrs AS BIGINT) AS tenure_years,
       COALESCE(category IN ('Mobile', 'Laptops', 'Gaming', 'Consumer Electronics', 'Home Appliances'), false)
         AS addon_eligible,
       CAST(round_even(base_price * CAST(0.12 AS DOUBLE), 0) AS BIGINT) AS addon_price
FROM (SELECT f.order_id, f.employee_id, f.product_id, p.category, p.base_price, e.hire_date,
             floor(date_diff('day', e.hire_date, CAST(f.order_timestamp AS DATE)) / 365) AS yrs
      FROM fact_orders_gold f LEFT JOIN stg_products p ON f.product_id = p.product_id
      LEFT JOIN stg_employees e ON f.employee_id = e.employee_id)"""

# --------------------------------------------------------------------------
# ML
# --------------------------------------------------------------------------
ANOMALY_SQL = """
WITH inp AS (
    SELECT 'PRODUCT' AS entity_type, CAST(product_id AS VARCHAR) AS entity_id, product_name AS entity_name,
           'CONVERSION_RATE_PCT' AS metric_name, traffic_month AS period, CAST(conversion_rate_pct AS DOUBLE) AS metric_value
    FROM mart_traffic_conversion_by_product WHERE conversion_rate_pct IS NOT NULL
    UNION ALL
    SELECT 'EMPLOYEE', CAST(employee_id AS VARCHAR), employee_name, 'ADDON_ATTACH_RATE_PCT', performance_month,
           CAST(addon_attach_rate_pct AS DOUBLE)
    FROM mart_employee_addon_performance WHERE addon_attach_rate_pct IS NOT NULL),
scored AS (
    SELECT *, COUNT(x) OVER w AS n, CAST(SUM(x) OVER w AS BIGINT) AS sx, CAST(SUM(x * x) OVER w AS BIGINT) AS sxx
    FROM (SELECT *, CAST(round(metric_value * 100) AS BIGINT) AS x FROM inp WHERE entity_id IS NOT NULL)
    WINDOW w AS (PARTITION BY entity_type, entity_id)),
z AS (SELECT *, CAST(x * n - sx AS DOUBLE) / sqrt(CAST(n AS DOUBLE) * CAST(n * sxx - sx * sx AS DOUBLE) / CAST(n - 1 AS DOUBLE)) AS z
      FROM scored WHERE n >= 3 AND n * sxx <> sx * sx)
SELECT md5(concat_ws('|', entity_type, entity_id, metric_name, CAST(period AS VARCHAR))) AS anomaly_id,
       entity_type, entity_id, entity_name, metric_name, period, metric_value,
       CAST((sx * 20000 + n) // (2 * n) AS DOUBLE) / 1000000.0::DOUBLE AS baseline_mean,
       ROUND(sqrt(CAST(n * sxx - sx * sx AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) / 100.0::DOUBLE, 6) AS baseline_std,
       ROUND(z, 4) AS z_score, abs(z) > 2.0 AS is_anomaly,
       CASE WHEN z > 0 THEN 'HIGH' ELSE 'LOW' END AS anomaly_direction
FROM z"""

REVENUE_FORECAST_SQL = """
WITH y AS (SELECT sales_month AS ds, category, CAST(SUM(total_revenue) AS DOUBLE) AS y
           FROM mart_monthly_product_sales WHERE sales_month IS NOT NULL GROUP BY 1, 2),
span AS (SELECT category, MIN(ds) AS f, MAX(ds) AS l, COUNT(y) AS n FROM y GROUP BY 1 HAVING COUNT(y) >= 12),
d AS (SELECT y.ds, y.category, y.y, s.f,
             CAST((year(y.ds) - year(s.f)) * 12 + month(y.ds) - month(s.f) AS DOUBLE) AS t, month(y.ds) AS moy
      FROM y JOIN span s ON y.category = s.category),
fit AS (SELECT category, regr_intercept(y, t) AS a, regr_slope(y, t) AS b, abs(avg(y)) / 100 AS low FROM d GROUP BY 1),
d2 AS (SELECT d.*, greatest(fit.a + fit.b * d.t, fit.low) AS tr FROM d JOIN fit ON d.category = fit.category),
idx AS (SELECT category, moy, AVG(y / tr) AS raw FROM d2 GROUP BY 1, 2),
seas AS (SELECT category, moy, raw / AVG(raw) OVER (PARTITION BY category) AS s FROM idx),
sig AS (SELECT d2.category, STDDEV_SAMP(d2.y / (d2.tr * seas.s) - 1) AS sigma
        FROM d2 JOIN seas ON d2.category = seas.category AND d2.moy = seas.moy GROUP BY 1),
fc_asof AS (SELECT max(sales_month) AS a FROM mart_monthly_product_sales),
fut AS (SELECT category, f, CAST(unnest(generate_series(CAST(l AS TIMESTAMP) + INTERVAL 1 MONTH,
                                                        CAST(l AS TIMESTAMP) + INTERVAL 24 MONTH,
                                                        INTERVAL 1 MONTH)) AS DATE) AS forecast_date FROM span),
pred AS (SELECT fut.forecast_date, fut.category,
                greatest(fit.a + fit.b * CAST((year(fut.forecast_date) - year(fut.f)) * 12
                                              + month(fut.forecast_date) - month(fut.f) AS DOUBLE), fit.low)
                  * COALESCE(seas.s, 1.0) AS yhat,
                COALESCE(sig.sigma, 0.0) * 1.96 AS band
         FROM fut JOIN fit ON fut.category = fit.category JOIN sig ON fut.category = sig.category
         LEFT JOIN seas ON fut.category = seas.category AND month(fut.forecast_date) = seas.moy
         CROSS JOIN fc_asof
         WHERE fut.forecast_date <= make_date(CAST(year(fc_asof.a) + 1 AS BIGINT), 12, 31))
SELECT md5(category || '|' || CAST(forecast_date AS VARCHAR)) AS forecast_id, forecast_date, category,
       ROUND(greatest(yhat, 0.0), 2) AS revenue_forecast,
       ROUND(greatest(yhat * (1 - band), 0.0), 2) AS revenue_lower,
       ROUND(greatest(yhat * (1 + band), 0.0), 2) AS revenue_upper
FROM pred"""

DAILY_VISITS_SQL = """
SELECT event_date, CAST(SUM(total_visits) AS BIGINT) AS total_visits
FROM mart_hourly_traffic_hist WHERE total_visits IS NOT NULL GROUP BY 1"""

TRAFFIC_FORECAST_SQL = f"""
WITH y AS (SELECT event_date AS ds, CAST(total_visits AS DOUBLE) AS y FROM ({DAILY_VISITS_SQL.strip()})),
g AS (SELECT MIN(ds) AS f, MAX(ds) AS l FROM y),
d AS (SELECT y.ds, y.y, CAST(date_diff('day', g.f, y.ds) AS DOUBLE) AS t, month(y.ds) AS moy,
             dayofweek(y.ds) AS dow FROM y, g),
fit AS (SELECT regr_intercept(y, t) AS a, regr_slope(y, t) AS b, abs(avg(y)) / 100 AS low FROM d),
d2 AS (SELECT d.*, greatest(fit.a + fit.b * d.t, fit.low) AS tr FROM d, fit),
im AS (SELECT moy, AVG(y / tr) AS raw FROM d2 GROUP BY 1),
sm AS (SELECT moy, raw / (SELECT AVG(raw) FROM im) AS s_m FROM im),
d3 AS (SELECT d2.*, sm.s_m FROM d2 JOIN sm ON d2.moy = sm.moy),
iw AS (SELECT dow, AVG(y / (tr * s_m)) AS raw FROM d3 GROUP BY 1),
sw AS (SELECT dow, raw / (SELECT AVG(raw) FROM iw) AS s_w FROM iw),
sig AS (SELECT STDDEV_SAMP(d3.y / (d3.tr * d3.s_m * sw.s_w) - 1) AS sigma FROM d3 JOIN sw ON d3.dow = sw.dow),
fut AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', l) AS TIMESTAMP) + INTERVAL 1 MONTH,
                                           CAST(date_trunc('month', l) AS TIMESTAMP) + INTERVAL 24 MONTH,
                                           INTERVAL 1 MONTH)) AS DATE) AS prediction_date FROM g),
pred AS (SELECT fut.prediction_date,
                greatest(fit.a + fit.b * CAST(date_diff('day', g.f, fut.prediction_date) AS DOUBLE), fit.low)
                  * COALESCE(sm.s_m, 1.0) * COALESCE(sw.s_w, 1.0) AS yhat,
                COALESCE(sig.sigma, 0.0) * 1.96 AS band
         FROM fut CROSS JOIN g CROSS JOIN fit CROSS JOIN sig
         LEFT JOIN sm ON month(fut.prediction_date) = sm.moy
         LEFT JOIN sw ON dayofweek(fut.prediction_date) = sw.dow
         WHERE fut.prediction_date > g.l AND fut.prediction_date <= make_date(CAST(year(g.l) + 1 AS BIGINT), 12, 31))
SELECT prediction_date, ROUND(greatest(yhat, 0.0), 0) AS predicted_visits,
       ROUND(greatest(yhat * (1 - band), 0.0), 0) AS visits_lower,
       ROUND(greatest(yhat * (1 + band), 0.0), 0) AS visits_upper
FROM pred"""

RIDGE_SQL = """
WITH h AS (SELECT CAST(hour_of_day AS INTEGER) AS hour_of_day, CAST(dayofweek(event_date) + 1 AS INTEGER) AS weekday,
                  CAST(total_visits AS DOUBLE) AS v FROM mart_hourly_traffic_conversion),
cells AS (SELECT hour_of_day, weekday, COUNT(v) AS n_obs, AVG(v) AS cell_mean FROM h GROUP BY 1, 2),
m AS (SELECT AVG(v) AS m FROM h),
grid AS (SELECT CAST(i % 24 AS INTEGER) AS hour_of_day, CAST(i // 24 + 1 AS INTEGER) AS weekday FROM range(168) t(i))
SELECT g.hour_of_day, g.weekday, COALESCE(c.n_obs, 0) AS n_obs, ROUND(c.cell_mean, 4) AS cell_mean,
       ROUND(m.m + CAST(COALESCE(c.n_obs, 0) AS DOUBLE) / (CAST(COALESCE(c.n_obs, 0) AS DOUBLE) + CAST(3.0 AS DOUBLE))
             * (COALESCE(c.cell_mean, m.m) - m.m), 4) AS predicted_visits
FROM grid g LEFT JOIN cells c ON g.hour_of_day = c.hour_of_day AND g.weekday = c.weekday CROSS JOIN m"""

CATEGORY_MONTH_REVENUE_SQL = """
SELECT sales_month, category, CAST(SUM(total_revenue) AS BIGINT) AS total_revenue
FROM mart_monthly_product_sales GROUP BY 1, 2"""

# --------------------------------------------------------------------------
# Reports and data quality
# --------------------------------------------------------------------------
RPT_CITY_KPI_SQL = f"""
SELECT city, region, CAST(SUM(total_revenue) AS BIGINT) AS total_revenue, CAST(SUM(total_orders) AS BIGINT) AS total_orders,
       CAST(SUM(total_qty) AS BIGINT) AS total_qty, CAST(SUM(total_margin) AS BIGINT) AS total_margin,
       COUNT(sales_day) AS selling_days,
       {fixed_sql("SUM(total_revenue) / NULLIF(SUM(total_orders), 0)", 2)} AS avg_order_value
FROM mart_city_sales GROUP BY 1, 2"""

RPT_MOM_YOY_SQL = f"""
WITH m AS (SELECT city, sales_month, CAST(SUM(total_revenue) AS BIGINT) AS revenue FROM mart_city_sales GROUP BY 1, 2)
SELECT a.city, a.sales_month, a.revenue, pm.revenue AS prev_month_revenue,
       {pct_sql("a.revenue - pm.revenue", "pm.revenue")} AS mom_pct,
       py.revenue AS prev_year_revenue,
       {pct_sql("a.revenue - py.revenue", "py.revenue")} AS yoy_pct
FROM m a
LEFT JOIN m pm ON pm.city IS NOT DISTINCT FROM a.city AND CAST(pm.sales_month + INTERVAL 1 MONTH AS DATE) = a.sales_month
LEFT JOIN m py ON py.city IS NOT DISTINCT FROM a.city AND CAST(py.sales_month + INTERVAL 12 MONTH AS DATE) = a.sales_month"""

RPT_CATEGORY_MARGIN_SQL = f"""
SELECT s.category, s.product_id, s.product_name, CAST(SUM(s.total_revenue) AS BIGINT) AS total_revenue,
       CAST(SUM(s.product_margin) AS BIGINT) AS product_margin,
       {pct_sql("SUM(s.product_margin)", "SUM(s.product_revenue)")} AS margin_pct,
       d.avg_review_score
FROM mart_monthly_product_sales s LEFT JOIN dim_products_gold d ON s.product_id = d.product_id
GROUP BY s.category, s.product_id, s.product_name, d.avg_review_score"""

RPT_FUNNEL_SQL = f"""
SELECT traffic_month, category, CAST(SUM(total_views) AS BIGINT) AS views, CAST(SUM(total_carts) AS BIGINT) AS carts,
       CAST(SUM(total_orders) AS BIGINT) AS orders,
       {pct_sql("SUM(total_carts)", "SUM(total_views)")} AS cart_rate_pct,
       {pct_sql("SUM(total_orders)", "SUM(total_views)")} AS conversion_rate_pct
FROM mart_traffic_conversion_by_product GROUP BY 1, 2"""

RPT_REVIEW_DIST_SQL = "SELECT review, COUNT(*) AS orders FROM fact_orders_gold GROUP BY 1"

# Models of the stored pipeline, whose traffic is the events, where they have another name here.
STORED_AS = {"dim_date": "dim_date_span", "mart_traffic_conversion_by_product": "mart_traffic_events_by_product"}


def dq_unique_sql() -> str:
    parts = []
    for t, k in KEYED_TABLES.items():
        src = STORED_AS.get(t, t)
        parts.append(f"SELECT '{t}' AS table_name, '{k}' AS key_column, CAST(COALESCE(SUM(c), 0) AS BIGINT) AS row_count, "
                     f"COUNT(*) AS distinct_keys, COUNT(CASE WHEN c > 1 THEN 1 END) AS duplicate_keys "
                     f"FROM (SELECT {k}, COUNT(*) AS c FROM {src} GROUP BY {k})")
    return "\nUNION ALL\n".join(parts)


def dq_not_null_sql() -> str:
    parts = []
    for t, k in KEYED_TABLES.items():
        src = STORED_AS.get(t, t)
        parts.append(f"SELECT '{t}' AS table_name, '{k}' AS column_name, COUNT(*) AS row_count, "
                     f"COUNT(CASE WHEN {k} IS NULL THEN 1 END) AS null_count FROM {src}")
    return "\nUNION ALL\n".join(parts)


# Orders that the first load did not have, at or before the newest time that it had, or without one.
LATE_ORDER = "order_id % 11 = 3"
QUARANTINE_SQL = f"""
WITH loaded AS (SELECT * FROM stg_orders WHERE (order_timestamp <= {ORDERS_CUT_SQL} OR order_timestamp IS NULL) AND NOT ({LATE_ORDER}))
SELECT * FROM stg_orders
WHERE order_id NOT IN (SELECT order_id FROM loaded)
  AND (order_timestamp IS NULL OR order_timestamp <= (SELECT max(order_timestamp) FROM loaded))"""

# --------------------------------------------------------------------------
# Stored tables
# --------------------------------------------------------------------------
UPSERT_SQL = """
SELECT order_id, ts AS order_timestamp, quantity, CAST(date_trunc('month', ts) AS DATE) AS order_month
FROM (SELECT order_id,
             CASE WHEN order_id % 13 = 1 THEN NULL WHEN order_timestamp IS NULL THEN TIMESTAMP '1999-01-15 00:00:00'
                  WHEN order_id % 7 = 2 THEN order_timestamp + INTERVAL 40 DAY ELSE order_timestamp END AS ts,
             CAST(CASE WHEN order_id % 13 = 1 OR order_id % 7 = 2 OR order_timestamp IS NULL THEN quantity + 100 ELSE quantity END
                  AS INTEGER) AS quantity
      FROM stg_orders)"""

STORED_REVENUE_SQL = f"""
SELECT f.*, CAST((SELECT max(sales_month) FROM mart_monthly_product_sales) AS TIMESTAMP) AS generated_at
FROM ({REVENUE_FORECAST_SQL.strip()}) f"""

# Rows held back arrive when the watermark stands two hours before the newest of the others.
STATEFUL_HOURLY_SQL = """
WITH mark AS (SELECT max(event_time) - INTERVAL 2 HOURS AS mark_at FROM raw_traffic WHERE traffic_id NOT LIKE '%7'),
tagged AS (SELECT *, date_trunc('hour', event_time) AS h,
  traffic_id LIKE '%7' AND date_trunc('hour', event_time) + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', mark_at) FROM mark) AS late FROM raw_traffic)
SELECT CAST(h AS TIMESTAMP) AS event_hour,
       CASE WHEN COUNT(*) FILTER (NOT late) > 0 THEN COUNT(DISTINCT traffic_id) FILTER (NOT late) END AS total_visits,
       CASE WHEN COUNT(*) FILTER (NOT late) > 0 THEN COUNT(*) FILTER (NOT late AND item_in_cart = 'yes') END AS total_carts,
       CASE WHEN COUNT(*) FILTER (NOT late) > 0 THEN COUNT(DISTINCT order_id) FILTER (NOT late) END AS total_orders,
       COUNT(*) FILTER (late) AS late_rows
FROM tagged GROUP BY h"""

# --------------------------------------------------------------------------
# Seasonal models: the same normal equations, solved by Gauss-Jordan elimination.
# --------------------------------------------------------------------------


def seasonal_sql(series: str, hinges: int, yearly: int, weekly: int, hinge_ridge: float, season_ridge: float, first_step: str) -> list[tuple[str, str]]:
    """CTEs: forecast of each series ``g`` of ``series`` (g, ds, y) at the 24 month
    starts after ``first_step`` (of last), as future(g, ds, yhat, sigma)."""
    span = "greatest(date_diff('day', first, last), 1)::DOUBLE"
    t = f"(date_diff('day', first, ds) / {span})"
    days = "date_diff('day', DATE '2000-01-01', ds)::DOUBLE"
    terms = ["1.0::DOUBLE", t, *(f"greatest(0.0::DOUBLE, {t} - {0.8 * (j + 1) / (hinges + 1)!r}::DOUBLE)" for j in range(hinges))]
    for n, period in ((yearly, 365.25), (weekly, 7.0)):
        for k in range(1, n + 1):
            terms += [f"{f}(2 * pi() * {k} * {days} / {period}::DOUBLE)" for f in ("sin", "cos")]
    ridge = [1e-6] * 2 + [hinge_ridge] * hinges + [season_ridge] * 2 * (yearly + weekly)
    p = len(terms)
    listed = "[" + ", ".join(terms) + "]"
    return [
        ("series", series),
        ("spans", "SELECT g, min(ds) AS first, max(ds) AS last FROM series WHERE ds IS NOT NULL AND y IS NOT NULL GROUP BY g HAVING count(*) >= 12"),
        ("ridge", f"SELECT {[float(r) for r in ridge]}::DOUBLE[] AS r"),
        ("z", f"SELECT s.g, y::DOUBLE AS y, {listed} AS x FROM series s JOIN spans USING (g) WHERE ds IS NOT NULL AND y IS NOT NULL"),
        ("cells", f"""
SELECT g, i, j, sum(x[i] * x[j]) + CASE WHEN i = j THEN (SELECT r[i] FROM ridge) ELSE 0 END AS v
FROM z, range(1, {p + 1}) a(i), range(1, {p + 1}) b(j) GROUP BY g, i, j
UNION ALL SELECT g, i, {p + 1}, sum(x[i] * y) FROM z, range(1, {p + 1}) a(i) GROUP BY g, i"""),
        ("matrix", "SELECT g, list(cells_row ORDER BY i) AS m FROM (SELECT g, i, list(v ORDER BY j) AS cells_row FROM cells GROUP BY g, i) GROUP BY g"),
        ("solving(g, k, m)", f"""
SELECT g, 1, m FROM matrix
UNION ALL
SELECT g, k + 1, list_transform(range(1, {p + 1}), lambda i: CASE WHEN i = k THEN list_transform(m[k], lambda v: v / m[k][k])
  ELSE list_transform(range(1, {p + 2}), lambda j: m[i][j] - m[i][k] / m[k][k] * m[k][j]) END)
FROM solving WHERE k <= {p}"""),
        ("betas", f"SELECT g, list_transform(m, lambda r: r[{p + 1}]) AS beta FROM solving WHERE k = {p + 1}"),
        ("spreads", """
SELECT g, sqrt(sum(power(y - list_dot_product(x, beta), 2)) / greatest(1, count(*) - 1)) AS sigma FROM z JOIN betas USING (g) GROUP BY g"""),
        ("ahead", f"SELECT g, first, last, unnest([({first_step} + to_months(CAST(k AS INT)))::DATE FOR k IN range(1, 25)]) AS ds FROM spans"),
        ("future", f"SELECT g, ds, list_dot_product({listed}, beta) AS yhat, sigma FROM ahead JOIN betas USING (g) JOIN spreads USING (g)"),
    ]


SEASONAL_REVENUE_CTES = seasonal_sql(
    f"SELECT category AS g, sales_month AS ds, total_revenue AS y FROM ({CATEGORY_MONTH_REVENUE_SQL})", 3, 4, 0, 0.1, 0.1, "last")
SEASONAL_REVENUE_SQL = """
SELECT g AS category, ds AS forecast_date, round(greatest(yhat, 0.0), 0) AS revenue_forecast,
       round(greatest(yhat - 1.96 * sigma, 0.0), 0) AS revenue_lower, round(greatest(yhat + 1.96 * sigma, 0.0), 0) AS revenue_upper
FROM future WHERE ds <= make_date(year((SELECT max(sales_month) FROM mart_monthly_product_sales)) + 1, 12, 31)"""
SEASONAL_TRAFFIC_CTES = seasonal_sql(
    f"SELECT 'visits' AS g, event_date AS ds, total_visits AS y FROM ({DAILY_VISITS_SQL})", 8, 6, 3, 10.0, 10.0, "date_trunc('month', last)")
SEASONAL_TRAFFIC_SQL = """
SELECT ds AS prediction_date, round(greatest(yhat, 0.0), 1) AS predicted_visits,
       round(greatest(yhat - 1.96 * sigma, 0.0), 1) AS visits_lower, round(greatest(yhat + 1.96 * sigma, 0.0), 1) AS visits_upper
FROM future WHERE ds <= make_date(year((SELECT max(ds) FROM series)) + 1, 12, 31)"""
