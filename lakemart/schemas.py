"""Declared schemas of the raw layer (never inferred)."""

from pyspark.sql import types as T

RAW_PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("subcategory", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("base_price", T.LongType()),
    T.StructField("unit_cost", T.LongType()),
])

RAW_EMPLOYEES = T.StructType([
    T.StructField("employee_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("current_age", T.IntegerType()),
    T.StructField("hire_date", T.DateType()),
    T.StructField("exit_date", T.DateType()),
])

RAW_PAYROLL = T.StructType([
    T.StructField("employee_id", T.LongType()),
    T.StructField("monthly_salary", T.LongType()),
    T.StructField("month_year", T.DateType()),
])

RAW_TRAFFIC = T.StructType([
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("traffic_id", T.StringType()),
    T.StructField("item_in_cart", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("order_id", T.LongType()),
])

RAW_ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("service_type", T.StringType()),
    T.StructField("service_price", T.LongType()),
    T.StructField("employee_id", T.LongType()),
    T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("city", T.StringType()),
    T.StructField("review", T.IntegerType()),
])

RAW = {
    "raw_products": RAW_PRODUCTS,
    "raw_employees": RAW_EMPLOYEES,
    "raw_payroll": RAW_PAYROLL,
    "raw_traffic": RAW_TRAFFIC,
    "raw_orders": RAW_ORDERS,
}

# CSV landing form: timestamps and dates arrive as text, nullable ids as
# floats ("800001.0"). The CSV reader takes these text/double types and the
# coercion step (sources.files) turns them into the RAW types above.
CSV_TEXT_TYPES = {
    T.DateType(): T.StringType(),
    T.TimestampNTZType(): T.StringType(),
}


def csv_landing_schema(schema: T.StructType, float_ids: tuple = ()) -> T.StructType:
    """Schema to read a landed CSV with: dates as text, float-encoded ids as double."""
    fields = []
    for f in schema.fields:
        if f.name in float_ids:
            fields.append(T.StructField(f.name, T.DoubleType()))
        else:
            fields.append(T.StructField(f.name, CSV_TEXT_TYPES.get(f.dataType, f.dataType)))
    return T.StructType(fields)
