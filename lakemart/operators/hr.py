"""HR operators: age at hire, monthly salary, payroll expansion (employee x month)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.exprs import age_at_hire, col, monthly_salary


def last_activity_month(stg_orders: DataFrame, ts_col: str = "order_timestamp") -> Column:
    """First day of the month of the latest order, as a lazy scalar (the run's ``as_of``)."""
    return stg_orders.agg(F.trunc(F.max(ts_col), "MM").alias("_m")).scalar()


def first_hire_month(stg_employees: DataFrame) -> Column:
    return stg_employees.agg(F.trunc(F.min("hire_date"), "MM").alias("_m")).scalar()


def with_age_at_hire(employees: DataFrame, as_of) -> DataFrame:
    """Adds ``age_at_hire = max(18, current_age - whole years from hire to as_of)``."""
    return employees.withColumn("age_at_hire", age_at_hire("current_age", "hire_date", col(as_of)))


def payroll_expand(employees: DataFrame, start_month, end_month, as_of) -> DataFrame:
    """One payroll row per employee and month in ``[start_month, end_month]``.

    An employee is paid for month ``m`` (its first day) when
    ``hire_date <= m AND (exit_date IS NULL OR exit_date >= m)`` (exit
    inclusive). Instead of a theta join against a month table, each
    employee's own month range is generated with ``sequence`` and exploded:
    the work is proportional to the output, needs no shuffle, and an
    employee's months never leave the task that holds the employee.
    """
    hire = F.col("hire_date")
    first_paid = F.when(F.trunc(hire, "MM") == hire, hire).otherwise(F.add_months(F.trunc(hire, "MM"), 1))
    last_paid = F.trunc(F.col("exit_date"), "MM")
    lo = F.greatest(first_paid, col(start_month).cast("date"))
    hi = F.coalesce(F.least(last_paid, col(end_month).cast("date")), col(end_month).cast("date"))
    e = (with_age_at_hire(employees, as_of)
         .select("employee_id", "hire_date", "age_at_hire", lo.alias("_lo"), hi.alias("_hi"))
         .filter(F.col("_lo") <= F.col("_hi")))
    months = e.withColumn("payroll_month", F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 MONTH"))))
    return months.select(
        "employee_id",
        monthly_salary("age_at_hire", "hire_date", "payroll_month").alias("monthly_salary"),
        "payroll_month")


def append_payroll(existing: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Existing payroll plus newly generated months (by name)."""
    return existing.select("employee_id", "monthly_salary", "payroll_month").unionByName(
        new_rows.select("employee_id", "monthly_salary", "payroll_month"))
