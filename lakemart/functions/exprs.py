"""Column expressions shared by the silver, gold and ML layers.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``,
so it stays inside whole-stage codegen; no Python UDFs.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------

# City -> region (20 cities; any other city maps to NULL).
CITY_REGION = {
    "Praha": "Praha",
    "Brno": "Jihomoravský",
    "Ostrava": "Moravskoslezský",
    "Plzeň": "Plzeňský",
    "Liberec": "Liberecký",
    "Olomouc": "Olomoucký",
    "České Budějovice": "Jihočeský",
    "Hradec Králové": "Královéhradecký",
    "Pardubice": "Pardubický",
    "Ústí nad Labem": "Ústecký",
    "Havířov": "Moravskoslezský",
    "Zlín": "Zlínský",
    "Kladno": "Středočeský",
    "Most": "Ústecký",
    "Frýdek-Místek": "Moravskoslezský",
    "Opava": "Moravskoslezský",
    "Karviná": "Moravskoslezský",
    "Jihlava": "Vysočina",
    "Děčín": "Ústecký",
    "Teplice": "Ústecký",
}

# Tenure brackets: months below the bound -> label; anything else (including
# an unknown tenure) -> the last label.
TENURE_BRACKETS = [(6, "0-6 months"), (12, "6-12 months"), (36, "1-3 years")]
TENURE_ELSE = "3+ years"

# Open-ended employment end date used by the silver employee view.
OPEN_EXIT_DATE = _dt.date(9999, 12, 31)

# Product categories that may carry a paid add-on service, and its price share.
ADDON_CATEGORIES = ["Mobile", "Laptops", "Gaming", "Consumer Electronics", "Home Appliances"]
ADDON_PRICE_SHARE = 0.12

# Salary model: first salary year, band at that year, yearly band growth,
# experience growth, seniority raise, cap of raise years, age band.
SALARY_BASE_YEAR = 2021
SALARY_LOW = 28000
SALARY_HIGH = 33000
SALARY_BAND_GROWTH = 1.04
SALARY_EXPERIENCE_GROWTH = 1.04
SALARY_RAISE = 1.05
SALARY_RAISE_YEARS_CAP = 3
SALARY_AGE_LOW = 20
SALARY_AGE_HIGH = 25
MIN_HIRE_AGE = 18

# ---------------------------------------------------------------------------


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ntz(c) -> Column:
    """``date_trunc`` yields ``timestamp``; cast back to ``timestamp_ntz``."""
    return col(c).cast("timestamp_ntz")


def trunc_ts(unit: str, c) -> Column:
    """DATE_TRUNC(unit, ts) as ``timestamp_ntz``."""
    return to_ntz(F.date_trunc(unit, col(c)))


def trunc_date(unit: str, c) -> Column:
    """DATE_TRUNC(unit, ts)::DATE."""
    return F.date_trunc(unit, col(c)).cast("date")


def surrogate_key(period, ident) -> Column:
    """Stable md5 key of a period and an id: ``md5(period_date || '|' || id)``.

    Any NULL input gives a NULL key (``concat`` propagates NULL), which the
    upsert matches null-safely.
    """
    return F.md5(F.concat(col(period).cast("date").cast("string"), F.lit("|"),
                          col(ident).cast("string")))


def month_diff(start, end) -> Column:
    """Calendar month boundaries crossed from ``start`` to ``end``.

    Jan 31 -> Feb 1 is 1 (Spark's ``months_between``/``datediff(MONTH)`` count
    whole months and would give 0).
    """
    s, e = col(start), col(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))


def safe_ratio(num, den) -> Column:
    """num / den, NULL when den is 0 (ANSI mode raises on x/0)."""
    return col(num) / F.nullif(col(den), F.lit(0))


# Integer ratios and averages are fixed-point in the original models: the
# quotient carries 6 fractional digits and is then rounded half-up. Rounding a
# binary double directly would turn an exact tie such as 557.175 into 557.17.
FIXED_SCALE = 6


def fixed(x) -> Column:
    return col(x).cast(f"decimal(38,{FIXED_SCALE})")


def round_fixed(x, digits: int) -> Column:
    """ROUND(x, digits) on the 6-digit fixed-point value, returned as double."""
    return F.round(fixed(x), digits).cast("double")


def pct(num, den, digits: int = 2) -> Column:
    """ROUND(num / NULLIF(den, 0) * 100, digits) with a fixed-point quotient."""
    return F.round(fixed(safe_ratio(num, den)) * 100, digits).cast("double")


def tenure_bracket(months) -> Column:
    m = col(months)
    expr = None
    for bound, label in TENURE_BRACKETS:
        expr = F.when(m < bound, label) if expr is None else expr.when(m < bound, label)
    return expr.otherwise(TENURE_ELSE)


def city_region(city) -> Column:
    """Simple CASE lookup of the 20-city map; other cities and NULL -> NULL."""
    c = col(city)
    expr = None
    for k, v in CITY_REGION.items():
        expr = F.when(c == k, v) if expr is None else expr.when(c == k, v)
    return expr


def whole_years(start, end) -> Column:
    """floor(days(start -> end) / 365), floor toward minus infinity."""
    return F.floor(F.datediff(col(end), col(start)) / 365)


def age_at_hire(current_age, hire_date, as_of) -> Column:
    """max(18, current_age - whole years from hire to ``as_of``)."""
    return F.greatest(F.lit(MIN_HIRE_AGE).cast("bigint"),
                      (col(current_age) - whole_years(hire_date, as_of)).cast("bigint"))


def monthly_salary(age_hire, hire_date, month) -> Column:
    """Salary of an employee in ``month`` (first day), rounded to an integer.

    With n = year(month) - 2021, band lo = 28000*1.04^n, hi = 33000*1.04^n,
    e = whole years of experience: e >= 3 -> hi*1.05^3; otherwise an
    age-dependent base grown by 1.04^e, floored at hi once e >= 1, times 1.05^e.
    """
    n = F.year(col(month)) - SALARY_BASE_YEAR
    lo = F.lit(float(SALARY_LOW)) * F.pow(F.lit(SALARY_BAND_GROWTH), n)
    hi = F.lit(float(SALARY_HIGH)) * F.pow(F.lit(SALARY_BAND_GROWTH), n)
    e = whole_years(hire_date, month)
    a = col(age_hire)
    base = (F.when(a < SALARY_AGE_LOW, lo)
            .when(a <= SALARY_AGE_HIGH, lo + (a - SALARY_AGE_LOW) * ((hi - lo) / (SALARY_AGE_HIGH - SALARY_AGE_LOW)))
            .otherwise(hi))
    adj = base * F.pow(F.lit(SALARY_EXPERIENCE_GROWTH), e)
    adj = F.when(e >= 1, F.greatest(adj, hi)).otherwise(adj)
    junior = adj * F.pow(F.lit(SALARY_RAISE), e)
    senior = hi * F.pow(F.lit(SALARY_RAISE), F.lit(SALARY_RAISE_YEARS_CAP))
    # Python's round() is half-to-even; bround mirrors it.
    return F.bround(F.when(e >= SALARY_RAISE_YEARS_CAP, senior).otherwise(junior), 0).cast("bigint")
