"""Column functions shared by the plans. All are built-in expressions; none runs Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for NULL inside a surrogate key.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"

MONEY = "decimal(38,2)"


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the text of the columns joined by '-', NULL replaced by a fixed marker."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(SURROGATE_NULL))
        for c in cols
    ]
    return F.md5(parts[0] if len(parts) == 1 else F.concat_ws("-", *parts))


def key_if(present: Column, key: str | Column) -> Column:
    """Foreign key: the surrogate key of ``key`` where the looked-up row exists, else NULL."""
    return F.when(present.isNotNull(), surrogate_key(key))


def safe_amount(col: Column) -> Column:
    return F.coalesce(col, F.lit(0)).cast(MONEY)


def ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """num/den rounded half up; NULL when the denominator is NULL or zero.

    decimal(24,2) operands keep 14 fractional digits in the quotient, so the final rounding is
    not preceded by a coarser one.
    """
    safe = F.when(den != 0, den.cast("decimal(24,2)"))
    return F.round(num.cast("decimal(24,2)") / safe, digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    safe = F.when(whole != 0, whole.cast("decimal(20,0)"))
    return F.round(part.cast("decimal(18,0)") * 100 / safe, digits)


def days_between(start: Column, end: Column) -> Column:
    """Calendar days crossed, not elapsed 24-hour periods."""
    return F.datediff(end, start)


def weeks_between(start: Column, end: Column) -> Column:
    """Monday boundaries crossed."""
    monday = lambda c: F.date_trunc("week", c).cast("date")
    return (F.datediff(monday(end), monday(start)) / 7).cast("int")


def months_between_boundaries(start: Column, end: Column) -> Column:
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def years_between(start: Column, end: Column) -> Column:
    return F.year(end) - F.year(start)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole-second boundaries crossed between two timestamps without zone."""
    whole = lambda c: F.date_trunc("second", c).cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", whole(start), whole(end))


def minutes_between(start: Column, end: Column) -> Column:
    whole = lambda c: F.date_trunc("minute", c).cast("timestamp_ntz")
    return F.timestamp_diff("MINUTE", whole(start), whole(end))


def hours_between(start: Column, end: Column) -> Column:
    whole = lambda c: F.date_trunc("hour", c).cast("timestamp_ntz")
    return F.timestamp_diff("HOUR", whole(start), whole(end))


def quarter_end(d: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))


def year_end(d: Column) -> Column:
    return F.make_date(F.year(d), F.lit(12), F.lit(31))


def fiscal_label(year: Column, quarter: Column) -> Column:
    """'FY2026-Q1'; NULL when either part is NULL."""
    return F.concat(F.lit("FY"), year.cast("string"), F.lit("-Q"), quarter.cast("string"))


def ladder(value: Column, steps: list[tuple[float | int, str]], top: str, missing: str = "Unknown") -> Column:
    """Band labels by ascending exclusive upper bounds; the last bound and above is ``top``."""
    out = F.when(value < steps[0][0], steps[0][1])
    for bound, label in steps[1:]:
        out = out.when(value < bound, label)
    return out.when(value >= steps[-1][0], top).otherwise(missing)


# Segment bounds and labels.
def employee_segment(col: Column) -> Column:
    return ladder(col, [(50, "SMB"), (500, "Mid-Market"), (5000, "Enterprise")], "Strategic")


def revenue_segment(col: Column) -> Column:
    steps = [(1_000_000, "SMB"), (50_000_000, "Mid-Market"), (1_000_000_000, "Enterprise")]
    return ladder(col, steps, "Strategic")


def deal_size_band(col: Column) -> Column:
    steps = [(10_000, "Small  (< $10K)"), (50_000, "Mid    ($10K–$50K)"), (250_000, "Large  ($50K–$250K)")]
    return ladder(col, steps, "Enterprise ($250K+)")


def booking_category(col: Column) -> Column:
    return (
        F.when(col == "New Business", "New Logo")
        .when(col == "Renewal", "Renewal")
        .when(col.isin("Upsell", "Cross-Sell"), "Expansion")
        .otherwise("Other")
    )


def coverage_health(col: Column) -> Column:
    return (
        F.when(col >= 3.0, "✅ Healthy")
        .when(col >= 2.0, "⚠️  At Risk")
        .when(col.isNotNull(), "🔴 Critical")
        .otherwise("—")
    )


def null_of(kind: str) -> Column:
    return F.lit(None).cast(kind)
