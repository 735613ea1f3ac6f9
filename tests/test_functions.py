from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from revstream.functions import scalars as s
from revstream.plans import dims
from revstream.sources import seeds

NTZ = lambda t: F.lit(t).cast("timestamp_ntz")


def value(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


@pytest.mark.parametrize(
    "fn, a, b, expected",
    [
        (s.days_between, "2026-01-01 23:59:59", "2026-01-02 00:00:01", 1),
        (s.weeks_between, "2026-08-02", "2026-08-03", 1),
        (s.weeks_between, "2026-08-03", "2026-08-09", 0),
        (s.months_between_boundaries, "2026-01-31", "2026-02-01", 1),
        (s.years_between, "2025-12-31", "2026-01-01", 1),
        (s.seconds_between, "2026-01-01 00:00:00.9", "2026-01-01 00:00:01.1", 1),
        (s.minutes_between, "2026-01-01 00:00:59", "2026-01-01 00:01:00", 1),
        (s.hours_between, "2026-01-01 00:59:00", "2026-01-01 03:00:00", 3),
    ],
)
def test_differences_count_boundaries(spark, fn, a, b, expected):
    assert value(spark, fn(NTZ(a), NTZ(b))) == expected


def test_ratio_and_percent(spark):
    d = lambda x: F.lit(x).cast("decimal(38,2)")
    assert str(value(spark, s.ratio(d("1.00"), d("3.00")))) == "0.33"
    assert str(value(spark, s.ratio(d("1.01"), d("2.00")))) == "0.51"
    assert value(spark, s.ratio(d("1.00"), d("0.00"))) is None
    assert str(value(spark, s.percent(F.lit(1), F.lit(8)))) == "12.50"
    assert value(spark, s.percent(F.lit(1), F.lit(0))) is None


def test_money(spark):
    assert str(value(spark, s.safe_amount(F.lit(None)))) == "0.00"
    assert str(value(spark, s.safe_amount(F.lit("1.005").cast("decimal(10,3)")))) == "1.01"


def test_surrogate_key(spark):
    import hashlib

    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    df = spark.createDataFrame([(7, None)], "a int, b string")
    assert df.select(s.surrogate_key("a")).first()[0] == md5("7")
    assert df.select(s.surrogate_key("a", "b")).first()[0] == md5("7-_dbt_utils_surrogate_key_null_")


@pytest.mark.parametrize(
    "n, label", [(None, "Unknown"), (-1, "SMB"), (49, "SMB"), (50, "Mid-Market"), (499, "Mid-Market"), (500, "Enterprise"), (5000, "Strategic")]
)
def test_employee_segment(spark, n, label):
    assert value(spark, s.employee_segment(F.lit(n).cast("int"))) == label


def test_bands_and_labels(spark):
    assert value(spark, s.deal_size_band(F.lit(10_000))) == "Mid    ($10K–$50K)"
    assert value(spark, s.booking_category(F.lit(None).cast("string"))) == "Other"
    assert value(spark, s.coverage_health(F.lit(2.0))) == "⚠️  At Risk"
    assert value(spark, s.coverage_health(F.lit(None).cast("double"))) == "—"
    assert value(spark, s.fiscal_label(F.lit(2026), F.lit(None).cast("int"))) is None


def test_calendar(spark):
    c = dims.dim_date(spark, datetime(2026, 8, 2))
    assert c.count() == 4018 and len(c.columns) == 39
    row = c.filter("date_id = date'2021-01-01'").first()
    assert (row.week_of_year, row.day_of_week, row.day_of_week_name, row.month_name_short) == (53, 5, "Friday", "Jan")
    assert row.quarter_end_date == date(2021, 3, 31) and row.is_year_start and not row.is_future


def test_seeds(spark):
    stages = seeds.stage_order(spark).collect()
    assert [r.stage_order for r in stages] == list(range(1, 11))
    assert [r.stage_name for r in stages if not r.is_open] == ["Closed Won", "Closed Lost"]
    targets = {r.fiscal_quarter_label: int(r.bookings_target) for r in seeds.bookings_targets(spark).collect()}
    assert len(targets) == 12 and targets["FY2025-Q4"] == 1_750_000
