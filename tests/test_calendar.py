from datetime import date, timedelta

from pyspark.sql import functions as F

from quayledger.operators import calendar as cal

# Easter Sundays.
EASTERS = [date(1999, 4, 4), date(2000, 4, 23), date(2019, 4, 21), date(2024, 3, 31), date(2025, 4, 20),
           date(2026, 4, 5), date(2038, 4, 25), date(2076, 4, 19)]


def holidays(spark, first, last):
    return {r.date for r in cal.public_holidays(spark, first, last).collect()}


def test_easter_days_are_holidays(spark):
    days = holidays(spark, 1990, 2099)
    for easter in EASTERS:
        for offset in (-2, -1, 0, 1, 60):
            assert easter + timedelta(days=offset) in days


def test_holidays_of_two_years(spark):
    days = holidays(spark, 2025, 2026)
    assert {date(2025, 10, 11), date(2025, 10, 13), date(2025, 10, 27)} <= days
    assert date(2025, 2, 1) not in days and date(2026, 2, 1) in days
    assert date(2026, 2, 2) in days  # 1 February 2026 is a Sunday
    assert date(2025, 6, 30) in days  # 29 June 2025 is a Sunday
    assert date(2026, 10, 11) not in days
    # 2025: 9 fixed, 1 Monday, 3 once, 5 moving; 2026: 10 fixed, 2 Mondays, 5 moving.
    assert len(days) == (9 + 1 + 3 + 5) + (10 + 2 + 5)


def test_one_row_per_holiday(spark):
    df = cal.public_holidays(spark, 1990, 2099)
    assert df.count() == df.distinct().count()


def test_day_names(spark):
    df = spark.createDataFrame(
        [(date(2025, 12, 25),), (date(2025, 12, 28),), (date(2025, 12, 29),), (None,)], "date date"
    )
    out = {r.date: r.day_name for r in cal.with_day_name(df).collect()}
    assert out == {date(2025, 12, 25): "PH", date(2025, 12, 28): "Sun", date(2025, 12, 29): "Mon", None: None}


def test_holidays_of_any_year(spark):
    spine = cal.date_spine(spark, date(1850, 1, 1), date(2250, 12, 31))
    computed = {r.date for r in spine.filter(cal.is_public_holiday("date")).collect()}
    assert computed == holidays(spark, 1850, 2250)


def test_week_table_of_a_year(spark):
    spine = cal.date_spine(spark, date(2025, 1, 1), date(2025, 12, 31))
    assert spine.count() == 365
    expected = {}
    for n in range(1, 366):
        day = date(2025, 1, 1) + timedelta(days=n - 1)
        expected.setdefault((n + 1) // 7 + 1, []).append(day)
    rows = cal.week_table(spine).collect()
    assert {r.week_num: (r.start_date, r.end_date) for r in rows} == {
        w: (min(d), max(d)) for w, d in expected.items()
    }


def test_ranges(spark):
    assert cal.month_range(2024, 2) == (date(2024, 2, 1), date(2024, 2, 29))
    assert cal.two_month_range(2025, 1) == (date(2024, 12, 1), date(2025, 1, 31))
    spine = cal.date_spine(spark, date(2025, 1, 1), date(2025, 12, 31))
    assert spine.filter(cal.in_range(F.col("date"), cal.month_range(2025, 3))).count() == 31
    assert spine.filter(cal.in_range(F.col("date"), None)).count() == 365
