import datetime

import pytest
from pyspark.sql import functions as F

from factspark.functions import dates
from factspark.plans.settings import Settings


def test_spelled_and_days(spark):
    rows = spark.createDataFrame([("1988-01-22T00:00:00Z", "+1988-01-22T00:00:00Z"), ("2026-00-00", ""), (None, None)], "a string, b string")
    got = rows.select(dates.day(F.col("a")), dates.spelled(F.col("a")), dates.signed_day(F.col("b"))).collect()
    assert [tuple(r) for r in got] == [("1988-01-22", "22 January 1988", "1988-01-22"), ("2026-00-00", None, None), (None, None, None)]


def test_ages(spark):
    cases = [("2000-02-29", "2000-03-01", "2023-02-28", 0), ("1990-05-05", "1992-05-06", "2020-05-05", 3), ("2021-01-01", "1990-01-01", "2020-01-01", None), ("1990-00-00", "1990-01-01", "2020-01-01", None)]
    rows = spark.createDataFrame(cases, "a string, b string, e string, want int")
    assert all(r.gap == r.want for r in rows.select(dates.age_gap(F.col("a"), F.col("b"), F.col("e")).alias("gap"), "want").collect())
    rows = spark.createDataFrame([(datetime.date(2000, 2, 29), datetime.date(2023, 2, 28))], "a date, b date")
    assert rows.select(dates.age_on(F.col("a"), F.col("b"))).first()[0] == 22


def test_settled(spark):
    rows = spark.createDataFrame([("2026-02-19",), ("2026-12-01",), ("2026-05-05",), ("2026-00-00",)], "d string")
    assert [r[0] for r in rows.select(dates.settled(F.col("d"), "2026-05-05")).collect()] == [True, False, True, None]


@pytest.mark.parametrize(("given", "start"), [("2026", "2026-01-01"), ("2026-05", "2026-05-01"), ("2026-05-09", "2026-05-09"), (" 2026 ", "2026-01-01")])
def test_target_time(given, start):
    settings = Settings(given, run_date="2026-06-01")
    assert settings.target_start_date == start and settings.date_upper_bound == "2026-06-01"


@pytest.mark.parametrize("given", ["2026-99", "26", "2026-1", "2026-02-30", "", "2026-01-01-01"])
def test_target_time_errors(given):
    with pytest.raises(ValueError):
        Settings(given)
