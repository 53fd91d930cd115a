import datetime as dt

from pyspark.sql import functions as F

from pedalytics.config import Compat
from pedalytics.plans import calendar


def test_one_row_per_day(spark):
    dates = calendar.dim_dates(spark)
    assert dates.count() == 6574 == dates.select("date_sk").distinct().count()


def test_doubled_holiday_is_kept_on_request(spark):
    dates = calendar.dim_dates(spark, compat=Compat(holiday_fanout=True))
    assert dates.count() == 6575
    names = {r[0] for r in dates.filter("date_sk = 20220117").select("holiday_name").collect()}
    assert names == {"MLK Day", "New Years Day (observed)"}
    [kept] = calendar.dim_dates(spark).filter("date_sk = 20220117").select("holiday_name").collect()
    assert kept[0] == "MLK Day"


def test_holidays(spark):
    rows = {(str(r[0]), r[1]) for r in calendar.holidays(spark).collect()}
    assert len(rows) == 190
    assert {
        ("2013-01-01", "New Years Day"), ("2017-01-02", "New Years Day (observed)"),
        ("2028-01-01", "New Years Day (observed)"), ("2015-07-04", "Independence Day (observed)"),
        ("2020-07-03", "Independence Day (observed)"), ("2021-06-19", "Juneteenth"),
        ("2022-06-19", "Juneteenth"), ("2027-06-18", "Juneteenth (observed)"),
        ("2016-12-26", "Christmas Day (observed)"), ("2027-12-24", "Christmas Day (observed)"),
        ("2018-11-12", "Veterans Day (observed)"), ("2030-01-21", "MLK Day"),
        ("2016-05-30", "Memorial Day"), ("2029-11-22", "Thanksgiving"),
        ("2030-10-14", "Columbus Day"), ("2015-09-07", "Labor Day"), ("2027-02-15", "Presidents Day"),
    } <= rows
    assert not any(name == "Juneteenth" and day < "2021" for day, name in rows)


def test_day_columns(spark):
    day = calendar.dim_dates(spark).filter("date_sk = 20210101").first()
    assert day["day_of_week_num"] == 5 and day["week_of_year"] == 53 and day["season"] == "Winter"
    assert (day["day_of_week_name"], day["day_of_week_short"]) == ("Friday", "Fri")
    assert (day["month_name"], day["month_short"], day["year_month"]) == ("January", "Jan", "2021-01")
    assert day["last_day_of_month"] == dt.date(2021, 1, 31)
    assert day["last_day_of_year"] == dt.date(2021, 12, 31)
    assert not day["is_weekend"] and day["is_holiday"]


def test_long_ranges_are_not_cut(spark):
    dates = calendar.dim_dates(spark, dt.date(1990, 1, 1), dt.date(2040, 12, 31))
    ends = dates.agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
    assert tuple(ends) == (dt.date(1990, 1, 1), dt.date(2040, 12, 31), 18_628)


def test_holidays_follow_their_rules_in_any_year(spark):
    days = calendar.dim_dates(spark, dt.date(2032, 12, 1), dt.date(2033, 12, 31))
    named = {r["full_date"].isoformat(): r["holiday_name"] for r in days.where("is_holiday").collect()}
    assert named["2032-12-31"] == "New Years Day (observed)" and named["2033-11-24"] == "Thanksgiving"
