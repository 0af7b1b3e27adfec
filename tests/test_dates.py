import datetime as dt

from pyspark.sql import functions as F

from cohortlift.functions.dates import local_date, sunday_week, week_boundaries_between
from cohortlift.params import FIXTURE_PARAMS, Params, last_day_of_month


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_sunday_week_counts_boundaries(spark):
    sat, sun = dt.date(2020, 12, 5), dt.date(2020, 12, 6)
    assert _one(spark, week_boundaries_between(F.lit(sun), F.lit(sat))) == 1
    # Sunday to the next Saturday: same week
    assert _one(spark, week_boundaries_between(F.lit(dt.date(2020, 12, 12)), F.lit(sun))) == 0
    # 13 days, but only one boundary (Sun -> Sat next week)
    assert _one(spark, week_boundaries_between(F.lit(dt.date(2020, 12, 19)), F.lit(sun))) == 1
    assert _one(spark, sunday_week(F.lit(dt.date(1970, 1, 4)))) == 0
    assert _one(spark, sunday_week(F.lit(dt.date(1970, 1, 3)))) == -1


def test_utc_early_morning_is_previous_new_york_day(spark):
    ts = F.to_timestamp(F.lit("2020-12-02 03:30:00"))
    assert _one(spark, local_date(ts)) == dt.date(2020, 12, 1)
    ts = F.to_timestamp(F.lit("2020-12-02 05:30:00"))
    assert _one(spark, local_date(ts)) == dt.date(2020, 12, 2)


def test_dst_days(spark):
    # 2020-03-08: clocks go forward at 07:00 UTC; 2020-11-01: back at 06:00 UTC
    assert _one(spark, local_date(F.to_timestamp(F.lit("2020-03-08 04:59:00")))) == dt.date(2020, 3, 7)
    assert _one(spark, local_date(F.to_timestamp(F.lit("2020-03-09 03:59:00")))) == dt.date(2020, 3, 8)
    assert _one(spark, local_date(F.to_timestamp(F.lit("2020-03-09 04:00:00")))) == dt.date(2020, 3, 9)
    assert _one(spark, local_date(F.to_timestamp(F.lit("2020-11-02 04:59:00")))) == dt.date(2020, 11, 1)
    assert _one(spark, local_date(F.to_timestamp(F.lit("2020-11-02 05:00:00")))) == dt.date(2020, 11, 2)


def test_local_date_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        ts = F.timestamp_seconds(F.lit(1606879800))  # 2020-12-02 03:30 UTC
        assert _one(spark, local_date(ts)) == dt.date(2020, 12, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_windows():
    assert Params(campaign_start_period=dt.date(2020, 12, 1)).window_days == 31
    assert Params(campaign_start_period=dt.date(2021, 2, 1)).window_days == 28
    assert Params(campaign_start_period=dt.date(2020, 2, 1)).window_days == 29
    # a mid-month start runs to the end of the same month (not the next one)
    assert Params(campaign_start_period=dt.date(2021, 1, 31)).window_days == 1
    assert last_day_of_month(dt.date(2021, 1, 31)) == dt.date(2021, 1, 31)
    assert Params(winback_report_start=dt.date(2021, 2, 1)).winback_report_end == dt.date(2021, 2, 28)
    p = Params(campaign_start_period=dt.date(2020, 12, 1)).with_custom_window_end(dt.date(2020, 12, 16))
    assert p.window_days == 15 and p.window_end_exclusive == dt.date(2020, 12, 16)
    assert FIXTURE_PARAMS.tenure_threshold == dt.date(1996, 3, 27)
    assert FIXTURE_PARAMS.winback_signup_ceiling == dt.date(1996, 2, 29)


def test_ntz_midnight_independent_of_session_zone(spark):
    from cohortlift.functions.dates import ntz_midnight

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        v = _one(spark, ntz_midnight(dt.date(2020, 12, 1)).cast("string"))
        assert v == "2020-12-01 00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
