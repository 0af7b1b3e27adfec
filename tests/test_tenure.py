import datetime as dt

from cohortlift.operators.tenure import audience_size, tenure_classification
from cohortlift.params import Params

AS_OF = dt.date(2020, 12, 9)  # a Wednesday


def _bucket(spark, signup):
    df = spark.createDataFrame([("a", 1, "c", signup)], "aid string, profileid long, audiencecohort string, "
                                                       "signup_date date")
    return tenure_classification(df, Params(as_of=AS_OF)).first()["tenure_classification"]


def test_buckets(spark):
    sun = dt.date(2020, 12, 6)  # week of as_of starts here
    d = dt.timedelta
    assert _bucket(spark, sun) is None  # same week: 0
    assert _bucket(spark, sun - d(1)) == "FIRST_WEEK"  # Saturday before
    assert _bucket(spark, sun - d(7)) == "FIRST_WEEK"
    assert _bucket(spark, sun - d(8)) == "SECOND_WEEK"
    assert _bucket(spark, sun - d(15)) == "THIRD_FOURTH_WEEK"  # w = 3
    assert _bucket(spark, sun - d(22)) == "THIRD_FOURTH_WEEK"  # w = 4: tested before SECOND_MONTH
    assert _bucket(spark, sun - d(29)) == "SECOND_MONTH"  # w = 5
    assert _bucket(spark, sun - d(43)) == "SECOND_MONTH"  # w = 7
    assert _bucket(spark, sun - d(50)) == "THREE_PLUS_MONTHS"  # w = 8 (a Saturday)
    assert _bucket(spark, sun - d(57)) == "THREE_PLUS_MONTHS"  # w = 8
    assert _bucket(spark, None) is None
    assert _bucket(spark, AS_OF + d(30)) is None  # negative


def test_audience_size_counts_distinct_non_null(spark):
    df = spark.createDataFrame(
        [("a", "c", "T"), ("a", "c", "T"), (None, "c", "T"), ("b", "c", "T"), ("a", "c", None)],
        "aid string, audiencecohort string, tenure_classification string")
    got = {(r.audiencecohort, r.tenure_classification): r.audience_size for r in audience_size(df).collect()}
    assert got == {("c", "T"): 2, ("c", None): 1}


def test_random_dates_against_python_reference(spark):
    import random

    from pyspark.sql import functions as F

    from cohortlift.functions.dates import week_boundaries_between
    from cohortlift.operators.tenure import tenure_bucket

    def weeks(later, earlier):
        # Sunday-started weeks: shift so that Sunday is day 0, count week starts crossed
        start = lambda d: d - dt.timedelta(days=(d.weekday() + 1) % 7)
        return (start(later) - start(earlier)).days // 7

    def bucket(w):
        if w == 1:
            return "FIRST_WEEK"
        if w == 2:
            return "SECOND_WEEK"
        if w in (3, 4):
            return "THIRD_FOURTH_WEEK"
        if 4 <= w < 8:
            return "SECOND_MONTH"
        if w >= 8:
            return "THREE_PLUS_MONTHS"
        return None

    rnd = random.Random(7)
    base = dt.date(2019, 1, 1)
    pairs = [(base + dt.timedelta(days=rnd.randrange(900)), base + dt.timedelta(days=rnd.randrange(900)))
             for _ in range(2000)]
    df = spark.createDataFrame(pairs, "a date, b date")
    w = week_boundaries_between(F.col("a"), F.col("b"))
    got = df.select("a", "b", w.alias("w"), tenure_bucket(w).alias("t")).collect()
    for r in got:
        assert r.w == weeks(r.a, r.b), (r.a, r.b)
        assert r.t == bucket(r.w)
