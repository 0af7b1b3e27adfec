"""The daily status as validity ranges, and its day-by-day continuation."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortlift.operators import lapse as LP
from test_lapse import DLV, P, V, D, _plays, brute_dlv

DAY = dt.timedelta(days=1)


def days_of(ranges):
    rows = [tuple(r) for r in LP.expand_days(ranges).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed", [21, 22])
def test_status_carried_on_equals_the_rebuilt_one(spark, seed):
    """Three steps of a few days, with late plays (before the launch too), plays on the
    first day, viewers that are new, that return and that never come back."""
    rnd = random.Random(seed)
    plays = _plays(seed, viewers=9, n=160) + _plays(seed + 50, viewers=2, n=4)
    plays += [("old", dt.datetime(2020, 7, 1), D(2020, 7, 1) + k * DAY, "X", "p", 1, 0, 1.0) for k in (0, 5, 28, 29)]
    ends = [P.status_end - 40 * DAY, P.status_end - 39 * DAY, P.status_end - 5 * DAY, P.status_end]
    arrives = []
    for p in plays:
        own = next((k for k, e in enumerate(ends) if p[2] <= e), len(ends) - 1)
        arrives.append(rnd.choice([own, own, own, min(own + 1, 3), 3]))
    batch = lambda k: spark.createDataFrame([p for p, a in zip(plays, arrives, strict=True) if a == k], V)
    ranges = LP.last_view_ranges(batch(0), P, ends[0])
    for k in (1, 2, 3):
        ranges = spark.createDataFrame(LP.advance(ranges, batch(k), P, ends[k - 1], ends[k]).collect(), ranges.schema)
        known = [p for p, a in zip(plays, arrives, strict=True) if a <= k]
        assert days_of(ranges) == brute_dlv(known, P.status_start, ends[k])


def test_a_step_without_plays_prolongs_the_last_ranges(spark):
    ranges = LP.last_view_ranges(spark.createDataFrame(_plays(3), V), P, P.status_end - DAY)
    longer = LP.advance(ranges, spark.createDataFrame([], V), P, P.status_end - DAY, P.status_end)
    starts = {p[0] for p in _plays(3) if p[5] == 1 and p[2] <= P.status_end - DAY}
    assert {r.tracking_id for r in longer.filter(F.col("until") == F.lit(P.status_end)).collect()} == starts


def test_a_given_daily_status_in_any_order_of_days(spark):
    """Starts after the report day, repeated rows and days left out: the literal filter, on ranges of one day."""
    rnd = random.Random(8)
    rows = [(D(2020, 11, 25) + rnd.randrange(45) * DAY, f"v{rnd.randrange(4)}", D(2020, 11, 1) + rnd.randrange(90) * DAY) for _ in range(200)]
    status = spark.createDataFrame(rows + rows[:20], DLV)
    gap = lambda r: abs((r[0] - r[2]).days)
    save = {r for r in rows if P.save_report_start <= r[0] <= P.save_report_end and 15 <= gap(r) <= 29}
    winback = {r for r in rows if P.launch_date <= r[0] <= P.winback_report_end and gap(r) >= 30}
    for listed, lapses, want in ((LP.lapsing_save, LP.save_lapses, save), (LP.lapsing_winback, LP.winback_lapses, winback)):
        found = [tuple(r) for r in listed(status, P).collect()]
        assert sorted(found) == sorted(want)
        assert {tuple(r) for r in lapses(status, P).collect()} == {(v, s) for _, v, s in want}


def test_rates_expand_no_days(spark):
    video = spark.createDataFrame([], V)
    audience = spark.createDataFrame([], "aid string, profileid long, audiencecohort string, signup_date date, tenure_classification string")
    ranges = LP.last_view_ranges(video, P)
    for rate, lapses in ((LP.save_rate, LP.save_lapses), (LP.winback_rate, LP.winback_lapses)):
        plan = rate(audience, lapses(ranges, P), video, P)._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and "sequence(" not in plan
    assert "Generate" in LP.lapsing_save(ranges, P)._jdf.queryExecution().analyzed().toString()
