"""Lapsing viewers, save rate and winback rate.

The daily last-view status is kept as validity ranges: (tracking_id,
most_recent_start, since, until) says that on all report days from ``since`` to
``until`` the viewer's latest start was ``most_recent_start``. Both lapse bands,
the viewers' earliest lapse and the denominators follow from the ranges by date
arithmetic; days are expanded only where the result lists them
(``daily_last_view``, ``lapsing_*``). A given daily status table is read as
ranges of one day each.

The reference joins lapses to plays on the viewer with a date-range residual
and takes DISTINCT afterwards, which is many-to-many per viewer. Here each
side is first reduced to what the predicate needs, so every join is an
equi-join of one row per viewer on each side, however many plays a viewer has:

* save: a lapse (viewer, start) is saved by a play 15..29 days after start;
  each viewer's starts in the window and play days (both bounded by the
  calendar) are compared within the row;
* winback: "some play >= some start + 30" is "latest play >= earliest start + 30".
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import Params

KEYS = ["audiencecohort", "tenure_classification"]
RANGE = ["tracking_id", "most_recent_start", "since", "until"]
_ONE_DAY = dt.timedelta(days=1)
_NO_DAYS = "CAST(array() AS array<date>)"


def _points(days: DataFrame, lo: dt.date) -> DataFrame:
    """Each viewer's distinct days (tracking_id, d) from ``lo`` on, and the latest one before it."""
    day = F.greatest(F.col("d"), F.lit(lo - _ONE_DAY))
    return days.groupBy("tracking_id", day.alias("day")).agg(F.max("d").alias("d")).select("tracking_id", "d")


def play_points(video: DataFrame, params: Params) -> DataFrame:
    """(tracking_id, d): all that status and returns need of the plays, in one scan.

    The distinct days with a started play from ``params.status_start`` to the
    last day on which a return counts, plus the latest such day before. Per
    viewer at most (days in that time + 1) rows, however many plays.
    """
    starts = video.filter((F.col("num_views_started") == 1) & (F.col("adobe_date") <= F.lit(params.last_return_day)))
    return _points(starts.select(F.col("adobe_tracking_id").alias("tracking_id"), F.col("adobe_date").alias("d")), params.status_start)


def _ranges(points: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    """The ranges between ``lo`` and ``hi``: each day holds until the viewer's next one (``lead``)."""
    nxt = F.lead("d").over(Window.partitionBy("tracking_id").orderBy("d"))
    return points.select(
        "tracking_id", F.col("d").alias("most_recent_start"),
        F.greatest(F.col("d"), F.lit(lo)).alias("since"),
        F.least(F.coalesce(F.date_sub(nxt, 1), F.lit(hi)), F.lit(hi)).alias("until"),
    ).filter(F.col("since") <= F.col("until"))  # the anchor is empty when a start falls on the first day


def last_view_ranges(plays: DataFrame, params: Params, through: dt.date | None = None) -> DataFrame:
    """The daily status from ``params.status_start`` to ``through`` (default:
    ``status_end``) as ranges, from the plays or their ``play_points``.

    A viewer has a range for each start day at most, so a viewer with a third
    of all plays is still a small partition of the window.
    """
    points = play_points(plays, params) if "adobe_tracking_id" in plays.columns else plays
    return _ranges(points, params.status_start, through or params.status_end)


def advance(ranges: DataFrame, plays: DataFrame, params: Params, done: dt.date, through: dt.date) -> DataFrame:
    """The ranges through ``through``, from those through ``done`` and the plays
    that have arrived since: those of the new days and late ones of any day.

    Only viewers with such plays are rebuilt, from their ranges' starts and the
    new days. All others' last range is prolonged, without a window. Plays after
    ``through`` belong to a later step.
    """
    new = play_points(plays, params).filter(F.col("d") <= F.lit(through))
    touched = new.select("tracking_id").distinct()
    until = F.when(F.col("until") == F.lit(done), F.lit(through)).otherwise(F.col("until"))
    kept = ranges.join(touched, "tracking_id", "left_anti").withColumn("until", until)
    old = ranges.join(touched, "tracking_id", "left_semi").select("tracking_id", F.col("most_recent_start").alias("d"))
    again = _ranges(_points(old.union(new), params.status_start), params.status_start, through)
    return kept.select(*RANGE).union(again.select(*RANGE))


def as_ranges(status: DataFrame) -> DataFrame:
    """Ranges as they are; the rows of a daily status as ranges of one day."""
    if "since" in status.columns:
        return status
    return status.select("tracking_id", "most_recent_start", F.col("report_date").alias("since"), F.col("report_date").alias("until"))


def expand_days(ranges: DataFrame) -> DataFrame:
    """(report_date, tracking_id, most_recent_start), one row per day of each range."""
    return ranges.select(F.explode(F.sequence("since", "until")).alias("report_date"), "tracking_id", "most_recent_start")


def daily_last_view(video: DataFrame, params: Params) -> DataFrame:
    """(report_date, tracking_id, most_recent_start) for each day from
    ``params.status_start`` to ``status_end`` on which the viewer has a started
    play on or before it: the ranges, expanded. No days x plays join."""
    return expand_days(last_view_ranges(video, params))


def _bands(lo: dt.date, hi: dt.date, gap_min: int, gap_max: int | None) -> list[tuple[Column, Column]]:
    """First and last lapse day of a range between ``lo`` and ``hi``, gap_min..gap_max days after
    its start, and as many before it (the reference compares the absolute gap); empty if first > last."""
    start, since, until = F.col("most_recent_start"), F.col("since"), F.col("until")
    floor, ceiling = F.greatest(since, F.lit(lo)), F.least(until, F.lit(hi))
    after_last = ceiling if gap_max is None else F.least(ceiling, F.date_add(start, gap_max))
    before_first = floor if gap_max is None else F.greatest(floor, F.date_sub(start, gap_max))
    return [
        (F.greatest(floor, F.date_add(start, gap_min)), after_last),
        (before_first, F.least(ceiling, F.date_sub(start, max(gap_min, 1)))),
    ]


def _save_bands(params: Params):
    return _bands(max(params.launch_date, params.save_report_start), params.save_report_end, params.save_gap_min, params.save_gap_max)


def _winback_bands(params: Params):
    return _bands(params.launch_date, params.winback_report_end, params.winback_gap_min, None)


def _lapse_days(status: DataFrame, bands) -> DataFrame:
    days = F.concat(*[F.when(a <= b, F.sequence(a, b)).otherwise(F.expr(_NO_DAYS)) for a, b in bands])
    rows = as_ranges(status).select(F.explode(days).alias("report_date"), "tracking_id", "most_recent_start")
    return rows if "since" in status.columns else rows.distinct()  # derived ranges do not overlap


def _lapses(status: DataFrame, bands) -> DataFrame:
    (a, b), (c, d) = bands
    return as_ranges(status).filter((a <= b) | (c <= d)).select("tracking_id", "most_recent_start")


def lapsing_save(status: DataFrame, params: Params) -> DataFrame:
    """Distinct lapse rows in the save window with a 15..29-day gap."""
    return _lapse_days(status, _save_bands(params))


def lapsing_winback(status: DataFrame, params: Params) -> DataFrame:
    """Distinct lapse rows up to the winback month end with a gap of 30+ days."""
    return _lapse_days(status, _winback_bands(params))


def save_lapses(status: DataFrame, params: Params) -> DataFrame:
    """(tracking_id, most_recent_start) of the ranges with a day in ``lapsing_save``, without their days."""
    return _lapses(status, _save_bands(params))


def winback_lapses(status: DataFrame, params: Params) -> DataFrame:
    """(tracking_id, most_recent_start) of the ranges with a day in ``lapsing_winback``, without their days."""
    return _lapses(status, _winback_bands(params))


def _play_days(plays: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    """(tracking_id, day) of started plays between two days, from the plays or their ``play_points``."""
    if "adobe_tracking_id" not in plays.columns:
        return plays.filter(F.col("d").between(F.lit(lo), F.lit(hi))).select("tracking_id", F.col("d").alias("day"))
    return plays.filter(
        (F.col("num_views_started") == 1) & F.col("adobe_date").between(F.lit(lo), F.lit(hi))
    ).select(F.col("adobe_tracking_id").alias("tracking_id"), F.col("adobe_date").alias("day"))


def save_flags(plays: DataFrame, lapses: DataFrame, params: Params) -> DataFrame:
    """(tracking_id, back): every lapsing viewer once, back = 1 if saved, else NULL.

    One aggregation gives each lapser's distinct starts inside the save window,
    one each viewer's distinct play days in the days that can save (both sets
    are bounded by the calendar). They meet in one row per viewer.
    """
    rs, re = params.save_report_start, params.save_report_end
    lo_gap, hi_gap = params.save_gap_min, params.save_gap_max
    start = F.col("most_recent_start")
    starts = lapses.groupBy("tracking_id").agg(F.collect_set(F.when(start.between(F.lit(rs), F.lit(re)), start)).alias("starts"))
    # the play-date bounds follow from the start bounds; stated so the scan prunes
    days = _play_days(plays, rs + lo_gap * _ONE_DAY, re + hi_gap * _ONE_DAY)
    days = days.groupBy("tracking_id").agg(F.collect_set("day").alias("days"))
    saved = F.exists("starts", lambda s: F.exists("days", lambda d: d.between(F.date_add(s, lo_gap), F.date_add(s, hi_gap))))
    return starts.join(days, "tracking_id", "left").select("tracking_id", F.when(saved, F.lit(1)).alias("back"))


def returning_save(plays: DataFrame, lapses: DataFrame, params: Params) -> DataFrame:
    """(adobe_tracking_id): viewers with a started play 15..29 days after a
    lapse start that lies inside the save window."""
    return save_flags(plays, lapses, params).filter(F.col("back").isNotNull()).select(
        F.col("tracking_id").alias("adobe_tracking_id"))


def winback_flags(plays: DataFrame, lapses: DataFrame, params: Params) -> DataFrame:
    """(tracking_id, back): every lapsing viewer once, back = 1 if won back, else NULL.

    One aggregation of the lapses gives both the lapser set and each lapser's
    earliest start; one aggregation of the month's plays gives each viewer's
    latest play.
    """
    first = lapses.groupBy("tracking_id").agg(F.min("most_recent_start").alias("first_start"))
    last = _play_days(plays, params.winback_report_start, params.winback_report_end).groupBy(
        "tracking_id").agg(F.max("day").alias("last_play"))
    won = F.col("last_play") >= F.date_add("first_start", params.winback_gap_min)
    return first.join(last, "tracking_id", "left").select(
        "tracking_id", F.when(won, F.lit(1)).alias("back"))


def returning_winback(plays: DataFrame, lapses: DataFrame, params: Params) -> DataFrame:
    """(adobe_tracking_id): viewers with a started play in the winback month
    30+ days after one of their lapse starts."""
    return winback_flags(plays, lapses, params).filter(F.col("back").isNotNull()).select(
        F.col("tracking_id").alias("adobe_tracking_id"))


def _rate(classification: DataFrame, flagged: DataFrame, signup_ok: F.Column,
          denom: str, num: str, rate: str) -> DataFrame:
    """Per cohort x tenure: distinct lapsing viewers, distinct returning ones, ratio.

    Deduplication happens after the join on aid, where the data is already
    partitioned by aid, so the only further shuffle is the partial-aggregated
    one of the final (tiny) group-by.
    """
    aud = classification.filter(signup_ok).select("aid", *KEYS)
    j = aud.join(flagged, aud.aid == flagged.tracking_id)
    per_viewer = j.groupBy("aid", *KEYS).agg(F.max("back").alias("back"))
    return per_viewer.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias(denom),
        F.count("back").alias(num),
        (F.count("back") / F.count(F.lit(1))).alias(rate),
    )


def save_rate(classification: DataFrame, lapses: DataFrame, plays: DataFrame, params: Params) -> DataFrame:
    """Save rate; the saved viewers are derived from ``lapses`` and the plays in one pass."""
    ok = F.col("signup_date") >= F.lit(params.save_signup_floor)
    return _rate(classification, save_flags(plays, lapses, params), ok, "save_rate_denom", "saves", "save_rate")


def winback_rate(classification: DataFrame, lapses: DataFrame, plays: DataFrame, params: Params) -> DataFrame:
    """Winback rate; the returning viewers are derived from ``lapses`` and the plays in one pass."""
    ok = F.col("signup_date").between(F.lit(params.winback_signup_floor), F.lit(params.winback_signup_ceiling))
    return _rate(classification, winback_flags(plays, lapses, params), ok,
                 "winback_rate_denom", "winbacks", "winback_rate")
