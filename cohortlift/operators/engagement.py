"""Viewing KPIs per cohort x tenure."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import ntz_midnight
from ..params import Params
from .audience import COPIES, copies

SHORTFORM = "shortform"
KEYS = ["audiencecohort", "tenure_classification"]


def new_program(consumption_type, program) -> F.Column:
    """Any short-form consumption (case-insensitive) counts as one title."""
    return F.when(F.lower(consumption_type).contains(SHORTFORM), F.lit(SHORTFORM)).otherwise(program)


def title_normalisation(video: DataFrame) -> DataFrame:
    """Started plays with ``new_program``."""
    return video.filter(F.col("num_views_started") == 1).withColumn(
        "new_program", new_program(F.col("consumption_type"), F.col("program")))


def window_plays(video: DataFrame, params: Params) -> DataFrame:
    """Started plays whose timestamp is in [start, start + window days)."""
    lo, hi = params.campaign_start_period, params.window_end_exclusive
    cond = (F.col("adobe_timestamp") >= ntz_midnight(lo)) & (F.col("adobe_timestamp") < ntz_midnight(hi))
    if params.prune_on_play_date:
        # lets a date-partitioned play table skip whole partitions; ``unpruned_plays`` counts what it would lose
        cond = cond & _near_window(params)
    return title_normalisation(video.filter(cond))


def _near_window(params: Params) -> F.Column:
    """The play date is in the window or at most the margin away from it."""
    margin = dt.timedelta(days=params.play_date_margin_days)
    last = params.window_end_exclusive - dt.timedelta(days=1) + margin
    return F.col("adobe_date").between(F.lit(params.campaign_start_period - margin), F.lit(last))


def unpruned_plays(video: DataFrame, params: Params) -> DataFrame:
    """(plays): started plays of the window, by their timestamp, that pruning on
    the play date would leave out (dates beyond the margin, or none).

    Reads three columns of the other partitions, and of them only row groups
    whose timestamps reach into the window.
    """
    lo, hi = params.campaign_start_period, params.window_end_exclusive
    stray = (F.col("adobe_timestamp") >= ntz_midnight(lo)) & (F.col("adobe_timestamp") < ntz_midnight(hi))
    stray = stray & (F.col("num_views_started") == 1) & ~F.coalesce(_near_window(params), F.lit(False))
    return video.filter(stray).agg(F.count(F.lit(1)).alias("plays"))


def per_viewer_totals(video: DataFrame, params: Params) -> DataFrame:
    """(aid, distinct_titles, starts, completes, seconds) per tracking id.

    Aggregating plays per viewer *before* the audience join is the key
    reduction: the play table is by far the largest input, and this way it is
    shuffled once, already combined map-side, as at most one row per
    (viewer, title) and then per viewer. A viewer with a huge share of plays
    is thus cut down to a few rows before any join.
    """
    return (
        window_plays(video, params)
        .groupBy(F.col("adobe_tracking_id").alias("aid"))
        .agg(
            F.count_distinct("new_program").alias("distinct_titles"),
            F.sum("num_views_started").alias("starts"),
            F.sum("num_views_completed").alias("completes"),
            F.sum("num_seconds_played_no_ads").alias("seconds"),
        )
    )


def _per_viewer(audience: DataFrame, totals: DataFrame, how: str) -> DataFrame:
    """One row per aid x cohort x tenure; an audience row that stands for
    several multiplies the sums, as joining every play to every row would."""
    joined = audience.select("aid", *KEYS, copies(audience).alias(COPIES)).join(totals, "aid", how)
    weighed = lambda c: F.sum(F.col(c) * F.col(COPIES))
    return joined.groupBy("aid", *KEYS).agg(
        F.max("distinct_titles").alias("distinct_titles"),
        weighed("starts").alias("content_starts"),
        weighed("completes").alias("content_completed"),
        (weighed("seconds") / F.lit(3600)).alias("total_hours"),
    )


def viewer_stats(video: DataFrame, classification: DataFrame, params: Params) -> DataFrame:
    """Per aid x cohort x tenure: distinct titles, starts, completes and hours.

    Same values as joining every play to every matching audience row and then
    grouping: a duplicated audience row multiplies the sums (as in the
    reference), the distinct title count is unaffected.
    """
    return _per_viewer(classification, per_viewer_totals(video, params), "inner")


def cohort_kpis(video: DataFrame, classification: DataFrame, params: Params) -> DataFrame:
    """KPIs and audience size per cohort x tenure (NULL tenure is a group of its own).

    One pass over the audience: its rows with a tracking id are left-joined to
    the viewers' totals and grouped per aid where they lie (the join's
    partitioning), so that one final group-by counts the audience (all rows)
    and the viewers (rows with totals) without a distinct count. A group
    without viewers has no row.
    """
    audience = classification.filter(F.col("aid").isNotNull())
    per = _per_viewer(audience, per_viewer_totals(video, params), "left")
    n = F.count("content_starts")
    return per.groupBy(*KEYS).agg(
        n.alias("conversions_watched_video"),
        (F.sum("distinct_titles") / n).alias("repertoire"),
        F.stddev_samp("distinct_titles").alias("repertoire_stddev"),
        (F.sum("content_starts") / n).alias("avg_starts"),
        (F.sum("total_hours") / n).alias("usage"),
        F.stddev_samp("total_hours").alias("usage_stdv"),
        (F.sum("content_completed") / F.sum("content_starts")).alias("avg_completion_rate"),
        F.sum("content_starts").alias("all_starts"),
        F.sum("content_completed").alias("all_completes"),
        F.count(F.lit(1)).alias("audience_size"),
    ).filter(F.col("conversions_watched_video") > 0)
