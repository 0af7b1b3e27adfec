"""Tenure buckets and audience sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import week_boundaries_between
from ..params import Params

# Fixed bucket names of the reference.
FIRST_WEEK = "FIRST_WEEK"
SECOND_WEEK = "SECOND_WEEK"
THIRD_FOURTH_WEEK = "THIRD_FOURTH_WEEK"
SECOND_MONTH = "SECOND_MONTH"
THREE_PLUS_MONTHS = "THREE_PLUS_MONTHS"


def tenure_bucket(weeks) -> F.Column:
    """Bucket of a Sunday-week difference; branches are tested in order, so 4
    falls in THIRD_FOURTH_WEEK; below 1 (or NULL) gives NULL."""
    return (
        F.when(weeks == 1, F.lit(FIRST_WEEK))
        .when(weeks == 2, F.lit(SECOND_WEEK))
        .when(weeks.isin(3, 4), F.lit(THIRD_FOURTH_WEEK))
        .when((weeks >= 4) & (weeks < 8), F.lit(SECOND_MONTH))
        .when(weeks >= 8, F.lit(THREE_PLUS_MONTHS))
    )


def tenure_classification(audience_with_signup: DataFrame, params: Params) -> DataFrame:
    """+ tenure_classification from Sunday weeks between signup and the tenure date."""
    w = week_boundaries_between(F.lit(params.tenure_date), F.col("signup_date"))
    return audience_with_signup.withColumn("tenure_classification", tenure_bucket(w))


def audience_size(classification: DataFrame) -> DataFrame:
    """Distinct tracking ids per cohort x tenure over the whole audience.

    Groups are few and large (a third of all rows may sit in one), so the
    distinct count goes through Spark's partial (map-side) distinct
    aggregation: the shuffle carries (group, aid) pairs already deduplicated
    per map task, and no group is ever collected into one place.
    """
    return classification.groupBy("audiencecohort", "tenure_classification").agg(
        F.count_distinct("aid").alias("audience_size"))
