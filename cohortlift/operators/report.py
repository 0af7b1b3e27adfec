"""Labelled result tables (the notebook's formatting step)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L

KPI_COLUMNS = [
    "cohort", "targetable", "tenure_classification", "all_completes", "all_starts", "audience_size",
    "audiencecohort", "avg_completion_rate", "avg_starts", "conversions_watched_video", "repertoire",
    "repertoire_stdv", "usage", "usage_stdv",
]
SAVE_COLUMNS = ["cohort", "targetable", "tenure_classification", "saves", "save_rate_denom", "save_rate"]
WINBACK_COLUMNS = ["cohort", "targetable", "tenure_classification", "winbacks", "winback_rate_denom",
                   "winback_rate"]
SORT = ["cohort", "tenure_classification", "targetable"]


def labelled(df: DataFrame) -> DataFrame:
    """Drop the braze holdout row (a NULL label stays), add display cohort and arm."""
    lbl = F.col("audiencecohort")
    return (
        df.filter(~lbl.eqNullSafe(F.lit(L.BRAZE_LABEL)))
        .withColumn("cohort", L.campaign_display(L.label_part(lbl, 1)))
        .withColumn("targetable", L.arm_display(L.label_part(lbl, 0)))
    )


def _sorted(df: DataFrame) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(c) for c in SORT])


def kpi_report(kpis_with_size: DataFrame) -> DataFrame:
    df = labelled(kpis_with_size).withColumnRenamed("repertoire_stddev", "repertoire_stdv")
    return _sorted(df.select(*KPI_COLUMNS))


def save_report(save_rates: DataFrame) -> DataFrame:
    return _sorted(labelled(save_rates).select(*SAVE_COLUMNS))


def winback_report(winback_rates: DataFrame) -> DataFrame:
    return _sorted(labelled(winback_rates).select(*WINBACK_COLUMNS))
