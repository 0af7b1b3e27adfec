"""``queries()``: one entry per operator, each run over the driver's tables.

Every callable takes (spark, sf_dir) and returns the operator's result as one
lazy plan from the driver's parquet tables: the reference's input tables are
views over them (``sources.fixtures``), and each key computes all steps from
there. Nothing is written (but for the CSV hand-off of the csv_roundtrip
keys), kept between calls or set on the session.

Doubles are rounded to 6 decimals at the outermost projection (the oracle
does the same), since floating sums differ in order between engines.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import lapse as LP
from ..operators.audience import expanded
from ..params import FIXTURE_PARAMS, Params
from ..session import shared_dir
from ..sources import csv as CSV
from ..sources import schemas as S
from ..sources.fixtures import view_inputs
from .analysis import Analysis

ROUND = 6


def round_doubles(df: DataFrame, digits: int = ROUND) -> DataFrame:
    cols = [
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def analysis(spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS) -> Analysis:
    return Analysis(view_inputs(spark, sf_dir, params), params)


def _q(build: Callable[[Analysis], DataFrame], params: Params = FIXTURE_PARAMS):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(build(analysis(spark, sf_dir, params)))

    return run


def _csv_roundtrip(attr: str, schema: T.StructType):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{shared_dir(spark)}/csv/{attr}-{uuid.uuid4().hex}"
        CSV.write_csv(S.conform(getattr(analysis(spark, sf_dir), attr), schema), path)
        return round_doubles(CSV.read_csv(spark, path, schema))

    return run


def _status_by_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily status carried on in two steps, as a daily job would.

    Plays arrive with their day's step; about one in 13 comes a step late.
    """
    p = FIXTURE_PARAMS
    ends = [p.status_end - dt.timedelta(days=9), p.status_end - dt.timedelta(days=2), p.status_end]
    day = F.col("adobe_date")
    step = F.when(day <= F.lit(ends[0]), 0).when(day <= F.lit(ends[1]), 1).otherwise(2)
    late = (F.crc32(F.concat("adobe_tracking_id", day.cast("string"))) % 13 == 0).cast("int")
    plays = analysis(spark, sf_dir).i.silver_video.withColumn("step", F.least(step + late, F.lit(2)))
    ranges = LP.last_view_ranges(plays.filter("step = 0"), p, ends[0])
    for k in (1, 2):
        ranges = LP.advance(ranges, plays.filter(F.col("step") == k), p, ends[k - 1], ends[k])
    return LP.expand_days(ranges)


NO_TENURE = FIXTURE_PARAMS.replace(tenure_days=0)
# the checklist's custom window: end of analysis + 1 day
CUSTOM_WINDOW = FIXTURE_PARAMS.with_custom_window_end(FIXTURE_PARAMS.campaign_start_period.replace(day=16))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "holdout_groups": _q(lambda p: p.holdout_groups),
    "household_signup": _q(lambda p: p.household_signup),
    "holdout_users": _q(lambda p: expanded(p.holdout_users)),
    "holdout_users_no_tenure": _q(lambda p: expanded(p.holdout_users), NO_TENURE),
    "targetable_control": _q(lambda p: p.targetable("control")),
    "targetable_paidsoc": _q(lambda p: p.targetable("paidsoc")),
    "targetable_paiddis": _q(lambda p: p.targetable("paiddis")),
    "targetable_master": _q(lambda p: p.targetable_master),
    "targetable_users": _q(lambda p: p.targetable_users),
    "all_audience": _q(lambda p: expanded(p.all_audience)),
    "audience_signup": _q(lambda p: expanded(p.audience_signup)),
    "adopter_group": _q(lambda p: expanded(p.adopter_group)),
    "tenure_classification": _q(lambda p: expanded(p.classification)),
    "audience_size": _q(lambda p: p.audience_size),
    "audience_losses": _q(lambda p: p.losses()),
    "title_normalisation": _q(lambda p: p.title_normalisation),
    "viewer_stats": _q(lambda p: p.viewer_stats),
    "cohort_kpis": _q(lambda p: p.cohort_kpis),
    "cohort_kpis_custom_window": _q(lambda p: p.cohort_kpis, CUSTOM_WINDOW),
    "daily_last_view": _q(lambda p: p.daily_last_view),
    "daily_last_view_incremental": _status_by_steps,
    "last_view_ranges": _q(lambda p: p.last_view_ranges),
    "lapsing_save": _q(lambda p: p.lapsing_save),
    "returning_save": _q(lambda p: p.returning_save),
    "save_rate": _q(lambda p: p.save_rate),
    "lapsing_winback": _q(lambda p: p.lapsing_winback),
    "returning_winback": _q(lambda p: p.returning_winback),
    "winback_rate": _q(lambda p: p.winback_rate),
    "kpi_report": _q(lambda p: p.kpi_report),
    "save_report": _q(lambda p: p.save_report),
    "winback_report": _q(lambda p: p.winback_report),
    "repertoire_significance": _q(lambda p: p.repertoire_significance()),
    "usage_significance": _q(lambda p: p.usage_significance()),
    "engagement_significance": _q(lambda p: p.engagement_significance()),
    "conversion_significance": _q(lambda p: p.conversion_significance()),
    "save_significance": _q(lambda p: p.save_significance()),
    "winback_significance": _q(lambda p: p.winback_significance()),
    "csv_roundtrip_general": _csv_roundtrip("cohort_kpis", S.GENERAL_METRICS),
    "csv_roundtrip_save": _csv_roundtrip("save_rate", S.SAVE_RATES),
    "csv_roundtrip_winback": _csv_roundtrip("winback_rate", S.WINBACK_RATES),
}
