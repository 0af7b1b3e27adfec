"""Explicit schemas of the analysis's input tables (only the columns used).

Column names are lower-case versions of the reference's warehouse columns.
Profile and household ids keep the type their source has (``_ANY``).
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_ANY = T.NullType()

HOLDOUT_BACKFILL = T.StructType([
    T.StructField("identity_value", _S),
    T.StructField("identity_type", _S),
])

AUDIENCE_LIST = T.StructType([
    T.StructField("identityvalues_other_id_5", _S),
    T.StructField("audiencename", _S),
])

CUSTOMER_KEYS = T.StructType([
    T.StructField("profileid", _ANY),
    T.StructField("externalprofilerid", _S),
    T.StructField("partnerorsystemid", _S),
])

ACCOUNT_VIEW = T.StructType([
    T.StructField("householdid", _ANY),
    T.StructField("targetedoptindate", T.TimestampType()),
])

SILVER_VIDEO = T.StructType([
    T.StructField("adobe_tracking_id", _S),
    T.StructField("adobe_timestamp", T.TimestampNTZType()),
    T.StructField("adobe_date", T.DateType()),
    T.StructField("consumption_type", _S),
    T.StructField("program", _S),
    T.StructField("num_views_started", _I),
    T.StructField("num_views_completed", _I),
    T.StructField("num_seconds_played_no_ads", _D),
])

DAILY_LAST_VIEW_STATUS = T.StructType([
    T.StructField("report_date", T.DateType()),
    T.StructField("tracking_id", _S),
    T.StructField("most_recent_start", T.DateType()),
])

# Result tables handed over as CSV (GeneralMetrics / SaveRates / WinbackRates)
GENERAL_METRICS = T.StructType([
    T.StructField("audiencecohort", _S),
    T.StructField("tenure_classification", _S),
    T.StructField("conversions_watched_video", _L),
    T.StructField("repertoire", _D),
    T.StructField("repertoire_stddev", _D),
    T.StructField("avg_starts", _D),
    T.StructField("usage", _D),
    T.StructField("usage_stdv", _D),
    T.StructField("avg_completion_rate", _D),
    T.StructField("all_starts", _L),
    T.StructField("all_completes", _L),
    T.StructField("audience_size", _L),
])

SAVE_RATES = T.StructType([
    T.StructField("audiencecohort", _S),
    T.StructField("tenure_classification", _S),
    T.StructField("save_rate_denom", _L),
    T.StructField("saves", _L),
    T.StructField("save_rate", _D),
])

WINBACK_RATES = T.StructType([
    T.StructField("audiencecohort", _S),
    T.StructField("tenure_classification", _S),
    T.StructField("winback_rate_denom", _L),
    T.StructField("winbacks", _L),
    T.StructField("winback_rate", _D),
])


def conform(df, schema: T.StructType):
    """Select and cast a DataFrame's columns to ``schema`` (by name)."""
    from pyspark.sql import functions as F

    return df.select([
        F.col(f.name) if f.dataType == _ANY else F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
