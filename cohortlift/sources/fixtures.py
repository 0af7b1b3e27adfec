"""Adapters: the reference's input tables as views over the driver's tables.

The reference ships no data. These views give its inputs deterministic
contents derived from ``customer``, ``orders``, ``lineitem`` and ``part`` (the
rules are in FIXTURES.md; ``k`` is ``c_custkey``), so every query's work grows
with the driver's scale factor. ``oracle.py`` holds the same rules as DuckDB
CTEs; keep the two in step.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import AUDIENCE_LIST_NAMES
from ..params import FIXTURE_PARAMS, Params
from . import schemas as S
from .tables import read_table

# Fixed values of the fixture rules.
OPTIN_BASE_UTC = dt.datetime(1996, 4, 2, 3, 30, 0)  # evening of 04-01 in New York
OPTIN_SPREAD_DAYS = 90
OPTIN_SECOND_ROW_DAYS = 10
UNRELATED_AUDIENCE = "Weekly-Newsletter-Subscribers"
# k % 20 -> audience name
_AUDIENCE_BY_RESIDUE = {**dict(zip((0, 11, 2, 3), AUDIENCE_LIST_NAMES, strict=True)), 14: UNRELATED_AUDIENCE}
# backfill table -> residue of k % 10 (the e-mail rows are k % 100 = 90 + residue)
BACKFILL_RESIDUES = {
    "all_media_holdout_backfill": 0,
    "paid_social_holdout_backfill": 1,
    "paid_display_holdout_backfill": 2,
    "paid_braze_holdout_backfill": 3,
}


class Inputs:
    """The analysis's input tables, as DataFrames.

    Each table is given either as a DataFrame or as a zero-argument builder,
    which is called on first use; a query then only plans the inputs it reads.
    Without a ``daily_last_view_status`` (None) the status is derived from the plays.
    """

    _NAMES = ("backfills", "audience_list", "customer_keys", "account_view", "silver_video",
              "daily_last_view_status")

    def __init__(self, **tables):
        unknown = set(tables) - set(self._NAMES)
        if unknown:
            raise TypeError(f"unknown inputs: {sorted(unknown)}")
        self._src = tables
        self._built: dict = {}

    def __getattr__(self, name):
        if name.startswith("_") or name not in self._NAMES:
            raise AttributeError(name)
        if name not in self._built:
            v = self._src.get(name) if name == "daily_last_view_status" else self._src[name]
            self._built[name] = v() if callable(v) else v
        return self._built[name]


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("k"))


def _rows(ks: DataFrame, *variants) -> DataFrame:
    """One scan of the keys; each key yields the variants whose condition holds.

    ``variants`` are (condition, {column: expression}) pairs; a key's rows are
    exploded from an array of structs, so the table costs one pass over
    ``customer`` instead of a union of several scans.
    """
    cols = list(variants[0][1])
    arr = F.array(*[F.when(cond, F.struct(*[e.alias(c) for c, e in exprs.items()])) for cond, exprs in variants])
    return ks.select(F.explode(arr).alias("r")).filter(F.col("r").isNotNull()).select(
        *[F.col(f"r.{c}").alias(c) for c in cols])


def account_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    base = calendar.timegm(OPTIN_BASE_UTC.timetuple())
    first = F.lit(base) - ((k * 7) % OPTIN_SPREAD_DAYS) * 86400
    hh = _keys(spark, sf_dir).filter(k % 50 != 49)
    out = _rows(
        hh,
        (F.lit(True), {"householdid": k, "targetedoptindate": F.timestamp_seconds(first)}),
        (k % 3 == 0, {"householdid": k,
                      "targetedoptindate": F.timestamp_seconds(first + OPTIN_SECOND_ROW_DAYS * 86400)}),
    )
    return S.conform(out, S.ACCOUNT_VIEW)


def customer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    ks = k.cast("string")

    def row(prefix, suffix, partner):
        ext = F.concat(F.lit(prefix), ks, F.lit(suffix)) if suffix else F.concat(F.lit(prefix), ks)
        return {"profileid": k, "externalprofilerid": ext, "partnerorsystemid": F.lit(partner)}

    out = _rows(
        _keys(spark, sf_dir),
        (F.lit(True), row("mp", "", "mparticle")),
        (k % 25 == 7, row("mp", "", "mparticle")),  # a duplicated mapping row
        (~(k % 40).isin(30, 39), row("aid", "", "trackingid")),
        (k % 30 == 5, row("aid", "b", "trackingid")),  # a second tracking id
    )
    return S.conform(out, S.CUSTOMER_KEYS)


def holdout_backfill(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    r = BACKFILL_RESIDUES[table]
    k = F.col("k")
    out = _keys(spark, sf_dir).filter(k % 10 == r).select(
        F.concat(F.lit("mp"), k.cast("string")).alias("identity_value"),
        F.when(k % 100 == 90 + r, F.lit("email")).otherwise(F.lit("other_5")).alias("identity_type"),
    )
    return S.conform(out, S.HOLDOUT_BACKFILL)


def audience_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    name = F.lit(None).cast("string")
    for residue, aname in reversed(list(_AUDIENCE_BY_RESIDUE.items())):
        name = F.when(k % 20 == residue, F.lit(aname)).otherwise(name)
    out = _keys(spark, sf_dir).filter((k % 20).isin(*_AUDIENCE_BY_RESIDUE)).select(
        F.concat(F.lit("mp"), k.cast("string")).alias("identityvalues_other_id_5"),
        name.alias("audiencename"),
    )
    return S.conform(out, S.AUDIENCE_LIST)


def silver_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    j = li.join(od, li.l_orderkey == od.o_orderkey).join(pt, li.l_partkey == pt.p_partkey)
    out = j.select(
        F.concat(F.lit("aid"), F.col("o_custkey").cast("string")).alias("adobe_tracking_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("adobe_timestamp"),
        F.to_date(F.col("l_shipdate").cast("timestamp_ntz")).alias("adobe_date"),
        F.when(F.col("l_orderkey") % 17 == 0, F.lit(None).cast("string"))
        .when(F.col("p_type") == "PROMO", F.lit("VOD_ShortForm"))
        .otherwise(F.col("p_type")).alias("consumption_type"),
        F.col("p_name").alias("program"),
        F.when(F.col("l_linenumber") <= 6, 1).otherwise(0).alias("num_views_started"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("num_views_completed"),
        (F.col("l_quantity") * 60).alias("num_seconds_played_no_ads"),
    )
    return S.conform(out, S.SILVER_VIDEO)


def view_inputs(spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS) -> Inputs:
    """The inputs as lazy views over the driver's tables."""
    return Inputs(
        backfills=lambda: {t: holdout_backfill(spark, sf_dir, t) for t in BACKFILL_RESIDUES},
        audience_list=lambda: audience_list(spark, sf_dir),
        customer_keys=lambda: customer_keys(spark, sf_dir),
        account_view=lambda: account_view(spark, sf_dir),
        silver_video=lambda: silver_video(spark, sf_dir),
    )
