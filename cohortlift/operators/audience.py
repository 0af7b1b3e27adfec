"""Audience construction: holdouts, targetables and the full audience.

Every function maps DataFrames (+ Params) to a DataFrame and leaves
physical choices (broadcast vs. sort-merge, skew splits) to Catalyst and AQE.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.dates import local_date
from ..params import Params

# Label given to each holdout backfill table.
BACKFILL_LABELS = {
    "all_media_holdout_backfill": L.holdout("control"),
    "paid_social_holdout_backfill": L.holdout("paidsoc"),
    "paid_display_holdout_backfill": L.holdout("paiddis"),
    "paid_braze_holdout_backfill": L.holdout("braze"),
}
# Identity type that the backfills' mParticle ids carry.
MPARTICLE_IDENTITY_TYPE = "other_5"
TRACKING_PARTNER = "trackingid"

# How many equal rows of the reference's tables a row stands for.
COPIES = "copies"


def _braze_label(params: Params) -> str:
    # exclude_braze=True applies the exclusion the reference's comments intend
    return L.BRAZE_LABEL if params.exclude_braze else L.BRAZE_EXCLUSION_LABEL


def targetable_exclusions(params: Params) -> dict[str, tuple[str, ...]]:
    """Holdout labels each targetable campaign must not overlap with."""
    control, social, display = (L.holdout(c) for c in ("control", "paidsoc", "paiddis"))
    return {
        "control": (control, social, display, _braze_label(params)),
        "paidsoc": (control, social),
        "paiddis": (control, display),
    }


def copies(df: DataFrame) -> F.Column:
    """The rows' multiplicity, 1 where the table does not carry it."""
    return F.col(COPIES) if COPIES in df.columns else F.lit(1).cast("long")


def expanded(df: DataFrame) -> DataFrame:
    """The rows as often as they count, without the multiplicity."""
    rows = df.withColumn(COPIES, F.explode(F.sequence(F.lit(1).cast("long"), COPIES)))
    return rows.drop(COPIES)


def holdout_groups(backfills: dict[str, DataFrame], audience_list: DataFrame) -> DataFrame:
    """(identity_value, audiencecohort): union-distinct of the four backfills and the list."""
    parts = [
        backfills[t]
        .filter(F.col("identity_type") == MPARTICLE_IDENTITY_TYPE)
        .select("identity_value", F.lit(lbl).alias("audiencecohort"))
        for t, lbl in BACKFILL_LABELS.items()
    ]
    name_to_label = F.create_map(*[F.lit(x) for kv in L.AUDIENCE_LIST_NAMES.items() for x in kv])
    parts.append(
        audience_list.filter(F.col("audiencename").isin(*L.AUDIENCE_LIST_NAMES))
        .select(F.col("identityvalues_other_id_5").alias("identity_value"),
                name_to_label[F.col("audiencename")].alias("audiencecohort"))
    )
    return reduce(DataFrame.unionByName, parts).distinct()


def household_signup(account_view: DataFrame) -> DataFrame:
    """(householdid, signup_date): earliest opt-in per household as a New York date.

    min() is taken on the instant and converted once per household; the civil
    date is monotone in the instant, so this equals the min of converted dates.
    """
    return (
        account_view.groupBy("householdid")
        .agg(F.min("targetedoptindate").alias("first_optin"))
        .select("householdid", local_date(F.col("first_optin")).alias("signup_date"))
    )


def tracking_ids(customer_keys: DataFrame) -> DataFrame:
    """(profileid, aid): every tracking id of a profile."""
    return customer_keys.filter(F.col("partnerorsystemid") == TRACKING_PARTNER).select(
        "profileid", F.col("externalprofilerid").alias("aid"))


def holdout_users(customer_keys: DataFrame, holdouts: DataFrame, signup: DataFrame, params: Params) -> DataFrame:
    """(profileid, mparticleid, audiencecohort, aid, signup_date, copies) of holdout profiles.

    ``copies`` is the join multiplicity: the reference joins the mapping to
    (mapping x list) on the external id, so an id on k mapping rows matches k x k
    times, and every tracking id of a profile gives a row (aid NULL if none).
    Only profiles whose signup is before the tenure threshold are kept.

    The mapping is first cut to the held-out ids. Its rows are then counted per
    (id, profile) and per id, both partial aggregations; the product of the two
    counts is the multiplicity, which later sums weigh by. Nothing is repeated,
    however many mapping rows an id has.
    """
    held = holdouts.select(F.col("identity_value").alias("externalprofilerid")).distinct()
    rows = customer_keys.select("profileid", "externalprofilerid").join(held, "externalprofilerid", "left_semi")
    per_profile = rows.groupBy("externalprofilerid", "profileid").agg(F.count(F.lit(1)).alias("_own"))
    per_id = per_profile.groupBy(F.col("externalprofilerid").alias("identity_value")).agg(F.sum("_own").alias("_all"))
    labels = holdouts.join(per_id, "identity_value").select(
        F.col("identity_value").alias("externalprofilerid"), "audiencecohort", "_all")
    # with dedupe_audience the copies would be dropped downstream
    count = F.lit(1).cast("long") if params.dedupe_audience else F.col("_own") * F.col("_all")
    members = per_profile.join(labels, "externalprofilerid").select(
        "profileid", F.col("externalprofilerid").alias("mparticleid"), "audiencecohort", count.alias(COPIES))
    tenured = signup.filter(F.col("signup_date") < F.lit(params.tenure_threshold))
    with_signup = members.join(tenured, members.profileid == tenured.householdid).drop("householdid")
    return with_signup.join(tracking_ids(customer_keys), "profileid", "left").select(
        "profileid", "mparticleid", "audiencecohort", "aid", "signup_date", COPIES)


def eligible_households(signup: DataFrame, params: Params) -> DataFrame:
    """Households with an opt-in before the threshold (= earliest opt-in before it)."""
    return signup.filter(F.col("signup_date") < F.lit(params.tenure_threshold)).select("householdid")


def targetable(campaign: str, signup: DataFrame, holdout_users_df: DataFrame, params: Params) -> DataFrame:
    """(householdid, audiencecohort): eligible households not held out of ``campaign``."""
    excl = targetable_exclusions(params)[campaign]
    held = holdout_users_df.filter(F.col("audiencecohort").isin(*excl)).select("profileid")
    hh = eligible_households(signup, params)
    return hh.join(held, hh.householdid == held.profileid, "left_anti").select(
        "householdid", F.lit(L.targetable(campaign)).alias("audiencecohort"))


def targetable_master(signup: DataFrame, holdout_users_df: DataFrame, params: Params) -> DataFrame:
    """(profileid, audiencecohort): union-all of the three targetable groups.

    One pass instead of three anti joins: per profile, flag which holdouts it
    is in (one aggregation, partial on the map side), left-join to the
    eligible households and emit one row per campaign the household is free of.
    """
    excl = targetable_exclusions(params)
    all_labels = sorted({x for v in excl.values() for x in v})
    flags = holdout_users_df.groupBy("profileid").agg(
        *[F.max(F.col("audiencecohort") == x).alias(f"in_{i}") for i, x in enumerate(all_labels)])
    hh = eligible_households(signup, params)
    j = hh.join(flags, hh.householdid == flags.profileid, "left")
    free = {
        c: ~reduce(lambda a, b: a | b, [F.coalesce(F.col(f"in_{all_labels.index(x)}"), F.lit(False)) for x in v])
        for c, v in excl.items()
    }
    choices = F.array(*[F.when(ok, F.lit(L.targetable(c))) for c, ok in free.items()])
    return (
        j.select(F.col("householdid").alias("profileid"), F.explode(choices).alias("audiencecohort"))
        .filter(F.col("audiencecohort").isNotNull())
    )


def targetable_users(master: DataFrame, customer_keys: DataFrame) -> DataFrame:
    """(profileid, aid, audiencecohort): targetables with a tracking id (one row per id)."""
    return master.join(tracking_ids(customer_keys), "profileid").select("profileid", "aid", "audiencecohort")


def all_audience(holdout_users_df: DataFrame, targetable_users_df: DataFrame, params: Params) -> DataFrame:
    """(aid, profileid, audiencecohort, copies): holdouts (minus the braze-exclusion label) and targetables."""
    cols = ["aid", "profileid", "audiencecohort"]
    h = holdout_users_df.filter(F.col("audiencecohort") != _braze_label(params))
    h, t = (df.select(*cols, copies(df).alias(COPIES)) for df in (h, targetable_users_df))
    out = h.unionByName(t)
    return out.select(*cols).distinct().withColumn(COPIES, F.lit(1).cast("long")) if params.dedupe_audience else out


def audience_signup(audience: DataFrame, signup: DataFrame) -> DataFrame:
    """+ signup_date (left join: NULL when the profile has no household)."""
    return audience.join(signup, audience.profileid == signup.householdid, "left").select(
        "aid", "profileid", "audiencecohort", "signup_date", copies(audience).alias(COPIES))


def adopter_group(audience_with_signup: DataFrame, params: Params) -> DataFrame:
    """+ adopter_group: pre / during the campaign, or not_in_cohort without signup date."""
    s, c = F.col("signup_date"), F.lit(params.campaign_start_date)
    return audience_with_signup.withColumn(
        "adopter_group",
        F.when(s < c, F.lit("pre")).when(s >= c, F.lit("during")).otherwise(F.lit("not_in_cohort")),
    )


def losses(customer_keys: DataFrame, holdouts: DataFrame, holdout_users_df: DataFrame, master: DataFrame,
           audience: DataFrame) -> DataFrame:
    """(metric, n_rows): rows that the joins of the audience leave out or multiply.

    * held-out ids without a profile (O3), held-out rows without a tracking id (O3 keeps them);
    * targetable rows without a tracking id, which O8 drops;
    * audience rows beyond one per profile, cohort and tracking id (D4), and without signup date (O10).
    """
    def count(metric: str, df: DataFrame, rows: F.Column = F.lit(1)) -> DataFrame:
        return df.agg(F.lit(metric).alias("metric"), F.coalesce(F.sum(rows), F.lit(0)).cast("long").alias("n_rows"))

    ids = customer_keys.select(F.col("externalprofilerid").alias("identity_value"))
    weight = copies(audience)
    per = audience.groupBy("profileid", "audiencecohort", "aid").agg(F.sum(weight).alias("times"))
    return reduce(DataFrame.unionByName, [
        count("holdout_ids_without_profile", holdouts.select("identity_value").distinct().join(ids, "identity_value", "left_anti")),
        count("holdout_rows_without_tracking_id", holdout_users_df.filter(F.col("aid").isNull()), copies(holdout_users_df)),
        count("targetable_rows_without_tracking_id", master.join(tracking_ids(customer_keys), "profileid", "left_anti")),
        count("audience_rows_multiplied", per, F.col("times") - 1),
        count("audience_rows_without_signup", audience.filter(F.col("signup_date").isNull()), weight),
    ])
