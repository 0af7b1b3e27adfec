import datetime as dt
from collections import Counter

import pytest

from cohortlift.operators import audience as A
from cohortlift.params import Params

P = Params(as_of=dt.date(2020, 12, 8))  # threshold 2020-12-01
OLD, NEW = dt.date(2020, 10, 1), dt.date(2020, 12, 5)


def _ckm(spark, rows):
    return spark.createDataFrame(rows, "profileid long, externalprofilerid string, partnerorsystemid string")


def _signup(spark, rows):
    return spark.createDataFrame(rows, "householdid long, signup_date date")


def _bf(spark, rows):
    return spark.createDataFrame(rows, "identity_value string, identity_type string")


def _holdouts(spark, rows):
    return spark.createDataFrame(rows, "identity_value string, audiencecohort string")


def test_holdout_groups_union_distinct(spark):
    bfs = {
        "all_media_holdout_backfill": _bf(spark, [("mp1", "other_5"), ("mp1", "other_5"), ("mp2", "email")]),
        "paid_social_holdout_backfill": _bf(spark, [("mp3", "other_5")]),
        "paid_display_holdout_backfill": _bf(spark, []),
        "paid_braze_holdout_backfill": _bf(spark, [("mp4", "other_5")]),
    }
    lst = spark.createDataFrame(
        [("mp1", "Master-Media-Hold-Out-Groups---Control"),
         ("mp5", "Master-Media-Hold-Out-Groups---Paid-Display-Control-Group"),
         ("mp6", "Some-Other-Audience")],
        "identityvalues_other_id_5 string, audiencename string")
    got = sorted(tuple(r) for r in A.holdout_groups(bfs, lst).collect())
    assert got == [("mp1", "holdoutgroup_control"), ("mp3", "holdoutgroup_paidsoc"),
                   ("mp4", "holdoutgroup_braze"), ("mp5", "holdoutgroup_paiddis")]


def test_holdout_users_keeps_join_multiplicity(spark):
    ckm = _ckm(spark, [
        (1, "mp1", "mparticle"), (1, "mp1", "mparticle"),  # duplicated mapping row
        (1, "aid1", "trackingid"), (1, "aid1b", "trackingid"),  # two tracking ids
        (2, "mp2", "mparticle"),  # no tracking id
        (3, "mp3", "mparticle"), (3, "aid3", "trackingid"),  # signed up too late
    ])
    hold = _holdouts(spark, [("mp1", "holdoutgroup_control"), ("mp2", "holdoutgroup_paidsoc"),
                             ("mp3", "holdoutgroup_control")])
    sig = _signup(spark, [(1, OLD), (2, OLD), (3, NEW)])
    got = Counter(tuple(r) for r in A.expanded(A.holdout_users(ckm, hold, sig, P)).collect())
    # 2 x 2 mapping matches for mp1, times 2 tracking ids
    assert got[(1, "mp1", "holdoutgroup_control", "aid1", OLD)] == 4
    assert got[(1, "mp1", "holdoutgroup_control", "aid1b", OLD)] == 4
    assert got[(2, "mp2", "holdoutgroup_paidsoc", None, OLD)] == 1
    assert sum(got.values()) == 9
    # dedupe mode makes no copies
    deduped = A.expanded(A.holdout_users(ckm, hold, sig, P.replace(dedupe_audience=True)))
    assert deduped.count() == 3 and deduped.distinct().count() == 3


def test_targetables_and_braze_label(spark):
    sig = _signup(spark, [(1, OLD), (2, OLD), (3, OLD), (4, OLD), (5, NEW)])
    hu = spark.createDataFrame(
        [(1, "mp1", "holdoutgroup_control", "aid1", OLD), (2, "mp2", "holdoutgroup_paidsoc", "aid2", OLD),
         (3, "mp3", "holdoutgroup_braze", "aid3", OLD), (None, "x", "holdoutgroup_control", None, OLD)],
        "profileid long, mparticleid string, audiencecohort string, aid string, signup_date date")
    ids = lambda df: sorted(r.householdid for r in df.collect())
    # faithful: the braze exclusion tests a label that never occurs, so 3 stays
    assert ids(A.targetable("control", sig, hu, P)) == [3, 4]
    assert ids(A.targetable("paidsoc", sig, hu, P)) == [3, 4]
    assert ids(A.targetable("paiddis", sig, hu, P)) == [2, 3, 4]
    assert ids(A.targetable("control", sig, hu, P.replace(exclude_braze=True))) == [4]
    # the one-pass union equals the three anti joins
    for p in (P, P.replace(exclude_braze=True)):
        union = Counter()
        for c in ("control", "paidsoc", "paiddis"):
            union.update((r.householdid, r.audiencecohort) for r in A.targetable(c, sig, hu, p).collect())
        master = Counter(tuple(r) for r in A.targetable_master(sig, hu, p).collect())
        assert master == union


def test_all_audience_and_signup(spark):
    hu = spark.createDataFrame(
        [(1, "mp1", "holdoutgroup_control", "aid1", OLD), (3, "mp3", "holdoutgroup_braze", "aid3", OLD)],
        "profileid long, mparticleid string, audiencecohort string, aid string, signup_date date")
    tu = spark.createDataFrame([(4, "aid4", "targetablegroup_control"), (4, "aid4", "targetablegroup_control")],
                               "profileid long, aid string, audiencecohort string")
    aud = A.all_audience(hu, tu, P)
    assert aud.count() == 4  # braze holdouts stay (D2); duplicates stay (D4)
    assert A.all_audience(hu, tu, P.replace(exclude_braze=True, dedupe_audience=True)).count() == 2
    sig = _signup(spark, [(1, OLD)])
    rows = {r.profileid: r.signup_date for r in A.audience_signup(aud, sig).collect()}
    assert rows == {1: OLD, 3: None, 4: None}
    ag = {r.profileid: r.adopter_group for r in
          A.adopter_group(A.audience_signup(aud, sig), P.replace(campaign_start_date=dt.date(2020, 10, 1))).collect()}
    assert ag == {1: "during", 3: "not_in_cohort", 4: "not_in_cohort"}


def test_household_signup_new_york_date(spark):
    av = spark.createDataFrame(
        [(1, dt.datetime(2020, 12, 2, 3, 30)), (1, dt.datetime(2020, 12, 5, 12, 0)), (2, dt.datetime(2020, 12, 2, 5, 0))],
        "householdid long, targetedoptindate timestamp")
    got = {r.householdid: r.signup_date for r in A.household_signup(av).collect()}
    assert got == {1: dt.date(2020, 12, 1), 2: dt.date(2020, 12, 2)}


@pytest.mark.parametrize("threshold_days,expected", [(7, 1), (0, 2)])
def test_tenure_requirement(spark, threshold_days, expected):
    ckm = _ckm(spark, [(1, "mp1", "mparticle"), (2, "mp2", "mparticle")])
    hold = _holdouts(spark, [("mp1", "holdoutgroup_control"), ("mp2", "holdoutgroup_control")])
    sig = _signup(spark, [(1, OLD), (2, NEW)])
    assert A.holdout_users(ckm, hold, sig, P.replace(tenure_days=threshold_days)).count() == expected


def test_hot_external_id_fan_out(spark):
    """One external id on 40 mapping rows of 40 profiles, held out under two labels."""
    k = 40
    rows = [(p, "mpHOT", "mparticle") for p in range(k)] + [(p, f"aid{p}", "trackingid") for p in range(k)]
    ckm = _ckm(spark, rows)
    hold = _holdouts(spark, [("mpHOT", "holdoutgroup_control"), ("mpHOT", "holdoutgroup_paiddis")])
    sig = _signup(spark, [(p, OLD) for p in range(k)])
    got = Counter((r.profileid, r.audiencecohort) for r in A.expanded(A.holdout_users(ckm, hold, sig, P)).collect())
    # the reference's self-join: each of the k mapping rows meets all k rows of the id, per label
    assert sum(got.values()) == k * k * 2
    assert set(got.values()) == {k}
    deduped = A.holdout_users(ckm, hold, sig, P.replace(dedupe_audience=True))
    assert deduped.count() == k * 2 and deduped.distinct().count() == k * 2


def test_hot_external_id_reaches_the_kpis_unexpanded(spark):
    """One id on 100,000 mapping rows: k x k counts as a weight all the way to the sums."""
    from cohortlift.operators import engagement as E
    from cohortlift.operators import tenure as TN

    k = 100_000
    mapping = spark.range(k).selectExpr("0L AS profileid", "'mpHOT' AS externalprofilerid", "'mparticle' AS partnerorsystemid")
    ckm = mapping.union(_ckm(spark, [(0, "aid0", "trackingid")]))
    users = A.holdout_users(ckm, _holdouts(spark, [("mpHOT", "holdoutgroup_control")]), _signup(spark, [(0, OLD)]), P)
    assert [tuple(r) for r in users.select("aid", "copies").collect()] == [("aid0", k * k)]
    none = spark.createDataFrame([], "profileid long, aid string, audiencecohort string")
    audience = A.audience_signup(A.all_audience(users, none, P), _signup(spark, [(0, OLD)]))
    plays = spark.createDataFrame(
        [("aid0", dt.datetime(2020, 12, 3), dt.date(2020, 12, 3), "LONG", "p", 1, 1, 36.0)] * 2,
        "adobe_tracking_id string, adobe_timestamp timestamp_ntz, adobe_date date, consumption_type string, "
        "program string, num_views_started int, num_views_completed int, num_seconds_played_no_ads double")
    r = E.cohort_kpis(plays, TN.tenure_classification(audience, P), P).first()
    assert (r.conversions_watched_video, r.audience_size, r.all_starts, r.repertoire) == (1, 1, 2 * k * k, 1.0)
    assert r.usage == pytest.approx(2 * k * k / 100)
