"""The production entry point over input tables written from the fixtures."""

import pytest
from pyspark.sql import functions as F

from cohortlift.operators.audience import expanded
from cohortlift.operators.lapse import daily_last_view, expand_days
from cohortlift.params import FIXTURE_PARAMS
from cohortlift.plans.analysis import Analysis
from cohortlift.plans.run import run
from cohortlift.sources import schemas as S
from cohortlift.sources.csv import read_csv
from cohortlift.sources.fixtures import view_inputs
from support import SMALL


def test_run_end_to_end(spark, tmp_path):
    v = view_inputs(spark, SMALL, FIXTURE_PARAMS)
    locations = {}
    tables = dict(v.backfills)
    tables.update(audience_list=v.audience_list, customer_keys=v.customer_keys, account_view=v.account_view,
                  silver_video=v.silver_video, daily_last_view_status=daily_last_view(v.silver_video, FIXTURE_PARAMS))
    for name, df in tables.items():
        path = str(tmp_path / "in" / name)
        df.write.parquet(path)
        locations[name] = path
    paths = run(spark, locations, FIXTURE_PARAMS, str(tmp_path / "out"))
    gm = read_csv(spark, paths["GeneralMetrics"], S.GENERAL_METRICS)
    assert gm.count() == 25
    assert read_csv(spark, paths["SaveRates"], S.SAVE_RATES).count() == 24
    assert read_csv(spark, paths["WinbackRates"], S.WINBACK_RATES).count() == 14
    assert spark.read.parquet(paths["engagement_significance"]).count() == 9
    assert spark.read.parquet(paths["winback_significance"]).count() == 6
    # every table of the reference's scripts is there
    import __spark_entry__ as E

    for name in ("targetable_control", "targetable_paidsoc", "targetable_paiddis", "targetable_master"):
        assert spark.read.parquet(paths[name]).count() == E.queries()[name](spark, SMALL).count()
    adopter = expanded(spark.read.parquet(paths["adopter_group"]))
    assert adopter.count() == E.queries()["adopter_group"](spark, SMALL).count()
    assert "daily_last_view_status" not in paths


def test_run_without_status_and_with_options(spark, tmp_path):
    v = view_inputs(spark, SMALL, FIXTURE_PARAMS)
    locations = {}
    for name, df in {**v.backfills, **{n: getattr(v, n) for n in ("audience_list", "customer_keys", "account_view", "silver_video")}}.items():
        if name == "customer_keys":  # ids of any type
            df = df.withColumn("profileid", F.concat(F.lit("p"), "profileid"))
        if name == "account_view":
            df = df.withColumn("householdid", F.concat(F.lit("p"), "householdid"))
        locations[name] = str(tmp_path / "in" / name)
        df.write.parquet(locations[name])
    paths = run(spark, locations, FIXTURE_PARAMS.replace(tenure_as_of=FIXTURE_PARAMS.as_of), str(tmp_path / "out"))
    days = expand_days(spark.read.parquet(paths["last_view_ranges"]))
    assert days.count() == daily_last_view(v.silver_video, FIXTURE_PARAMS).count()
    assert read_csv(spark, paths["WinbackRates"], S.WINBACK_RATES).count() == 14
    with pytest.raises(Exception, match="lacks an arm"):
        run(spark, locations, FIXTURE_PARAMS.replace(on_missing_arm="error"), str(tmp_path / "error"))


def test_statistics_are_stored_unrounded(spark):
    from cohortlift.plans.registry import analysis

    p = [r.p_value for r in analysis(spark, SMALL).conversion_significance().collect() if r.p_value]
    assert any(round(x, 6) != x for x in p)


def test_read_inputs_derives_status_and_lowercases(spark, tmp_path):
    from cohortlift.sources.tables import read_inputs

    v = view_inputs(spark, SMALL, FIXTURE_PARAMS)
    path = str(tmp_path / "ckm")
    v.customer_keys.toDF("ProfileID", "ExternalProfilerID", "PartnerOrSystemId").write.parquet(path)
    vid = str(tmp_path / "video")
    v.silver_video.write.parquet(vid)
    locs = {"customer_keys": path, "silver_video": vid}
    for name in ("all_media_holdout_backfill", "paid_social_holdout_backfill", "paid_display_holdout_backfill",
                 "paid_braze_holdout_backfill", "audience_list", "account_view"):
        p = str(tmp_path / name)
        (v.backfills[name] if name in v.backfills else getattr(v, name)).write.parquet(p)
        locs[name] = p
    i = read_inputs(spark, locs, FIXTURE_PARAMS)
    assert i.customer_keys.columns == ["profileid", "externalprofilerid", "partnerorsystemid"]
    assert i.daily_last_view_status is None
    status = Analysis(i, FIXTURE_PARAMS).daily_last_view
    assert status.count() == daily_last_view(v.silver_video, FIXTURE_PARAMS).count()
