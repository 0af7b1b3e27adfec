"""Bucketed tables, the strict CSV hand-off, results published in one step, pruning without loss."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlift.operators import engagement as E
from cohortlift.operators import lapse as LP
from cohortlift.params import FIXTURE_PARAMS, Params
from cohortlift.plans import run as R
from cohortlift.plans.registry import analysis
from cohortlift.sources import csv as CSV
from cohortlift.sources.publish import publish, published
from cohortlift.sources.tables import read_bucketed, write_bucketed
from support import SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges_over(plan: str, table: str) -> int:
    """Exchanges between the plan's root and the scans of a table: those that its rows pass."""
    stack, found = [], []
    for line in plan.splitlines():
        body = line.lstrip(" :+-*()0123456789")
        depth = len(line) - len(line.lstrip(" :+-"))
        while stack and stack[-1][0] >= depth:
            stack.pop()
        if "Scan parquet" in body and table in body:
            # aggregated results are shuffled by cohort; the table itself is shuffled by the viewer
            found.append(sum("Exchange hashpartitioning(aid" in x or "Exchange hashpartitioning(tracking_id" in x for _, x in stack))
        stack.append((depth, body))
    assert found, plan
    return max(found)


def test_kpis_and_rates_read_the_bucketed_audience_without_shuffling_it(spark, tmp_path):
    p = analysis(spark, SMALL)
    tables = p.materialise(spark, str(tmp_path / "run"), ("classification", "play_points", "last_view_ranges"))
    threshold = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    for df in (tables.cohort_kpis, tables.save_rate, tables.winback_rate):
        plan = _plan(df)
        name = tables.tables["classification"].inputFiles()[0].rsplit("/", 2)[1]
        assert name == "classification"
        assert "Bucketed: true" in plan
        assert _exchanges_over(plan, "tenure_classification") == 0
    # ranges, play points and audience lie alike: the rates shuffle nothing by viewer but play days
    assert "hashpartitioning(tracking_id" not in _plan(tables.winback_rate)
    assert threshold == spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    key = lambda df: sorted(map(str, df.collect()))
    assert key(tables.save_rate) == key(p.save_rate) and key(tables.winback_rate) == key(p.winback_rate)


def test_bucketed_table_with_many_rows_without_key(spark, tmp_path):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), F.col("id") % 70)).alias("aid"), "id")
    path = str(tmp_path / "t")
    table = write_bucketed(rows, path, "aid", 4)
    again = read_bucketed(spark, path, "aid", 4)
    for t in (table, again):
        assert t.count() == 3000 and t.filter("aid IS NULL").count() == 1000
        assert "Exchange" not in _plan(t.groupBy("aid").count())
        assert sorted(map(tuple, t.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) <= 2 * 4  # a file for each bucket, four for that of the nulls


SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType()), T.StructField("x", T.DoubleType())])


def test_csv_keeps_missing_and_empty_apart(spark, tmp_path):
    rows = [("a", 1, 0.5), ("", 2, None), (None, None, -1.0), ('q"uo,te', 3, 1e-300), ("two\\", 4, 0.1)]
    path = str(tmp_path / "t")
    CSV.write_csv(spark.createDataFrame(rows, SCHEMA), path)
    assert sorted(map(tuple, CSV.read_csv(spark, path, SCHEMA).collect()), key=str) == sorted(rows, key=str)
    assert CSV.malformed(spark, path, SCHEMA).count() == 0
    with pytest.raises(Exception, match="already exists"):
        CSV.write_csv(spark.createDataFrame(rows, SCHEMA), path)


@pytest.mark.parametrize("bad", ["b,seven,1.0", "b,7,1.0.0", "b,7", "b,7,1.0,surplus"])
def test_a_cell_that_does_not_parse_stops_the_read(spark, tmp_path, bad):
    (tmp_path / "t.csv").write_text(f"name,n,x\na,1,0.5\n{bad}\nc,2,1.5\n")
    path = str(tmp_path / "t.csv")
    with pytest.raises(Exception, match="(?i)malformed"):
        CSV.read_csv(spark, path, SCHEMA).collect()
    found = CSV.malformed(spark, path, SCHEMA).collect()
    assert [r.text for r in found] == [bad] and found[0].file.endswith("t.csv")


def test_a_header_that_differs_stops_the_read(spark, tmp_path):
    (tmp_path / "t.csv").write_text("name,x,n\na,1,0.5\n")
    with pytest.raises(Exception):
        CSV.read_csv(spark, str(tmp_path / "t.csv"), SCHEMA).collect()


def test_manifest_is_replaced_in_one_step(spark, tmp_path):
    out = str(tmp_path / "out")
    assert published(spark, out) is None
    publish(spark, out, "one", {"a": "x"}, {"lost": 3})
    assert published(spark, out) == {"run": "one", "paths": {"a": "x"}, "notes": {"lost": 3}}
    publish(spark, out, "two", {"a": "y"})
    assert published(spark, out)["paths"] == {"a": "y"}
    assert [f for f in os.listdir(out) if not f.endswith(".crc")] == ["manifest.json"]


def test_a_run_that_stops_leaves_the_last_results(spark, tmp_path, monkeypatch):
    from cohortlift.sources.fixtures import view_inputs

    v = view_inputs(spark, SMALL, FIXTURE_PARAMS)
    tables = {**v.backfills, **{n: getattr(v, n) for n in ("audience_list", "customer_keys", "account_view", "silver_video")}}
    locations = {n: str(tmp_path / "in" / n) for n in tables}
    for n, df in tables.items():
        df.write.parquet(locations[n])
    out = str(tmp_path / "out")
    paths = R.run(spark, locations, FIXTURE_PARAMS, out)
    first = published(spark, out)
    assert first["paths"] == paths and first["notes"]["targetable_rows_without_tracking_id"] > 0
    monkeypatch.setattr(R, "TESTS", ("no_such_step",))
    with pytest.raises(AttributeError):
        R.run(spark, locations, FIXTURE_PARAMS, out)
    assert published(spark, out) == first
    assert spark.read.parquet(first["paths"]["kpi_report"]).count() == 23
    # pruning that would lose a play stops the run before anything is written
    video = spark.read.parquet(locations["silver_video"])
    stray = video.filter("num_views_started = 1").limit(1).withColumn("adobe_timestamp", F.lit(dt.datetime(1996, 3, 9)).cast("timestamp_ntz"))
    video.union(stray.withColumn("adobe_date", F.lit(dt.date(1996, 2, 9)))).write.parquet(str(tmp_path / "in" / "stray"))
    pruned = FIXTURE_PARAMS.replace(prune_on_play_date=True)
    with pytest.raises(ValueError, match="would lose 1 plays"):
        R.run(spark, locations | {"silver_video": str(tmp_path / "in" / "stray")}, pruned, out)


V = "adobe_tracking_id string, adobe_timestamp timestamp_ntz, adobe_date date, num_views_started int"


def test_pruning_keeps_dates_within_the_margin_and_counts_the_rest(spark):
    p = Params(prune_on_play_date=True, play_date_margin_days=2)
    at = dt.datetime(2020, 12, 31, 23, 30)
    day = lambda k: at.date() + dt.timedelta(days=k)
    rows = [("v", at, day(k), 1) for k in (-40, 0, 1, 2, 3)] + [("v", at, None, 1), ("v", at, day(9), 0), ("v", dt.datetime(2021, 2, 1), day(30), 1)]
    video = spark.createDataFrame(rows, V).withColumn("consumption_type", F.lit("x")).withColumn("program", F.lit("p"))
    assert {r.adobe_date for r in E.window_plays(video, p).collect()} == {day(0), day(1), day(2)}
    assert E.unpruned_plays(video, p).first()[0] == 3
    assert E.window_plays(video, p.replace(prune_on_play_date=False)).count() == 6


def test_play_points_hold_what_the_rates_need(spark):
    p = analysis(spark, SMALL)
    key = lambda df: sorted(map(str, df.collect()))
    points = LP.play_points(p.i.silver_video, p.p)
    ranges = LP.last_view_ranges(points, p.p)
    for flags, lapses in ((LP.save_flags, LP.save_lapses), (LP.winback_flags, LP.winback_lapses)):
        assert key(flags(points, lapses(ranges, p.p), p.p)) == key(flags(p.i.silver_video, lapses(ranges, p.p), p.p))
