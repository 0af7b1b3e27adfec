"""Plan-shape checks: the properties the design relies on at scale."""

import pytest

import __spark_entry__ as E
from support import SMALL

from cohortlift.plans.registry import QUERIES

KEYS = sorted(QUERIES)
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "CollectLimit")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_cartesian_nested_loop_or_python(spark, key):
    plan = _plan(E.queries()[key](spark, SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{key}: {bad}"
    # the only window is that of the daily status: per viewer, at most (days in range + 1) rows
    for line in plan.splitlines():
        if "Window [" in line:
            assert "lead(" in line and "tracking_id" in line, (key, line)


@pytest.mark.parametrize("key", [k for k in KEYS if not k.startswith("csv_")])
def test_plans_read_the_given_tables(spark, key):
    files = {f for f in E.queries()[key](spark, SMALL).inputFiles()}
    assert files and all(f.startswith(f"file://{SMALL}/") for f in files), files
    if key.endswith(("_report", "_significance")):
        assert {f.rsplit("/", 1)[1] for f in files} >= {"customer.parquet", "lineitem.parquet", "orders.parquet"}


def test_results_follow_the_tables(spark, tmp_path):
    """A table changed at its path gives the new answer in the same session."""
    customers = spark.read.parquet(f"{SMALL}/customer.parquet")
    customers.write.parquet(str(tmp_path / "customer.parquet"))
    before = E.queries()["household_signup"](spark, str(tmp_path)).count()
    customers.filter("c_custkey <= 75").write.mode("overwrite").parquet(str(tmp_path / "customer.parquet"))
    after = E.queries()["household_signup"](spark, str(tmp_path)).count()
    assert (before, after) == (147, 75)  # c_custkey starts at 0


def test_queries_leave_the_session_alone(spark):
    names = ("spark.sql.session.timeZone", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(n) for n in names]
    for key in KEYS:
        E.queries()[key](spark, SMALL)
    assert [spark.conf.get(n) for n in names] == before


def test_signup_date_in_any_session_zone(spark):
    want = sorted(map(str, E.queries()["household_signup"](spark, SMALL).collect()))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert sorted(map(str, E.queries()["household_signup"](spark, SMALL).collect())) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def _formatted(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_play_filters_reach_the_scan(spark):
    text = _formatted(spark, E.queries()["viewer_stats"](spark, SMALL))
    scans = [sec for sec in text.split("\n\n") if "Scan parquet" in sec and "lineitem" in sec]
    assert len(scans) == 1, text
    pushed = [ln for ln in scans[0].splitlines() if ln.startswith("PushedFilters")][0]
    for f in ("GreaterThanOrEqual(l_shipdate", "LessThan(l_shipdate"):
        assert f in pushed, pushed


def test_shuffles_of_the_largest_steps(spark):
    """Over written inputs, the KPIs shuffle four times and the daily status twice."""
    from cohortlift.operators import engagement, lapse
    from cohortlift.params import FIXTURE_PARAMS
    from cohortlift.plans.registry import analysis

    p = analysis(spark, SMALL)
    video, audience = (spark.createDataFrame([], df.schema) for df in (p.i.silver_video, p.classification))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.optimizer.excludedRules", "org.apache.spark.sql.catalyst.optimizer.ConvertToLocalRelation,"
                   "org.apache.spark.sql.catalyst.optimizer.PropagateEmptyRelation")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _plan(engagement.cohort_kpis(video, audience, FIXTURE_PARAMS)).count("Exchange hashpartitioning") == 4
        assert _plan(lapse.daily_last_view(video, FIXTURE_PARAMS)).count("Exchange hashpartitioning") == 2
    finally:
        for c in ("spark.sql.adaptive.enabled", "spark.sql.optimizer.excludedRules"):
            spark.conf.unset(c)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
