"""The analysis as one composed plan.

``Analysis`` wires the operators in the reference's run order (audience ->
tenure -> KPIs / save / winback -> labelled reports -> tests). Each step is a
lazily built DataFrame, memoised so that a step used by several outputs is
one node of the plan (Spark then reuses its shuffle exchanges).

``materialise`` is the production path: it writes the audience steps in
order (as the reference's CREATE TABLE statements do) to the shared folder
named by ``spark.checkpoint.dir`` and continues from the written copies. That
cuts lineage, and a lost executor then costs only the tasks of the current
stage, not a recomputation of the audience from raw inputs.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from ..operators import audience as A
from ..operators import engagement as E
from ..operators import lapse as LP
from ..operators import report as R
from ..operators import significance as SG
from ..operators import tenure as TN
from ..params import Params
from ..sources.fixtures import Inputs
from ..sources.tables import write_bucketed


class Analysis:
    def __init__(self, inputs: Inputs, params: Params, tables: dict[str, DataFrame] | None = None):
        self.i = inputs
        self.p = params
        self.tables = tables or {}  # steps that are read instead of computed

    def _get(self, name: str, build):
        return self.tables[name] if name in self.tables else build()

    # audience ------------------------------------------------------------
    @functools.cached_property
    def holdout_groups(self) -> DataFrame:
        return self._get("holdout_groups", lambda: A.holdout_groups(self.i.backfills, self.i.audience_list))

    @functools.cached_property
    def household_signup(self) -> DataFrame:
        return self._get("household_signup", lambda: A.household_signup(self.i.account_view))

    @functools.cached_property
    def holdout_users(self) -> DataFrame:
        return self._get("holdout_users", lambda: A.holdout_users(
            self.i.customer_keys, self.holdout_groups, self.household_signup, self.p))

    def targetable(self, campaign: str) -> DataFrame:
        return self._get(f"targetable_{campaign}", lambda: A.targetable(
            campaign, self.household_signup, self.holdout_users, self.p))

    @property
    def targetable_control(self) -> DataFrame:
        return self.targetable("control")

    @property
    def targetable_paidsoc(self) -> DataFrame:
        return self.targetable("paidsoc")

    @property
    def targetable_paiddis(self) -> DataFrame:
        return self.targetable("paiddis")

    @functools.cached_property
    def targetable_master(self) -> DataFrame:
        return self._get("targetable_master", lambda: A.targetable_master(
            self.household_signup, self.holdout_users, self.p))

    @functools.cached_property
    def targetable_users(self) -> DataFrame:
        return self._get("targetable_users", lambda: A.targetable_users(
            self.targetable_master, self.i.customer_keys))

    @functools.cached_property
    def all_audience(self) -> DataFrame:
        return self._get("all_audience", lambda: A.all_audience(self.holdout_users, self.targetable_users, self.p))

    @functools.cached_property
    def audience_signup(self) -> DataFrame:
        return self._get("audience_signup", lambda: A.audience_signup(self.all_audience, self.household_signup))

    @functools.cached_property
    def adopter_group(self) -> DataFrame:
        return self._get("adopter_group", lambda: A.adopter_group(self.audience_signup, self.p))

    @functools.cached_property
    def classification(self) -> DataFrame:
        return self._get("classification", lambda: TN.tenure_classification(self.audience_signup, self.p))

    @functools.cached_property
    def audience_size(self) -> DataFrame:
        return TN.audience_size(self.classification)

    # engagement ----------------------------------------------------------
    @functools.cached_property
    def title_normalisation(self) -> DataFrame:
        return E.title_normalisation(self.i.silver_video)

    @functools.cached_property
    def viewer_stats(self) -> DataFrame:
        return E.viewer_stats(self.i.silver_video, self.classification, self.p)

    @functools.cached_property
    def cohort_kpis(self) -> DataFrame:
        return self._get("cohort_kpis", lambda: E.cohort_kpis(
            self.i.silver_video, self.classification, self.p))

    # save / winback ------------------------------------------------------
    @functools.cached_property
    def daily_last_view(self) -> DataFrame:
        """The support operator: daily last-start status derived from plays."""
        return LP.expand_days(self.last_view_ranges)

    @functools.cached_property
    def plays(self) -> DataFrame:
        """What status and rates read of the plays: their distinct days per viewer, from one
        scan, where the status is derived from them; else the plays themselves."""
        return self.play_points if self.i.daily_last_view_status is None else self.i.silver_video

    @functools.cached_property
    def play_points(self) -> DataFrame:
        return self._get("play_points", lambda: LP.play_points(self.i.silver_video, self.p))

    @functools.cached_property
    def last_view_ranges(self) -> DataFrame:
        return self._get("last_view_ranges", lambda: LP.last_view_ranges(self.play_points, self.p))

    @functools.cached_property
    def status(self) -> DataFrame:
        """The status the rates read: the given daily table, or the derived ranges."""
        given = self.i.daily_last_view_status
        return self.last_view_ranges if given is None else given

    @functools.cached_property
    def lapsing_save(self) -> DataFrame:
        return LP.lapsing_save(self.status, self.p)

    @functools.cached_property
    def returning_save(self) -> DataFrame:
        return LP.returning_save(self.plays, LP.save_lapses(self.status, self.p), self.p)

    @functools.cached_property
    def save_rate(self) -> DataFrame:
        return self._get("save_rate", lambda: LP.save_rate(
            self.classification, LP.save_lapses(self.status, self.p), self.plays, self.p))

    @functools.cached_property
    def lapsing_winback(self) -> DataFrame:
        return LP.lapsing_winback(self.status, self.p)

    @functools.cached_property
    def returning_winback(self) -> DataFrame:
        return LP.returning_winback(self.plays, LP.winback_lapses(self.status, self.p), self.p)

    @functools.cached_property
    def winback_rate(self) -> DataFrame:
        return self._get("winback_rate", lambda: LP.winback_rate(
            self.classification, LP.winback_lapses(self.status, self.p), self.plays, self.p))

    # reports and tests ---------------------------------------------------
    @functools.cached_property
    def kpi_report(self) -> DataFrame:
        return R.kpi_report(self.cohort_kpis)

    @functools.cached_property
    def save_report(self) -> DataFrame:
        return R.save_report(self.save_rate)

    @functools.cached_property
    def winback_report(self) -> DataFrame:
        return R.winback_report(self.winback_rate)

    def repertoire_significance(self) -> DataFrame:
        return SG.t_test(R.labelled(self._kpi_stdv()), "repertoire", self.p)

    def usage_significance(self) -> DataFrame:
        return SG.t_test(R.labelled(self._kpi_stdv()), "usage", self.p)

    def engagement_significance(self) -> DataFrame:
        return SG.engagement_significance(R.labelled(self._kpi_stdv()), self.p)

    def conversion_significance(self) -> DataFrame:
        return SG.z_test(R.labelled(self.cohort_kpis), "conversions_watched_video", "audience_size", self.p)

    def save_significance(self) -> DataFrame:
        return SG.z_test(R.labelled(self.save_rate), "saves", "save_rate_denom", self.p)

    def winback_significance(self) -> DataFrame:
        return SG.z_test(R.labelled(self.winback_rate), "winbacks", "winback_rate_denom", self.p)

    def _kpi_stdv(self) -> DataFrame:
        return self.cohort_kpis.withColumnRenamed("repertoire_stddev", "repertoire_stdv")

    # production path -----------------------------------------------------
    # The reference's run order: each statement writes a table the next reads.
    # Audience tables carry ``copies``, the rows of the reference's table a row stands for.
    STAGES = ("holdout_groups", "household_signup", "holdout_users", "targetable_control", "targetable_paidsoc",
              "targetable_paiddis", "targetable_master", "targetable_users", "all_audience", "audience_signup",
              "adopter_group", "classification")

    def with_tables(self, tables: dict[str, DataFrame]) -> "Analysis":
        """An Analysis that reads the given steps from ``tables`` instead of computing them."""
        return Analysis(self.i, self.p, {**self.tables, **tables})

    #: Tables that analyses join by a viewer's id are written bucketed by it.
    BUCKETED = {"classification": "aid", "play_points": "tracking_id", "last_view_ranges": "tracking_id"}

    def materialise(self, spark: SparkSession, root: str, stages=STAGES, buckets: int | None = None) -> "Analysis":
        """Write each step of ``stages`` under ``root`` in order, every step
        computed from the already written ones, and return an Analysis that
        reads them.

        ``root`` must be a new folder on shared storage (``session.shared_dir``):
        the written tables cut the lineage, so a lost executor costs only the
        tasks of the running stage, never a recomputation of the audience from
        raw inputs. ``BUCKETED`` tables get ``buckets`` buckets (default: the
        session's shuffle partitions), so that KPIs and rates join the audience
        without shuffling it again.
        """
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        tables: dict[str, DataFrame] = {}
        for name in stages:
            df = getattr(self.with_tables(tables), name)
            path = f"{root.rstrip('/')}/{name}"
            if name in self.BUCKETED:
                tables[name] = write_bucketed(df, path, self.BUCKETED[name], buckets)
            else:
                df.write.parquet(path)
                tables[name] = spark.read.parquet(path)
        return self.with_tables(tables)

    # what the joins leave out ---------------------------------------------
    def losses(self) -> DataFrame:
        """(metric, n_rows): what the audience joins drop or multiply, each a partial aggregation over written steps."""
        return A.losses(self.i.customer_keys, self.holdout_groups, self.holdout_users, self.targetable_master, self.audience_signup)
