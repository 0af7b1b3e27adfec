"""Targetable vs. Holdout significance tests per cohort x tenure.

Input is a labelled report (``report.labelled``): one row per cohort, arm and
tenure, i.e. already-aggregated data of a few dozen rows. The two arms are
paired by one group-by; groups with a NULL tenure or a missing arm give no
row (``Params.on_missing_arm='error'`` raises instead, as the notebook would).
Statistics are not rounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import stats as ST
from ..params import Params

GROUP = ["cohort", "tenure_classification"]


def paired(report: DataFrame, cols: list[str], on_missing_arm: str) -> DataFrame:
    """(cohort, tenure_classification, t_<col>..., h_<col>...) with the first
    row (by label) of the Targetable arm and of the other arm."""
    is_t = F.col("targetable") == L.DISPLAY_TARGETABLE
    order = F.coalesce(F.col("audiencecohort"), F.lit(""))
    rows = F.struct(*cols)
    g = report.filter(F.col("tenure_classification").isNotNull()).groupBy(*GROUP).agg(
        F.min_by(rows, F.when(is_t, order)).alias("t"),
        F.min_by(rows, F.when(~is_t, order)).alias("h"),
        F.count_if(is_t).alias("_nt"),
        F.count_if(~is_t).alias("_nh"),
    )
    if on_missing_arm == "error":
        missing = (F.col("_nt") == 0) | (F.col("_nh") == 0)
        g = g.filter(F.when(missing, F.raise_error(F.lit("a cohort/tenure group lacks an arm")))
                     .otherwise(F.lit(True)))
    g = g.filter((F.col("_nt") > 0) & (F.col("_nh") > 0))
    return g.select(*GROUP, *[F.col(f"t.{c}").alias(f"t_{c}") for c in cols],
                    *[F.col(f"h.{c}").alias(f"h_{c}") for c in cols])


def t_test(report: DataFrame, stat: str, params: Params) -> DataFrame:
    """Pooled two-sample t-test of ``stat`` (mean) with ``<stat>_stdv``, n = audience_size."""
    sd = f"{stat}_stdv"
    p = paired(report, [stat, sd, "audience_size"], params.on_missing_arm)
    t, df = ST.pooled_t(F.col(f"t_{stat}"), F.col(f"t_{sd}"), F.col("t_audience_size"),
                        F.col(f"h_{stat}"), F.col(f"h_{sd}"), F.col("h_audience_size"))
    p = p.select(*GROUP, t.alias("t"), df.alias("df"))
    p = p.withColumn("p_value", ST.t_two_sided_p(F.col("t"), F.col("df")))
    return p.select(
        *GROUP, "t", "df", "p_value",
        ST.significance_flag(F.col("p_value"), params.alpha).alias(f"{stat}_significance"))


def z_test(report: DataFrame, count: str, nobs: str, params: Params) -> DataFrame:
    """Pooled two-proportion z-test of ``count`` out of ``nobs``."""
    p = paired(report, [count, nobs], params.on_missing_arm)
    z = ST.pooled_z(F.col(f"t_{count}"), F.col(f"t_{nobs}"), F.col(f"h_{count}"), F.col(f"h_{nobs}"))
    p = p.select(*GROUP, z.alias("z"))
    p = p.withColumn("p_value", ST.normal_two_sided_p(F.col("z")))
    return p.select(
        *GROUP, "z", "p_value",
        ST.significance_flag(F.col("p_value"), params.alpha).alias(f"{count}_significance"))


def engagement_significance(report: DataFrame, params: Params) -> DataFrame:
    """Wide form: repertoire and usage flags per (cohort, tenure)."""
    stats = ["repertoire", "usage"]
    sd = {"repertoire": "repertoire_stdv", "usage": "usage_stdv"}
    p = paired(report, stats + list(sd.values()) + ["audience_size"], params.on_missing_arm)
    tstats = []
    for s in stats:
        t, df = ST.pooled_t(F.col(f"t_{s}"), F.col(f"t_{sd[s]}"), F.col("t_audience_size"),
                            F.col(f"h_{s}"), F.col(f"h_{sd[s]}"), F.col("h_audience_size"))
        tstats += [t.alias(f"{s}_t"), df.alias(f"{s}_df")]
    p = p.select(*GROUP, *tstats)
    p = p.select(*GROUP, *[ST.t_two_sided_p(F.col(f"{s}_t"), F.col(f"{s}_df")).alias(f"{s}_p") for s in stats])
    return p.select(*GROUP, *[ST.significance_flag(F.col(f"{s}_p"), params.alpha).alias(f"{s}_significance")
                              for s in stats])
