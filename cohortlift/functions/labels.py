"""Cohort labels: construction, parsing and display names.

A label is ``<arm>_<campaign>``, e.g. ``holdoutgroup_paidsoc``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's (arm and campaign codes,
# the four audience-list names and the display names of the report).
HOLDOUT_ARM = "holdoutgroup"
TARGETABLE_ARM = "targetablegroup"
CAMPAIGNS = ("control", "paidsoc", "paiddis", "braze")
AUDIENCE_LIST_NAMES = {
    "Master-Media-Hold-Out-Groups---Control": "holdoutgroup_control",
    "Master-Media-Hold-Out-Groups---Paid-Social-Control-Group": "holdoutgroup_paidsoc",
    "Master-Media-Hold-Out-Groups---Paid-Display-Control-Group": "holdoutgroup_paiddis",
    "Master-Media-Hold-Out-Groups---Braze-Control-Group": "holdoutgroup_braze",
}
# The exclusions of the reference test this label, which is never produced
# (the produced one is holdoutgroup_braze), so by default they never fire.
BRAZE_EXCLUSION_LABEL = "holdoutgroup_brazeco"
BRAZE_LABEL = "holdoutgroup_braze"
DISPLAY_PAID_DISPLAY = "Paid Display"
DISPLAY_PAID_SOCIAL = "Paid Social"
DISPLAY_ALL_PAID = "All Paid Media"
DISPLAY_TARGETABLE = "Targetable"
DISPLAY_HOLDOUT = "Holdout"


def label(arm: str, campaign: str) -> str:
    return f"{arm}_{campaign}"


def holdout(campaign: str) -> str:
    return label(HOLDOUT_ARM, campaign)


def targetable(campaign: str) -> str:
    return label(TARGETABLE_ARM, campaign)


def label_part(col: Column, i: int) -> Column:
    """i-th '_'-separated part of a label; NULL when there is no such part."""
    return F.get(F.split(col, "_"), i)


def campaign_display(code: Column) -> Column:
    """paiddis / paidsoc get their names; anything else (NULL too) is All Paid Media."""
    return (
        F.when(code == "paiddis", F.lit(DISPLAY_PAID_DISPLAY))
        .when(code == "paidsoc", F.lit(DISPLAY_PAID_SOCIAL))
        .otherwise(F.lit(DISPLAY_ALL_PAID))
    )


def arm_display(arm: Column) -> Column:
    """targetablegroup is Targetable; anything else (NULL too) is Holdout."""
    return F.when(arm == TARGETABLE_ARM, F.lit(DISPLAY_TARGETABLE)).otherwise(F.lit(DISPLAY_HOLDOUT))
