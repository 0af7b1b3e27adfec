"""cohortlift: subscriber-retention experiment analysis on Spark.

Holdout and targetable audiences, tenure buckets, viewing KPIs, save and
winback rates per cohort, and Targetable-vs-Holdout significance tests, each
a function from DataFrames and ``Params`` to a DataFrame.
"""

from .params import FIXTURE_PARAMS, Params

__all__ = ["Params", "FIXTURE_PARAMS"]
