"""Production run: the reference's whole checklist as one Spark application.

    python -m cohortlift.plans.run --inputs inputs.json --out <shared folder> [--as-of 2020-12-08] ...

``inputs.json`` maps each input name of ``sources.tables.INPUT_SCHEMAS`` to a
catalog table or Parquet path. Each run has a folder ``<out>/runs/<run id>``: the
audience steps are written as Parquet tables under ``tables``; GeneralMetrics,
SaveRates and WinbackRates go to headed CSV under ``csv`` (the notebook's
inputs), and the labelled reports, significance tables and counted losses to
Parquet under ``results``. ``<out>/manifest.json`` names the last complete run's paths.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import json

from pyspark.sql import SparkSession

from ..operators.engagement import unpruned_plays
from ..params import Params
from ..session import apply_cluster_defaults, apply_conf, shared_dir
from ..sources import csv as CSV
from ..sources import schemas as S
from ..sources.publish import publish, run_folder
from ..sources.tables import read_inputs
from .analysis import Analysis

RESULTS = ("kpi_report", "save_report", "winback_report")
TESTS = ("engagement_significance", "conversion_significance", "save_significance", "winback_significance")


def run(spark: SparkSession, locations: dict[str, str], params: Params, out: str | None = None) -> dict[str, str]:
    """Run everything; returns {result name: path}.

    All is written under ``<out>/runs/<run id>`` and published in one step at
    the end: ``<out>/manifest.json`` names the paths of the last complete run
    (``sources.publish.published``), with the counted losses as notes.

    The three rate tables are computed once each (the play table is scanned
    for them only), written, and everything after them (CSV hand-off,
    labelled reports, significance tests) reads the written copies, as the
    reference's notebook reads its exported CSVs.
    """
    apply_conf(spark)
    out = (out or f"{shared_dir(spark).rstrip('/')}/run-{params.as_of.isoformat()}").rstrip("/")
    run_id, root = run_folder(out)
    p = Analysis(read_inputs(spark, locations, params), params)
    if params.prune_on_play_date and (lost := unpruned_plays(p.i.silver_video, params).first()[0]):
        raise ValueError(f"prune_on_play_date would lose {lost} plays dated over {params.play_date_margin_days} days off the window")
    # a status that has to be derived from the plays is a table of its own, read by both rates
    derived = () if "daily_last_view_status" in locations else ("play_points", "last_view_ranges")
    p = p.materialise(spark, f"{root}/tables", (*Analysis.STAGES, *derived))
    rates = {}
    paths = {name: f"{root}/tables/{name}" for name in (*Analysis.STAGES, *derived)}
    for csv_name, attr, schema in (("GeneralMetrics", "cohort_kpis", S.GENERAL_METRICS),
                                   ("SaveRates", "save_rate", S.SAVE_RATES),
                                   ("WinbackRates", "winback_rate", S.WINBACK_RATES)):
        path = f"{root}/tables/{attr}"
        S.conform(getattr(p, attr), schema).write.parquet(path)
        rates[attr] = spark.read.parquet(path)
        paths[csv_name] = f"{root}/csv/{csv_name}"
        CSV.write_csv(rates[attr], paths[csv_name])
    done = p.with_tables(rates)
    for name in (*RESULTS, *TESTS, "losses"):
        paths[name] = f"{root}/results/{name}"
        result = getattr(done, name)
        (result() if callable(result) else result).write.parquet(paths[name])
    publish(spark, out, run_id, paths, {r.metric: r.n_rows for r in spark.read.parquet(paths["losses"]).collect()})
    return paths


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


PARSE = {"Date": _date, "Date | None": _date, "int": int, "int | None": int, "float": float, "str": str,
         "bool": lambda x: x.lower() in ("1", "true", "yes")}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--inputs", required=True, help="JSON file: input name -> table or path")
    ap.add_argument("--out", default=None, help="output folder on shared storage")
    ap.add_argument("--custom-window-end", default=None,
                    help="KPI window end + 1 day (the checklist's override of analysis_window)")
    for f in dataclasses.fields(Params):
        if f.type in PARSE:
            ap.add_argument("--" + f.name.replace("_", "-"), default=None)
    a = ap.parse_args(argv)
    kw = {}
    for f in dataclasses.fields(Params):
        v = getattr(a, f.name, None)
        if v is None:
            continue
        kw[f.name] = PARSE[f.type](v)
    spark = SparkSession.builder.appName("cohortlift").getOrCreate()
    apply_cluster_defaults(spark)
    with open(a.inputs) as fh:
        locations = json.load(fh)
    params = Params(**kw)
    if a.custom_window_end:
        params = params.with_custom_window_end(_date(a.custom_window_end))
    for k, v in run(spark, locations, params, a.out).items():
        print(f"{k}\t{v}")


if __name__ == "__main__":
    main()
