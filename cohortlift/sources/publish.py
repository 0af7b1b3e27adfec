"""Results published in one step.

A run writes everything into a folder of its own and then replaces one small
file, the manifest, by renaming. Readers follow the manifest: a run that stops
half-way, or that is still writing, leaves them the results of the one before.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

MANIFEST = "manifest.json"


def run_folder(out: str) -> tuple[str, str]:
    """(run id, new folder for the run under ``out``)."""
    run_id = uuid.uuid4().hex
    return run_id, f"{out.rstrip('/')}/runs/{run_id}"


def _files(spark: SparkSession, out: str):
    """The file context of ``out`` and a function that makes paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = path(out).getFileSystem(conf).makeQualified(path(out))
    return spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(root.toUri(), conf), path


def publish(spark: SparkSession, out: str, run_id: str, paths: dict[str, str], notes: dict | None = None) -> None:
    """Point the manifest of ``out`` to ``paths``: written aside, then renamed over the old one."""
    out = out.rstrip("/")
    context, path = _files(spark, out)
    jvm = spark._jvm
    aside, final = path(f"{out}/.{run_id}.json"), path(f"{out}/{MANIFEST}")
    flags = jvm.java.util.EnumSet.of(jvm.org.apache.hadoop.fs.CreateFlag.CREATE, jvm.org.apache.hadoop.fs.CreateFlag.OVERWRITE)
    opts = getattr(jvm.org.apache.hadoop.fs, "Options$CreateOpts")
    options = spark.sparkContext._gateway.new_array(opts, 1)
    options[0] = opts.createParent()
    stream = context.create(aside, flags, options)
    try:
        stream.write(bytearray(json.dumps({"run": run_id, "paths": paths, "notes": notes or {}}, sort_keys=True).encode()))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(aside, final, options)


def published(spark: SparkSession, out: str) -> dict | None:
    """The manifest of ``out`` ({run, paths, notes}), or None if nothing was published."""
    context, path = _files(spark, out)
    final = path(f"{out.rstrip('/')}/{MANIFEST}")
    if not context.util().exists(final):
        return None
    stream = context.open(final)
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
    finally:
        stream.close()
