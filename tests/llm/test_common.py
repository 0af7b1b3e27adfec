"""Written tables: what they leave behind."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from cohortlift.llm.common import CLEAN_UP, discard, written


def test_written_tables_leave_no_shuffle_files_and_no_setting(spark):
    before = spark.conf.get(CLEAN_UP)
    spark.sparkContext._jvm.System.gc()
    top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    size = lambda: sum(os.path.getsize(f) for d in top for f in glob.glob(f"{d}/**/shuffle_*", recursive=True) if os.path.exists(f))
    at = size()
    rows = spark.range(400_000).withColumn("v", F.sha2(F.col("id").cast("string"), 256))
    table = written(rows.repartition(5, "id"), "t")
    assert table.count() == 400_000
    assert size() - at < 10 << 20  # the rows take over 25 MB
    assert spark.conf.get(CLEAN_UP) == before


def test_discarded_tables_are_gone(spark):
    table = written(spark.range(3), "t")
    assert table.count() == 3
    discard(table)
    with pytest.raises(Exception):
        table.count()
