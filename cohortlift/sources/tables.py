"""Table readers.

``read_table`` reads one of the driver's parquet tables. ``read_inputs``
reads real input tables (Parquet paths or catalog table names) with the
explicit schemas of ``schemas.py``; nothing is schema-inferred.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas as S

INPUT_SCHEMAS = {
    "all_media_holdout_backfill": S.HOLDOUT_BACKFILL,
    "paid_social_holdout_backfill": S.HOLDOUT_BACKFILL,
    "paid_display_holdout_backfill": S.HOLDOUT_BACKFILL,
    "paid_braze_holdout_backfill": S.HOLDOUT_BACKFILL,
    "audience_list": S.AUDIENCE_LIST,
    "customer_keys": S.CUSTOMER_KEYS,
    "account_view": S.ACCOUNT_VIEW,
    "silver_video": S.SILVER_VIDEO,
    "daily_last_view_status": S.DAILY_LAST_VIEW_STATUS,
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables, as it is now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_source(spark: SparkSession, location: str, name: str) -> DataFrame:
    """A catalog table (``db.table``) or a Parquet path, conformed to the schema of ``name``.

    Lower-cases column names first, so warehouse exports in any case work.
    """
    schema = INPUT_SCHEMAS[name]
    if "/" in location or location.endswith(".parquet"):
        df = spark.read.parquet(location)
    else:
        df = spark.table(location)
    df = df.toDF(*[c.lower() for c in df.columns])
    return S.conform(df, schema)


def read_inputs(spark: SparkSession, locations: dict[str, str], params=None):
    """Build ``Inputs`` from {input name: location}.

    Without a ``daily_last_view_status`` location the analysis derives the
    status from the plays, from the launch to the end of the reports.
    """
    from .fixtures import BACKFILL_RESIDUES, Inputs

    t = {name: read_source(spark, loc, name) for name, loc in locations.items()}
    return Inputs(
        backfills={b: t[b] for b in BACKFILL_RESIDUES},
        audience_list=t["audience_list"],
        customer_keys=t["customer_keys"],
        account_view=t["account_view"],
        silver_video=t["silver_video"],
        daily_last_view_status=t.get("daily_last_view_status"),
    )


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """``df`` as a Parquet table at ``path``, bucketed and sorted by ``key``, read back.

    A join or grouping by ``key`` then needs no shuffle of the table; two
    tables with as many buckets join without any. Rows are dealt by key first,
    so a bucket is one file; rows without key, however many, are spread over
    the tasks (their bucket has several files). The catalog entry is the
    session's; ``read_bucketed`` makes another one later.
    """
    spread = F.when(F.col(key).isNull(), F.xxhash64(*[c for c in df.columns if c != key], F.monotonically_increasing_id()))
    name = f"cohortlift_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, F.col(key), spread)  # a null adds nothing to Spark's hash: dealt like the bucket
    rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """A table that ``write_bucketed`` has written, in any later session."""
    name = f"cohortlift_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
