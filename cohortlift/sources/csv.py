"""CSV hand-off of result tables (GeneralMetrics / SaveRates / WinbackRates).

Results are written with a header, by Spark tasks (no single-file coalesce:
part files are read back as one table), and read back with an explicit
schema, never an inferred one. A missing value is written as nothing and an
empty text as ``""``, and they are read as what they are. A cell that does not
parse stops the read; ``malformed`` lists such rows with their text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
EMPTY = "\0empty"


def write_csv(df: DataFrame, path: str) -> None:
    """New folder ``path``; an existing one is an error."""
    df.write.option("header", True).option("nullValue", "").option("emptyValue", '""').csv(path)


def _reader(spark: SparkSession, schema: T.StructType):
    # a quoted empty cell is read as EMPTY, so that it is not taken for a missing one
    options = {"header": True, "enforceSchema": False, "nullValue": "", "emptyValue": EMPTY}
    return spark.read.schema(schema).options(**options)


def _texts(df: DataFrame, schema: T.StructType) -> list:
    return [
        F.when(F.col(f.name) == EMPTY, "").otherwise(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in schema.fields
    ]


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table; a cell that is not of its column's type, a missing or surplus
    cell and a header that differs from the schema raise when the rows are read."""
    rows = _reader(spark, schema).option("mode", "FAILFAST").csv(path)
    return rows.select(*_texts(rows, schema))


def malformed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(file, text, and the cells as far as they parse) of the rows that ``read_csv`` would stop at."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    # enforceSchema: the header lacks the extra column
    rows = _reader(spark, wide).options(enforceSchema=True, columnNameOfCorruptRecord=CORRUPT).csv(path)
    # a condition on all cells, so that none is pruned from the parsing
    cells = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in schema.names])) >= 0
    bad = rows.filter(F.col(CORRUPT).isNotNull() & cells)
    return bad.select(F.input_file_name().alias("file"), F.col(CORRUPT).alias("text"), *_texts(rows, schema))
