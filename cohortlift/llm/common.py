"""Helpers shared by the operators: the shared folder, written tables, worker caches."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Spark's setting to remove an execution's shuffle files at its end.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only where that is unset, and only on a single-machine master (tests), a
    folder of the application under /tmp stands in.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to storage shared by all executors")
        folder = f"/tmp/cohortlift-{spark.sparkContext.applicationId}"
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts the lineage: a lost executor costs running tasks only. The shuffle
    files of the write go with its end, instead of when the driver's garbage is
    collected. The table is removed when the application ends, or by ``discard``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.deleteOnExit(at)
    table = spark.read.schema(df.schema).parquet(path)
    table._discard = lambda: files.delete(at, True)
    return table


def discard(table: DataFrame) -> None:
    """Removes a table of ``written`` at once, for use when all that was made of it is written too."""
    table._discard()


def text_of(column: str = "text") -> Column:
    """The text column; null reads as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker process, so that
    e.g. a loaded tokenizer is reused by the worker's next tasks."""
    home = sys.modules.setdefault("_cohortlift_worker", types.ModuleType("_cohortlift_worker"))
    return home.__dict__.setdefault(name, {})


def batches(columns: dict, schema, rows: int = 20_000):
    """RecordBatches of at most ``rows`` rows from equally long columns."""
    import pyarrow as pa

    table = pa.table([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
    yield from table.to_batches(max_chunksize=rows)


def small(batches, rows: int = 512):
    """The same rows in batches that stay small as Python objects."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


class Polynomial:
    """Hashes of byte ranges of one buffer, by prefix sums of a polynomial modulo 2^64.

    Equal ranges have equal hashes wherever they lie; users either tolerate
    the rare collision or verify.
    """

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, size: int):
        import numpy as np

        base = np.uint64(self.BASE)
        inverse = np.uint64(pow(self.BASE, -1, 1 << 64))
        self.size = size
        with np.errstate(over="ignore"):
            self.power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, base)])
            self.inverse = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, inverse)])

    def prefix(self, data):
        """Prefix sums over the bytes (uint8 array of at most ``size``)."""
        import numpy as np

        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[: len(data)], out=out[1:])
        return out

    def ranges(self, prefix, start, end):
        """Mixed 64-bit hashes of the byte ranges [start, end)."""
        import numpy as np

        h = (prefix[end] - prefix[start]) * self.inverse[start]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def polynomial(size: int) -> Polynomial:
    """The worker's Polynomial for buffers of at least ``size`` bytes."""
    cache = worker_cache("polynomial")
    if "p" not in cache or cache["p"].size < size:
        cache["p"] = Polynomial(max(size, 1 << 20))
    return cache["p"]


def runs(batches, keys: list[str]):
    """One table per run of rows with equal keys (long columns), from batches sorted by them."""
    import numpy as np
    import pyarrow as pa

    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        new = np.zeros(table.num_rows, bool)
        for key in keys:
            k = table.column(key).to_numpy()
            new[1:] |= k[1:] != k[:-1]
        cuts = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-1])
    if rest is not None:
        yield rest
