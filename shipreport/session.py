"""Session settings and the shared folder used for cut points."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

# Runtime SQL settings every job of this library relies on.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the next operator then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods above 8000 bytes of bytecode. Wide status and delay
    # stages exceed that as one method; split into small ones they run many times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Parquet packs tables of repeating values ten times and more; taken by file size, tables of
    # a hundred MB in memory would be broadcast through the driver.
    "spark.sql.sources.fileCompressionFactor": "10.0",
    # Texts of thousands of characters go to Python tasks in small batches.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Keep "bulan=01" text; inference would turn it into the number 1.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings on a session somebody else created."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(name: str = "shipreport", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    A session on a local master may run without it and then gets a fresh
    temporary folder. On a cluster a machine-local folder would not survive
    the loss of an executor, so the setting is required there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="shipreport-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/shipreport-{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Store the rows in the shared folder and continue from the stored copy.

    Used where two branches of a job must see the very same physical partitions.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared folder and read them back as a table.

    For rows several column-pruned scans will read, such as the pivots of a report.
    """
    path = fresh_path(df.sparkSession, label)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Work that deals out wide rows is done in at most so many slices, of about so many rows.
SLICES, SLICE_ROWS = 6, 2_000_000


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query go when it ends, not when the driver happens to collect garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def in_slices(df: DataFrame, key: Column | None, write: Callable[[DataFrame, bool, bool], None]) -> None:
    """Call ``write(rows, first, last)`` for slices of ``df`` that together hold every row once.

    Shuffles of wide rows take several times the size of packed tables. A slice holds the rows
    with some remainders of the hash of ``key`` (rows without a key are in one slice), a filter that
    Spark evaluates where the key is read, and its shuffle files go before the next one begins.
    The first slice, 1 of SLICES, is counted, and as many of the others go together as hold
    SLICE_ROWS. ``df`` is computed once a slice, so its keys must not be drawn at random. ``write``
    must run the slice. Without a ``key`` all rows are one slice.
    """
    if key is None:
        write(df, True, True)
        return
    place = F.pmod(F.xxhash64(key), F.lit(SLICES))
    seen = Observation()
    with shuffles_freed(df.sparkSession):
        write(df.where(place == 0).observe(seen, F.count(F.lit(1)).alias("n")), True, False)
        together = max(1, SLICE_ROWS // max(1, seen.get.get("n") or 0))
        for start in range(1, SLICES, together):
            end = min(start + together, SLICES)
            write(df.where(place.between(start, end - 1)), False, end == SLICES)
