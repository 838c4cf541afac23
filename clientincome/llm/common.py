"""What the corpus operators share: written cuts, text columns, shared files."""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientincome.session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_ROWS = 500  # rows of an Arrow batch: a batch of whole texts stays at a few MB


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session: texts are long, so few rows each."""
    if int(spark.conf.get(_ARROW_ROWS)) > ARROW_ROWS:
        spark.conf.set(_ARROW_ROWS, str(ARROW_ROWS))


@contextmanager
def _shuffles_cleaned(spark: SparkSession):
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, so a lost
    executor costs a reread; the shuffle files of the step are removed at once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffles_cleaned(spark):
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``written`` made, once nothing reads them any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ------------------------------------------------------------- shared files
def _local(path: str) -> str | None:
    """The path without its scheme if the shared folder is mounted, else None."""
    if path.startswith("file:"):
        rest = path[5:]
        return "/" + rest.lstrip("/")
    return path if "://" not in path else None


def make_folder(path: str) -> None:
    local = _local(path)
    if local is not None:
        os.makedirs(local, exist_ok=True)
    else:
        from pyarrow import fs

        store, rest = fs.FileSystem.from_uri(path)
        store.create_dir(rest, recursive=True)


def open_write(path: str):
    local = _local(path)
    if local is not None:
        return open(local, "wb")
    from pyarrow import fs

    store, rest = fs.FileSystem.from_uri(path)
    return store.open_output_stream(rest)


def open_read(path: str):
    local = _local(path)
    if local is not None:
        return open(local, "rb")
    from pyarrow import fs

    store, rest = fs.FileSystem.from_uri(path)
    return store.open_input_file(rest)
