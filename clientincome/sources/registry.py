"""Versions of saved artefacts, published one by one.

A version is a folder (model, factor, ...) that a run writes at its leisure.
It counts only once its manifest, one small JSON file, has been written aside
and moved into place in a single rename: a reader sees the whole version or
none.  The manifest lists the marker files that the version must have, so a
folder removed or damaged later is passed over too.  File operations go
through the file system of the path, whatever store that is.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version STRING, path STRING, n_rows LONG, parts ARRAY<STRING>"
PUBLISHED = "published"
SUCCESS = "_SUCCESS"  # what Spark's writers leave last


class _Store:
    """The file system that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.root = root.rstrip("/")
        self._fs = self._path(self.root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def write_new(self, path: str, text: str) -> None:
        """The whole file at ``path``, or no file; an error if there is one."""
        target = self._path(path)
        aside = self._path(f"{target.getParent().toString()}/.{uuid.uuid4().hex}")
        out = self._fs.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        if self._fs.exists(target) or not self._fs.rename(aside, target):
            self._fs.delete(aside, False)
            raise FileExistsError(f"{path} is published already")


def publish(spark: SparkSession, root: str, version: str, path: str, n_rows: int, parts: Iterable[str]) -> None:
    """Publish the folder ``path`` as ``version``; ``parts``: its tables, each with a marker file by now."""
    store = _Store(spark, root)
    markers = [f"{p}/{SUCCESS}" for p in parts]
    missing = [m for m in markers if not store.exists(f"{path}/{m}")]
    if missing:
        raise FileNotFoundError(f"version {version} is unfinished: {path} lacks {missing}")
    row = {"version": version, "path": path, "n_rows": n_rows, "parts": markers}
    store.write_new(f"{store.root}/{PUBLISHED}/{version}.json", json.dumps(row))


def published(spark: SparkSession, root: str) -> DataFrame:
    """(version, path, n_rows, parts) of every published version."""
    store = _Store(spark, root)
    folder = f"{store.root}/{PUBLISHED}"
    if not store.exists(folder):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(folder)


def latest(spark: SparkSession, root: str, version: str | None = None) -> Row | None:
    """The newest published version whose parts are all there (or the one named); None if there is none.

    Versions are read newest first, one at a time, until one is whole.
    """
    store, known = _Store(spark, root), published(spark, root)
    if version is not None:
        known = known.where(F.col("version") == version)
    for row in known.orderBy(F.desc("version")).toLocalIterator():
        if all(store.exists(f"{row['path']}/{p}") for p in row["parts"]):
            return row
    return None
