"""Replacing single files of a plain Parquet table, and a ledger of the batches already in it.

New files are first written aside, in a hidden folder of the table. A journal then names them and
the files they replace; from there on the swap can only go forward: new files are moved in, old ones
deleted, the batch is entered in the ledger, the journal removed. :func:`recover` finishes a swap
that was cut off, and drops what never got a journal, so a table is never left between two
states for the next writer. There is one writer at a time; a reader during a swap may see both.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

JOURNAL, LEDGER, STAGED = "_swap.json", "_ledger", "_staged-"


class _Files:
    """The few file operations needed, in whatever store the table lies."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.fs = self.path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, *parts: str):
        made = self.jvm.org.apache.hadoop.fs.Path(parts[0])
        for part in parts[1:]:
            made = self.jvm.org.apache.hadoop.fs.Path(made, part)
        return made

    def read(self, path) -> str | None:
        if not self.fs.exists(path):
            return None
        stream = self.fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path, text: str) -> None:
        """Whole or not at all: written beside and renamed."""
        beside = self.path(path.getParent().toString(), f"_{uuid.uuid4().hex}")
        stream = self.fs.create(beside, True)
        stream.write(text.encode())
        stream.close()
        self.fs.delete(path, False)
        self.fs.rename(beside, path)

    def files(self, path) -> list:
        out, listing = [], self.fs.listFiles(path, True)
        while listing.hasNext():
            found = listing.next().getPath()
            if not found.getName().startswith(("_", ".")):
                out.append(found)
        return out


def location(spark: SparkSession, table: str) -> str:
    """The folder of a catalog table."""
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def staging(spark: SparkSession, table: str) -> str:
    """A fresh hidden folder of the table to write new files into."""
    return f"{location(spark, table)}/{STAGED}{uuid.uuid4().hex}"


def applied(spark: SparkSession, table: str, stream: str) -> int | None:
    """The last batch of ``stream`` that the table holds."""
    root = location(spark, table)
    files = _Files(spark, root)
    text = files.read(files.path(root, LEDGER, stream))
    return int(text) if text else None


def swap(spark: SparkSession, table: str, staged: str, old: Sequence[str],
         batch: tuple[str, int] | None = None) -> None:
    """Replaces the files ``old`` (``_metadata.file_path`` values) by those in ``staged``, and enters
    ``batch`` (stream, number) in the ledger with it."""
    root = location(spark, table)
    files = _Files(spark, root)
    journal = {"staged": staged, "old": list(old), "batch": list(batch) if batch else None}
    files.write(files.path(root, JOURNAL), json.dumps(journal))
    _finish(spark, table, root, files, journal)


def recover(spark: SparkSession, table: str) -> bool:
    """Finishes a swap that was cut off; whether there was one. Staged files without a journal go."""
    root = location(spark, table)
    files = _Files(spark, root)
    text = files.read(files.path(root, JOURNAL))
    if text:
        _finish(spark, table, root, files, json.loads(text))
    if files.fs.exists(files.path(root)):
        for status in files.fs.listStatus(files.path(root)):
            if status.getPath().getName().startswith(STAGED):
                files.fs.delete(status.getPath(), True)
    return bool(text)


def _finish(spark: SparkSession, table: str, root: str, files: _Files, journal: dict) -> None:
    staged = files.path(journal["staged"])
    if files.fs.exists(staged):
        top = files.fs.getFileStatus(staged).getPath().toString()
        for found in files.files(staged):
            target = files.path(root, found.toString()[len(top) + 1:])
            files.fs.mkdirs(target.getParent())
            if not files.fs.exists(target):
                files.fs.rename(found, target)
    for old in journal["old"]:
        files.fs.delete(files.path(_plain(files, old)), False)
    if journal["batch"]:
        stream, number = journal["batch"]
        files.fs.mkdirs(files.path(root, LEDGER))
        files.write(files.path(root, LEDGER, stream), str(number))
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.sql(f"MSCK REPAIR TABLE {table} ADD PARTITIONS")
    spark.catalog.refreshTable(table)
    files.fs.delete(staged, True)
    files.fs.delete(files.path(root, JOURNAL), False)


def _plain(files: _Files, uri: str) -> str:
    """A path from the URI form that ``_metadata.file_path`` has."""
    return files.jvm.org.apache.hadoop.fs.Path(files.jvm.java.net.URI(uri)).toString()
