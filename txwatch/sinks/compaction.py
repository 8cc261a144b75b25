"""Small files of a stored table packed into few, under running writers and readers.

Streams append to ``<root>/<column>=<value>/``.  ``compact`` writes the rows of folders with
many files again, as few sorted files below ``<root>/_packed``, and then publishes a layout:
for each packed value its packed folder and the names of the files that it replaces.  The
layout is one small file claimed with ``put_if_absent``, so a reader sees a value's old files
or its packed ones, never both or neither.  Replaced files stay where they are until
``vacuum``, so a query that has listed them reads to its end, and a file that a writer appends
meanwhile is in no layout's list and stays visible.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txwatch.sinks.claims import hadoop, names, put_if_absent, text_of

ROWS_PER_FILE, MAX_FILES = 4_000_000, 8


def layout(spark: SparkSession, root: str) -> tuple[int, dict]:
    """The newest layout of a table and its version; version 0 if it was never packed."""
    for name in reversed(names(spark, f"{root}/_layout")):
        text = text_of(spark, f"{root}/_layout/{name}")
        if text.endswith("\n"):
            return int(name), json.loads(text)
    return 0, {"column": None, "packed": {}}


def _publish(spark: SparkSession, root: str, version: int, content: dict) -> None:
    if not put_if_absent(spark, f"{root}/_layout/{version + 1:012d}", json.dumps(content) + "\n"):
        raise RuntimeError(f"{root}: another layout was published meanwhile; pack again")


def _data_files(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in names(spark, folder) if not n.startswith("_")]


def read_packed(spark: SparkSession, root: str, column: str, values: list[str], schema: StructType,
                found: dict) -> DataFrame:
    """The rows of the given values of a table with a layout."""
    plain, packed = [], []
    for value in sorted(values):
        own, folder = found["packed"].get(value), f"{root}/{column}={value}"
        files = _data_files(spark, folder)
        if own is None:
            plain += [folder] if files else []
        else:
            packed.append(f"{root}/{own['folder']}")
            plain += [f"{folder}/{n}" for n in files if n not in set(own["replaces"])]
    out = None
    for base, paths in ((root, plain), (f"{root}/_packed", packed)):
        if paths:
            rows = spark.read.option("basePath", base).schema(schema).parquet(*paths)
            out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], schema) if out is None else out


def values_of(spark: SparkSession, root: str, column: str) -> list[str]:
    return [n.split("=", 1)[1] for n in names(spark, root) if n.startswith(f"{column}=")]


def compact(spark: SparkSession, root: str, column: str, schema: StructType, order_by: str,
            values: list[str] | None = None, max_files: int = MAX_FILES,
            rows_per_file: int = ROWS_PER_FILE) -> list[str]:
    """Pack the folders of ``values`` (all) that hold more than ``max_files`` files; returns
    the values packed.  One job for all of them; files are cut by ranges of ``order_by``."""
    root = root.rstrip("/")
    version, found = layout(spark, root)
    chosen, files = [], {}
    for value in values_of(spark, root, column) if values is None else values:
        files[value] = _data_files(spark, f"{root}/{column}={value}")
        own = found["packed"].get(value)
        new = len(files[value]) - len(own["replaces"] if own else [])
        if new + (own["files"] if own else 0) > max_files and new > 0:
            chosen.append(value)
    if not chosen:
        return []
    # exactly the files listed now: what is appended from here on is not replaced
    frozen = {"packed": {v: found["packed"].get(v) or {"folder": None, "replaces": []} for v in chosen}}
    paths = [f"{root}/{column}={v}/{n}" for v in chosen for n in files[v] if n not in frozen["packed"][v]["replaces"]]
    rows = spark.read.option("basePath", root).schema(schema).parquet(*paths)
    again = [f"{root}/{p['folder']}" for p in frozen["packed"].values() if p["folder"]]
    if again:
        rows = rows.unionByName(spark.read.option("basePath", f"{root}/_packed").schema(schema).parquet(*again))
    n = rows.count()
    generation = uuid.uuid4().hex
    staging = f"{root}/_staging-{generation}"
    parts = max(1, -(-n // rows_per_file))
    (rows.repartitionByRange(parts, column, order_by).sortWithinPartitions(column, order_by)
     .write.option("maxRecordsPerFile", rows_per_file).partitionBy(column).parquet(staging))
    packed = dict(found["packed"])
    for value in chosen:
        folder = f"_packed/{column}={value}/gen-{generation}"
        target, fs = hadoop(spark, f"{root}/{folder}")
        fs.mkdirs(target.getParent())
        source, _ = hadoop(spark, f"{staging}/{column}={value}")
        if not fs.rename(source, target):
            raise IOError(f"could not move {source} to {target}")
        packed[value] = {"folder": folder, "replaces": files[value], "files": len(_data_files(spark, f"{root}/{folder}"))}
    _publish(spark, root, version, {"column": column, "packed": packed})
    target, fs = hadoop(spark, staging)
    fs.delete(target, True)
    return chosen


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete what the newest layout replaces (run it when no query that began before that
    layout is still running); returns the number of files and folders deleted."""
    root = root.rstrip("/")
    version, found = layout(spark, root)
    gone = 0
    for value, own in found["packed"].items():
        folder = f"{root}/{found['column']}={value}"
        kept = own["folder"].rsplit("/", 1)[1]
        stale = [f"{folder}/{n}" for n in names(spark, folder) if n in set(own["replaces"])]
        stale += [f"{root}/_packed/{found['column']}={value}/{n}"
                  for n in names(spark, f"{root}/_packed/{found['column']}={value}") if n != kept]
        for path in stale:
            target, fs = hadoop(spark, path)
            fs.delete(target, True)
        gone += len(stale)
    if gone:
        # names of deleted files need not be kept
        packed = {v: {**own, "replaces": [n for n in own["replaces"]
                                          if n in set(names(spark, f"{root}/{found['column']}={v}"))]}
                  for v, own in found["packed"].items()}
        _publish(spark, root, version, {"column": found["column"], "packed": packed})
    for name in names(spark, f"{root}/_layout"):
        if int(name) < version:
            target, fs = hadoop(spark, f"{root}/_layout/{name}")
            fs.delete(target, False)
    return gone
