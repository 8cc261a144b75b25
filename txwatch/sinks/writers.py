"""Sinks: insert-or-ignore Parquet tables, the partitioned warehouse, CSV reports, JDBC."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txwatch.sinks import compaction


#: Schemes whose folder rename copies objects one by one.
OBJECT_STORES = frozenset({"s3", "s3a", "s3n", "gs", "oss", "cos"})


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when a Parquet table has been written at ``path`` (any file system)."""
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    except Exception:  # noqa: BLE001 - no JVM handle (remote session): ask the reader
        try:
            spark.read.parquet(path).schema  # noqa: B018
            return True
        except Exception:  # noqa: BLE001
            return False
    return fs.exists(jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")) or (
        fs.exists(hpath) and len(fs.listStatus(hpath)) > 0)


def batch_bounds(batch: DataFrame, partition_col: str, time_col: str) -> dict:
    """Partition values and time range of one micro-batch, in one small job.

    Used to prune the stored table before a key check: the distinct dates of one
    batch are few (bounded by the batch's time span), so fetching them is cheap.
    """
    row = batch.agg(F.collect_set(partition_col).alias("values"),
                    F.min(time_col).alias("lo"), F.max(time_col).alias("hi"),
                    F.unix_millis(F.min(time_col).cast("timestamp")).alias("lo_ms"),
                    F.unix_millis(F.max(time_col).cast("timestamp")).alias("hi_ms")).first()
    return {**row.asDict(), "values": list(row["values"] or [])}


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A stored Parquet table; with its declared schema an empty table (a folder with
    no data files yet) reads as zero rows instead of failing schema inference."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
        found = compaction.layout(spark, path.rstrip("/"))[1]
        if found["packed"]:
            column = found["column"]
            return compaction.read_packed(spark, path.rstrip("/"), column, compaction.values_of(spark, path, column),
                                          schema, found)
    return reader.parquet(path)


def read_folders(spark: SparkSession, path: str, partition_col: str, values: list[str],
                 schema: StructType | None = None) -> DataFrame:
    """The given partition folders of a stored table; folders that don't exist are empty."""
    root = path.rstrip("/")
    if schema is not None:
        packed = compaction.layout(spark, root)[1]
        if packed["column"] == partition_col:
            return compaction.read_packed(spark, root, partition_col, values, schema, packed)
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = [f"{root}/{partition_col}={v}" for v in sorted(values)]
    found = [f for f in folders if fs.exists(jvm.org.apache.hadoop.fs.Path(f))]
    if not found:
        return spark.createDataFrame([], schema) if schema is not None else read_table(spark, root).limit(0)
    reader = spark.read.option("basePath", root)
    return (reader.schema(schema) if schema is not None else reader).parquet(*found)


def stored_slice(spark: SparkSession, path: str, bounds: dict | None,
                 partition_col: str | None, time_col: str | None,
                 schema: StructType | None = None) -> DataFrame:
    """The part of a stored table a batch can collide with: its partitions (directory
    pruning) and its time range (Parquet min/max statistics skip other files)."""
    if bounds and partition_col:
        # only the touched partition folders are listed, however long the history is
        values = [v.isoformat() if hasattr(v, "isoformat") else str(v) for v in bounds["values"]]
        stored = read_folders(spark, path, partition_col, values, schema)
    else:
        stored = read_table(spark, path, schema)
    if bounds and time_col and bounds["lo"] is not None:
        stored = stored.where(F.col(time_col).between(F.lit(bounds["lo"]), F.lit(bounds["hi"])))
    return stored


def insert_or_ignore_parquet(batch: DataFrame, path: str, keys: list[str],
                             partition_col: str | None = None,
                             time_col: str | None = None,
                             bounds: dict | None = None,
                             deduplicated: bool = False,
                             partitions: int | None = None) -> None:
    """Append the rows whose key is not stored yet (a primary-key insert that skips
    duplicates instead of failing, so replays and retries are harmless).

    The key check reads only the stored slice the batch can collide with (see
    ``stored_slice``); a replayed transaction keeps its event time, so it always lands
    in that slice.  ``deduplicated`` skips the in-batch dedup when the caller did it;
    ``partitions`` sizes the dedup shuffle (micro-batch plans run without AQE).
    """
    spark = batch.sparkSession
    if deduplicated:
        fresh = batch
    elif partitions:
        # copies of a key become one row before the shuffle
        rest = [c for c in batch.columns if c not in keys]
        fresh = (batch.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("first"))
                 .select(*keys, "first.*").select(*batch.columns).coalesce(partitions))
    else:
        fresh = batch.dropDuplicates(keys)
    if table_exists(spark, path):
        if bounds is None and partition_col:
            bounds = batch_bounds(fresh, partition_col, time_col or partition_col)
        stored = stored_slice(spark, path, bounds, partition_col, time_col, fresh.schema)
        fresh = fresh.join(stored.select(*keys), keys, "left_anti")
    writer = fresh.write.mode("append")
    if partition_col:
        writer = writer.partitionBy(partition_col)
    writer.parquet(path)


def publish_batch(rows: DataFrame, feed_root: str, batch_id: int) -> None:
    """Make one micro-batch's rows visible to a downstream file stream all at once.

    The rows are written to a hidden staging folder (names starting with ``_`` are
    skipped by file listings) and the folder is then renamed to ``batch_id=N``, so a
    reader lists either none or all of the batch's files.  A retried batch replaces
    its folder.  Folder rename has to be atomic: object stores without it are refused.

    File streams list files by their time.  A batch's files get rising times in the order of
    the partitions, after those of the batches that are still in the feed.
    """
    spark = rows.sparkSession
    root = feed_root.rstrip("/")
    if root.split(":", 1)[0] in OBJECT_STORES:
        raise ValueError(f"{root}: the feed needs a file system with atomic folder rename")
    staging = f"{root}/_staging-{batch_id}-{uuid.uuid4().hex}"
    rows.write.mode("overwrite").parquet(staging)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{root}/batch_id={batch_id}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    own = sorted((f.getPath() for f in fs.listStatus(jvm.org.apache.hadoop.fs.Path(staging))
                  if f.getPath().getName().startswith("part-")), key=lambda path: path.getName())
    waiting = [f.getModificationTime()
               for folder in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/batch_id=*")) or []
               for f in fs.listStatus(folder.getPath())]
    first = max([int(time.time() * 1000), *(at + 1 for at in waiting)])
    for i, path in enumerate(own):
        fs.setTimes(path, first + i, -1)
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staging), target):
        raise IOError(f"could not publish micro-batch {batch_id} to {target}")


def move_folder(spark: SparkSession, folder: str, target: str) -> None:
    """Rename a folder; one that does not exist becomes an empty target."""
    jvm = spark.sparkContext._jvm
    source, to = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(target)
    fs = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(source):
        fs.mkdirs(to)
        return
    fs.mkdirs(to.getParent())
    if not fs.rename(source, to):
        raise IOError(f"could not move {folder} to {target}")


def write_warehouse(validated_window: DataFrame, root: str, window_start) -> None:
    """One batch window into the warehouse: date= and hour= of the window start.

    Dynamic partition overwrite: a rerun replaces that window's partition and no
    other; an empty window writes nothing and removes nothing.
    """
    ws = F.lit(str(window_start)).cast("timestamp")
    (validated_window
     .withColumn("date", F.date_format(ws, "yyyy-MM-dd"))
     .withColumn("hour", F.date_format(ws, "HH"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date", "hour").parquet(root))


def write_csv_report(report: DataFrame, path: str) -> None:
    """A small report as one CSV file with a header (also for zero rows).

    Reports are aggregates (a few rows per category or one row per window), so one
    output task is fine; the data behind them stays distributed.
    """
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict,
               mode: str = "append", num_partitions: int | None = None) -> None:
    """DataFrameWriter.jdbc; ``num_partitions`` caps concurrent connections."""
    if num_partitions:
        df = df.coalesce(num_partitions)
    df.write.jdbc(url, table, mode=mode, properties=properties)


def insert_or_ignore_jdbc(batch: DataFrame, url: str, table: str, properties: dict,
                          keys: list[str], key_ranges: list[str] | None = None) -> None:
    """Insert-or-ignore into a database table: anti join against its stored keys,
    then a plain append (a duplicate can no longer roll back a whole partition).

    ``key_ranges`` are SQL conditions that split the table (one task reads each); without
    them one connection reads all stored keys."""
    spark = batch.sparkSession
    reader = {"predicates": key_ranges} if key_ranges else {}
    stored = spark.read.jdbc(url, table, properties=properties, **reader).select(*keys)
    fresh = batch.dropDuplicates(keys).join(stored, keys, "left_anti")
    fresh.write.jdbc(url, table, mode="append", properties=properties)
