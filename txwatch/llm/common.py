"""Helpers shared by the corpus operators: shared folder, staged tables, columns."""

from __future__ import annotations

import pickle
import tempfile
import uuid

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the contracts: the white space that separates words.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = "[ \\t-\\r]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the one that the cluster names in ``spark.checkpoint.dir``.

    Only where the setting is absent (tests, a laptop) a temporary folder is made, once
    per application, and that is refused on a cluster master.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not root:
        kept = sc._jsc.sc().getCheckpointDir()
        if kept.isDefined():
            root = kept.get()
        elif sc.master.startswith("local") and "cluster" not in sc.master:
            root = tempfile.mkdtemp(prefix="txwatch-llm-")
            sc.setCheckpointDir(root)
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The reread table has no lineage: losing an executor later repeats nothing of what
    made it, and every reader sees the same rows in the same files.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sent(spark: SparkSession, thing: object) -> Broadcast:
    """Broadcast an object of this package: pickled by value, as its functions are (a plain
    broadcast asks for the package on every executor)."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(thing))


def received(broadcast: Broadcast) -> object:
    """In a task: the object that ``sent`` broadcast."""
    return pickle.loads(broadcast.value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null or blank: an empty array."""
    return F.when(text.isNotNull(), F.array_remove(F.split(text, SPACE_RUN), "")).otherwise(
        F.array().cast("array<string>"))


def whole_row(docs: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """All columns of a row as one struct, so that helper columns can't clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in without])
