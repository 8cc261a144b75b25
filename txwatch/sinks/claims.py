"""Small files that exactly one writer can create: versions and numbers are claimed by them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop(spark: SparkSession, path: str):
    """The path and its file system, as the cluster's storage layer sees them."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put_if_absent(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a file with ``text``; False if it is there already (somebody else's)."""
    target, fs = hadoop(spark, path)
    jvm = spark.sparkContext._jvm
    fs.mkdirs(target.getParent())
    data = text.encode("utf-8")
    if fs.getScheme() == "file":      # Hadoop's local files only check before they create
        option = jvm.java.nio.file.StandardOpenOption
        options = spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 2)
        options[0], options[1] = option.CREATE_NEW, option.WRITE
        try:
            jvm.java.nio.file.Files.write(jvm.java.nio.file.Paths.get(target.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)), data, options)
        except Exception as e:  # noqa: BLE001 - told apart by the Java class
            if "FileAlreadyExistsException" in str(e):
                return False
            raise
        return True
    try:
        out = fs.create(target, False)
    except Exception as e:  # noqa: BLE001
        if "FileAlreadyExists" in str(e):
            return False
        raise
    try:
        out.write(data)
    finally:
        out.close()
    return True


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, in place of one that is there."""
    target, fs = hadoop(spark, path)
    out = fs.create(target, True)
    try:
        out.write(text.encode("utf-8"))
    finally:
        out.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    target, fs = hadoop(spark, folder)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if not s.getPath().getName().startswith("."))


def text_of(spark: SparkSession, path: str) -> str:
    target, fs = hadoop(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def next_number(spark: SparkSession, folder: str, above: int = 0) -> int:
    """Claim the next number of a sequence.  Each number is a file that only one writer can
    create, so two runs at once get two numbers."""
    taken = names(spark, folder)
    number = max(above, int(taken[-1]) if taken else 0) + 1
    while not put_if_absent(spark, f"{folder.rstrip('/')}/{number:019d}"):
        number += 1
    return number
