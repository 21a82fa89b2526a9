"""Small files that are written once, on any file system that Spark reaches."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    """The path, and its file system's older and newer interface; the newer one renames without overwriting."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), conf)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in `folder`, none if it does not exist. Names that begin with a dot are left out."""
    at, files, _ = _path(spark, folder)
    if not files.exists(at):
        return []
    return sorted(name for name in (s.getPath().getName() for s in files.listStatus(at)) if not name.startswith("."))


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write `text` to `path`, or return False if that exists already.

    The file is complete when its name appears: it is written beside and renamed, and a rename does not replace what is
    there. Of two writers at the same moment one gets False where the file system's rename is atomic, as HDFS's is.
    """
    folder, _, name = path.rpartition("/")
    beside, files, _ = _path(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = files.create(beside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    at, _, context = _path(spark, path)
    kinds = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.NONE
    try:
        context.rename(beside, at, options)
        return True
    except Exception:
        if not files.exists(at):
            raise
        files.delete(beside, False)
        return False
