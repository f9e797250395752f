"""Small file-system helpers over Hadoop paths."""

from __future__ import annotations

from threading import Lock
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession

# Local file systems look for the target before they rename; HDFS does both in one step.
_RENAMING = Lock()


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet data under a path, or None where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def is_unreadable(error: Exception) -> bool:
    """Whether an error says that data is missing or damaged, not that its store fails."""
    if isinstance(error, AnalysisException):
        return True
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    return (condition or "").startswith(("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER"))


def _file_system(spark: SparkSession, path: str) -> tuple:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    target, system = _file_system(spark, path)
    system.delete(target, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders of a folder, in order; none where it does not exist."""
    target, system = _file_system(spark, path)
    if not system.exists(target):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(target))


def _is(error: Py4JJavaError, kind: str) -> bool:
    return kind in error.java_exception.getClass().getName()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, or None where it does not exist."""
    target, system = _file_system(spark, path)
    try:
        source = system.open(target)
    except Py4JJavaError as error:
        if _is(error, "FileNotFound"):
            return None
        raise
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file appear whole, or change nothing and say so where it exists already."""
    target, system = _file_system(spark, path)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    target = system.makeQualified(target)
    part = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid4().hex}")
    out = system.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    try:
        with _RENAMING:
            context.rename(part, target, options)
    except Py4JJavaError as error:
        system.delete(part, True)
        if _is(error, "FileAlreadyExists"):
            return False
        raise
    return True
