"""Listing, renaming and small text files through the session's Hadoop file system, so
the same code works on a local folder, HDFS or an object store."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return bool(fs.exists(hpath))


def _names(spark: SparkSession, path: str, folders: bool) -> list[str]:
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return []
    return [s.getPath().getName() for s in fs.listStatus(hpath) if bool(s.isDirectory()) is folders]


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` ([] if it does not exist)."""
    return _names(spark, path, True)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right in ``path`` ([] if it does not exist)."""
    return _names(spark, path, False)


def remove(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return bool(fs.delete(hpath, True))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the target's parent is made, an existing target is an error."""
    fs, hsource = _fs(spark, source)
    htarget = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(htarget.getParent())
    if fs.exists(htarget) or not fs.rename(hsource, htarget):
        raise FileExistsError(f"cannot move {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = _fs(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a whole file appear under ``path`` at once; False if there is one already, which stays as it is."""
    fs, hpath = _fs(spark, path)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    draft = jvm.org.apache.hadoop.fs.Path(hpath.getParent(), f".{hpath.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(hpath), no_options)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and authority, as the file system names it."""
    fs, hpath = _fs(spark, path)
    return fs.makeQualified(hpath).toString()
