"""Names, marks and removal of files on whatever file system a path is on, from the driver."""

from __future__ import annotations

import re

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """(file system, path in it)."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names in a folder; none if it does not exist."""
    fs, at = _located(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _located(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _located(spark, path)
    fs.delete(at, True)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern of the file system meets; none if there is no such path."""
    fs, at = _located(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(at) or ()]


def escaped(path: str) -> str:
    """A pattern that only this path meets."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def below(spark: SparkSession, path: str, ending: str) -> list[str]:
    """Paths of the files of a name in a folder, at any depth; of a file, itself."""
    fs, at = _located(spark, path)
    found, held = fs.listFiles(at, True), []
    while found.hasNext():
        file = found.next().getPath()
        if file.getName().endswith(ending):
            held.append(file.toString())
    return held


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether the path is on the machine's own file system."""
    return _located(spark, path)[0].getUri().getScheme() == "file"


def create_once(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if there is one already, made by whomever.

    Of several callers at the same time exactly one gets True, on one machine's disk and on file
    systems that create files atomically, as HDFS does.
    """
    fs, at = _located(spark, path)
    jvm = spark.sparkContext._jvm
    fs.mkdirs(at.getParent())
    try:
        if is_local(spark, path):
            jvm.java.nio.file.Files.createFile(
                jvm.java.io.File(at.toUri().getPath()).toPath(),
                spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0))
        else:
            fs.create(at, False).close()
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or fs.exists(at):
            return False
        raise
    return True
