"""Things of which, among several writers, exactly one can be made: files and folders that were not there."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path in full."""
    packages = spark._jvm.org.apache.hadoop.fs
    plain = packages.Path(path)
    system = plain.getFileSystem(spark._jsc.hadoopConfiguration())
    return packages, system, system.makeQualified(plain)


def _is_taken(error: Py4JJavaError) -> bool:
    return "AlreadyExists" in error.java_exception.getClass().getName()


def create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if there is one already."""
    _, system, full = _hadoop(spark, path)
    try:
        system.create(full, False).close()
    except Py4JJavaError as error:
        if _is_taken(error):
            return False
        raise
    return True


def rename_once(spark: SparkSession, source: str, target: str) -> bool:
    """Give a finished folder its name, by which it appears whole; False if the name is taken already."""
    packages, system, old = _hadoop(spark, source)
    _, _, new = _hadoop(spark, target)
    system.mkdirs(new.getParent())
    # without the option to overwrite, renaming onto something that exists fails
    plain = spark.sparkContext._gateway.new_array(packages.Options.Rename, 0)
    try:
        packages.FileContext.getFileContext(old.toUri(), spark._jsc.hadoopConfiguration()).rename(old, new, plain)
    except Py4JJavaError as error:
        if _is_taken(error):
            return False
        raise
    return True
