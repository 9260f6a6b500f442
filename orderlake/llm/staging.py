"""Tables an operator reads more than once, and the package for the workers."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import cache, wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="orderlake-llm-")


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names; where it is unset, as in tests, a temporary one, but
    only if driver and executors are one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and read it back: its rows are the same for every reader, and losing an
    executor costs no more than reading again."""
    path = f"{shared_folder(df.sparkSession)}/orderlake-llm/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@cache
def _archive() -> str:
    package = Path(__file__).resolve().parents[1]
    path = f"{tempfile.mkdtemp(prefix='orderlake-package-')}/{package.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    return path


_SHIPPED: set[str] = set()


_KEPT: list = []


def kept(make: Callable) -> Callable:
    """``cache`` for what a worker keeps between the tasks of one operator, until tasks of a ``lean`` one begin."""
    _KEPT.append(cache(make))
    return _KEPT[-1]


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def _drop_kept() -> None:
    if any(made.cache_info().currsize for made in _KEPT):
        for made in _KEPT:
            made.cache_clear()
        _give_back()


def lean(run: Callable) -> Callable:
    """A task's function that frees what other operators keep in its worker, and gives its own memory back at its
    end. Workers live on, and what all of them hold counts against one executor."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _drop_kept()
        try:
            yield from run(batches)
        finally:
            _give_back()

    return task


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the workers, once per application: the operators' functions import it."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        context.addPyFile(_archive())
        _SHIPPED.add(context.applicationId)
    return spark
