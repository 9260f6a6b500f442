"""Frames that are needed twice: to find the edges of tiles, and to be compared with them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of the files a frame is made of from which on it is written; joining and shuffling fewer again is cheaper.
LARGE = 32 << 20


def computed_once(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the folder ``spark.checkpoint.dir`` names and read back, so that what it is made of is
    joined and shuffled once. Made of little, or without such a folder, it is left to every reader to compute."""
    spark = df.sparkSession
    folder = _folder(spark)
    if not folder or _input_bytes(df) < LARGE:
        return df
    path = f"{folder.rstrip('/')}/orderlake/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None)


def _input_bytes(df: DataFrame) -> int:
    """The size of the files, of which only the names and sizes are read; 0 for a frame made of none."""
    files = df.inputFiles()
    if not files:
        return 0
    return df.sparkSession.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0] or 0
