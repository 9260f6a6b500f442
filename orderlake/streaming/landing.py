"""Files dropped into a landing folder as raw batches, each file exactly once, and on into silver.

The stream's checkpoint remembers which files were taken and replaces the watermark. Every trigger
works off what is there and stops, so it can be scheduled like a batch job.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.columns import as_date
from orderlake.plans import jobs
from orderlake.schemas import SCHEMAS
from orderlake.sources import files
from orderlake.sources.lake import Batch, Lake

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def land_files(
    lake: Lake,
    table: str,
    folder: str,
    load_date: str | dt.date,
    file_format: str = "parquet",
    max_files: int = 1000,
    publish: bool = False,
    **options: str,
) -> int:
    """Take all new files of one table and return the number of batches committed for it. With ``publish`` every
    micro-batch also goes through silver: its lines and the days they are on are rebuilt, and options whose line
    has not come yet stay open until the stream of lines brings it.

    Delimited text is read by the names in the header, as ``files.read_csv_text`` does, JSON as one object per
    line, and rows with a value that does not fit, or no object at all, are set aside by ``Lake.write_batch``.

    A micro-batch that is repeated after a failure finds its run in the ledger and is not landed twice. Silver
    takes in whatever it does not hold yet, so a batch that was landed and not published is published then.
    """
    by_header, by_line = file_format == "csv", file_format == "json"
    day = as_date(load_date)

    def land(rows: DataFrame, epoch: int) -> None:
        run_id = f"stream-{table}-{epoch}"
        if not lake.ledger("batches").filter(F.col("run_id") == run_id).isEmpty():
            return
        if by_header:
            rows = files.read_csv_text(lake.spark, [row.path for row in rows.collect()], table, **options)
        if by_line:
            rows = files.parse_json_lines(rows, table)
        batch = Batch(lake.next_batch_id(), day, None, None, {})
        batch.rows[table] = lake.write_batch(rows, table, batch)
        lake.commit_batch(batch, run_id)

    def take(rows: DataFrame, epoch: int) -> None:
        land(rows, epoch)
        if publish:
            jobs.silver(lake)

    before = len(lake.batches())
    stream = lake.spark.readStream.options(maxFilesPerTrigger=max_files)
    if by_header:
        # the stream finds the files, of which only the names are read
        stream = stream.schema(_FILES).format("binaryFile").load(folder).select("path")
    elif by_line:
        stream = stream.options(**options).text(folder)
    else:
        stream = stream.options(**options).schema(SCHEMAS[table]).format(file_format).load(folder)
    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", lake.zone("ops", "streams", table))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(lake.batches()) - before
