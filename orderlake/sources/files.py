"""File sources: raw partitions, whole tables and delimited text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orderlake.functions.columns import as_date
from orderlake.operators import quality
from orderlake.schemas import SCHEMAS


def read_raw_day(spark: SparkSession, root: str, table: str, load_date: str | dt.date) -> DataFrame:
    """One load date of a raw table with its fixed schema; other dates' folders are not read."""
    frame = spark.read.schema(f"{SCHEMAS[table]}, load_date date").parquet(f"{root}/{table}")
    return frame.filter(F.col("load_date") == F.lit(as_date(load_date)))


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A whole published table with the schema it was written with."""
    return spark.read.parquet(f"{root}/{table}")


def _csv(spark: SparkSession):
    # quoted text holds line breaks, and quotes inside text are doubled
    return spark.read.options(header=True, multiLine=True, quote='"', escape='"')


def _fields(table: str) -> dict[str, str]:
    return dict(part.split() for part in SCHEMAS[table].split(", "))


def records(spark: SparkSession, path: str | list[str], quote: str = '"') -> DataFrame:
    """The records of delimited text files, line breaks inside quotes and all: ``file``, ``is_first`` and
    ``record``. A file is read in blocks by many tasks.

    A line begins a record if the quotes before it in its file are even in number; a quote inside text is
    doubled and counts twice. Quotes are summed up per block, blocks are summed up along the file, and lines
    within their block. A block's first lines may still belong to the last record of an earlier one.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
        "value",
        (F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))).alias("quotes"),
    )
    block = ["file", "start"]
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    sums = lines.groupBy(*block).agg(F.sum("quotes").alias("quotes"))
    entering = sums.select(*block, F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("entering"))
    inside = Window.partitionBy(*block).orderBy("id")
    before = F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = ((before + F.col("entering")) % 2 == 0).cast("int")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = lines.join(entering, block).withColumn("begins", begins).withColumn("number", F.sum("begins").over(upto))
    alone = (F.col("begins") == 1) & (F.lead("begins").over(inside) == 1)
    numbered = numbered.withColumn("alone", F.coalesce(alone, F.lit(False))).drop("quotes", "entering", "begins")

    last = numbered.groupBy(*block).agg(F.max("number").alias("number"))
    owner = F.last(F.when(F.col("number") > 0, F.struct("start", "number")), ignorenulls=True).over(earlier)
    owners = last.select(*block, owner.alias("owner"))
    place = F.struct("start", "id", "value")
    own = numbered.filter("number > 0").select("file", "start", "number", "alone", place.alias("line"))
    rest = numbered.filter("number = 0").join(owners, block)
    rest = rest.select("file", "owner.start", "owner.number", F.lit(False).alias("alone"), place.alias("line"))
    record = ["file", "start", "number"]
    # nearly all records are one line and need not be put together
    whole = own.filter("alone").select(*record, F.col("line.value").alias("record"))
    broken = own.filter("NOT alone").unionByName(rest).groupBy(*record).agg(F.sort_array(F.collect_list("line")).alias("lines"))
    joined = F.array_join(F.transform("lines", lambda line: line["value"]), "\n")
    found = whole.unionByName(broken.select(*record, joined.alias("record")))
    text = F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    first = (F.col("start") == 0) & (F.col("number") == 1)
    return found.select("file", first.alias("is_first"), F.when(first, F.ltrim(text, F.lit("\ufeff"))).otherwise(text).alias("record"))


def read_csv_text(spark: SparkSession, path: str | list[str], table: str, **options: str) -> DataFrame:
    """A source table from delimited text, columns found by the names in the header, as text.

    A missing column raises at once, further ones are left out. The files of one read have to share one header;
    another one fails the read. Files with line breaks inside values are read by many tasks, too; records are
    taken apart by Spark's own parser.
    """
    wanted, header = list(_fields(table)), _csv(spark).options(**options).csv(path).columns
    if missing := [c for c in wanted if c not in header]:
        raise ValueError(f"{table} lacks the columns {', '.join(missing)}")
    schema = ", ".join(f"c{i} string" for i in range(len(header)))
    found = records(spark, path, options.get("quote", '"')).filter("record <> ''")
    row = F.from_csv("record", schema, {"quote": '"', "escape": '"', "multiLine": "true", **options})
    rows = found.select("is_first", "file", row.alias("row"))
    cells = F.array(*[F.col("row")[f"c{i}"] for i in range(len(header))])
    same = cells == F.array(*map(F.lit, header))
    other = F.raise_error(F.concat(F.col("file"), F.lit(" has another header than the first file")))
    body = rows.filter(F.when(~F.col("is_first"), True).when(same, False).otherwise(other.cast("boolean")))
    return body.select([F.col("row")[f"c{header.index(c)}"].alias(c) for c in wanted])


def parse_json_lines(lines: DataFrame, table: str) -> DataFrame:
    """A source table from lines of JSON (column ``value``), one object each, as text. Keys are found by name,
    missing ones are null, further ones are left out; blank lines are skipped. A line that holds no object has
    null columns and is kept whole in ``UNREADABLE``."""
    wanted = list(_fields(table))
    schema = StructType([StructField(c, StringType()) for c in [*wanted, quality.UNREADABLE]])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": quality.UNREADABLE}
    lines = lines.filter(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", schema, options).alias("row"))
    # what is valid JSON but no object gives a row without a value
    bare = ~F.trim("value").startswith("{")
    unreadable = F.coalesce(F.col("row")[quality.UNREADABLE], F.when(bare, F.col("value")))
    return parsed.select(*[F.when(unreadable.isNull(), F.col("row")[c]).alias(c) for c in wanted], unreadable.alias(quality.UNREADABLE))


def _typed(table: str) -> dict[str, str]:
    return {c: kind for c, kind in _fields(table).items() if kind != "string"}


def typed(text: DataFrame, table: str) -> DataFrame:
    """Rows of text whose values all fit the table's types, cast to them."""
    fitting = quality.accepted(text, quality.unparsed(_typed(table)))
    return fitting.withColumns({c: F.col(c).try_cast(kind) for c, kind in _typed(table).items()})


def unparsed(text: DataFrame, table: str) -> DataFrame:
    """Rows of text with a value that does not fit, as text, with the reasons."""
    return quality.rejected(text, quality.unparsed(_typed(table)))


def read_csv(spark: SparkSession, path: str | list[str], table: str) -> DataFrame:
    """The rows of a source table that fit its schema. ``unparsed(read_csv_text(...), table)`` has the rest;
    the two are all rows of the files."""
    return typed(read_csv_text(spark, path, table), table)


def read_csv_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Types guessed from the data, for exploration only: it reads the file twice and turns
    identifiers made of digits into numbers."""
    return _csv(spark).option("inferSchema", True).csv(path)
