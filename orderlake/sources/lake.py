"""The lake: raw batches, silver days, rejects and reports, all read through ledgers.

Data is written into folders of its own first and one ledger file after it, which appears whole or not at
all. A reader sees what the ledger names: the newest generation of a batch, the newest run of a day, the
newest run or version of a bucket. A run that dies in between leaves files no reader looks at.

Two things are kept per bucket, by a hash: where each line is in silver, and what the reports are made of.
So a run reads and writes the buckets of what it changes, and no others.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field, replace
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from orderlake.operators import customers, quality
from orderlake.operators.ranking import Edge
from orderlake.schemas import ENRICHED, FLOOR_WATERMARK, SCHEMAS
from orderlake.session import require_utc
from orderlake.sources.once import create_once, rename_once
from orderlake.sources.sinks import replace_table, write_partitions

_LEDGERS = {
    "batches": "batch_id bigint, generation bigint, table_name string, load_date date, lo string, hi string, "
    "n_rows bigint, n_unparsed bigint, run_id string, committed_at timestamp",
    # per run one row for each batch taken in, one for each day rebuilt and one for each bucket of the line
    # index; a bucket is one of so many
    "silver": "run bigint, batch_id bigint, generation bigint, is_day boolean, day date, bucket int, buckets int, "
    "committed_at timestamp",
    # per version one row, and one for each bucket of its state it has written
    "reports": "version bigint, reference_date date, churn_days int, silver_run bigint, tags_version bigint, "
    "edges string, state string, bucket int, buckets int, committed_at timestamp",
}

#: Where the lines are: per line its order and day.
_INDEX = "LINEITEM_ID string, ORDER_ID string, ORDER_DATE date"
#: What reports are made of: lines summed per order, customer, restaurant and day.
SLICE_KEY = ["ORDER_ID", "USER_ID", "RESTAURANT_ID", "ORDER_DATE"]
_SLICES = "ORDER_ID string, USER_ID string, RESTAURANT_ID string, ORDER_DATE date, LINE_REVENUE decimal(38,2), NUM_LINES bigint"
#: The kept tables of the reports, by the column that deals their rows into buckets.
STATES = {
    "customer_orders": ("USER_ID", _SLICES),
    "customer_days": ("USER_ID", "USER_ID string, SNAPSHOT_DATE date, DAILY_SPEND decimal(38,2), RUNNING_LTV decimal(38,2), LATEST_LTV decimal(38,2)"),
    "customers": ("USER_ID", "USER_ID string, FREQUENCY bigint, MONETARY decimal(38,2), LAST_ORDER date, LATEST_LTV decimal(38,2)"),
    "location_orders": ("ORDER_ID", _SLICES),
    "location_parts": ("ORDER_ID", "RESTAURANT_ID string, TOTAL_REVENUE decimal(38,2), NUM_ORDERS bigint"),
}
_OPEN_TAGS = "USER_ID string, CLV_TAG string, VALID_FROM date"
_CLOSED_TAGS = f"{_OPEN_TAGS}, VALID_TO date, version bigint"


class WriterConflict(RuntimeError):
    """Another writer has committed what this one was about to."""


@dataclass(frozen=True)
class Batch:
    """One committed load: the range it read, and per table the rows it found that fit and that do not."""

    batch_id: int
    load_date: dt.date
    lo: str | None
    hi: str | None
    rows: dict[str, int]
    generation: int = 1
    unparsed: dict[str, int] = field(default_factory=dict)

    @property
    def decides_options(self) -> bool:
        """It read lines and options together, so a line without options has none."""
        return {"order_items", "order_item_options"} <= set(self.rows)

    @property
    def advanced(self) -> bool:
        """The load moved the watermark, which it does only to something strictly newer."""
        return self.hi is not None and self.hi > self.lo


class Lake:
    """Paths and ledgers under one root folder. Watermarks and days are in UTC, and so must the session be.

    ``buckets`` is the number kept tables are dealt into. A bucket is read and written whole, so it should be
    some hundred megabytes; with another number than before, the next run makes these tables anew.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = require_utc(spark), root.rstrip("/"), buckets

    def zone(self, *parts: object) -> str:
        return "/".join([self.root, *map(str, parts)])

    def _read(self, schema: str, *parts: object) -> DataFrame:
        """A table that may have no file yet."""
        try:
            return self.spark.read.schema(schema).parquet(self.zone(*parts))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    # ledgers: one tiny folder per commit

    def ledger(self, name: str) -> DataFrame:
        columns = [part.split()[0] for part in _LEDGERS[name].split(", ")]
        return self._read(_LEDGERS[name], "ops", name).select(*columns)

    def commit(self, name: str, rows: list[dict], entry: str) -> None:
        """Put ledger rows under a name, as one file that appears whole. Of several writers who put something under
        one name the first wins; the others' rows are never visible. Columns not given are null."""
        now = dt.datetime.now(dt.timezone.utc)
        columns = [part.split()[0] for part in _LEDGERS[name].split(", ")]
        full = [tuple((row | {"committed_at": now}).get(c) for c in columns) for row in rows]
        draft = self.zone("ops", "drafts", uuid.uuid4().hex)
        self.spark.createDataFrame(full, _LEDGERS[name]).coalesce(1).write.parquet(draft)
        if not rename_once(self.spark, draft, self.zone("ops", name, f"entry={entry}")):
            raise WriterConflict(f"{name}: {entry} was committed meanwhile")

    def claim(self, name: str, number: int) -> int:
        """A number no other writer uses, from the given one on. What is written is put into a folder of that
        number, so writers never share one; those of dead writers stay unused."""
        while not create_once(self.spark, self.zone("ops", "claims", name, f"{number:08d}")):
            number += 1
        return number

    # raw batches

    def committed(self) -> DataFrame:
        """Ledger rows of the newest generation of every batch."""
        rows = self.ledger("batches")
        newest = rows.groupBy("batch_id").agg(F.max("generation").alias("generation"))
        return rows.join(newest, ["batch_id", "generation"])

    def watermark(self) -> str:
        """Upper end of the newest committed load, or the floor before the first."""
        return self.ledger("batches").agg(F.max("hi")).first()[0] or FLOOR_WATERMARK

    def next_batch_id(self) -> int:
        """A number for a new batch."""
        return self.claim("batches", (self.ledger("batches").agg(F.max("batch_id")).first()[0] or 0) + 1)

    def batches(self, only: set[int] | None = None) -> list[Batch]:
        """Committed batches, oldest first: the ledger holds one row per batch and table."""
        rows = self.committed()
        return _batches(rows if only is None else rows.filter(F.col("batch_id").isin(list(only))))

    def new_batches(self) -> list[Batch]:
        """Committed batches, or new generations of them, that silver does not hold yet."""
        done = self.ledger("silver").filter(~F.col("is_day")).select("batch_id", "generation")
        return _batches(self.committed().join(done, ["batch_id", "generation"], "left_anti"))

    def newest_with(self, table: str) -> Batch | None:
        """The newest committed batch that holds a table."""
        newest = self.committed().filter(F.col("table_name") == table).agg(F.max("batch_id")).first()[0]
        return None if newest is None else self.batches({newest})[0]

    def _batch_path(self, batch: Batch, *zone: str) -> str:
        return self.zone(*zone, f"load_date={batch.load_date}", f"batch_id={batch.batch_id}", f"generation={batch.generation}")

    def write_batch(self, df: DataFrame, table: str, batch: Batch) -> int:
        """Write one table of a batch into its own folder and return the number of rows, counted while
        writing. Rows with a value that does not fit its column's type go to the rejects of the batch's
        generation, as text and with the reasons, and are counted in ``batch.unparsed``. So do lines no row
        could be made of, which the reason holds."""
        fields = dict(part.split() for part in SCHEMAS[table].split(", "))
        rows = df.select([F.col(name).alias(name) for name in fields])
        rules = quality.unparsed({c: fields[c] for c, has in rows.dtypes if fields[c] not in ("string", has)})
        if quality.UNREADABLE in df.columns:
            rows = df.select([F.col(name).alias(name) for name in [*fields, quality.UNREADABLE]])
            rules[quality.UNREADABLE] = F.col(quality.UNREADABLE).isNotNull()
        batch.unparsed[table] = 0
        if rules:
            # both parts are taken from one reading of the source
            staged = self._batch_path(batch, "staging", "batches", table)
            replace_table(rows, staged)
            rows = self.spark.read.schema(rows.schema).parquet(staged)
            bad = quality.rejected(rows, rules)
            if quality.UNREADABLE in rows.columns:
                whole = F.concat(F.lit("line is not an object: "), F.col(quality.UNREADABLE))
                bad = bad.withColumn(quality.REASON, F.coalesce(whole, F.col(quality.REASON)))
            bad = bad.select([F.col(c).cast("string").alias(c) for c in [*fields, quality.REASON]])
            batch.unparsed[table] = self._write_counted(bad, self._batch_path(batch, "rejects", "unparsed", table))
            rows = quality.accepted(rows, rules)
        typed = rows.select([F.col(name).try_cast(kind).alias(name) for name, kind in fields.items()])
        return self._write_counted(typed, self._batch_path(batch, "raw", table))

    def _write_counted(self, rows: DataFrame, path: str) -> int:
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
        return seen.get["n"]

    def commit_batch(self, batch: Batch, run_id: str) -> None:
        """Make a batch visible. A new load has to start where the lake is now, and a batch's generation can be
        committed once; otherwise somebody else has written meanwhile, and nothing of the batch is ever seen.

        New batches are entered one after the other: the entry's number follows from the ledger the watermark is
        read from, so who enters first makes the other's entry, and with it an outdated watermark, impossible.
        """
        mine = (F.col("batch_id") == batch.batch_id) & (F.col("generation") >= batch.generation)
        loads, high, known = self.ledger("batches").agg(F.count_distinct("batch_id"), F.max("hi"), F.count_if(mine)).first()
        if known:
            raise WriterConflict(f"batch {batch.batch_id} is already committed")
        if batch.generation == 1 and batch.lo is not None and not (batch.lo == (high or FLOOR_WATERMARK) <= batch.hi):
            raise WriterConflict(f"the watermark is no longer {batch.lo}")
        whole = {"batch_id": batch.batch_id, "generation": batch.generation, "load_date": batch.load_date}
        whole |= {"lo": batch.lo, "hi": batch.hi, "run_id": run_id}
        rows = [whole | {"table_name": table, "n_rows": n, "n_unparsed": batch.unparsed.get(table, 0)} for table, n in batch.rows.items()]
        entry = f"load-{loads + 1:08d}" if batch.generation == 1 else f"batch-{batch.batch_id:08d}-generation-{batch.generation}"
        self.commit("batches", rows, entry)

    def next_generation(self, batch: Batch) -> Batch:
        generation = self.claim(f"batch-{batch.batch_id:08d}", batch.generation + 1)
        return replace(batch, rows={}, unparsed={}, generation=generation)

    def read_batches(self, table: str, batches: list[Batch] | None = None) -> DataFrame:
        """The rows of a raw table with load date and batch: of the given batches in the generation they
        name, or of all committed ones."""
        schema = f"{SCHEMAS[table]}, load_date date, batch_id bigint, generation bigint"
        rows = self._read(schema, "raw", table)
        if batches is None:
            chosen = self.committed().filter(F.col("table_name") == table)
            keys = ["load_date", "batch_id", "generation"]
            return rows.join(chosen.select(*keys), keys, "left_semi").drop("generation")
        wanted = F.lit(False)
        for b in batches:
            # the load date as well: a run that died may have used the batch's number on another day
            folder = (F.col("load_date") == F.lit(b.load_date)) & (F.col("batch_id") == b.batch_id)
            wanted = wanted | (folder & (F.col("generation") == b.generation))
        return rows.filter(wanted).drop("generation")

    def read_generations(self, table: str, batch_ids: list[int]) -> DataFrame:
        """The rows of all generations of the given batches, dead ones included."""
        schema = f"{SCHEMAS[table]}, load_date date, batch_id bigint, generation bigint"
        return self._read(schema, "raw", table).filter(F.col("batch_id").isin(batch_ids))

    # silver and rejects

    def silver_run(self) -> int:
        """Newest committed run of the silver job, 0 if there is none."""
        return self.ledger("silver").agg(F.max("run")).first()[0] or 0

    def silver(self, table: str, run: int | None = None) -> DataFrame:
        """A silver table as of the newest committed run, or an earlier one. Of the order lines, each day comes
        from the last run that rebuilt it."""
        run = run or self.silver_run()
        if not run:
            raise LookupError("silver is not published yet")
        if table != "order_items_enriched":
            return self.spark.read.parquet(self.zone("prod", table, f"run={run}"))
        rebuilt = self.ledger("silver").filter(F.col("is_day") & (F.col("run") <= run))
        days = rebuilt.groupBy("day").agg(F.max("run").alias("_run"))
        rows = self._read(f"{ENRICHED}, run bigint, year int, month int, day int", "prod", table)
        current = (F.col("run") == F.col("_run")) & F.col("ORDER_DATE").eqNullSafe(F.col("day_"))
        return rows.join(days.withColumnRenamed("day", "day_"), current).drop("run", "_run", "day_")

    def days_since(self, run: int) -> list[dt.date | None]:
        """The days rebuilt after a run."""
        rebuilt = self.ledger("silver").filter(F.col("is_day") & (F.col("run") > run))
        return [row.day for row in rebuilt.select("day").distinct().collect()]

    def in_bucket(self, column: str):
        """The bucket of a value; null has one, too."""
        return F.pmod(F.xxhash64(column), F.lit(self.buckets)).cast("int")

    def _newest(self, rows: DataFrame, ledger: DataFrame, number: str, buckets: list[int] | None) -> DataFrame:
        """Of every bucket the rows its newest run or version has written; ``number`` names which. At most one
        ledger row per bucket comes to the driver, so that only the folders named are read."""
        written: dict[int, list[int]] = {}
        for bucket, newest in ledger.groupBy("bucket").agg(F.max(number)).collect():
            if buckets is None or bucket in buckets:
                written.setdefault(newest, []).append(bucket)
        wanted = F.lit(False)
        for newest, own in sorted(written.items()):
            wanted = wanted | ((F.col(number) == newest) & F.col("bucket").isin(own))
        return rows.filter(wanted).drop(number)

    def has_line_index(self, run: int) -> bool:
        """Whether a run, the newest, has kept the index, in this number of buckets."""
        kept = (F.col("run") == run) & (F.col("buckets") == self.buckets)
        return not self.ledger("silver").filter(kept).isEmpty()

    def line_index(self, buckets: list[int]) -> DataFrame:
        """Of the lines in some buckets: line, order, day and bucket."""
        kept = self.ledger("silver").filter(F.col("buckets") == self.buckets)
        rows = self._read(f"{_INDEX}, run bigint, bucket int", "prod", f"line_index_{self.buckets}")
        return self._newest(rows, kept, "run", buckets)

    def write_line_index(self, lines: DataFrame, run: int) -> None:
        own = lines.select("LINEITEM_ID", "ORDER_ID", "ORDER_DATE", self.in_bucket("LINEITEM_ID").alias("bucket"))
        write_partitions(own, self.zone("prod", f"line_index_{self.buckets}", f"run={run}"), ("bucket",))

    def rejects(self, table: str) -> DataFrame:
        """Rows set aside, as of the newest committed run: all options without a line, and of the order
        lines those of each batch's last run."""
        run = self.silver_run()
        if not run:
            raise LookupError("silver is not published yet")
        if table == "order_item_options":
            return self.spark.read.parquet(self.zone("rejects", table, f"run={run}"))
        taken = self.ledger("silver").filter(~F.col("is_day")).groupBy("batch_id").agg(F.max("run").alias("run"))
        return self.spark.read.parquet(self.zone("rejects", table)).join(taken, ["batch_id", "run"]).drop("run")

    def unparsed(self, table: str) -> DataFrame:
        """Rows of all committed batches with a value that does not fit its column's type, as text, with the
        reasons, load date and batch."""
        fields = ", ".join(f"{part.split()[0]} string" for part in SCHEMAS[table].split(", "))
        schema = f"{fields}, {quality.REASON} string, load_date date, batch_id bigint, generation bigint"
        # a batch that set nothing aside may have files of a dead run in its folder
        chosen = self.committed().filter((F.col("table_name") == table) & (F.col("n_unparsed") > 0))
        keys = ["load_date", "batch_id", "generation"]
        return self._read(schema, "rejects", "unparsed", table).join(chosen.select(*keys), keys, "left_semi").drop("generation")

    # reports

    def report_version(self) -> int:
        """Newest published version of the reports, 0 if there is none."""
        return self.ledger("reports").agg(F.max("version")).first()[0] or 0

    def published(self, version: int | None = None) -> Row | None:
        """What is known of a version, the newest by default: its days, the silver run it was made from and the
        edges of its tiers."""
        chosen = version or self.report_version()
        return self.ledger("reports").filter((F.col("version") == chosen) & F.col("state").isNull()).first()

    def state(self, table: str, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """A kept table as of a version: each bucket as the last version up to it has written it."""
        chosen = self.published(version)
        key, schema = STATES[table]
        of = chosen.buckets if chosen else self.buckets
        rows = self._read(f"{schema}, version bigint, bucket int", "state", f"{table}_{of}")
        kept = self.ledger("reports").filter((F.col("state") == key) & (F.col("buckets") == of))
        return self._newest(rows, kept.filter(F.col("version") <= (chosen.version if chosen else 0)), "version", buckets)

    def state_with(self, table: str, version: int, buckets: list[int], kept: bool) -> DataFrame:
        """A kept table with the buckets a version not yet published has written; if ``kept``, the others as they
        were published."""
        path = ("state", f"{table}_{self.buckets}", f"version={version}")
        new = self._read(f"{STATES[table][1]}, bucket int", *path)
        if not kept:
            return new
        return new.unionByName(self.state(table, buckets=[b for b in range(self.buckets) if b not in buckets]))

    def write_state(self, rows: DataFrame, table: str, version: int) -> None:
        """Write the buckets of a kept table that ``rows`` belong to; they carry their bucket."""
        columns = [part.split() for part in STATES[table][1].split(", ")]
        typed = rows.select(*[F.col(c).cast(kind).alias(c) for c, kind in columns], "bucket")
        write_partitions(typed, self.zone("state", f"{table}_{self.buckets}", f"version={version}"), ("bucket",))

    def report(self, table: str, version: int | None = None) -> DataFrame:
        """A report table; all tables of one version come from the same run. The two customer reports are read
        from the kept tables: what depends on the version, tiers and recency, is worked out in place."""
        chosen = self.published(version)
        if chosen is None:
            raise LookupError("no reports are published yet")
        number = chosen.version
        if table == "clv":
            return customers.tagged(self.state("customer_days", number).drop("bucket"), edges_from(chosen.edges))
        if table == "rfm":
            kept = self.state("customers", number).drop("bucket")
            recency = F.datediff(F.lit(chosen.reference_date), "LAST_ORDER")
            return customers.flag_churn(kept.withColumn("RECENCY", recency).drop("LAST_ORDER", "LATEST_LTV"), chosen.churn_days)
        if table == "clv_tag_history":
            until = F.col("version") <= chosen.tags_version
            closed = self._read(_CLOSED_TAGS, "state", "closed_tags").filter(until).drop("version")
            return closed.unionByName(self.open_tags(chosen.tags_version).withColumn("VALID_TO", F.lit(None).cast("date")))
        return self.spark.read.parquet(self.zone("reporting", f"version={number}", table))

    def open_tags(self, version: int) -> DataFrame:
        """The tiers customers have since a version that has written them; none for 0."""
        return self._read(_OPEN_TAGS, "state", "open_tags", f"version={version}")


def edges_from(text: str) -> list[Edge]:
    """Edges of tiers as the ledger holds them."""
    return [Edge(None if value is None else Decimal(value), key, first) for value, key, first in json.loads(text)]


def edges_text(edges: list[Edge]) -> str:
    return json.dumps([(None if e.value is None else str(e.value), e.key, e.first) for e in edges])


def _batches(rows: DataFrame) -> list[Batch]:
    found: dict[int, Batch] = {}
    for row in rows.orderBy("batch_id", "table_name").collect():
        batch = Batch(row.batch_id, row.load_date, row.lo, row.hi, {}, row.generation)
        batch = found.setdefault(row.batch_id, batch)
        batch.rows[row.table_name], batch.unparsed[row.table_name] = row.n_rows, row.n_unparsed or 0
    return list(found.values())
