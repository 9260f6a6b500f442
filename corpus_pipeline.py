"""A corpus in five stages, each written as Parquet and read again as the next one's documents.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. A stage works on all rows its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import bpe, decontaminate, language, near_dups, secrets
from orderlake.llm.queries import VOCABULARY
from orderlake.llm.staging import ship, staged
from orderlake.operators.joins import join_unique

#: Columns added to rows while near-duplicates are sought.
KEY, OTHER = "_row_key", "_other_key"
#: Rows a worker is sent at once. Encoding works out the pieces of more texts together.
ROWS_AT_ONCE, ROWS_ENCODED_AT_ONCE = 1024, 4096
#: How far from chance to certainty the score of a document's best language has to lie.
LEAST_LIFT = 0.067


def _ready(spark: SparkSession, rows_at_once: int) -> None:
    """Six workers share an executor with the JVM, and a batch exists several times on its way through both."""
    ship(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_at_once)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages. Those without a letter, null and empty texts among them, or far
    from all languages go. Without any labelled text nothing is known of languages, and all rows stay."""
    _ready(spark, ROWS_AT_ONCE)
    return language.keep_known(docs, language.fit(docs), LEAST_LIFT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id; of equal rows one.

    Rows are linked under a key of their own, a hash of all columns, whatever their ids: rows that share or lack
    an id are documents like others. Rows without text are linked with nothing but equal rows. A second
    hash keeps unlike rows apart should they share the first.
    """
    _ready(spark, ROWS_AT_ONCE)
    columns = docs.columns
    keyed = docs.withColumns({KEY: F.xxhash64(*columns), OTHER: F.xxhash64(F.lit(KEY), *reversed(columns))})
    groups = near_dups.near_duplicates(keyed.select(F.col(KEY).alias("doc_id"), "text")).select("doc_id", "component_id").distinct()
    ids = keyed.select(F.col(KEY).alias("doc_id"), F.col("doc_id").alias("own")).distinct()
    first = F.min(F.struct(F.col("own").isNull(), "own", "doc_id"))
    chosen = join_unique(ids, groups, ["doc_id"], "inner").groupBy("component_id").agg(first.alias("first"))
    kept = chosen.select(F.col("first.doc_id").alias(KEY))
    return join_unique(keyed, kept, [KEY], "left_semi").dropDuplicates([KEY, OTHER]).select(columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Null and empty texts have no passage and stay, items without
    words match nothing, repeated rows are judged alike."""
    _ready(spark, ROWS_AT_ONCE)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and the characters of these counted anew. Null texts stay
    null, texts without a secret and their counts are not touched."""
    marked = F.contains("text", F.lit(secrets.REDACTED))
    return secrets.redact(docs).withColumn("n_chars", F.when(marked, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they decode to. Null texts count as empty,
    repeated rows are separate."""
    _ready(spark, ROWS_ENCODED_AT_ONCE)
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("encoding", encoding),
]

#: SQL cannot train a network or merge bytes; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
