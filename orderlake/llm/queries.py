"""The named queries of this subpackage: thin uses of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import (
    bpe, decontaminate, divergence, language, manifest, mixing, near_dups, nearest, secrets, sharding, substrings, token_counts, urls,
)
from orderlake.llm.staging import ship

SHARDS = 40
TOKEN_LIMIT = 2048
QUERY_EVERY = 20
VOCABULARY = "word_bpe_49k.json"
#: How much likelier documents labelled good or poor are to be drawn than those without a label.
QUALITY = {1: 2.0, 0: 0.5}
# The rules pages are judged by.
URL_RULES = (
    urls.Rule(urls.ALLOW, "com", "/"),
    urls.Rule(urls.BLOCK, "example.com", "/en/"),
    urls.Rule(urls.ALLOW, "www.example.com", "/en/"),
    urls.Rule(urls.BLOCK, "net", "/es/"),
    urls.Rule(urls.BLOCK, "net", "/fr/"),
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = lambda spark, folder: build(ship(spark), folder)
    return build


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _span_words(spans: str) -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


@query
def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, folder, "documents"))

    def count(rank: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("bigint")

    counts = [count(rank).alias(f"n_{rule.kind}") for rank, rule in enumerate(secrets.RULES)]
    text = secrets.span_text(F.col("spans"))
    return found.select("doc_id", *counts, F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


@query
def op2_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest_neighbours(_table(spark, folder, "embeddings"), QUERY_EVERY)


@query
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_passages(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    n_hit = _span_words("spans")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, folder, "documents"))


@query
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(_table(spark, folder, "documents"), SHARDS)


@query
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge(_table(spark, folder, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits")


@query
def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(_table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


@query
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(_table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return language.identify(docs, language.fit(docs))


@query
def op10_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    return near_dups.near_duplicates(_table(spark, folder, "documents"), size=2)


@query
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_table(spark, folder, "documents"))


@query
def op12_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    labels = _table(spark, folder, "labels").filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    # a document labelled twice counts as the better
    best = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    weight = F.when(F.col("quality") > 0, QUALITY[1]).otherwise(QUALITY[0])
    return mixing.mix(_table(spark, folder, "documents"), best.select("doc_id", weight.alias("weight")))


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    fields = {name: F.col(name) for name in ("doc_id", "source", "lang", "n_chars", "text")}
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    without = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proven = manifest.manifest(_table(spark, folder, "documents"), fields, {"text": without})
    siblings = F.array_join(F.transform("proof", lambda step: F.concat(step["left"], step["right"])), "")
    folded = manifest.fold(F.col("claim"), F.col("proof"))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
