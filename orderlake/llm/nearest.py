"""Nearest neighbours by multi-index hashing of learned binary codes.

Codes are signs of rotated vectors; the rotations are learned on a bounded sample so that rounding to signs
loses little. A code is split into substrings of eight bits. Two codes that differ in at most R bits differ
in at most R / m bits of one of the m substrings, so looking up, for every substring, the values within that
radius finds all codes within R. What lies within R is ranked by the exact inner product.

Vectors are cut into index shards and queries into blocks, both of bounded size; every shard meets every
block once. A shard keeps, per substring and value, its codes as a bit list, so uniting the lists of all
substrings for a query costs a few kilobytes of reading. Copies of one vector are one entry of a shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.staging import staged

#: Neighbours per query; vectors and queries handled at once.
NEAREST = 20
SHARD, BLOCK = 4096, 2048
#: Rotations, each as many bits as vectors have components; vectors in the sample, and rounds of learning.
ROTATIONS, SAMPLE, ROUNDS = 4, 4096, 30
#: Share of true neighbours within the radius on the sample.
COVERED = 0.985
BYTE_BITS = np.array([bin(i).count("1") for i in range(256)], np.uint8)


# --- learning ------------------------------------------------------------------------------------


def learn(sample: np.ndarray, rotations: int, rounds: int, seed: int = 0) -> np.ndarray:
    """Rotations, side by side, that bring the sample close to corners of a cube: each round takes the signs
    and solves for the rotation that maps best onto them."""
    rng = np.random.default_rng(seed)
    found = []
    for _ in range(rotations):
        turn = np.linalg.qr(rng.normal(size=(sample.shape[1], sample.shape[1])))[0]
        for _ in range(rounds):
            left, _, right = np.linalg.svd(sample.T @ np.where(sample @ turn >= 0, 1.0, -1.0))
            turn = left @ right
        found.append(turn)
    return np.concatenate(found, 1)


def codes(vectors: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """One byte per substring of eight signs."""
    return np.packbits(vectors @ turn >= 0, axis=1)


def radius(sample: np.ndarray, turn: np.ndarray, nearest: int) -> int:
    """The distance within which ``COVERED`` of the sample's true neighbours lie. Among all vectors neighbours
    are closer than among the sample's, so it errs on the wide side."""
    queries, own = sample[:256], codes(sample, turn)
    scores = queries @ sample.T
    scores[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    top = np.argsort(-scores, axis=1)[:, : min(nearest, len(sample) - 1)]
    distance = BYTE_BITS[own[: len(queries), None] ^ own[top]].sum(2)
    return int(np.quantile(distance, COVERED)) if distance.size else own.shape[1] * 8


# --- shards --------------------------------------------------------------------------------------


class Shard:
    """An index over distinct vectors: per substring and byte value, the codes with it, as bits."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, turn: np.ndarray, within: int, nearest: int):
        self._vectors, entry = _distinct(vectors)
        # repeated rows count once; of copies only the smallest ids can be among the nearest, the query's own left aside
        entry, ids = np.unique(np.stack([entry, ids]), axis=1)
        begin = np.searchsorted(entry, np.arange(len(self._vectors) + 1))
        self._ids = [ids[a : min(b, a + nearest + 1)] for a, b in zip(begin, begin[1:])]
        self._codes = codes(self._vectors, turn)
        self._within, self._nearest = within, nearest
        n, m = self._codes.shape
        reach = within // m
        near = BYTE_BITS[np.arange(256)[:, None] ^ np.arange(256)[None]] <= reach
        self._lists = np.zeros((m, 256, (n + 7) // 8), np.uint8)
        for sub in range(m):
            # bit lists of single values, united over the values within reach
            single = np.zeros((256, n), bool)
            single[self._codes[:, sub], np.arange(n)] = True
            self._lists[sub] = np.packbits(near.astype(np.float32) @ single.astype(np.float32) > 0, axis=1)

    def search(self, query: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct ids and scores of the nearest entries within the radius, best first, ties to the smaller id.
        An id with several vectors has the score of its best."""
        lists = self._lists[np.arange(len(code)), code]
        met = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(lists, axis=0))[: len(self._codes)])
        met = met[BYTE_BITS[self._codes[met] ^ code].sum(1, dtype=np.int32) <= self._within]
        scores = (self._vectors[met] * query).sum(1)
        if len(met) > 4 * self._nearest:
            worst = np.partition(scores, len(met) - self._nearest - 1)[len(met) - self._nearest - 1]
            ids, best = self._best(met[scores >= worst], scores[scores >= worst])
            # fewer only if ids with several vectors among the best entries took the places of others
            if len(ids) > self._nearest:
                return ids, best
        return self._best(met, scores)

    def _best(self, met: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(met):
            return np.zeros(0, np.int64), scores
        ids = np.concatenate([self._ids[i] for i in met])
        scores = np.repeat(scores, [len(self._ids[i]) for i in met])
        order = np.lexsort((ids, -scores))
        first = np.sort(np.unique(ids[order], return_index=True)[1])[: self._nearest + 1]
        return ids[order][first], scores[order][first]


def _distinct(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and which one each row is."""
    rows = np.ascontiguousarray(vectors + 0.0)  # -0.0 counts as 0.0
    keys = rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1])))[:, 0]
    _, first, which = np.unique(keys, return_index=True, return_inverse=True)
    return rows[first], which


# --- Spark ---------------------------------------------------------------------------------------


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Vectors that take part: not null, finite, not all zero, with an id."""
    components = F.col("v")
    # a null component makes the test null, and then the vector goes too
    finite = F.forall(components, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(components, lambda x: x != 0)
    plain = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return plain.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(finite & nonzero)


def _blobs(size: int) -> Callable:
    """Rows of at most ``size`` vectors, numbered within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for whole in batches:
            for first in range(0, whole.num_rows, size):
                batch = whole.slice(first, size)
                ids = batch.column("vec_id").to_numpy()
                flat = batch.column("v").flatten().to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([ids.tobytes()], pa.binary()), pa.array([flat.tobytes()], pa.binary())],
                    ["number", "ids", "flat"],
                )
                number += 1

    return run


def _search(turn: np.ndarray, within: int, nearest: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                ids, flat, q_ids, q_flat = (batch.column(c)[row].as_py() for c in ("ids", "flat", "q_ids", "q_flat"))
                if held != (ids, flat):
                    entries = np.frombuffer(ids, np.int64)
                    shard, held = Shard(entries, np.frombuffer(flat).reshape(len(entries), -1), turn, within, nearest), (ids, flat)
                queries = np.frombuffer(q_ids, np.int64)
                distinct, which = _distinct(np.frombuffer(q_flat).reshape(len(queries), -1))
                found = [shard.search(q, c) for q, c in zip(distinct, codes(distinct, turn))]
                for first in range(0, len(queries), 256):
                    part = range(first, min(first + 256, len(queries)))
                    sizes = [len(found[which[i]][0]) for i in part]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(queries[part.start : part.stop], sizes)),
                            pa.array(np.concatenate([found[which[i]][0] for i in part])),
                            pa.array(np.concatenate([found[which[i]][1] for i in part])),
                        ],
                        ["query_id", "vec_id", "score"],
                    )

    return run


def _is_query(every: int) -> Column:
    return F.col("vec_id") % every == 0


def nearest_neighbours(
    vectors: DataFrame,
    every: int,
    nearest: int = NEAREST,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shards: int | None = None,
) -> DataFrame:
    """Per query its nearest other vectors: query_id, rank (from 1), vec_id and score, the inner product in
    double precision. Queries are the vectors whose id ``every`` divides; candidates are all but the query.

    Equal scores rank by the smaller id. Vectors that are null, all zero, or hold a null or non-finite
    component take no part, nor do rows without id and vectors of another length than the most frequent one
    of the sample. Repeated rows of one id and vector count once in a result, and an id with several vectors
    once, with its best score. Other columns are not read.
    The search is approximate: a true neighbour farther than the learned radius in code bits is missed. Every
    query has ``nearest`` neighbours, or all candidates if there are fewer: those with fewer within the radius
    are searched again with a radius of all bits, which is exact.
    """
    spark = vectors.sparkSession
    whole = usable(vectors, id_col, vector_col)
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    sample = _sample(whole)
    if not sample:
        return spark.createDataFrame([], schema)
    lengths = [len(v) for v in sample]
    length = max(set(lengths), key=lambda n: (lengths.count(n), n))
    fitted = np.array([v for v in sample if len(v) == length])
    turn = learn(fitted, ROTATIONS, ROUNDS)

    whole = whole.filter(F.size("v") == length)
    rows, ids = whole.agg(F.count(F.lit(1)), F.count_distinct("vec_id")).first()
    # a shard is one stretch of the index; every query is sent to each
    shards = shards or max(1, -(-rows // SHARD))
    blob = "number bigint, ids binary, flat binary"
    index = whole.mapInArrow(_blobs(SHARD), blob).withColumn("at", F.pmod(F.xxhash64("ids"), F.lit(shards)))
    everywhere = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def search(queries: DataFrame, within: int) -> DataFrame:
        blocks = queries.mapInArrow(_blobs(BLOCK), blob)
        blocks = blocks.select(F.col("ids").alias("q_ids"), F.col("flat").alias("q_flat"), everywhere.alias("at"))
        # a merge join streams its left side, so a shard meets all its blocks before the next is built
        met = index.join(blocks.hint("merge"), "at").select("ids", "flat", "q_ids", "q_flat").mapInArrow(
            _search(turn, within, nearest), "query_id bigint, vec_id bigint, score double"
        )
        others = met.filter("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        ranked = others.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= nearest)
        return ranked.select("query_id", "rank", "vec_id", "score")

    queries = whole.filter(_is_query(every)).repartition(max(1, -(-rows // (every * BLOCK))))
    found = staged(search(queries, radius(fitted, turn, nearest)), "nearest")
    have = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    asked = queries.select(F.col("vec_id").alias("query_id")).distinct()
    wanted = F.lit(min(nearest, ids - 1))
    short = staged(asked.join(have, "query_id", "left").filter(F.coalesce("n", F.lit(0)) < wanted).select("query_id"), "short")
    if short.isEmpty():
        return found
    again = search(queries.join(short, F.col("vec_id") == F.col("query_id"), "left_semi"), turn.shape[1])
    return found.join(short, "query_id", "left_anti").unionByName(again)


def _sample(whole: DataFrame) -> list[list[float]]:
    """``SAMPLE`` distinct vectors, those of the smallest hashes. Only hashes are shuffled to find them."""
    hashed = whole.withColumn("h", F.xxhash64("v"))
    chosen = hashed.select("h").distinct().orderBy("h").limit(SAMPLE)
    rows = hashed.join(F.broadcast(chosen), "h").groupBy("h").agg(F.first("v").alias("v")).orderBy("h").collect()
    return [row.v for row in rows]
