"""Benchmark passages in training documents, found through an FM-index of every shard.

A shard is a stretch of a partition. Its words become numbers of the benchmark's vocabulary. Words the
benchmark does not have can be in no phrase, so only stretches of known words at least as long as the
shortest phrase enter the index, each closed by a separator. The index is a suffix array's Burrows-Wheeler
transform in a wavelet matrix, with the text positions of every 16th symbol and of the first of each
stretch. All phrases are searched backward at once, a numpy step per word and bit.

Documents are never shuffled. Phrases are taken in blocks of a bounded number of words, and each block is
one pass over the shards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm import words as W
from orderlake.llm.staging import lean
from orderlake.operators.joins import join_unique

WINDOW = 10
#: Indexed words of a shard, and texts in it, after which the next begins.
SHARD_WORDS, SHARD_TEXTS = 1 << 20, 1 << 16
#: Every so many text positions is kept in the index.
SAMPLED = 16
#: Benchmark words broadcast at once; more are searched in further passes.
BLOCK_WORDS = 4_000_000


# --- index ---------------------------------------------------------------------------------------


class WaveletMatrix:
    """Rank queries over a sequence of numbers, one bit of the numbers per level."""

    def __init__(self, symbols: np.ndarray, top: int):
        self._levels = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit) & 1 > 0
            before = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(~ones, out=before[1:])
            self._levels.append((bit, before))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its ``end``."""
        low, high = np.zeros(len(symbol), np.int64), end.astype(np.int64)
        for bit, zeros in self._levels:
            one, n_zeros = (symbol >> bit) & 1 > 0, int(zeros[-1])
            low = np.where(one, n_zeros + low - zeros[low], zeros[low])
            high = np.where(one, n_zeros + high - zeros[high], zeros[high])
        return high - low


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes by doubling. Symbol 0 separates: each of its places sorts by position, below
    all words, so no comparison runs past one."""
    n = len(symbols)
    gaps = symbols == 0
    rank = np.where(gaps, np.cumsum(gaps) - 1, symbols.astype(np.int64) + int(gaps.sum()))
    step = 1
    _, rank = np.unique(rank, return_inverse=True)
    while True:
        following = np.zeros(n, np.int64)
        following[: max(0, n - step)] = rank[step:] + 1
        key = rank * np.int64(n + 2) + following
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) > 0)])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


class FmIndex:
    """Count and locate phrases in a sequence that ends with a separator (0)."""

    def __init__(self, symbols: np.ndarray, top: int):
        order = suffix_array(symbols)
        self.n = len(symbols)
        self._bwt = symbols[order - 1]
        self._wavelet = WaveletMatrix(self._bwt, top)
        counts = np.bincount(symbols, minlength=top + 1)
        self._first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        # a walk back never crosses a separator, as the first place after one is sampled
        kept = (order % SAMPLED == 0) | (self._bwt == 0)
        self._kept = kept
        self._kept_before = np.cumsum(kept) - 1
        self._places = order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows ``low`` to ``high`` of the index for the phrases that occur, and which these are. Phrases
        are rows of a matrix, filled from the right."""
        which = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for step in range(1, phrases.shape[1] + 1):
            ended = lengths[which] < step
            if ended.any():
                done.append((which[ended], low[ended], high[ended]))
                which, low, high = which[~ended], low[~ended], high[~ended]
            symbol = phrases[which, -step]
            low = self._first[symbol] + self._wavelet.rank(symbol, low)
            high = self._first[symbol] + self._wavelet.rank(symbol, high)
            found = low < high
            which, low, high = which[found], low[found], high[found]
            if not len(which):
                break
        done.append((which, low, high))
        return tuple(np.concatenate(part) for part in zip(*done))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the index, walking back to the next sampled one."""
        place, steps, rows = np.empty(len(rows), np.int64), 0, rows.copy()
        open_ = np.arange(len(rows))
        while len(open_):
            here = rows[open_]
            kept = self._kept[here]
            place[open_[kept]] = self._places[self._kept_before[here[kept]]] + steps
            open_, here = open_[~kept], here[~kept]
            symbol = self._bwt[here]
            rows[open_] = self._first[symbol] + self._wavelet.rank(symbol, here)
            steps += 1
        return place


# --- phrases -------------------------------------------------------------------------------------


@dataclass
class Phrases:
    """The distinct windows of a block of benchmark items: numbers of words, and the items of each."""

    vocabulary: np.ndarray  # sorted word hashes; the number of a word is its place here plus one
    table: np.ndarray
    lengths: np.ndarray
    edges: np.ndarray  # items of phrase p: items[edges[p]:edges[p + 1]]
    items: np.ndarray


def _splitter() -> W.Splitter:
    return W.Splitter(W.ALPHANUMERIC, lower=True)


def phrases(items: list[tuple[int | None, str | None]], window: int) -> Phrases | None:
    """Windows of the items; an item shorter than a window is one phrase. None if there is no word."""
    texts = pa.array([text for _, text in items], pa.large_string())
    found: dict[tuple[int, ...], set[int]] = {}
    hashes: list[np.ndarray] = []
    for words in _splitter().slices(texts):
        hashes.append(words.hash)
        for i in range(words.n_texts):
            own = words.hash[words.borders[i] : words.borders[i + 1]].tolist()
            number = items[words.first + i][0]
            for start in range(max(1, len(own) - window + 1)) if own else ():
                found.setdefault(tuple(own[start : start + window]), set()).add(number)
    vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
    if not found:
        return None
    table, lengths = np.zeros((len(found), window), np.int64), np.array([len(p) for p in found])
    for row, phrase in enumerate(found):
        table[row, window - len(phrase) :] = np.searchsorted(vocabulary, np.array(phrase, np.uint64)) + 1
    owners = [sorted(i for i in s if i is not None) for s in found.values()]
    edges = np.concatenate([[0], np.cumsum([len(o) for o in owners])])
    return Phrases(vocabulary, table, lengths, edges, np.array([i for o in owners for i in o], np.int64))


def _known(words: W.Words, wanted: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers (0: unknown), and which words lie in stretches as long as the shortest phrase."""
    at = np.minimum(np.searchsorted(wanted.vocabulary, words.hash), len(wanted.vocabulary) - 1)
    numbers = np.where(wanted.vocabulary[at] == words.hash, at + 1, 0)
    n = len(numbers)
    edge = np.ones(n, bool)
    edge[1:] = (words.text_of[1:] != words.text_of[:-1]) | (numbers[1:] == 0) | (numbers[:-1] == 0)
    stretch = np.cumsum(edge) - 1
    long_enough = np.bincount(stretch, minlength=1)[stretch] >= wanted.lengths.min() if n else edge
    return numbers, np.flatnonzero(long_enough & (numbers > 0))


_FIELDS = ["doc_id", "digest", "n_words", "spans", "items"]


class _Shard:
    """Texts gathered until there is enough to index."""

    def __init__(self, wanted: Phrases):
        self._wanted, self.n_indexed = wanted, 0
        self._ids: list[pa.Array] = []
        self._digests: list[pa.Array] = []
        self._counts, self._numbers, self._places = [], [], []
        self.n_texts = self._n_words = 0

    def add(self, batch: pa.RecordBatch, words: W.Words) -> None:
        numbers, kept = _known(words, self._wanted)
        self._ids.append(batch.column("doc_id").slice(words.first, words.n_texts))
        self._digests.append(batch.column("digest").slice(words.first, words.n_texts))
        self._counts.append(np.diff(words.borders))
        self._numbers.append(numbers[kept])
        # a place is a word of the shard; a gap of one between texts keeps their words apart
        self._places.append(kept + words.text_of[kept] + self._n_words + self.n_texts)
        self._n_words += len(words.hash)
        self.n_texts += words.n_texts
        self.n_indexed += len(kept)

    def _occurrences(self) -> tuple[np.ndarray, np.ndarray]:
        """First words of all phrases found, in words of the shard, and the phrases."""
        places, numbers = np.concatenate(self._places), np.concatenate(self._numbers)
        if not len(places):
            return places, places
        # a separator follows each stretch of neighbouring words
        last = np.flatnonzero(np.append(np.diff(places) > 1, True))
        symbols = np.insert(numbers, last + 1, 0)
        places = np.insert(places, last + 1, -1)
        index = FmIndex(symbols, len(self._wanted.vocabulary))
        which, low, high = index.search(self._wanted.table, self._wanted.lengths)
        n = high - low
        rows = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        return places[index.locate(rows)], np.repeat(which, n)

    def result(self) -> pa.RecordBatch:
        wanted, counts = self._wanted, np.concatenate(self._counts)
        begin = np.concatenate([[0], np.cumsum(counts + 1)])
        start, which = self._occurrences()
        order = np.argsort(start, kind="stable")
        start, which = start[order], which[order]
        end = start + wanted.lengths[which]
        reach = np.maximum.accumulate(end) if len(end) else end
        opens = np.ones(len(start), bool)
        opens[1:] = start[1:] > reach[:-1]
        span_start, span_end = start[opens], reach[np.append(np.flatnonzero(opens)[1:] - 1, len(reach) - 1)] if len(start) else end
        span_text = np.searchsorted(begin, span_start, "right") - 1
        text = np.searchsorted(begin, start, "right") - 1
        n_items = np.diff(wanted.edges)[which]
        place = np.repeat(wanted.edges[which] - np.cumsum(n_items) + n_items, n_items) + np.arange(n_items.sum())
        pairs = np.unique(np.stack([np.repeat(text, n_items), wanted.items[place]], 1), axis=0)
        item_edges = np.searchsorted(pairs[:, 0], np.arange(self.n_texts + 1))
        span_edges = np.searchsorted(span_text, np.arange(self.n_texts + 1))
        spans = pa.StructArray.from_arrays(
            [pa.array(span_start - begin[span_text]), pa.array(span_end - begin[span_text])], ["start", "end"]
        )
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays(self._ids),
                pa.concat_arrays(self._digests),
                pa.array(counts),
                pa.ListArray.from_arrays(pa.array(span_edges.astype(np.int32)), spans),
                pa.ListArray.from_arrays(pa.array(item_edges.astype(np.int32)), pa.array(pairs[:, 1])),
            ],
            _FIELDS,
        )


_FOUND = "doc_id bigint, digest bigint, n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<bigint>"


def _search(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, splitter = shared.value, _splitter()
        shard = _Shard(wanted)
        for batch in batches:
            for words in splitter.slices(batch.column("text")):
                shard.add(batch, words)
                if shard.n_indexed >= SHARD_WORDS or shard.n_texts >= SHARD_TEXTS:
                    yield shard.result()
                    shard = _Shard(wanted)
        if shard.n_texts:
            yield shard.result()

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    splitter = _splitter()
    for batch in batches:
        for words in splitter.slices(batch.column("text")):
            nothing = pa.array([[]] * words.n_texts, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            items = pa.array([[]] * words.n_texts, pa.list_(pa.int64()))
            piece = slice(words.first, words.first + words.n_texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")[piece], batch.column("digest")[piece], pa.array(np.diff(words.borders)), nothing, items],
                _FIELDS,
            )


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """The items, so many words at a time: memory on the driver is that of one block."""
    held, n = [], 0
    for row in benchmark.toLocalIterator():
        held.append((row.item_id, row.text))
        n += len(row.text or "") // 2 + 1
        if n >= block_words:
            yield held
            held, n = [], 0
    if held:
        yield held


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, the merged spans of words to remove (start, end exclusive) and
    the items (sorted ids) of which a window occurs.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case. A
    window is ``window`` words of an item, or the whole item if it is shorter. Null and empty texts have no
    words and no spans; an item without an id marks words and is not listed; repeated rows are separate.
    Other columns of either table are not read.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    plain = plain.withColumn("digest", F.xxhash64("doc_id", "text"))
    items = benchmark.select(F.col("item_id").cast("bigint"), "text")
    parts = []
    for block in _blocks(items, block_words):
        wanted = phrases(block, window)
        if wanted is not None:
            parts.append(plain.mapInArrow(_search(spark.sparkContext.broadcast(wanted)), _FOUND))
    if not parts:
        return plain.mapInArrow(_count, _FOUND).drop("digest")
    return (parts[0] if len(parts) == 1 else _merged(plain, parts)).drop("digest")


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window of the benchmark occurs. One shard per Arrow
    batch, one pass per block of items, no shuffle."""
    spark = docs.sparkSession

    def without(shared) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            splitter = _splitter()
            for batch in batches:
                shard, none = _Shard(shared.value), pa.nulls(batch.num_rows, pa.int64())
                texts = pa.RecordBatch.from_arrays([none, none, batch.column(text_col)], ["doc_id", "digest", "text"])
                for words in splitter.slices(texts.column("text")):
                    shard.add(texts, words)
                if shard.n_texts:
                    hit = pa.compute.list_value_length(shard.result().column("spans"))
                    yield batch.filter(pa.compute.equal(hit, 0))

        return run

    for block in _blocks(benchmark.select(F.col("item_id").cast("bigint"), "text"), block_words):
        wanted = phrases(block, window)
        if wanted is not None:
            docs = docs.mapInArrow(lean(without(spark.sparkContext.broadcast(wanted))), docs.schema)
    return docs


def _merged(plain: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """Bring the results of several blocks of items together by document."""
    key = ["doc_id", "digest"]
    one_list = reduce(DataFrame.unionAll, parts).groupBy(*key).agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )

    def extend(spans: Column, span: Column) -> Column:
        last = F.element_at(spans, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        meets = (F.size(spans) > 0) & (F.coalesce(F.try_element_at(spans, F.lit(-1))["end"], F.lit(-1)) >= span["start"])
        return F.when(meets, F.concat(F.slice(spans, 1, F.size(spans) - 1), F.array(wider))).otherwise(
            F.concat(spans, F.array(span))
        )

    none = F.slice("spans", 1, 0)
    joined = join_unique(plain.select(*key), one_list, key, "left", null_safe=True)
    return joined.select("doc_id", "digest", "n_words", F.aggregate("spans", none, extend).alias("spans"), "items")
