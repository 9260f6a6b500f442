"""Removing word sequences that occur more than once in a corpus.

Every window of 35 words is tested, but not every window is shuffled. The smallest hash among a window's
16-word grams is its anchor: equal windows have equal anchors at equal places, and about one word in nine
is the anchor of a window. So a window can only be repeated if its anchor is counted twice.

* First pass: a count-min sketch of the anchors of each partition; the sketches are merged cell by cell
  and kept as bits saying "twice or more". The sketch has a fixed size. When it fills up it lets more
  windows through; it never holds one back, since it only ever counts too much.
* Second pass: windows whose anchor is estimated twice are grouped exactly, by 96 bits of hash. A task first
  groups its own: windows it holds twice are settled there, and of each kind it hands on one, so no window,
  however common, makes more rows than there are tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm import words as W
from orderlake.operators.joins import join_unique

WINDOW = 35
#: Words of the grams among which anchors are chosen.
GRAM = 16
#: Rows of the sketch, and the binary logarithm of the cells in each: 16 MB as bits, whatever the input.
DEPTH, CELL_BITS = 2, 26
#: Cells of a sketch are merged in blocks of so many bits, each by one task.
BLOCK_BITS = 20
#: Anchors, and candidate windows, held before a task hands on what it has counted.
HELD_ANCHORS, HELD_WINDOWS = 1 << 22, 1 << 20

#: The key of a row: 128 bits of hash over its id and text. Rows that share it are equal.
DOC = ["doc", "digest"]


class _Hasher:
    """Hashes of word ranges and anchors for one slice of texts after the other."""

    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, gram
        self.splitter = W.Splitter(W.NOT_BLANK, lower=False)
        self._one, self._two = W.PrefixHash(W.WORD_BASE), W.PrefixHash(W.OTHER_BASE)

    def slices(self, column: pa.Array) -> Iterator[W.Words]:
        for words in self.splitter.slices(column):
            self._sums = self._one.sums(words.hash)
            self._other = None
            yield words

    def both(self, words: W.Words, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96 bits of hash for ranges of words."""
        if self._other is None:
            self._other = self._two.sums(words.hash ^ W.MIX_1)
        length = (end - start).astype(np.uint64)
        one = W.mix(self._one.ranges(self._sums, start, end) + length)
        two = W.mix(self._two.ranges(self._other, start, end) + length) >> np.uint64(32)
        return one.view(np.int64), two.astype(np.uint32).view(np.int32)

    def anchors(self, words: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The starts of all windows, the anchor of each, and the distinct occurrences of anchors."""
        starts = W.whole(words, self.window)
        if not len(starts):
            return starts, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        span, n = self.window - self.gram + 1, len(words.start)
        grams = np.zeros(n, np.uint64)
        at = W.whole(words, self.gram)
        grams[at] = W.mix(self._one.ranges(self._sums, at, at + self.gram)) | np.uint64(1)
        least = ~W.window_max(~grams[: n - self.gram + 1], span)[starts]
        # a gram is an anchor if it is the least of some window it lies in
        wanted = np.zeros(n + span - 1, np.uint64)
        wanted[starts + span - 1] = least
        return starts, least, grams[(W.window_max(wanted, span) == grams) & (grams > 0)]


def cells(values: np.ndarray, row: int) -> np.ndarray:
    """The cell of each value in one row of the sketch."""
    shift = np.uint64((row + 1) * int(W.BYTE_BASE) % (1 << 64))
    return (W.mix(values + shift) >> np.uint64(64 - CELL_BITS)).astype(np.uint32)


_SKETCH = "block int, once binary, often binary"


def _sketch(values: np.ndarray) -> pa.RecordBatch:
    """The cells of one partition's anchors, apart by how often they were hit."""
    rows = []
    for row in range(DEPTH):
        found, counts = np.unique(cells(values, row), return_counts=True)
        blocks = found >> BLOCK_BITS
        edges = np.searchsorted(blocks, np.arange((1 << (CELL_BITS - BLOCK_BITS)) + 1))
        for block in np.unique(blocks):
            part = slice(edges[block], edges[block + 1])
            inner, many = found[part] & np.uint32((1 << BLOCK_BITS) - 1), counts[part] > 1
            rows.append(((row << (CELL_BITS - BLOCK_BITS)) + int(block), inner[~many].tobytes(), inner[many].tobytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.binary(), pa.binary()))],
        ["block", "once", "often"],
    )


def _partition_sketches(window: int, gram: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, n = _Hasher(window, gram), [], 0
        for batch in batches:
            for words in hasher.slices(batch.column(0)):
                found = hasher.anchors(words)[2]
                held.append(found)
                n += len(found)
                if n >= HELD_ANCHORS:
                    yield _sketch(np.concatenate(held))
                    held, n = [], 0
        if n:
            yield _sketch(np.concatenate(held))

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up sketches block by block, at one byte a cell, however many sketches arrive."""
    blocks: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, once, often in zip(*(column.to_pylist() for column in batch.columns)):
            counts = blocks.setdefault(block, np.zeros(1 << BLOCK_BITS, np.uint8))
            single = np.frombuffer(once, np.uint32)
            counts[single] = np.minimum(counts[single] + 1, 2)
            counts[np.frombuffer(often, np.uint32)] = 2
    for block, counts in blocks.items():
        bits = np.packbits(counts > 1, bitorder="little").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([bits], pa.binary())], ["block", "bits"])


def repeated_cells(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """One bit per cell of the merged sketch: counted twice or more. 16 MB come to the driver."""
    n_blocks = DEPTH << (CELL_BITS - BLOCK_BITS)
    sketches = texts.mapInArrow(_partition_sketches(window, gram), _SKETCH)
    merged = sketches.repartition(n_blocks, "block").mapInArrow(_merge, "block int, bits binary")
    size = 1 << (BLOCK_BITS - 3)
    out = np.zeros(n_blocks * size, np.uint8)
    for row in merged.collect():
        out[row.block * size : (row.block + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return out


def _estimated_twice(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the smallest count of each value over the rows of the sketch is two or more."""
    out = np.ones(len(values), bool)
    for row in range(DEPTH):
        cell = cells(values, row).astype(np.int64) + (row << CELL_BITS)
        out &= (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0
    return out


_WINDOWS = "w1 bigint, w2 int, doc bigint, digest bigint, start int, n int, times int"


def _ranges(text: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ranges of neighbouring starts of one text begin in the sorted arrays, and their lengths."""
    new = np.flatnonzero(np.concatenate([[True], (np.diff(start) != 1) | (np.diff(text) != 0)]))
    return new, np.diff(np.append(new, len(start)))


def _grouped(held: list[tuple], docs: list[pa.Array], digests: list[pa.Array]) -> pa.RecordBatch:
    """One row per kind of window held, with two for its times if it occurs more than once, and rows with
    hashes of their own for the ranges its other occurrences make up."""
    one, two, text, start = (np.concatenate(part) for part in zip(*held))
    order = np.argsort(one, kind="stable")
    same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    again = np.concatenate([[False], same])
    times = np.where(np.append(same, False), 2, 1)[~again]
    kept, rest = order[~again], np.sort(order[again])
    new, n = _ranges(text[rest], start[rest]) if len(rest) else (rest, rest)
    first = rest[new]
    own = W.mix(one[first].view(np.uint64) ^ W.mix(text[first].astype(np.uint64) << np.uint64(32) | start[first].astype(np.uint64)))
    rows = np.concatenate([kept, first])
    place = pa.array(text[rows])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([one[kept], own.view(np.int64)])),
            pa.array(two[rows]),
            pa.concat_arrays(docs).take(place),
            pa.concat_arrays(digests).take(place),
            pa.array(start[rows].astype(np.int32)),
            pa.array(np.concatenate([np.ones(len(kept)), n]).astype(np.int32)),
            pa.array(np.concatenate([times, np.full(len(first), 2)]).astype(np.int32)),
        ],
        ["w1", "w2", *DOC, "start", "n", "times"],
    )


def _candidates(window: int, gram: int, shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, bits = _Hasher(window, gram), shared.value
        held, docs, digests, n_held, n_texts = [], [], [], 0, 0
        for batch in batches:
            for words in hasher.slices(batch.column("text")):
                starts, anchors, _ = hasher.anchors(words)
                starts = starts[_estimated_twice(bits, anchors)]
                text = words.text_of[starts]
                held.append((*hasher.both(words, starts, starts + window), text + n_texts, starts - words.borders[text]))
                docs.append(batch.column("doc").slice(words.first, words.n_texts))
                digests.append(batch.column("digest").slice(words.first, words.n_texts))
                n_held, n_texts = n_held + len(starts), n_texts + words.n_texts
                if n_held >= HELD_WINDOWS:
                    yield _grouped(held, docs, digests)
                    held, docs, digests, n_held, n_texts = [], [], [], 0, 0
        if n_held:
            yield _grouped(held, docs, digests)

    return run


def _finish(window: int) -> Callable:
    """Words left of each text once the listed ranges of windows are taken out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, removed, digests = [], [], []
            for text, listed in zip(batch.column("text").cast(pa.large_binary()), batch.column("ranges")):
                words = (text.as_py() or b"").split()  # bytes are split at the six ASCII blanks
                n_gone = 0
                if listed.is_valid:
                    packed = listed.values.to_numpy()
                    gone = W.covered(packed >> 32, (packed & 0xFFFFFFFF) + window - 1, len(words))
                    words, n_gone = list(compress(words, (~gone).tolist())), int(gone.sum())
                n_words.append(len(words) + n_gone)
                removed.append(n_gone)
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and kept_sha256, the digest of the words left.

    A word goes if a window of ``window`` words over it has a word sequence that starts anywhere else as
    well, in another row or the same one. Null texts have no words, shorter texts no window. Repeated rows
    count as further documents. Other columns are not read. Memory is about 100 bytes per byte of the
    longest text.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(repeated_cells(plain.select("text"), window, gram))
    keyed = plain.withColumns({"doc": F.xxhash64("doc_id", "text"), "digest": F.xxhash64(F.lit(WINDOW), "text", "doc_id")})
    candidates = keyed.select("text", *DOC).mapInArrow(_candidates(window, gram, shared), _WINDOWS)
    total = F.sum("times").over(Window.partitionBy("w1", "w2"))
    repeated = candidates.withColumn("times", total).filter("times > 1")
    packed = F.shiftleft(F.col("start").cast("bigint"), 32) + F.col("n")
    ranges = repeated.groupBy(*DOC).agg(F.collect_set(packed).alias("ranges"))
    return join_unique(keyed, ranges, DOC, "left").select("doc_id", "text", "ranges").mapInArrow(
        _finish(window), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    )
