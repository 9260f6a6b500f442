"""Counting tokens without making them.

A word's count is its initial symbols less the merges that happen. The merges are played with a heap of
ranked pairs and a linked list, once per distinct word of a worker; no identifier leaves the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm import wordbpe
from orderlake.llm.staging import kept

#: Texts counted together; their pieces are in memory at once.
TEXTS_AT_ONCE = 256


@kept
def _counter(path: str) -> wordbpe.Remembered:
    bpe = wordbpe.load(path)

    def of_word(word: str) -> int:
        if word in bpe.specials:
            return 1
        symbols = bpe.initial(word)
        return len(symbols) - wordbpe.merge(symbols, bpe.pairs)[1]

    words = wordbpe.Remembered(lambda new: map(of_word, new))

    def of_pieces(new: list[str]) -> Iterator[int]:
        cut = [bpe.words(piece) for piece in new]
        known = words({word for own in cut for word in own})
        return (sum(map(known.__getitem__, own)) for own in cut)

    return wordbpe.Remembered(of_pieces)


def _count(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for whole in batches:
            for first in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(first, TEXTS_AT_ONCE)
                texts = batch.column("text").to_pylist()
                cut = [wordbpe.pieces(text) for text in texts]
                known = counter(set().union(*cut))
                sizes = [len((text or "").encode()) for text in texts]
                counts = [sum(map(known.__getitem__, own)) for own in cut]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    return run


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8) and n_tokens of the whole text under the vocabulary file ``path``,
    which every worker can read. Null texts count as empty, repeated rows are separate, other columns are
    not read. Special strings inside a text count as the file says, none are added.
    """
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(_count(path), "doc_id bigint, n_bytes bigint, n_tokens bigint")
