"""Assigning rows to shards with jump consistent hashing.

A key visits shards 0 < j1 < j2 < ... in jumps drawn from its own random numbers; its shard among n is the
last one visited below n. The visits do not depend on n, so a further shard takes exactly the keys that
jump onto it, and no table of the ring is kept. The random numbers are hashes of the key and the number of
the jump. Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.staging import staged

#: Bytes a row takes beside its text.
ROW_BYTES = 16


def _uniform(key: Column, draw: Column) -> Column:
    """A number in (0, 1] from the upper 53 bits of a hash."""
    bits = F.shiftrightunsigned(F.xxhash64(key, draw), 11)
    return (bits.cast("double") + 1) / F.lit(float(1 << 53))


def jump_shards(key: str, shards: int) -> Column:
    """The shard of a key among ``shards`` and among one more, as a struct of ``shard`` and ``grown``.

    One walk serves both. It takes ln(shards) jumps on average and at most ``shards``; later steps of the
    fold leave the state as it is.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")

    def jump(state: Column, draw: Column) -> Column:
        at = state["at"]
        following = F.floor((at + 1) / _uniform(F.col(key), draw))
        # a jump may be astronomically long; it only matters that it leaves the shards
        following = F.least(following, F.lit(shards + 1).cast("bigint"))
        moved = F.struct(
            F.when(following < shards, following).otherwise(state["shard"]).alias("shard"),
            F.when(following <= shards, following).otherwise(state["grown"]).alias("grown"),
            following.alias("at"),
        )
        return F.when(at >= shards, state).otherwise(moved)

    zero = F.lit(0).cast("bigint")
    begin = F.struct(zero.alias("shard"), zero.alias("grown"), zero.alias("at"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), begin, jump)


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot and grown_shard.

    ``size`` is the text's UTF-8 bytes plus 16; a null text has no bytes and the checksum of none (0). Law
    ``key``: a doc_id always has the same shard among the same number of shards, so repeated ids share one,
    and so do all rows without id. ``grown_shard`` is the shard among one more. Slots number the rows of a
    shard without gaps. Other columns are not read.

    Slots are counted per shard and input partition, then per shard over the partitions' counts. So no
    task sorts a whole shard, however unevenly the ids are spread.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    both = jump_shards("doc_id", shards)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.octet_length(text).alias("n"), F.crc32(text).alias("crc"))
    placed = staged(
        rows.select("doc_id", (F.col("n") + ROW_BYTES).cast("bigint").alias("size"), F.col("crc").alias("text_crc32"), both.alias("both"))
        .select("doc_id", "size", "text_crc32", "both.shard", "both.grown", F.monotonically_increasing_id().alias("row")),
        "placed",
    )
    # the upper bits of a row number are its partition
    placed = placed.withColumn("part", F.shiftrightunsigned("row", 33))
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1
    return placed.withColumn("inside", inside).join(offsets, ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("offset") + F.col("inside")).alias("slot"),
        F.col("grown").cast("int").alias("grown_shard"),
    )
