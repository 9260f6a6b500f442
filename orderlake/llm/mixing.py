"""Mixing sources to target weights.

Each source gets its share of the mix by weight, at most so many times its own size; what is cut off goes to
the others by weight until none is above. A source gives whole epochs first. The rest is drawn without
replacement: every document has an exponential random key divided by its quality weight, and documents are
taken from the smallest key on until the words are used up. The last one gives only as many words as are left.

No source is sorted whole. Keys are dealt into buckets, far finer than a source is large; sums per bucket
say in which bucket the budget ends, and only the documents of that one are put into order. Copies, which
share a key, are counted and cut as one. Everything is a DataFrame expression.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.staging import staged
from orderlake.operators.joins import join_unique

#: Weights of the sources in order, repeating; size of the mix in percent of all sizes; most epochs of a source.
WEIGHTS, PERCENT, MOST = (5, 2, 1), 150, 2
#: Buckets per doubling of the key.
BUCKETS = 4096
_BLANKS = " \t\n\x0b\x0c\r"
_PLACE_BITS = 33
_RANDOM_BITS = 52


def word_count(text: Column) -> Column:
    """Runs of other characters than the six ASCII blanks. Every run, with the blanks after it, becomes one
    mark, and the marks are counted: no list of words is made."""
    bare = F.btrim(text, F.lit(_BLANKS))
    return F.length(F.regexp_replace(bare, r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "x"))


def _uniform(*parts: Column) -> Column:
    """A number between 0 and 1, both excluded, from 52 bits of a digest."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    bits = F.conv(F.substring(F.md5(text), 1, _RANDOM_BITS // 4), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(1 << _RANDOM_BITS))


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources with their place in code point order, null last; sorted in ranges, not in one task."""
    placed = staged(sources.orderBy(F.asc_nulls_last("source")).withColumn("id", F.monotonically_increasing_id()), "sources")
    part = F.shiftrightunsigned("id", _PLACE_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.col("before") + F.col("id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return placed.withColumn("part", part).join(offsets, "part").withColumn("place", place).drop("id", "part", "before")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, most: int = MOST) -> DataFrame:
    """``source, source_size`` with the source's ``target``. Sizes and shares are whole numbers until the last
    division. Each round fixes the sources above their limit; few rounds are needed, none moves rows."""
    if percent > 100 * most:
        raise ValueError("the limits do not add up to the mix")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod("place", F.lit(len(weights))).cast("int") + 1)
    known = staged(_numbered(sources).withColumn("weight", weight.cast("decimal(38,0)")), "weights")
    # in hundredths of words, so that the percentage is exact
    limit = (F.col("source_size") * (100 * most)).cast("decimal(38,0)")
    total = known.agg(F.sum("source_size")).first()[0] or 0
    left, shares = percent * total, None
    above = F.lit(False)
    while True:
        spent, open_, n = known.agg(
            F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)
        ).first()
        if n == shares or not open_:
            break
        shares, rest, open_ = n, Decimal(left - int(spent or 0)), Decimal(int(open_))
        above = F.col("weight") * F.lit(rest) > limit * F.lit(open_)
    if shares is None:
        return known.withColumn("target", F.lit(0.0)).select("source", "source_size", "target")
    free = (F.col("weight") * F.lit(rest)).cast("double") / F.lit(float(100 * open_))
    target = F.when(above, (F.col("source_size") * most).cast("double")).otherwise(free)
    return known.withColumn("target", target).select("source", "source_size", "target")


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    percent: int = PERCENT,
    most: int = MOST,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per row: doc_id, size (words), source_size, target of its source, and taken, the words the mix takes of
    it. A source's taken words are its target rounded down; no row gives more than ``most`` times its size.

    ``quality`` has a positive ``weight`` for some ``doc_id``, each once; others weigh 1. It changes who comes
    first in the last, partial epoch. Keys are digests of id, source and text, so the same rows give the same
    mix however they are dealt into files. Equal keys go by id, then size; of equal rows it does not matter
    which is taken. Null and empty texts have size 0 and give nothing, null sources are one source, rows without id
    are rows like others. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(source_col).alias("source"),
        word_count(text).cast("bigint").alias("size"),
        _uniform(F.col(id_col), F.col(source_col), text).alias("u"),
    )
    if quality is not None:
        rows = join_unique(rows, quality.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("weight").cast("double")), ["doc_id"], "left")
    else:
        rows = rows.withColumn("weight", F.lit(None).cast("double"))
    key = -F.log("u") / F.coalesce(F.col("weight"), F.lit(1.0))
    rows = rows.withColumn("key", key).withColumn("bucket", F.floor(F.log2("key") * BUCKETS))
    placed = staged(rows.select("doc_id", "source", "size", "key", "bucket", F.monotonically_increasing_id().alias("row")), "keys")

    sums = staged(placed.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "buckets")
    plan = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, percent, most)
    plan = plan.withColumn("epochs", F.expr("CASE WHEN source_size > 0 THEN floor(target) div source_size ELSE 0L END"))
    plan = plan.withColumn("rest", F.floor("target") - F.col("epochs") * F.col("source_size"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = join_unique(sums.withColumn("upto", F.sum("words").over(upto)), plan.select("source", "rest"), ["source"], "inner", null_safe=True)
    ends = ends.filter((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest")))
    ends = ends.select("source", F.col("bucket").alias("last"), (F.col("rest") - F.col("upto") + F.col("words")).alias("budget"))
    plan = staged(join_unique(plan.drop("rest"), ends, ["source"], "left", null_safe=True), "plan")

    known = join_unique(placed, plan, ["source"], "left", null_safe=True)
    whole = F.col("epochs") * F.col("size")
    # without a last bucket nothing is drawn
    apart = known.filter(F.col("last").isNull() | (F.col("bucket") != F.col("last")))
    taken = apart.withColumn("taken", whole + F.when(F.col("bucket") < F.col("last"), F.col("size")).otherwise(0))
    drawn = _cut(staged(known.filter(F.col("bucket") == F.col("last")), "last"))
    drawn = drawn.withColumn("taken", whole + F.col("part_taken"))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    return taken.select(*columns).unionByName(drawn.select(*columns))


def _cut(rows: DataFrame) -> DataFrame:
    """Rows of each source's last bucket with ``part_taken``, the words of them within the source's budget."""
    same = ["source", "key", "doc_id", "size"]
    rows = rows.withColumn("part", F.shiftrightunsigned("row", _PLACE_BITS))
    copies = rows.groupBy(*same, "part").agg(F.count(F.lit(1)).alias("n"), F.first("budget").alias("budget"))
    kinds = copies.groupBy(*same).agg(F.sum("n").alias("times"), F.first("budget").alias("budget"))
    earlier = Window.partitionBy("source").orderBy("key", F.asc_nulls_first("doc_id"), "size")
    before = F.sum(F.col("times") * F.col("size")).over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    kinds = kinds.select(*same, (F.col("budget") - F.coalesce(before, F.lit(0))).alias("left"))
    # equal rows are numbered by the part they lie in, then within it
    offset = F.sum("n").over(Window.partitionBy(*same).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    copies = copies.select(*same, "part", F.coalesce(offset, F.lit(0)).alias("offset"))
    copies = join_unique(copies, kinds, same, "inner", null_safe=True)
    inside = F.row_number().over(Window.partitionBy(*same, "part").orderBy("row")) - 1
    numbered = join_unique(rows.withColumn("inside", inside), copies, [*same, "part"], "inner", null_safe=True)
    left = F.col("left") - (F.col("offset") + F.col("inside")) * F.col("size")
    return numbered.withColumn("part_taken", F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), left)))
