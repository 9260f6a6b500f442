"""How the sources of a language differ in the terms they use.

Terms are counted per language and source. A language keeps the terms of at least so many of its documents,
and every source gives each kept term a smoothed share in parts of a billion, in whole numbers.

* Terms of a source: the shares depend on two numbers only, the term's count in the source and in the
  language. Terms are grouped into cells of these two, the difference is worked out once per cell, and cells
  of equal difference are merged and ranked by how many terms came before them. Only the terms of the cells
  that reach the ranks asked for are looked up and put into order, so the order of all terms is never made.
* Pairs of sources: the sum over all terms of the difference of their shares. Sources are dealt into blocks
  and terms into buckets; a task adds up one bucket for two blocks of sources. Terms neither source has are
  one multiplication.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.staging import staged
from orderlake.operators.joins import join_unique

#: Documents of its language a kept term is in; parts shares are counted in; what is added to every count.
LEAST_DOCUMENTS, PARTS, ADDED = 30, 1_000_000_000, 5
#: Ranks of terms that are listed.
TERM_RANKS = 50
#: Terms a task holds before it hands on what it has counted; bytes of text split at a time.
HELD_TERMS, PIECE = 1 << 18, 1 << 20
#: Sources of a block, and terms of a bucket on average.
BLOCK, BUCKET = 64, 1024

# Letters and bytes of characters beyond ASCII; A-Z become a-z, all else a blank.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

GROUP = ["lang", "source"]


# --- counting ------------------------------------------------------------------------------------


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a piece of it at a time."""
    text, at = text.translate(_LETTERS), 0
    while len(text) - at > PIECE:
        end = text.find(b" ", at + PIECE)
        if end < 0:
            break
        yield text[at:end].split()
        at = end
    yield text[at:].split()


def _flushed(found: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (times, documents) in found.items():
        terms = list(times)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(terms), pa.string()),
                pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()),
                pa.array(list(times.values()), pa.int64()),
                pa.array([documents[t] for t in terms], pa.int64()),
            ],
            [*GROUP, "term", "n", "docs"],
        )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in (*GROUP, "text"))):
            group = (lang.as_py(), source.as_py())
            if group not in found:
                found[group] = (Counter(), Counter())
                # the group occurs, whatever its texts hold
                found[group][0][b""] = 0
            times, documents = found[group]
            before, distinct = len(times), set()
            for terms in _pieces(text.as_py()):
                times.update(terms)
                distinct.update(terms)
            documents.update(distinct)
            held += len(times) - before
        if held >= HELD_TERMS:
            yield from _flushed(found)
            found, held = {}, 0
    yield from _flushed(found)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Per language, source and term: occurrences ``n`` and documents ``docs``. Every language and source that
    occurs also has a row for the empty term, with no occurrence."""
    plain = docs.select(
        F.coalesce(F.col(lang_col), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col), F.lit("")).alias("source"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    counted = plain.mapInArrow(_count, "lang string, source string, term binary, n bigint, docs bigint")
    return counted.groupBy(*GROUP, F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column | str, total: str, kept: str) -> Column:
    """The smoothed share of a count, exact whatever the size of the numbers. Where no term is kept there is
    nothing to share."""
    wide = "decimal(28,0)"
    count = (F.col(count) if isinstance(count, str) else count).cast(wide)
    whole = F.greatest(F.col(total) + ADDED * F.col(kept), F.lit(1)).cast(wide)
    return F.call_function("div", F.lit(PARTS).cast("decimal(10,0)") * (count + ADDED), whole) + 1


# --- terms ---------------------------------------------------------------------------------------


def _ranked_terms(kept: DataFrame, groups: DataFrame, ranks: int) -> DataFrame:
    """The terms a source has more of than its language, by difference; ``ranks`` of each source."""
    cell = [*GROUP, "n", "n_lang"]
    cells = join_unique(kept.groupBy(*cell).agg(F.count(F.lit(1)).alias("times")), groups, GROUP, "inner")
    cells = cells.select(*cell, "times", (share("n", "total", "kept") - share("n_lang", "lang_total", "kept")).alias("value")).filter("value > 0")
    merged = cells.groupBy(*GROUP, "value").agg(F.sum("times").alias("times"))
    # every value has a term, so values beyond as many as there are ranks come too late
    best = Window.partitionBy(*GROUP).orderBy(F.desc("value"))
    merged = merged.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= ranks)
    before = F.sum("times").over(best.rowsBetween(Window.unboundedPreceding, -1))
    merged = merged.select(*GROUP, "value", F.coalesce(before, F.lit(0)).alias("before")).filter(F.col("before") < ranks)
    chosen = join_unique(cells.drop("times"), merged, [*GROUP, "value"], "inner")
    terms = join_unique(kept.select(*cell, "term"), chosen, cell, "inner")
    inside = Window.partitionBy(*GROUP, "value").orderBy("term")
    # cells may tie in value: their terms are put into one order
    terms = terms.withColumn("inside", F.row_number().over(inside)).filter(F.col("inside") <= ranks)
    rank = (F.col("before") + F.col("inside")).cast("int")
    return terms.select(*GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), "value", rank.alias("rank")).filter(rank <= ranks)


# --- pairs ---------------------------------------------------------------------------------------


def _pair_sums(table: pa.Table) -> pa.Table:
    """For two blocks of sources and one bucket of terms: by how much the difference of two sources exceeds
    that of sources with none of these terms, summed over the terms."""
    place, part = table.column("no").to_numpy(), table.column("p").to_numpy()
    lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    heads = pa.compute.is_null(table.column("term")).to_numpy()
    sources, first = np.unique(place[heads], return_index=True)
    empty = part[heads][first]
    body = ~heads
    terms = table.column("term").filter(pa.array(body)).combine_chunks().dictionary_encode()
    shares = np.repeat(empty[:, None], len(terms.dictionary), axis=1)
    shares[np.searchsorted(sources, place[body]), terms.indices.to_numpy()] = part[body]
    one, two, value = [], [], []
    high = np.flatnonzero(sources // BLOCK == hi)
    for s in np.flatnonzero(sources // BLOCK == lo):
        others = high[sources[high] > sources[s]] if lo == hi else high
        both = np.abs(shares[others] - shares[s]).sum(1) - shares.shape[1] * np.abs(empty[others] - empty[s])
        one.append(np.full(len(others), sources[s]))
        two.append(sources[others])
        value.append(both)
    lang = table.column("lang")[0].as_py()
    flat = [np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (one, two, value)]
    return pa.table({"lang": pa.array([lang] * len(flat[0]), pa.string()), "one": flat[0], "two": flat[1], "value": flat[2]})


def _ranked_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """All other sources of the language, by difference."""
    same_lang = Window.partitionBy("lang")
    numbered = groups.withColumn("no", F.row_number().over(same_lang.orderBy("source")) - 1)
    numbered = numbered.withColumn("blocks", F.floor(F.max("no").over(same_lang) / BLOCK) + 1)
    numbered = staged(
        numbered.select(
            *GROUP, "no", "blocks", "kept", "total", share(F.lit(0), "total", "kept").alias("empty"),
            (F.floor(F.col("kept") / BUCKET) + 1).alias("buckets"),
        ),
        "sources",
    )
    zero = F.lit(0).cast("bigint")
    every_bucket = F.explode(F.sequence(zero, F.col("buckets") - 1))
    heads = numbered.select("lang", "no", "blocks", every_bucket.alias("bucket"), F.lit(None).cast("string").alias("term"), F.col("empty").alias("p"))
    body = join_unique(kept.select(*GROUP, "term", "n"), numbered, GROUP, "inner").select(
        "lang", "no", "blocks", F.pmod(F.xxhash64("term"), "buckets").alias("bucket"), "term", share("n", "total", "kept").alias("p")
    )
    own = F.floor(F.col("no") / BLOCK)
    met = heads.unionByName(body).withColumn("other", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    met = met.select(
        "lang", F.least(own, "other").alias("lo"), F.greatest(own, "other").alias("hi"), "bucket", F.col("no").cast("bigint").alias("no"), "term", "p"
    )
    sums = met.groupBy("lang", "lo", "hi", "bucket").applyInArrow(_pair_sums, "lang string, one bigint, two bigint, value bigint")
    sums = sums.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))
    ways = [F.struct(F.col(a).alias("no"), F.col(b).alias("other")) for a, b in (("one", "two"), ("two", "one"))]
    own_side = numbered.select("lang", F.col("no").cast("bigint").alias("no"), "source", "empty", "kept")
    other_side = numbered.select("lang", F.col("no").cast("bigint").alias("other"), F.col("source").alias("item"), F.col("empty").alias("other_empty"))
    both = sums.select("lang", "value", F.inline(F.array(*ways))).join(own_side, ["lang", "no"]).join(other_side, ["lang", "other"])
    value = F.col("value") + F.col("kept") * F.abs(F.col("empty") - F.col("other_empty"))
    ranked = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item"))
    both = both.select(*GROUP, F.lit("pair").alias("part"), "item", F.when(F.col("kept") > 0, value).otherwise(0).alias("value"))
    return both.withColumn("rank", ranked)


# --- both ----------------------------------------------------------------------------------------


def audit(
    docs: DataFrame,
    least: int = LEAST_DOCUMENTS,
    ranks: int = TERM_RANKS,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Per language and source: ``pair`` rows for every other source of the language, and ``term`` rows for the
    first ``ranks`` terms the source uses more than its language. Columns: lang, source, part, item, value, rank.

    Terms are runs of letters A-Z (taken as a-z) and of characters beyond ASCII. Null and empty texts have no
    term; null languages and sources count as ''. Repeated rows are further documents. A source without a
    kept term has pairs with the shares of zero counts, and of value 0 where its language keeps no term.
    Other columns are not read. An empty table gives no rows.
    """
    counted = staged(term_counts(docs, text_col, lang_col, source_col), "terms")
    terms = counted.filter("term <> ''")
    languages = terms.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
    languages = staged(languages.filter(F.col("docs") >= least).drop("docs"), "languages")
    kept = staged(join_unique(terms.drop("docs"), languages, ["lang", "term"], "inner"), "kept")
    of_lang = languages.groupBy("lang").agg(F.sum("n_lang").alias("lang_total"), F.count(F.lit(1)).alias("kept"))
    of_group = kept.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    groups = join_unique(counted.filter("term = ''").select(*GROUP), of_group, GROUP, "left")
    groups = staged(join_unique(groups, of_lang, ["lang"], "left").fillna(0, ["total", "lang_total", "kept"]), "groups")
    return _ranked_pairs(kept, groups).unionByName(_ranked_terms(kept, groups, ranks))
