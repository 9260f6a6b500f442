"""Secrets in texts, found through a trigram index.

From every rule's pattern a Boolean query over trigrams is derived that each text with a match satisfies:
all trigrams of a literal, any of the branches of an alternation, nothing for what is optional. The index
holds, per block of documents and per trigram that some rule asks for, the documents with that trigram.
Queries are answered by intersecting and uniting these lists, and only the candidates are matched with the
pattern itself. A rule without a mandatory trigram has every document as a candidate.

Everything is a DataFrame expression; the patterns are parsed once, on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.operators.joins import join_unique

GRAM = 3
#: Documents that share a block of the index, on average.
BLOCK_DOCS = 4096
REDACTED = "[REDACTED]"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose group ``group`` has at least ``least`` characters.
    A pattern is written so that Spark's regular expressions and Python's parser both take it."""

    kind: str
    pattern: str
    group: int
    least: int


# The three kinds of secrets, in the order in which spans at one place are listed. A run of
# hex digits is always matched whole, so asking for 24 of them in the pattern finds the same runs.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)

# --- queries over trigrams -----------------------------------------------------------------------

#: A query: None (any text), a trigram, or ("and" | "or", parts).
Query = None | str | tuple


def _combine(kind: str, parts: list[Query]) -> Query:
    if kind == "or" and None in parts:
        return None
    kept = list(dict.fromkeys(p for p in parts if p is not None))
    return None if not kept else kept[0] if len(kept) == 1 else (kind, tuple(kept))


def _literal(text: str) -> Query:
    return _combine("and", [text[i : i + GRAM] for i in range(len(text) - GRAM + 1)])


def _derive(nodes) -> Query:
    """The query of a sequence of parsed nodes. Neighbouring letters are joined before they are cut."""
    parts, run = [], ""
    for op, arg in nodes:
        if op is sre.LITERAL:
            run += chr(arg).lower()
            continue
        parts.append(_literal(run))
        run = ""
        if op is sre.SUBPATTERN:
            parts.append(_derive(arg[-1]))
        elif op is sre.BRANCH:
            parts.append(_combine("or", [_derive(branch) for branch in arg[1]]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] > 0:
            parts.append(_derive(arg[2]))
    return _combine("and", [*parts, _literal(run)])


def trigram_query(pattern: str) -> Query:
    """What trigrams of the lower-cased text a match of the pattern needs; None if it needs none."""
    return _derive(sre_parser.parse(pattern))


def grams_of(query: Query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(grams_of, query[1]))


# --- index ---------------------------------------------------------------------------------------


def _with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    rest = F.struct(F.lit(0).alias("_"), *[c for c in docs.columns if c != text_col])
    plain = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.col(text_col).isNull().alias("empty"), rest.alias("rest")
    )
    # equal keys of unequal documents would only add a candidate
    return plain.withColumn("key", F.xxhash64("doc_id", "text"))


def index(keyed: DataFrame, grams: list[str], blocks: int) -> DataFrame:
    """The inverted index: one row per block, with a map from trigram to the sorted keys that have it."""
    lowered = keyed.select("key", F.lower("text").alias("lowered"))
    held = F.array_compact(F.array(*[F.when(F.contains("lowered", F.lit(g)), F.lit(g)) for g in grams]))
    postings = lowered.select("key", F.explode(held).alias("gram"))
    lists = postings.groupBy(F.pmod("key", F.lit(blocks)).alias("block"), "gram").agg(
        F.array_sort(F.collect_set("key")).alias("keys")
    )
    return lists.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("gram", "keys"))).alias("postings"))


def _answer(query: Query) -> Column:
    """The keys of a block that satisfy a query."""
    if isinstance(query, str):
        return F.coalesce(F.try_element_at("postings", F.lit(query)), F.array().cast("array<bigint>"))
    join = F.array_intersect if query[0] == "and" else F.array_union
    return reduce(join, [_answer(part) for part in query[1]])


def candidates(keyed: DataFrame, queries: dict[str, Query], blocks: int) -> DataFrame:
    """One row per key that satisfies some query, with the kinds it satisfies."""
    asked = {kind: query for kind, query in queries.items() if query is not None}
    grams = sorted(set().union(*map(grams_of, asked.values())))
    answers = [
        F.arrays_zip(keys.alias("key"), F.array_repeat(F.lit(kind), F.size(keys)).alias("kind"))
        for kind, keys in ((kind, _answer(q)) for kind, q in asked.items())
    ]
    lists = index(keyed, grams, blocks)
    found = lists.select(F.inline(F.flatten(F.array(*answers))).alias("key", "kind"))
    return found.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


# --- matches -------------------------------------------------------------------------------------


def _matches(rule: Rule, rank: int) -> Column:
    """Start, rank and end (exclusive, in characters) of the valid matches, leftmost first. The pieces between
    matches and the matches take turns, so lengths add up to places."""
    pieces = F.split("text", rule.pattern, -1)
    matched = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    held = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))
    steps = F.transform(
        matched,
        lambda m, i: F.struct(F.length(pieces[i]).alias("gap"), F.length(m).alias("n"), (F.length(held[i]) >= rule.least).alias("ok")),
    )

    def add(state: Column, step: Column) -> Column:
        start = state["at"] + step["gap"]
        end = start + step["n"]
        span = F.struct(start.alias("start"), end.alias("end"), step["ok"].alias("ok"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    none = F.array().cast("array<struct<start: int, end: int, ok: boolean>>")
    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    valid = F.filter(F.aggregate(steps, begin, add)["spans"], lambda s: s["ok"])
    return F.transform(valid, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))


def _spans(rules: tuple[Rule, ...], queries: dict[str, Query]) -> Column:
    """All valid matches of a row as a sorted array of (start, rank of the kind, end)."""
    none = F.array().cast("array<struct<start: int, rank: int, end: int>>")
    found = []
    for rank, rule in enumerate(rules):
        wanted = F.col("text").rlike(rule.pattern)
        if queries[rule.kind] is not None:
            wanted = F.array_contains("kinds", rule.kind) & wanted
        found.append(F.when(wanted, _matches(rule, rank)).otherwise(none))
    return F.array_sort(F.flatten(F.array(*found)))


def _blocks(docs: DataFrame) -> int:
    return max(1, docs.count() // BLOCK_DOCS)


def find_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, text and ``spans``, all valid matches as (start, rank of the kind, end), sorted.

    Matches of a kind are leftmost and do not overlap each other; kinds may. Places count characters, the
    end is exclusive. A null text counts as empty and has no spans. Repeated rows are separate; other
    columns are not read.
    """
    return _scanned(docs, rules, id_col, text_col).select("doc_id", "text", "spans")


def _scanned(docs: DataFrame, rules: tuple[Rule, ...], id_col: str, text_col: str) -> DataFrame:
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    keyed = _with_key(docs, id_col, text_col)
    if any(q is not None for q in queries.values()):
        found = candidates(keyed, queries, _blocks(docs))
        keyed = join_unique(keyed, found, ["key"], "left")
    return keyed.withColumn("spans", _spans(rules, queries))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of ``docs``, every span in the text replaced by a mark. Null texts stay null."""
    found = _scanned(docs, rules, id_col, text_col)
    text = F.when(~F.col("empty"), redacted(F.col("text"), F.col("spans")))
    return found.select([text.alias(c) if c == text_col else F.col(f"rest.`{c}`") for c in docs.columns])


def span_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["rank"]], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, and what overlapping spans cover together, replaced by a mark."""
    def add(state: Column, span: Column) -> Column:
        gap = F.greatest(span["start"] - state["at"], F.lit(0))
        mark = F.when(span["start"] >= state["at"], F.lit(REDACTED)).otherwise(F.lit(""))
        return F.struct(
            F.greatest(span["end"], state["at"]).alias("at"),
            F.concat(state["parts"], F.array(F.substring(text, state["at"] + 1, gap), mark)).alias("parts"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    rest = lambda state: F.concat(F.array_join(state["parts"], ""), F.substring(text, state["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, begin, add, rest)).otherwise(text)
