"""Judging URLs by rules on host and path, and by a weighted vocabulary.

Terms are found with one Aho-Corasick automaton per task and count only between characters that are no
letters or digits. One strict term rejects a URL, as do several distinct soft ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"

# Terms one of which rejects a URL, terms of which several distinct ones do, and how many.
STRICT_TERMS = ("porn", "xxx", "casino", "cheap-pills", "viagra", "warez", "malware", "phishing", "hentai")
SOFT_TERMS = (
    "adult", "bet", "bonus", "cheap", "crack", "dating", "escort", "free", "jackpot", "keygen", "loan",
    "nude", "pills", "poker", "sexy", "slots", "spam", "torrent", "win",
)
SOFT_LIMIT = 2
LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and paths that begin like ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; empty without ``://`` or URL."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, *LETTERS), path


def _fits(rule: Rule) -> Column:
    host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
    return host & F.col("path").startswith(rule.path)


def _terms(strict: tuple[str, ...], soft: tuple[str, ...]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for term in {*strict, *soft}:
            automaton.add_word(term, term)
        automaton.make_automaton()
        fold = str.maketrans(*LETTERS)

        def found(url: str | None) -> set[str]:
            url = (url or "").translate(fold)
            hits = set()
            for last, term in automaton.iter(url):
                left, right = url[last - len(term) : last - len(term) + 1] if last >= len(term) else "", url[last + 1 : last + 2]
                if not ((left.isascii() and left.isalnum()) or (right.isascii() and right.isalnum())):
                    hits.add(term)
            return hits

        for batch in batches:
            hits = [found(url) for url in batch.column("url").to_pylist()]
            names = [sorted(h) for h in hits]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([len(h.intersection(strict)) for h in hits], pa.int32()),
                    pa.array([len(h.intersection(soft)) for h in hits], pa.int32()),
                    pa.array(names, pa.list_(pa.string())),
                ],
                ["page_id", "url", "strict_hits", "soft_hits", "terms"],
            )

    return run


def judge(
    pages: DataFrame,
    rules: tuple[Rule, ...],
    strict: tuple[str, ...] = STRICT_TERMS,
    soft: tuple[str, ...] = SOFT_TERMS,
    soft_limit: int = SOFT_LIMIT,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, strict_hits, soft_hits and the terms found.

    The longest rule that fits decides; without one, the vocabulary does: block on one strict term or on
    ``soft_limit`` distinct soft terms. A null or empty URL holds no term, fits no rule and is allowed. Terms
    are lower case; a URL's A-Z are folded. Repeated rows are separate, other columns are not read.
    """
    plain = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"))
    hits = "page_id bigint, url string, strict_hits int, soft_hits int, terms array<string>"
    found = plain.mapInArrow(_terms(strict, soft), hits)
    host, path = host_and_path(F.col("url"))
    chosen = F.lit(None).cast("string")
    verdict = F.when((F.col("strict_hits") > 0) | (F.col("soft_hits") >= soft_limit), BLOCK).otherwise(ALLOW)
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        chosen = F.when(_fits(rule), rule.name).otherwise(chosen)
        verdict = F.when(_fits(rule), rule.verdict).otherwise(verdict)
    parts = found.select("page_id", host.alias("host"), path.alias("path"), "strict_hits", "soft_hits", "terms")
    return parts.select("page_id", "host", "path", chosen.alias("rule"), verdict.alias("verdict"), "strict_hits", "soft_hits", "terms")
