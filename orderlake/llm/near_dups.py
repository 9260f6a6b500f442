"""Near-duplicate documents with SetSketch registers.

A document's set is its distinct shingles. Each register keeps the least of an exponentially distributed hash
over the set, on a logarithmic scale: registers of a union are the larger of both, and two sets agree in a
register about as often as they share elements. Bands of registers are the buckets in which candidates meet.

1. Documents with equal sets become one class, represented by the smallest id.
2. In every bucket each class is paired with the bucket's smallest. Pairs that sizes and 64 register bits
   rule out are dropped, the rest is estimated from all registers by likelihood, and what may be similar
   enough is confirmed on the full sets. Links give components.
3. What a bucket of three or more still holds apart is paired with another representative. Then every class
   outside its bucket's largest component is tested against that component and against the others outside
   it, on the full sets, in blocks of bounded size. Nothing a bucket has brought together stays untested,
   and no pairs of a group of near copies become rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm import words as W
from orderlake.llm.components import components
from orderlake.llm.staging import lean, staged
from orderlake.operators.joins import join_unique

#: Words of a shingle, and the similarity of a link in percent.
SHINGLE, PERCENT = 5, 80
#: Registers: bands times registers in a band, the base of their scale, its rate and its top. Further bands take
#: one register of each of five neighbourhoods.
BANDS, BAND, MORE_BANDS = 40, 5, 20
BASE, RATE, TOP = 1.02, 20.0, 65534
#: Share of the pairs at the threshold that an estimate may rule out.
LOSS = 1e-12
#: Rounds of pairing with one representative per bucket before classes are tested against components.
ROUNDS = 2
#: Members of a component, and classes tested against it, in one block; shingles of either in a block, unless
#: one class alone has more.
MEMBERS_AT_ONCE, TESTED_AT_ONCE = 1024, 256
SHINGLES_AT_ONCE = 1 << 19

_SEED = np.random.default_rng(20240229)
_FACTORS = _SEED.integers(0, 1 << 32, BANDS * BAND, np.uint32) | np.uint32(1)
_TERMS = _SEED.integers(0, 1 << 32, BANDS * BAND, np.uint32)
_BAND_POWERS = W.powers(W.OTHER_BASE, BAND)


def most_often(n: int, chance: float) -> int:
    """How often something of the given chance happens in ``n`` trials at most, but for ``LOSS`` of all cases.
    Binomial tails are summed up: far out they are heavier than a normal distribution's."""
    tail, most = 0.0, n
    while most and (tail := tail + comb(n, most) * chance**most * (1 - chance) ** (n - most)) <= LOSS:
        most -= 1
    return most


def shingle_sets(splitter: W.Splitter, column: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For each slice of texts its first row and the sorted distinct shingle hashes of each text."""
    for words in splitter.slices(column):
        hashes = words.hash
        starts = W.whole(words, size)
        shingles = np.zeros(len(hashes), np.uint64)
        for k in range(size):
            shingles[starts] = W.mix(shingles[starts] * W.WORD_BASE + hashes[starts + k])
        sets = []
        for i in range(words.n_texts):
            first, end = words.borders[i], words.borders[i + 1]
            if end - first >= size:
                sets.append(np.unique(shingles[first : end - size + 1]))
            elif end > first:  # too few words: the whole sequence is one shingle
                value = np.zeros(1, np.uint64)
                for h in hashes[first:end]:
                    value = W.mix(value * W.OTHER_BASE + h)
                sets.append(value)
            else:
                sets.append(hashes[:0])
        yield words.first, sets


def registers(shingles: np.ndarray) -> np.ndarray:
    """The registers of a set that is not empty."""
    low = (shingles & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    least = np.full(len(_FACTORS), 0xFFFFFFFF, np.uint32)
    for first in range(0, len(low), 4096):
        part = low[None, first : first + 4096] * _FACTORS[:, None] + _TERMS[:, None]
        np.minimum(least, part.min(1), out=least)
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity of pairs of sets of known sizes by maximum likelihood over how many registers are larger
    in the one, larger in the other, and equal. ``a`` and ``b`` are matrices with a row per pair."""
    more, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    most = np.minimum(u / v, v / u)
    grid = np.linspace(0, 1, 201)[None, :] * most

    def larger(share: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(share, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    p, q = larger(u - v * grid), larger(v - u * grid)
    likelihood = sum(
        n * np.log(np.maximum(chance, 1e-12)) for n, chance in ((more, p), (less, q), (a.shape[1] - more - less, 1 - p - q))
    )
    return np.take_along_axis(grid, likelihood.argmax(1)[:, None], 1)[:, 0]


_SIGNED = "doc_id bigint, id bigint, n_shingles bigint, s1 bigint, s2 bigint, registers binary"


def _sign(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = W.Splitter(W.NOT_BLANK, lower=True)
        for batch in batches:
            for first, sets in shingle_sets(splitter, batch.column("text"), size):
                prints = np.array(
                    [np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64) for s in sets], np.int64
                ).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(sets)),
                        batch.column("id").slice(first, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(prints[:, 0].copy()),
                        pa.array(prints[:, 1].copy()),
                        pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["doc_id", "id", "n_shingles", "s1", "s2", "registers"],
                )

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets of each class, with its size and one bit of 64 registers."""
    for whole in batches:
        for first in range(0, whole.num_rows, 2048):
            batch = whole.slice(first, 2048)
            rows = _matrix(batch.column("registers"))
            bands = rows.reshape(len(rows), BANDS, BAND)
            across = rows.reshape(len(rows), BAND, BANDS)[:, :, :MORE_BANDS].transpose(0, 2, 1)
            folded = (np.concatenate([bands, across], 1).astype(np.uint64) + np.uint64(1)) * _BAND_POWERS
            buckets = W.mix(folded.sum(2) + np.arange(folded.shape[1], dtype=np.uint64) * W.BYTE_BASE)
            bits = np.packbits((rows[:, :64] & 1).astype(bool), axis=1).view(np.int64)[:, 0]
            place = pa.array(np.repeat(np.arange(len(rows)), folded.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets.view(np.int64).ravel()), *(c.take(place) for c in (batch.column("id"), batch.column("n"), pa.array(bits)))],
                ["bucket", "id", "n", "bits"],
            )


def _possible(a: str, b: str, percent: int) -> Column:
    """Sizes and register bits of two classes allow a link."""
    n_a, n_b = F.col(f"{a}n"), F.col(f"{b}n")
    most = most_often(64, (1 - percent / 100) / 2)
    sizes = (n_a * 100 >= n_b * percent) & (n_b * 100 >= n_a * percent)
    return sizes & (F.bit_count(F.col(f"{a}bits").bitwiseXOR(F.col(f"{b}bits"))) <= most)


def _estimated(least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                sizes = [batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b")]
                similar = estimate(_matrix(batch.column("r_a")), _matrix(batch.column("r_b")), *sizes) >= least
                yield batch.select(["a", "b"]).filter(pa.array(similar))

    return run


def _confirmed(size: int, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = W.Splitter(W.NOT_BLANK, lower=True)

        def sets(column: pa.Array) -> list[np.ndarray]:
            return [s for _, part in shingle_sets(splitter, column, size) for s in part]

        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                linked = []
                for one, two in zip(sets(batch.column("t_a")), sets(batch.column("t_b"))):
                    common = len(np.intersect1d(one, two, assume_unique=True))
                    linked.append(common > 0 and 100 * common >= percent * (len(one) + len(two) - common))
                yield batch.select(["a", "b"]).filter(pa.array(linked))

    return run


class _Links:
    """Tests candidates on the sets of classes; ``texts`` has the texts (id, text) of all that may be asked."""

    def __init__(self, texts: DataFrame, classes: DataFrame, size: int, percent: int):
        self._texts, self._classes, self._size, self._percent = texts, classes, size, percent
        self._least = 1 - most_often(BANDS * BAND, 1 - percent / 100) / (BANDS * BAND)

    def _both(self, pairs: DataFrame, table: DataFrame, columns: dict[str, str]) -> DataFrame:
        for side in "ab":
            named = table.select(F.col("id").alias(side), *[F.col(c).alias(f"{new}_{side}") for c, new in columns.items()])
            pairs = join_unique(pairs, named, [side], "inner")
        return pairs

    def of_pairs(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar enough: estimated, then confirmed on the full sets."""
        known = self._both(pairs, self._classes, {"n": "n", "registers": "r"})
        likely = known.mapInArrow(lean(_estimated(self._least)), "a bigint, b bigint")
        both = self._both(likely, self._texts, {"text": "t"})
        return staged(both.mapInArrow(lean(_confirmed(self._size, self._percent)), "a bigint, b bigint"), "links")

    def of_components(self, tests: DataFrame, labels: DataFrame) -> DataFrame:
        """Links of classes (id, component) to the components they are to be tested against (against), and to
        the other classes to be tested against the same."""
        everyone = labels.select("id", "component", F.col("component").alias("against"))
        everyone = join_unique(everyone, tests.select("against").distinct(), ["against"], "left_semi").union(tests).distinct()
        weights = self._classes.select("id", "n")

        def parts(rows: DataFrame, at_once: int, name: str) -> DataFrame:
            """Parts the classes tested against one component are dealt into, by their number and their shingles."""
            weighed = join_unique(rows, weights, ["id"], "inner").groupBy("against")
            sizes = weighed.agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("shingles"))
            most = F.greatest(F.ceil(F.col("classes") / at_once), F.ceil(F.col("shingles") / SHINGLES_AT_ONCE))
            return sizes.select("against", most.alias(name))

        blocks = parts(everyone, MEMBERS_AT_ONCE, "m").join(parts(tests, TESTED_AT_ONCE, "t"), "against")
        zero, own, others = F.lit(0).cast("bigint"), F.pmod(F.xxhash64("id"), F.col("m")), F.pmod(F.xxhash64("id"), F.col("t"))
        members = join_unique(everyone, blocks, ["against"], "inner").select(
            "against", "id", "component", F.lit(True).alias("member"), own.alias("x"), F.explode(F.sequence(zero, F.col("t") - 1)).alias("y")
        )
        tested = join_unique(tests, blocks, ["against"], "inner").select(
            "against", "id", "component", F.lit(False).alias("member"), F.explode(F.sequence(zero, F.col("m") - 1)).alias("x"), others.alias("y")
        )
        rows = join_unique(members.union(tested), self._texts.select("id", "text"), ["id"], "inner")
        found = rows.groupBy("against", "x", "y").applyInArrow(_tested(self._size, self._percent), "a bigint, b bigint")
        return staged(found, "tested")


def _tested(size: int, percent: int) -> Callable:
    """Links that bring together all components of a block that any of its tested classes links. A link inside
    a component, or between two that earlier links of the block have joined, adds nothing and is left out."""

    def run(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        splitter = W.Splitter(W.NOT_BLANK, lower=True)
        ids, member = block.column("id").to_numpy(), block.column("member").to_numpy()
        part = np.unique(block.column("component").to_numpy(), return_inverse=True)[1]
        texts = block.column("text").combine_chunks()
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
        sets = [s for _, part in shingle_sets(splitter, texts, size) for s in part]
        links: list[tuple[int, int]] = []
        # an id that repeats may come with a text without words, too
        filled = np.array([len(s) > 0 for s in sets], bool)
        inside = np.flatnonzero(member & filled)
        if len(inside) and len(inside) < len(ids):
            lengths = np.array([len(sets[i]) for i in inside])
            values, places = np.unique(np.concatenate([sets[i] for i in inside]), return_inverse=True)
            begin = np.cumsum(lengths) - lengths
            for i in np.flatnonzero(~member & filled):
                at = np.minimum(np.searchsorted(values, sets[i]), len(values) - 1)
                held = np.zeros(len(values), np.int32)
                held[at[values[at] == sets[i]]] = 1
                common = np.add.reduceat(held[places], begin)
                linked = 100 * common >= percent * (lengths + len(sets[i]) - common)
                others = inside[linked]
                others = others[part[others] != part[i]]
                for k in others[np.unique(part[others], return_index=True)[1]]:
                    links.append((int(ids[i]), int(ids[k])))
                    part[part == part[k]] = part[i]
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    found = join_unique(members, labels, ["id"], "left")
    return found.withColumn("component", F.coalesce("component", "id"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id and kept.

    Two documents are linked if their sets of ``size``-word shingles (A-Z in lower case; a shorter text is
    one shingle) share ``percent`` in a hundred of their union. ``component_id`` is the smallest id reachable
    over links, ``kept`` marks the documents with that id. Empty and null texts have no set and no link.
    Repeated rows share their id and stay or go together. A row without an id is a document like others: it links
    and is linked, but names no component, and where no document with an id is reachable it has none and is
    kept. Other columns are not read.

    Two documents that are similar enough miss every bucket with probability (1 - s ** 5) ** 60, 4.6e-11 at
    s = 0.8, were the bands independent; the estimates rule out one in 1e12 of them each.
    """
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    # a text without an id goes by its hash
    plain = plain.withColumn("id", F.coalesce("doc_id", F.xxhash64("text")))
    signed = staged(plain.mapInArrow(lean(_sign(size)), _SIGNED), "signed")
    sets = ["s1", "s2", "n_shingles"]
    full = signed.filter(F.col("n_shingles") > 0)
    classes = full.groupBy(*sets).agg(
        F.coalesce(F.min("doc_id"), F.min("id")).alias("id"), F.min("doc_id").alias("first"), F.min_by("registers", "id").alias("registers")
    )
    classes = staged(classes.withColumnRenamed("n_shingles", "n"), "classes")
    texts = plain.select("id", "text", F.xxhash64("text").alias("digest"))
    labels = _connect(classes, texts, size, percent)
    # the smallest id of a component may be a hash
    named = join_unique(classes.select("id", "first"), labels, ["id"], "inner")
    names = named.groupBy("component").agg(F.min("first").alias("name"))
    labels = join_unique(labels, names, ["component"], "inner").select("id", "name", F.lit(True).alias("linked"))
    named = join_unique(classes.select("s1", "s2", F.col("n").alias("n_shingles"), "id", "first"), labels, ["id"], "left")
    named = named.select(*sets, F.when(F.col("linked"), F.col("name")).otherwise(F.col("first")).alias("component"))
    found = join_unique(full.select("doc_id", *sets), named, sets, "left").select("doc_id", "n_shingles", "component")
    empty = signed.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component"))
    alone = F.col("component").isNull()
    return found.union(empty).select(
        "doc_id",
        "n_shingles",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), alone).alias("kept"),
    )


def _connect(classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Components of the classes that are linked to any other: (id, component)."""
    bands = classes.select("id", "n", "registers").mapInArrow(lean(_bands), "bucket bigint, id bigint, n bigint, bits bigint")
    lead = F.min(F.struct("id", "n", "bits")).alias("lead")
    counts = bands.groupBy("bucket").agg(lead, F.max("id").alias("high"), F.count(F.lit(1)).alias("times"))
    shared = counts.filter("lead.id < high").select("bucket", "times", *_leader("lead"))
    members = staged(join_unique(bands, shared, ["bucket"], "inner"), "members")
    first = staged(_with_leader(members.filter("id <> l_id"), percent), "pairs")
    # two classes alone in a bucket are settled by their pair
    larger = members.filter("times > 2").select("bucket", "id", "n", "bits")
    needed = first.select(F.explode(F.array("a", "b")).alias("id")).union(larger.select("id")).distinct()
    kept = join_unique(texts, needed, ["id"], "left_semi").dropDuplicates(["id", "digest"])
    links = _Links(staged(kept, "texts"), classes, size, percent)

    edges = links.of_pairs(first)
    labels = staged(components(edges), "labels")
    for turn in range(1, ROUNDS):
        pairs = _with_leader(_apart(larger, labels, turn), percent)
        labels = _joined(labels, links.of_pairs(pairs))
    tests = _apart(larger, labels, ROUNDS).select("id", "component", F.col("l_component").alias("against")).distinct()
    # a class whose component was not named yet is its own
    around = _labelled(larger.select("id").distinct(), labels)
    everyone = labels.union(around.select("id", "component")).distinct()
    return _joined(labels, links.of_components(staged(tests, "tests"), staged(everyone, "everyone")))


def _joined(labels: DataFrame, found: DataFrame) -> DataFrame:
    """The labels after further links. Only the graph of the components that these bring together is searched."""
    for side in "ab":
        named = labels.select(F.col("id").alias(side), "component")
        found = join_unique(found, named, [side], "left").withColumn(side, F.coalesce("component", side)).drop("component")
    grown = staged(components(found), "grown")
    renamed = grown.select(F.col("id").alias("component"), F.col("component").alias("now"))
    relabelled = join_unique(labels, renamed, ["component"], "left").select("id", F.coalesce("now", "component").alias("component"))
    return staged(relabelled.union(grown.select("id", "component")).distinct(), "labels")


def _leader(lead: str) -> list[Column]:
    return [F.col(f"{lead}.{c}").alias(f"l_{c}") for c in ("id", "n", "bits")]


def _apart(members: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """Members outside their bucket's largest component, with that component and one representative of it:
    the class of the smallest hash, another one each turn."""
    now = _labelled(members, labels)
    lead = F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("order"), "id", "n", "bits")).alias("lead")
    parts = now.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("times"), lead)
    largest = F.max_by(F.struct("component", "lead"), F.struct("times", "component")).alias("largest")
    several = parts.groupBy("bucket").agg(largest, F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    several = several.select("bucket", F.col("largest.component").alias("l_component"), *_leader("largest.lead"))
    return staged(join_unique(now, several, ["bucket"], "inner").filter("component <> l_component"), "apart")


def _with_leader(members: DataFrame, percent: int) -> DataFrame:
    """Each member of a bucket with the bucket's representative, where a link is possible."""
    named = members.withColumnsRenamed({"n": "m_n", "bits": "m_bits"}).filter(_possible("m_", "l_", percent))
    return named.select(F.least("id", "l_id").alias("a"), F.greatest("id", "l_id").alias("b")).distinct()
