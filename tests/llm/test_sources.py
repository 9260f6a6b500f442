"""Operators on the sources of a corpus, against SQL and plain versions, on odd rows, copies and many sources."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from orderlake.llm import divergence, manifest, mixing, staging

QUERIES, ORACLE = contract.queries(), contract.oracle_sql()
NAMES = ("op11_source_divergence", "op12_source_mix", "op13_merkle_manifest")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, term string, key int, tree int, pos int, weight int"


def write(spark, folder, rows, labels=()):
    """Documents from (doc_id, text, lang, source), with further columns of names the operators use."""
    full = [(i, t, lang, s, None if t is None else len(t), "x", 1, 2, 3, 4) for i, t, lang, s in rows]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    marked = spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int")
    marked.coalesce(1).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def odd_rows():
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("Alpha", "béta", "中", "zz") for b in "abcdefgh"]
    rows = []
    for i in range(400):
        source = rng.choice(["hot", "hot", "hot", "b", "", None, "é", "z"])
        text = " ".join(rng.choices(words, weights=[1 + (len(source or "") + k) % 5 for k in range(len(words))], k=rng.randint(0, 40)))
        rows.append((i * 7 % 400, text, rng.choice(["en", "en", "fr", None]), source))
    rows += [(1000, None, "en", "hot"), (1001, "", "en", "hot"), (1002, " \t\n\x0b", None, None), (None, "no id\nhere", "en", "b")]
    rows += [(None, None, None, None), (None, None, None, None), (5, "again", "xx", "lonely"), (5, "again", "xx", "lonely")]
    rows += [(7000, "the same text\nonce more", "en", "hot")] * 150
    rows += [(8000 + i, "one copy of many\n", "en", "hot") for i in range(200)]
    rows += [(9000, "long " * 300_000 + "\n", "fr", "z"), (9001, "1 2 3 !", "en", "zero"), (9002, "Ünïcode\x00bytes", "en", "z")]
    return rows


def rows_of(df):
    return sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())


def expected(folder, name):
    with duckdb.connect() as duck:
        for table in ("documents", "labels"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
        found = duck.execute(ORACLE[name])
        columns = [d[0] for d in found.description]
        order = sorted(range(len(columns)), key=columns.__getitem__)
        return sorted(repr(tuple(row[i] for i in order)) for row in found.fetchall())


@pytest.fixture(scope="module")
def odd_folder(spark, tmp_path_factory):
    labels = [(i, i % 2, 0) for i in range(0, 300, 3)] + [(3, 1, 0), (None, 1, 0), (4, None, 0)]
    return write(spark, tmp_path_factory.mktemp("odd"), odd_rows(), labels)


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_equal_sql(spark, odd_folder, name):
    assert rows_of(QUERIES[name](spark, odd_folder)) == expected(odd_folder, name)


@pytest.mark.parametrize("name", NAMES)
def test_smallest_folder_equals_sql(spark, small_data, name):
    with duckdb.connect() as duck:
        for table in ("documents", "labels"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small_data}/{table}.parquet'")
        found = duck.execute(ORACLE[name])
        columns = [d[0] for d in found.description]
        order = sorted(range(len(columns)), key=columns.__getitem__)
        want = sorted(repr(tuple(row[i] for i in order)) for row in found.fetchall())
    assert rows_of(QUERIES[name](spark, small_data)) == want


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, tmp_path, name):
    assert QUERIES[name](spark, write(spark, tmp_path, [])).collect() == []


# --- divergence ----------------------------------------------------------------------------------


def plain_audit(rows, least, ranks):
    """The audit with plain dictionaries."""
    import re

    pattern, lower = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"), {i: i + 32 for i in range(65, 91)}
    documents, by_source, by_lang = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = pattern.findall((text or "").translate(lower))
        documents[lang].update(set(terms))
        by_source[lang, source].update(terms)
    for lang, found in documents.items():
        kept = [t for t, n in found.items() if n >= least]
        sources = sorted(s for g, s in by_source if g == lang)
        for s in sources:
            by_lang[lang].update({t: by_source[lang, s][t] for t in kept})

        def shares(counts):
            total = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 5) // total for t in kept}

        p, q = {s: shares(by_source[lang, s]) for s in sources}, shares(by_lang[lang])
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if by_source[lang, s][t] and p[s][t] > q[t]]
            for part, listed in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
                for rank, (value, _, item) in enumerate(listed, 1):
                    yield lang, s, part, item, -value, rank


@pytest.mark.parametrize("block, bucket, ranks", [(64, 1024, 50), (2, 5, 3)])
def test_audit_equals_plain_version(spark, odd_folder, monkeypatch, block, bucket, ranks):
    # the workers import the package as shipped, so only what the driver plans changes with the bucket
    monkeypatch.setattr(divergence, "BUCKET", bucket)
    staging.ship(spark)
    rows = [r for r in odd_rows() if r[0] != 9000] + [(i, "rare common", "en", f"s{i}") for i in range(70)]
    docs = spark.createDataFrame([(i, t, lang, s) for i, t, lang, s in rows], "doc_id long, text string, lang string, source string")
    found = divergence.audit(docs, 10, ranks)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r[c] for c in columns) for r in found.collect()) == sorted(plain_audit(rows, 10, ranks))


def test_long_texts_are_split_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 10)
    text = "ab Cd efg " * 50 + "x" * 40 + " end"
    pieces = list(divergence._pieces(text.encode()))
    assert len(pieces) > 10
    assert [t for p in pieces for t in p] == text.lower().encode().split()


# --- mixing --------------------------------------------------------------------------------------


def test_targets_are_reshared_until_none_is_above(spark):
    sizes = {f"s{i:02d}": n for i, n in enumerate([10, 1, 1000, 3, 50, 7, 200, 2, 90, 0])}
    frame = spark.createDataFrame([*sizes.items(), (None, 11)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    names = [*sorted(sizes), None]
    size = sizes | {None: 11}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped, total = set(), 1.5 * sum(size.values())
    while True:
        rest = total - sum(2 * size[s] for s in capped)
        level = rest / sum(weight[s] for s in names if s not in capped)
        above = {s for s in names if s not in capped and weight[s] * level > 2 * size[s]}
        if not above:
            break
        capped |= above
    for s in names:
        assert got[s] == pytest.approx(2 * size[s] if s in capped else weight[s] * level)
    assert sum(got.values()) == pytest.approx(total)


def test_mix_meets_targets_and_is_the_same_however_rows_are_dealt(spark, odd_folder):
    docs = spark.read.parquet(f"{odd_folder}/documents.parquet")
    one = mixing.mix(docs.repartition(7))
    rows = one.collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.mix(docs.coalesce(1)).collect()), key=repr)
    by_source = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        taken = by_source.setdefault((r.source_size, r.target), [0])
        taken[0] += r.taken
    for (_, target), (taken,) in by_source.items():
        assert taken % math.floor(target) == 0 if target >= 1 else taken == 0


def test_better_documents_are_drawn_more_often(spark):
    docs = spark.createDataFrame([(i, f"w{i} x", s) for s in "abc" for i in range(1000)], "doc_id long, text string, source string")
    good = spark.createDataFrame([(i, 8.0) for i in range(0, 1000, 2)], "doc_id long, weight double")
    taken = mixing.mix(docs, good, percent=50).groupBy(F.col("doc_id") % 2 == 0, "target").agg(F.sum("taken").alias("n")).collect()
    least = min(r.target for r in taken)
    good_words, others = (next(r.n for r in taken if r.target == least and r[0] is want) for want in (True, False))
    assert good_words > 2 * others


def test_copies_are_cut_as_one(spark):
    # a third of all rows is one row
    rows = [(1, "a b c", "hot")] * 3000 + [(i, "d e", "hot") for i in range(2, 3000)] + [(i, "f", "small") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    found = mixing.mix(docs).collect()
    words = defaultdict(int)
    for r in found:
        words[r.source_size] += r.taken
    targets = {r.source_size: r.target for r in found}
    assert {s: math.floor(t) for s, t in targets.items()} == dict(words)
    assert len(found) == len(rows)


@pytest.mark.parametrize("text", ["", " ", "a", " a", "a ", " a\tb\n\x0bc\x0c\rd ", " x 　", "x" * 100_000 + " y"])
def test_word_count(spark, text):
    import re

    got = spark.range(1).select(mixing.word_count(F.lit(text)).alias("n")).first().n
    assert got == len(re.findall(r"[^\x20\x09-\x0D]+", text))


def test_mix_is_made_of_expressions(spark, small_data):
    plan = QUERIES["op12_source_mix"](spark, small_data)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# --- manifest ------------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves):
    """Root, and per leaf the siblings level by level as (before, after)."""
    proofs, at = [[] for _ in leaves], list(range(len(leaves)))
    while len(leaves) > 1:
        for i, place in enumerate(at):
            run = leaves[place // 3 * 3 : place // 3 * 3 + 3]
            proofs[i].append(("".join(run[: place % 3]), "".join(run[place % 3 + 1 :])))
        leaves = [sha("".join(leaves[i : i + 3])) for i in range(0, len(leaves), 3)]
        at = [place // 3 for place in at]
    return leaves[0], proofs


@pytest.mark.parametrize("height", range(1, 7))
def test_addresses_use_every_place_once_and_keep_lower_trees_together(height):
    levels = manifest.addresses(height)
    assert sorted(a for level in levels for a in level) == list(range(manifest._nodes(height)))
    assert [len(level) for level in levels] == [3**d for d in range(height)]
    upper = height // 2
    if upper:
        # every tree below the cut lies in one stretch
        size = manifest._nodes(height - upper)
        for tree in range(3**upper):
            own = [a for d in range(upper, height) for a in levels[d][tree * 3 ** (d - upper) : (tree + 1) * 3 ** (d - upper)]]
            assert max(own) - min(own) == size - 1


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9, 10, 27, 28, 80, 100])
def test_subtree_equals_plain_tree(n):
    leaves = [sha(str(i)) for i in range(n)]
    subtree = manifest.Subtree(leaves, manifest.levels(n))
    root, proofs = plain_tree(leaves)
    found = subtree.siblings()
    assert subtree.root == root
    assert [[own[i // 3**level] for level, own in enumerate(found)] for i in range(n)] == proofs


def test_trees_of_several_subtrees_and_many_sources(spark):
    """One source far larger than a subtree, one a little larger, many small ones; a third of the rows equal."""
    staging.ship(spark)
    rows = [(i, "big", f"t{i}") for i in range(9000)] + [(77, "big", "same")] * 9000 + [(i, "mid", "m") for i in range(manifest.SPAN + 1)]
    rows += [(i, f"s{i % 900}", f"x{i}") for i in range(2000)] + [(1, None, "n"), (None, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    fields = {c: F.col(c) for c in ("doc_id", "source", "text")}
    found = manifest.manifest(docs, fields, {"text": F.when(F.col("doc_id") == 5, "forged").otherwise(F.col("text"))})
    folded = found.select("doc_id", "leaf", "subroot", "root", "proof", manifest.fold(F.col("claim"), F.col("proof")).alias("end"))

    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    groups = defaultdict(list)
    for doc, source, text in rows:
        groups[source].append((doc is not None, doc or 0, sha(field(doc) + field(source) + field(text)), doc))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([r[2] for r in sorted(groups[s], key=lambda r: r[:3])]) for s in order}
    root, above = plain_tree([trees[s][0] for s in order])
    want = Counter()
    for s, upper in zip(order, above):
        for r, proof in zip(sorted(groups[s], key=lambda r: r[:3]), trees[s][1]):
            want[r[3], r[2], trees[s][0], root, tuple(proof + upper)] += 1
    got = folded.collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple((p.left, p.right) for p in r.proof)) for r in got) == want
    assert all((r.end == root) == (r.doc_id != 5) for r in got)
