"""Cases that once went wrong, every query by name against plain versions, and the pipeline's stages on odd rows."""

import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import brute
import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
from orderlake.llm import language, near_dups, nearest, queries, sharding, staging, substrings, urls

QUERIES = contract.queries()
PATH = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def ready(spark):
    return staging.ship(spark)


def read(folder, table, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{folder}/{table}.parquet'").fetchall()


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- every query, all columns ----------------------------------------------------------------------


def test_texts_by_name(ready, small_data):
    docs = read(small_data, "documents", "doc_id, text")
    items = read(small_data, "benchmark", "item_id, text")
    plain = {
        "op1_secret_scan": (brute.secrets(docs), "doc_id n_assign n_access n_hex base_sha256 spans"),
        "op3_decontamination": (brute.passages(docs, items), "doc_id n_words n_hit n_items items_sha256 contaminated"),
        "op4_substring_dedup": (brute.repeats(docs), "doc_id n_words n_removed kept_sha256"),
        "op5_bpe": (brute.tokens(docs, Tokenizer.from_file(PATH)), "doc_id n_tokens ids_sha256 decoded_sha256"),
        "op10_near_dups": (brute.near(docs), "doc_id n_shingles component_id kept"),
    }
    for name, (want, columns) in plain.items():
        found = QUERIES[name](ready, small_data)
        assert rows(found, *columns.split()) == sorted(want, key=repr), name


def test_token_counts_by_name(ready, small_data):
    docs = read(small_data, "documents", "doc_id, text")
    want = [(i, len((t or "").encode()), n, n > 2048) for (i, t), (_, n, *_) in zip(docs, brute.tokens(docs, Tokenizer.from_file(PATH)))]
    assert rows(QUERIES["op8_token_counts"](ready, small_data), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)


def test_nearest_by_name(ready, small_data):
    vectors = {i: np.array(v, float) for i, v in read(small_data, "embeddings", "vec_id, embedding") if v is not None}
    vectors = {i: v for i, v in vectors.items() if np.isfinite(v).all() and v.any()}
    ids = np.array(sorted(vectors))
    whole = np.stack([vectors[i] for i in ids])
    found = defaultdict(list)
    for r in QUERIES["op2_nearest"](ready, small_data).orderBy("query_id", "rank").collect():
        assert r.rank == len(found[r.query_id]) + 1 and r.score == pytest.approx(float(vectors[r.query_id] @ vectors[r.vec_id]), abs=1e-9)
        found[r.query_id].append((-r.score, r.vec_id))
    hits = 0
    for q in ids[ids % 20 == 0].tolist():
        scores = whole @ vectors[q]
        best = sorted((-s, i) for s, i in zip(scores, ids.tolist()) if i != q)[:20]
        assert found[q] == sorted(found[q]) and len({i for _, i in found[q]}) == len(best)
        hits += len({i for _, i in found[q]} & {i for _, i in best}) / len(best)
    assert set(found) == set(ids[ids % 20 == 0].tolist()) and hits >= 0.9 * len(found)


def walk(key, shards):
    """The plain jump walk, drawing with the hash Spark has."""
    at, last = 0, 0
    for draw in range(1, shards + 1):
        seed = 42 if key is None else xxhash.xxh64(struct.pack("<q", key), seed=42).intdigest()
        bits = xxhash.xxh64(struct.pack("<i", draw), seed=seed).intdigest() >> 11
        at = int((at + 1) / ((bits + 1) / (1 << 53)))
        if at >= shards:
            break
        last = at
    return last


def test_sharding_by_name(ready, small_data):
    docs = read(small_data, "documents", "doc_id, text")
    found = QUERIES["op6_sharding"](ready, small_data).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), walk(i, 40), walk(i, 41)) for i, t in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in found) == want
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    null = sharding.assign(ready.createDataFrame([(None, "x")], "doc_id long, text string"), 40).first()
    assert null.shard == walk(None, 40)


def plain_verdict(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(brute.LOWER)
    rules = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(rules, key=lambda r: len(r.name), default=None)
    folded = url.translate(brute.LOWER)
    strict, soft = ({t for t in terms if re.search(rf"(?<![A-Za-z0-9]){re.escape(t)}(?![A-Za-z0-9])", folded)} for terms in (urls.STRICT_TERMS, urls.SOFT_TERMS))
    blocked = rule.verdict if rule else "block" if strict or len(soft) >= urls.SOFT_LIMIT else "allow"
    return host, path, rule.name if rule else None, blocked, len(strict), len(soft)


def test_urls_by_name(ready, small_data):
    pages = read(small_data, "pages", "page_id, url")
    found = QUERIES["op7_url_filter"](ready, small_data)
    want = [(i, *plain_verdict(url)) for i, url in pages]
    assert rows(found, "page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits") == sorted(want, key=repr)


def test_urls_of_odd_rows(ready):
    odd = [(1, None), (1, None), (2, ""), (2, "http://x.org/casino"), (2, "http://x.org/casino"), (None, "://"), (4, "HTTP://A.COM?free#bet"),
           (5, "http://x.org/" + "free-" * 300_000), (6, "x" * 100_000), (7, "http://é.net/es/win/bet")]
    full = [(i, url, 1, "a", "b") for i, url in odd]
    pages = ready.createDataFrame(full, "page_id long, url string, terms int, host string, verdict string").repartition(3)
    found = urls.judge(pages, queries.URL_RULES)
    assert rows(found, "page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits") == sorted(((i, *plain_verdict(u)) for i, u in odd), key=repr)
    assert urls.judge(pages.limit(0), queries.URL_RULES).collect() == []


# --- long texts ------------------------------------------------------------------------------------


def test_texts_of_megabytes(ready, tmp_path):
    rng = random.Random(9)
    words = [f"word{i}" for i in range(5000)]
    long = " ".join(rng.choices(words, k=600_000))
    passage = " ".join(rng.choices(words, k=50))
    docs = [(1, long + " " + passage), (2, passage), (3, "password = hunter2hunter2 " + long[:3_000_000]), (4, None)]
    ready.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    ready.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert len(docs[0][1]) > 5_000_000
    found = {name: {r.doc_id: r for r in QUERIES[name](ready, str(tmp_path)).collect()} for name in
             ("op1_secret_scan", "op3_decontamination", "op4_substring_dedup", "op5_bpe", "op8_token_counts", "op9_language_id", "op10_near_dups")}
    assert sorted(tuple(r)[:4] for r in found["op4_substring_dedup"].values()) == sorted(brute.repeats(docs))
    assert [found["op3_decontamination"][i].n_hit for i in (1, 2, 3, 4)] == [50, 50, 0, 0]
    assert found["op1_secret_scan"][3].n_assign == 1 and found["op1_secret_scan"][1].spans == ""
    want = {r[0]: r[1] for r in brute.tokens(docs, Tokenizer.from_file(PATH))}
    assert {i: r.n_tokens for i, r in found["op5_bpe"].items()} == want == {i: r.n_tokens for i, r in found["op8_token_counts"].items()}
    assert {i: r.kept for i, r in found["op10_near_dups"].items()} == {1: True, 2: True, 3: True, 4: True}


# --- repeats: rows of equal short hash -------------------------------------------------------------


def test_rows_of_equal_short_hash_are_kept_apart(ready):
    tail = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.concat(F.lit("t"), F.col("id"), F.lit("x"), i)), " ")
    texts = ready.range(300_000).select(tail.alias("text")).withColumn("h", F.hash(F.lit(None).cast("bigint"), "text"))
    same = texts.groupBy("h").agg(F.collect_list("text").alias("texts")).filter(F.size("texts") > 1).first()
    one, two = same.texts[:2]
    docs = [(None, one), (None, two), (7, one + " and more")]
    found = substrings.remove_repeats(ready.createDataFrame(docs, "doc_id long, text string"))
    assert rows(found, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.repeats(docs), key=repr)


# --- neighbours: every query has as many as there are ------------------------------------------------


def all_pairs(vectors, q, n):
    scores = vectors @ vectors[q]
    return sorted((i for i in range(len(vectors)) if i != q), key=lambda i: (-scores[i], i))[:n]


@pytest.mark.parametrize("n", [1, 2, 3, 12, 21, 22])
def test_few_vectors_are_all_neighbours(ready, n):
    vectors = np.random.default_rng(n).normal(size=(n, 16))
    df = ready.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in nearest.nearest_neighbours(df, 1).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r.vec_id)
    assert all(len(found[q]) == min(20, n - 1) for q in range(n))
    if n <= 21:
        assert all(found[q] == all_pairs(vectors, q, 20) for q in range(n))


def test_isolated_vectors_and_a_sample_of_copies(ready):
    rng = np.random.default_rng(8)
    vectors = np.concatenate([np.repeat(rng.normal(size=(1, 16)), 4500, axis=0), rng.normal(size=(36, 16)) * 5])
    rows_ = [(i, v.tolist(), 1, "x") for i, v in enumerate(vectors)]
    df = ready.createDataFrame(rows_, "vec_id long, embedding array<double>, rank int, at string").repartition(4)
    counts = Counter(r.query_id for r in nearest.nearest_neighbours(df, 12).collect())
    assert set(counts) == set(range(0, len(vectors), 12)) and set(counts.values()) == {20}


def test_share_of_codes_probed():
    """How much of a shard the probes return: little where vectors lie in clusters, nearly all where they do not."""
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(64, 64))
    shares = {}
    for name, vectors in (("clusters", centers[rng.integers(0, 64, 2048)] + 0.05 * rng.normal(size=(2048, 64))), ("noise", rng.normal(size=(2048, 64)))):
        turn = nearest.learn(vectors, nearest.ROTATIONS, 5)
        shard = nearest.Shard(np.arange(2048), vectors, turn, nearest.radius(vectors, turn, 20), 20)
        own = nearest.codes(vectors[:64], turn)
        met = [np.unpackbits(np.bitwise_or.reduce(shard._lists[np.arange(len(c)), c], axis=0))[:2048].mean() for c in own]
        shares[name] = float(np.mean(met))
    print(shares)
    assert shares["clusters"] < 0.3 and shares["clusters"] < shares["noise"]


# --- the pipeline's stages ---------------------------------------------------------------------------

PROSE = {
    "en": "the quick brown fox jumps over the lazy dog and then it sleeps under the old tree near the river",
    "fr": "le renard brun saute par dessus le chien paresseux et dort ensuite sous le vieil arbre de la rivière",
    "de": "der schnelle braune fuchs springt über den faulen hund und schläft dann unter dem alten baum am fluss",
}


def frame(spark, rows_):
    """Documents with further columns of names the stages use themselves."""
    full = [(i, t, lang, s, None if t is None else len(t), 1, "k", 2) for i, t, lang, s in rows_]
    return spark.createDataFrame(full, COLUMNS + ", component_id int, digest string, kept int").repartition(3)


@pytest.fixture(scope="module")
def odd_docs():
    rng = random.Random(4)
    made = []
    for i in range(60):
        lang = rng.choice([*PROSE])
        made.append((i, " ".join(rng.choices(PROSE[lang].split(), k=40)) + f" n{i} m{i} o{i}", lang, "s"))
    return made + [(None, None, None, None), (100, None, "en", "s"), (101, "", "en", "s"), (102, " \t\n", None, "s"), (103, "1234 !!! 5678", "en", "s")]


STAGES = dict(corpus_pipeline.STAGES)


def test_stages_on_odd_and_empty_tables(ready, small_data, odd_docs):
    docs = frame(ready, odd_docs + odd_docs[:3])
    for name, stage in STAGES.items():
        empty = stage(ready, docs.limit(0), small_data)
        assert empty.collect() == [], name
        found = stage(ready, docs, small_data)
        if name != "encoding":
            assert found.columns == docs.columns, name
        found.collect()


def test_language_stage_rejects_what_is_in_no_language(ready, small_data, odd_docs):
    kept = STAGES["language_id"](ready, frame(ready, odd_docs), small_data).collect()
    # planted: no letter, no text; all prose stays
    assert {r.doc_id for r in kept} == {i for i, t, *_ in odd_docs if t and re.search("[a-z]", t)}


def test_language_stage_without_labels_keeps_all_rows(ready, small_data, odd_docs):
    docs = frame(ready, [(i, t, None, s) for i, t, _, s in odd_docs])
    assert STAGES["language_id"](ready, docs, small_data).count() == len(odd_docs)


def test_least_score_follows_the_number_of_languages():
    scores = {n: language.least_score(type("Model", (), {"classes": list(range(n))})(), 0.067) for n in (1, 2, 4, 100)}
    assert scores[1] == 0 and 0.5 < scores[2] < 0.55 and 0.29 < scores[4] < 0.31 and 0.01 < scores[100] < 0.08


def test_one_row_of_each_group_stays_whatever_the_ids(ready, small_data):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(800)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(8)]
    near = texts[3].split()
    near[10] = "changed"
    near = " ".join(near)
    # one id for unlike texts, no id, copies with and without ids, equal rows
    given = [(1, texts[0], "en", "s"), (1, texts[1], "en", "s"), (None, texts[2], "en", "s"), (None, texts[4], "en", "s"),
             (5, texts[3], "en", "s"), (6, near, "en", "s"), (None, texts[3], "en", "t"), (7, texts[5], "en", "s"), (7, texts[5], "en", "s"),
             (8, None, "en", "s"), (9, "", "en", "s"), (10, "", "en", "s"), (None, None, None, None), (None, None, None, None)]
    found = STAGES["near_duplicates"](ready, frame(ready, given), small_data)
    have = Counter((r.doc_id, r.text, r.source) for r in found.collect())
    assert have == Counter([(1, texts[0], "s"), (1, texts[1], "s"), (None, texts[2], "s"), (None, texts[4], "s"), (5, texts[3], "s"),
                            (7, texts[5], "s"), (8, None, "s"), (9, "", "s"), (10, "", "s"), (None, None, None)])
    assert found.columns == frame(ready, given).columns


def test_redacted_documents_have_their_characters_counted(ready, small_data):
    text = "my password: hunter2secret and more"
    (row,) = STAGES["secret_scan"](ready, frame(ready, [(1, text, "en", "s")]), small_data).collect()
    assert row.text == "my [REDACTED] and more" and row.n_chars == len(row.text)


def test_contaminated_documents_go_and_the_rest_stays(ready, tmp_path, odd_docs):
    passage = " ".join(f"item{i}" for i in range(12))
    bench = [(1, passage, "x"), (None, None, "y"), (2, "", "z"), (2, passage, "x")]
    ready.createDataFrame(bench, "item_id long, text string, doc_id string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frame(ready, odd_docs + [(500, "before " + passage.upper() + " after", "en", "s"), (501, passage[:50], "en", "s")])
    kept = STAGES["decontamination"](ready, docs, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in kept) == Counter([r[0] for r in odd_docs] + [501])


def test_estimates_lose_no_pair_at_the_threshold():
    # the tail of a binomial distribution is heavier than five standard deviations suggest
    draws = np.random.default_rng(3)
    most, differ = near_dups.most_often(64, 0.1), draws.binomial(64, 0.1, 4_000_000)
    assert (differ <= most).all() and most < 32
    assert near_dups.most_often(200, 0.2) / 200 < 0.45
    # sets of 9 with 8 in common, of which one in four hundred thousand was ruled out by 64 register bits
    texts = np.random.default_rng(7).integers(0, 1 << 32, (40, 10), np.uint64)
    for row in texts:
        a, b = near_dups.registers(row[:9]), near_dups.registers(row[1:])
        bands = [{(k, *a_or_b) for k, a_or_b in enumerate(map(tuple, x.reshape(40, 5)))} for x in (a, b)]
        assert bands[0] & bands[1]


def test_buckets_of_a_class_take_every_band():
    import pyarrow as pa

    x = near_dups.registers(np.arange(50, dtype=np.uint64))
    batch = pa.RecordBatch.from_pydict({"id": [1], "n": [50], "registers": [x.tobytes()]})
    (rows,) = near_dups._bands(iter([batch]))
    assert len(set(rows.column("bucket").to_pylist())) == near_dups.BANDS + near_dups.MORE_BANDS
    # one that agrees in every fifth register of each fifth only has met none of the first bands
    y = x.copy() + np.uint16(1)
    y[3::40] = x[3::40]
    (other,) = near_dups._bands(iter([pa.RecordBatch.from_pydict({"id": [2], "n": [50], "registers": [y.tobytes()]})]))
    assert len(set(rows.column("bucket").to_pylist()) & set(other.column("bucket").to_pylist())) == 1


def test_documents_without_an_id_link_others(ready):
    words = [f"w{i}" for i in range(60)]
    text = lambda first: " ".join(words[first : first + 41])
    # 40 shingles each; 4 words on share 36 of 44, 8 words on 32 of 48
    rows = [(1, text(0)), (None, text(4)), (2, text(8)), (3, ""), (3, "x y z"), (None, "p q r"), (None, "P q r"), (None, None)]
    found = near_dups.near_duplicates(ready.createDataFrame(rows, "doc_id bigint, text string"), size=2).collect()
    have = sorted(((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in found))
    assert have == sorted([(1, 40, 1, True), (0, 40, 1, False), (2, 40, 1, False), (3, 0, 3, True), (3, 2, 3, True), (0, 2, 0, True), (0, 2, 0, True), (0, 0, 0, True)])


def test_tasks_of_one_operator_free_what_others_keep():
    from orderlake.llm import bpe, token_counts, wordbpe

    wordbpe.load(PATH), token_counts._counter(PATH)
    assert wordbpe.load.cache_info().currsize == token_counts._counter.cache_info().currsize == 1
    assert [*staging.lean(lambda batches: (2 * b for b in batches))(iter([1, 2]))] == [2, 4]
    assert [made.cache_info().currsize for made in (wordbpe.load, token_counts._counter, bpe._proposer)] == [0, 0, 0]


def test_workers_are_sent_few_rows_at_once(ready, small_data, settings):
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="10000")
    docs = ready.read.parquet(f"{small_data}/documents.parquet")
    STAGES["near_duplicates"](ready, docs.limit(3), small_data)
    assert int(ready.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1024
