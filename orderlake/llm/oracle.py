"""The named queries of this subpackage as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from orderlake.llm.urls import SOFT_LIMIT, SOFT_TERMS, STRICT_TERMS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SQL: dict[str, str] = {}

_SQL["op11_source_divergence"] = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text
    FROM documents
),
words AS (
    SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
),
languages AS (
    SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 30
),
totals AS (SELECT lang, sum(n) AS total, count(*) AS v FROM languages GROUP BY lang),
grps AS (SELECT DISTINCT lang, source FROM docs),
counts AS (
    SELECT w.lang, w.source, w.term, count(*) AS n FROM words w SEMI JOIN languages USING (lang, term) GROUP BY ALL
),
sized AS (
    SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM grps g LEFT JOIN counts c USING (lang, source) GROUP BY ALL
),
shares AS (
    SELECT s.lang, s.source, l.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.total + 5 * t.v) AS p,
           1 + (1000000000::HUGEINT * (l.n + 5)) // (t.total + 5 * t.v) AS q
    FROM sized s JOIN languages l USING (lang) JOIN totals t USING (lang)
    LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = l.term
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
    FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY ALL
),
ranked AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM ranked
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM numbered WHERE part = 'pair' OR r <= 50
"""

_SQL["op12_source_mix"] = r"""
WITH labelled AS (
    SELECT doc_id, CASE WHEN max(quality) > 0 THEN 2.0 ELSE 0.5 END AS weight
    FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
),
docs AS (
    SELECT d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+')) AS size,
           md5(coalesce(d.doc_id::VARCHAR, '') || ':' || coalesce(d.source, '') || ':' || coalesce(d.text, '')) AS digest,
           coalesce(l.weight, 1.0)::DOUBLE AS weight
    FROM documents d LEFT JOIN labelled l ON d.doc_id = l.doc_id
),
keyed AS (
    SELECT doc_id, source, size,
           -ln((('0x' || substr(digest, 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE) / weight AS key
    FROM docs
),
sources AS (
    SELECT source, sum(size)::HUGEINT AS source_size,
           [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::HUGEINT AS weight
    FROM keyed GROUP BY source
),
filled AS (
    SELECT *, sum(source_size) OVER () AS whole,
           coalesce(sum(200 * source_size) OVER (ORDER BY source_size * (10 // weight), source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
           sum(weight) OVER (ORDER BY source_size * (10 // weight), source NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
    FROM sources
),
judged AS (
    SELECT *, weight * (150 * whole - spent) > 200 * source_size * open AS above FROM filled
),
level AS (
    SELECT 150 * any_value(whole) - coalesce(sum(200 * source_size) FILTER (above), 0) AS rest,
           sum(weight) FILTER (NOT above) AS open
    FROM judged
),
plan AS (
    SELECT source, source_size,
           CASE WHEN above THEN (2 * source_size)::DOUBLE
                ELSE (weight * rest)::HUGEINT::DOUBLE / (100 * level.open)::HUGEINT::DOUBLE END AS target
    FROM judged, level
),
parted AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size::BIGINT ELSE 0 END AS epochs FROM plan
),
drawn AS (
    SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs,
           floor(p.target)::BIGINT - p.epochs * p.source_size - coalesce(sum(k.size) OVER (
               PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS FIRST, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS budget
    FROM keyed k JOIN parted p ON k.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (epochs * size + greatest(0, least(size, budget)))::BIGINT AS taken
FROM drawn
"""

_SQL["op3_decontamination"] = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
),
items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
),
phrases AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS size, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS phrase
    FROM items, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS t(i) WHERE len(words) > 0
),
windows AS (
    SELECT row, i, size, array_to_string(words[i:i + size - 1], ' ') AS phrase
    FROM docs, (SELECT DISTINCT size FROM phrases) s, unnest(generate_series(1, len(words) - size + 1)) AS t(i)
),
hits AS (SELECT DISTINCT w.row, w.i, w.size, p.item_id FROM windows w JOIN phrases p USING (size, phrase)),
hit AS (SELECT row, count(DISTINCT i + k) AS n FROM hits, unnest(generate_series(0, size - 1)) AS t(k) GROUP BY row),
found AS (
    SELECT row, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT row, item_id::VARCHAR AS name FROM hits WHERE item_id IS NOT NULL) x GROUP BY row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(f.n, 0)::BIGINT AS n_items,
       sha256(coalesce(f.names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit h USING (row) LEFT JOIN found f USING (row)
"""

_SQL["op4_substring_dedup"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
starts AS (
    SELECT row, i, md5(array_to_string(words[i:i + 34], ' ')) AS digest FROM docs, unnest(generate_series(1, len(words) - 34)) AS t(i)
),
again AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY digest) AS n FROM starts) x WHERE n > 1),
gone AS (SELECT DISTINCT row, i + k AS i FROM again, unnest(generate_series(0, 34)) AS t(k)),
kept AS (
    SELECT row, string_agg(word, ' ' ORDER BY i) AS text
    FROM (SELECT row, i, words[i] AS word FROM docs, unnest(generate_series(1, len(words))) AS t(i)) x
    ANTI JOIN gone USING (row, i) GROUP BY row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs LEFT JOIN (SELECT row, count(*) AS n FROM gone GROUP BY row) g USING (row) LEFT JOIN kept k USING (row)
"""

_SQL["op10_near_dups"] = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS words FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 1], ' ') AS shingle
    FROM docs, unnest(generate_series(1, greatest(len(words) - 1, 1))) AS t(i) WHERE len(words) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS one, b.doc_id AS two, count(*) AS n FROM shingles a JOIN shingles b USING (shingle)
    WHERE a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
    SELECT one, two FROM common c JOIN sizes a ON a.doc_id = one JOIN sizes b ON b.doc_id = two
    WHERE 100 * c.n >= 80 * (a.n + b.n - c.n)
),
edges AS (SELECT one, two FROM links UNION ALL SELECT two, one FROM links),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM docs
    UNION
    SELECT r.doc_id, e.two FROM reached r JOIN edges e ON e.one = r.other
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, r.component_id, r.component_id = d.doc_id AS kept
FROM docs d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r USING (doc_id)
"""


def _hits(terms: tuple[str, ...]) -> str:
    """How many of the terms occur between characters that are no letters or digits."""
    sides = "(^|[^A-Za-z0-9])", "([^A-Za-z0-9]|$)"
    return " + ".join(f"(regexp_matches(folded, '{sides[0]}{term}{sides[1]}'))::INT" for term in terms)


_SQL["op7_url_filter"] = f"""
WITH parts AS (
    SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS folded,
           CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
),
cut AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
           {_hits(STRICT_TERMS)} AS strict_hits, {_hits(SOFT_TERMS)} AS soft_hits
    FROM parts
),
ruled AS (
    SELECT *, CASE
        WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
        WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule
    FROM cut
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN strict_hits > 0 OR soft_hits >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict,
       strict_hits, soft_hits
FROM ruled
"""


def _hashed(text: str) -> str:
    """The digest of a row with the given expression for its text."""
    columns = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    parts = [f"coalesce(strlen({c})::VARCHAR || ':' || ({c}), '-')" for c in columns]
    return f"sha256({' || '.join(parts)})"


# the checksum bit by bit, as SQL has no function for it
_CRC = """xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::UBIGINT)),
    lambda crc, b: list_reduce(
        list_prepend(xor(crc, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, step: xor(x >> 1, 3988292384::UBIGINT * (x & 1::UBIGINT)))))"""

_SQL["op13_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS (
    SELECT row_number() OVER () AS row, doc_id, source, {_hashed("text")} AS leaf,
           CASE WHEN doc_id IS NOT NULL AND {_CRC} % 2 = 0 THEN {_hashed("replace(text, chr(10), '')")} ELSE {_hashed("text")} END AS claim
    FROM documents
),
placed AS (
    SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS n,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS pos
    FROM leaves
),
nodes(level, tree, pos, n, digest) AS (
    SELECT 0, tree, pos, n, leaf FROM placed
    UNION ALL
    SELECT level + 1, tree, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
    FROM nodes WHERE n > 1 GROUP BY level, tree, pos // 3, n
),
upper_nodes(level, pos, n, digest) AS (
    SELECT 0, tree, (SELECT count(DISTINCT tree) FROM placed), digest FROM nodes WHERE n = 1
    UNION ALL
    SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
    FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 3, n
),
runs AS (
    SELECT level, tree, pos // 3 AS run, list(digest ORDER BY pos) AS digests FROM nodes WHERE n > 1 GROUP BY ALL
),
upper_runs AS (
    SELECT level, pos // 3 AS run, list(digest ORDER BY pos) AS digests FROM upper_nodes WHERE n > 1 GROUP BY ALL
),
climbed(row, level, tree, pos, proof, node) AS (
    SELECT row, 0, tree, pos, '', claim FROM placed
    UNION ALL
    SELECT c.row, c.level + 1, c.tree, c.pos // 3,
           c.proof || array_to_string(r.digests[1:c.pos % 3], '') || array_to_string(r.digests[c.pos % 3 + 2:], ''),
           sha256(array_to_string(r.digests[1:c.pos % 3], '') || c.node || array_to_string(r.digests[c.pos % 3 + 2:], ''))
    FROM climbed c JOIN runs r ON r.level = c.level AND r.tree = c.tree AND r.run = c.pos // 3
),
at_subroot AS (
    SELECT row, tree AS pos, arg_max(proof, level) AS proof, arg_max(node, level) AS node FROM climbed GROUP BY row, tree
),
finished(row, level, pos, proof, node) AS (
    SELECT row, 0, pos, proof, node FROM at_subroot
    UNION ALL
    SELECT c.row, c.level + 1, c.pos // 3,
           c.proof || array_to_string(r.digests[1:c.pos % 3], '') || array_to_string(r.digests[c.pos % 3 + 2:], ''),
           sha256(array_to_string(r.digests[1:c.pos % 3], '') || c.node || array_to_string(r.digests[c.pos % 3 + 2:], ''))
    FROM finished c JOIN upper_runs r ON r.level = c.level AND r.run = c.pos // 3
),
ends AS (SELECT row, arg_max(proof, level) AS proof, arg_max(node, level) AS node FROM finished GROUP BY row)
SELECT p.doc_id, p.leaf, s.digest AS subroot, u.digest AS root, sha256(e.proof) AS proof_sha256,
       e.node AS folded_root, e.node = u.digest AS verified
FROM placed p JOIN ends e USING (row) JOIN nodes s ON s.tree = p.tree AND s.n = 1
CROSS JOIN (SELECT digest FROM upper_nodes WHERE n = 1) u
"""


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
