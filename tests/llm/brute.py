"""Plain single-process versions of the operators, to hold small results against."""

import hashlib
import re
from collections import Counter

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def passages(docs, items, window=10):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per (doc_id, text)."""
    wanted = {}
    for number, text in items:
        own = ALNUM.findall((text or "").translate(LOWER))
        for i in range(max(1, len(own) - window + 1)) if own else ():
            wanted.setdefault(tuple(own[i : i + window]), set()).add(number)
    sizes = {len(w) for w in wanted}
    for doc, text in docs:
        own = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                if (key := tuple(own[i : i + size])) in wanted:
                    hit.update(range(i, i + size))
                    found |= wanted[key] - {None}
        yield doc, len(own), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)


def repeats(docs, window=35):
    """(doc_id, n_words, n_removed, kept_sha256) per (doc_id, text)."""
    split = [(doc, BLANK.findall(text or "")) for doc, text in docs]
    seen = Counter(tuple(own[i : i + window]) for _, own in split for i in range(len(own) - window + 1))
    for doc, own in split:
        gone = set()
        for i in range(len(own) - window + 1):
            if seen[tuple(own[i : i + window])] > 1:
                gone.update(range(i, i + window))
        yield doc, len(own), len(gone), sha(" ".join(w for i, w in enumerate(own) if i not in gone))


SECRETS = (
    ("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)


def secrets(docs):
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) per (doc_id, text)."""
    for doc, text in docs:
        found = [
            (m.start(), rank, m.end())
            for rank, (_, pattern, group, least) in enumerate(SECRETS)
            for m in pattern.finditer(text or "")
            if len(m[group]) >= least
        ]
        spans = ",".join(f"{SECRETS[rank][0]}:{start}:{end}" for start, rank, end in sorted(found))
        yield doc, *(sum(f[1] == k for f in found) for k in range(3)), sha(spans), spans


def tokens(docs, tokenizer):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per (doc_id, text)."""
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        yield doc, len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))


def near(docs, size=2, percent=80):
    """(doc_id, n_shingles, component_id, kept) per (doc_id, text); ids are distinct."""
    sets = {}
    for doc, text in docs:
        own = BLANK.findall((text or "").translate(LOWER))
        sets[doc] = {tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1))} if own else set()
    root = {doc: doc for doc in sets}

    def find(doc):
        while root[doc] != doc:
            doc = root[doc]
        return doc

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small and 100 * small >= percent * large:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (small + large - common):
                    one, two = sorted((find(a), find(b)))
                    root[two] = one
    for doc in ids:
        yield doc, len(sets[doc]), find(doc), find(doc) == doc
