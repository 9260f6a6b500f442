"""Byte-pair encoding by speculation, and decoding.

Greedy longest match proposes the tokens of all new words of a batch, found by one automaton in one pass. A
sequence of tokens is what merging would give exactly if every token can be made at all and no two
neighbours could have merged differently across their border. The second is tested for all neighbours of
the batch at once: both tokens are taken apart from the latest merge back, and at each step the two symbols
that meet at the border must not have a merge that would have come first.

A word that fails gets further proposals: from its start, the longest token that fits its predecessor is
taken; where none fits, the predecessor is shortened to the next token it begins with. Tests of borders are
remembered. Only words for which that finds nothing are merged one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm import wordbpe
from orderlake.llm.staging import kept

#: Texts, and bytes of text, whose distinct pieces are encoded together.
TEXTS_OF_SLICE, SLICE_BYTES = 8192, 1 << 24
#: Tests of borders that are remembered.
REMEMBERED = 1 << 19


class Proposer:
    """Encodes words of one vocabulary."""

    def __init__(self, bpe: wordbpe.WordBpe):
        self._bpe = bpe
        n = max(bpe.tokens) + 1
        self._n = n
        self._left, self._right, self._rank = np.full(n, -1), np.full(n, -1), np.full(n, -1)
        merges = np.array(bpe.merges, np.int64).reshape(-1, 3)
        made = merges[:, 2]
        self._left[made], self._right[made], self._rank[made] = merges[:, 0], merges[:, 1], np.arange(len(merges))
        keys = merges[:, 0] * n + merges[:, 1]
        order = np.argsort(keys)
        # closed by a key no pair has, so that a search never runs off the end
        self._keys, self._key_rank = np.append(keys[order], n * n), np.append(order, len(merges))
        # taking apart in the order of ranks needs parts that came before the whole, and one way to make each
        parts = np.maximum(self._rank[merges[:, 0]], self._rank[merges[:, 1]])
        self._ordered = bool((parts < np.arange(len(merges))).all()) and len(np.unique(made)) == len(made)
        self._reachable = self._makeable(merges)
        # tokens as strings, the end of a word as one further character
        strings: dict[int, str] = {i: s for s, i in bpe.symbols.items()}
        for left, right, token in bpe.merges:
            strings[token] = strings[left] + strings[right]
        self._length = np.zeros(n, np.int64)
        self._automaton = ahocorasick.Automaton()
        by_text = {text: token for token, text in strings.items()}
        for text, token in by_text.items():
            self._automaton.add_word(text, token)
            self._length[token] = len(text)
        self._automaton.make_automaton()
        self._size = self._length.tolist()
        # the longest token a token begins with, itself aside
        self._shorter: list[int | None] = [None] * n
        for text, token in by_text.items():
            self._shorter[token] = next((by_text[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in by_text), None)
        self._usable = self._reachable.tolist()
        self._fits: dict[int, bool] = {}

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self._n + right
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._key_rank[at], np.iinfo(np.int64).max)

    def compatible(self, left: np.ndarray, right: np.ndarray, whole: bool = True) -> np.ndarray:
        """Whether merging leaves the border between each two tokens alone; with ``whole`` false, until both
        are complete."""
        left, right = left.copy(), right.copy()
        ok = np.ones(len(left), bool)
        if whole:
            ok &= self._pair_rank(left, right) == np.iinfo(np.int64).max
        open_ = np.flatnonzero(ok)
        while len(open_):
            a, b = left[open_], right[open_]
            ra, rb = self._rank[a], self._rank[b]
            undo_left = ra > rb
            # of two equal merges the left one happens first, so the right one is undone first
            left[open_] = np.where(undo_left, self._right[a], a)
            right[open_] = np.where(undo_left, b, self._left[b])
            live = np.maximum(ra, rb) >= 0
            open_, ra, rb, undo_left = open_[live], ra[live], rb[live], undo_left[live]
            met = self._pair_rank(left[open_], right[open_])
            bad = np.where(undo_left, met < ra, met <= rb)
            ok[open_[bad]] = False
            open_ = open_[~bad]
        return ok

    def _makeable(self, merges: np.ndarray) -> np.ndarray:
        """Tokens that merging their own symbols gives."""
        good = np.ones(self._n, bool)
        if self._ordered:
            good[merges[:, 2]] = self.compatible(merges[:, 0], merges[:, 1], whole=False)
            while True:
                now = good.copy()
                now[merges[:, 2]] &= good[merges[:, 0]] & good[merges[:, 1]]
                if (now == good).all():
                    break
                good = now
        return good

    def propose(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Longest tokens from the left of all words, and the word each belongs to. The word's end is no token by
        itself: where it is left over, the proposal lacks it."""
        ends = np.cumsum([len(word) + 1 for word in words])
        met = list(self._automaton.iter_long(wordbpe.END.join(words) + wordbpe.END))
        last, token = (np.fromiter(map(itemgetter(i), met), np.int64, len(met)) for i in (0, 1))
        return token, np.searchsorted(ends, last, "right")

    def _test(self, left: int, right: int) -> bool:
        """``compatible`` for one pair, remembered."""
        if len(self._fits) >= REMEMBERED:
            self._fits.clear()
        known = self._fits[left * self._n + right] = self._border(left, right)
        return known

    def _border(self, left: int, right: int) -> bool:
        pairs, rank = self._bpe.pairs, self._rank
        if (left, right) in pairs:
            return False
        while True:
            undo_left, undone = rank[left] > rank[right], max(rank[left], rank[right])
            if undone < 0:
                return True
            if undo_left:
                left = int(self._right[left])
            else:
                right = int(self._left[right])
            met = pairs.get((left, right))
            if met is not None and (met[0] < undone if undo_left else met[0] <= undone):
                return False

    def step_back(self, word: str, fitting: list[int]) -> list[int] | None:
        """Tokens of which each fits the one before, the longest first, or None if there are none. ``fitting`` are
        the tokens of the proposal up to the first that does not fit, which is tried before shorter ones."""
        text, n = word + wordbpe.END, len(word) + 1
        size, usable, fits, width = self._size, self._usable, self._fits, self._n
        out = fitting
        at = sum([size[t] for t in out])
        dead: set[int] = set()
        token = self._longest(text, at)
        while True:
            while token is not None:
                end = at + size[token]
                # the end of the word is no token
                if end != n - 1 and end not in dead and usable[token]:
                    if not out:
                        break
                    known = fits.get(out[-1] * width + token)
                    if self._test(out[-1], token) if known is None else known:
                        break
                token = self._shorter[token]
            if token is None:
                dead.add(at)
                if not out:
                    return None
                at -= size[out[-1]]
                token = self._shorter[out.pop()]
                continue
            out.append(token)
            at = end
            if at == n:
                return out
            token = self._longest(text, at)

    def _longest(self, text: str, at: int) -> int | None:
        last, token = next(self._automaton.iter_long(text, at), (-1, None))
        return token if token is not None and last - self._size[token] + 1 == at else None

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
        """The tokens of all words, the borders between words, and how many words were merged one by one."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(1, np.int64), 0
        specials = self._bpe.specials
        flat, owner = self.propose(words)
        borders = np.searchsorted(owner, np.arange(len(words) + 1))
        # every character and the end have to be covered, by tokens merging can make
        covered = np.bincount(owner, self._length[flat], len(words)) == np.array([len(word) + 1 for word in words])
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        apart = inner[~self.compatible(flat[inner], flat[inner + 1])]
        good = covered & self._ordered
        good[owner[apart]] = False
        good[owner[~self._reachable[flat]]] = False
        good[[i for i, word in enumerate(words) if word in specials]] = False
        # per failing word how many tokens fit, up to its first failing border
        fit = np.zeros(len(words), np.int64)
        failing, first = np.unique(owner[apart], return_index=True)
        fit[failing] = apart[first] + 1 - borders[failing]
        fit[owner[~self._reachable[flat]]] = 0
        failed = np.flatnonzero(~good)
        tokens, own, merged = flat.tolist(), [], 0
        for i, begin, n in zip(failed.tolist(), borders[failed].tolist(), fit[failed].tolist()):
            word = words[i]
            found = None
            if word in specials:
                found = [specials[word]]
            elif self._ordered:
                found = self.step_back(word, tokens[begin : begin + n])
            if found is None:
                left = wordbpe.merge(self._bpe.initial(word), self._bpe.pairs)[0]
                found, merged = [t for t in left if t >= 0], merged + 1
            own.append(found)
        if not own:
            return flat, borders, 0
        # the words that failed take their tokens' places
        sizes = np.diff(borders)
        sizes[failed] = [len(found) for found in own]
        after = np.concatenate([[0], np.cumsum(sizes)])
        out = np.empty(after[-1], np.int64)
        right = np.repeat(good, sizes)
        out[right] = flat[good[owner]]
        out[~right] = np.fromiter(chain.from_iterable(own), np.int64, int(sizes[failed].sum()))
        return out, after, merged

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all pieces, and the borders between them."""
        words, owner = self._bpe.words_of(pieces)
        kinds = pa.array(words, pa.string()).dictionary_encode()
        flat, borders, _ = self.encode(kinds.dictionary.to_pylist())
        which = kinds.indices.to_numpy()
        tokens, ends = gathered(flat, borders, which)
        return tokens, ends[np.searchsorted(owner, np.arange(len(pieces) + 1))]


def gathered(flat: np.ndarray, borders: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``which`` of an array cut at ``borders``, one after the other, and the borders between them."""
    sizes = np.diff(borders)[which]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    places = np.repeat(borders[which] - ends[:-1], sizes) + np.arange(ends[-1])
    return flat[places], ends


@kept
def _proposer(path: str) -> Proposer:
    return Proposer(wordbpe.load(path))


def decode(path: str, ids: list[int]) -> str:
    """Tokens of the ids, specials included, joined by blanks: the file names no decoder."""
    return " ".join(map(wordbpe.load(path).tokens.__getitem__, ids))


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts, a bounded number and volume at a time; one longer text comes alone."""
    ends = np.cumsum(np.asarray(pa.compute.binary_length(texts).fill_null(0), np.int64))
    first = 0
    while first < len(texts):
        done = int(ends[first - 1]) if first else 0
        last = min(int(np.searchsorted(ends, done + SLICE_BYTES, "right")), first + TEXTS_OF_SLICE)
        yield texts.slice(first, max(last - first, 1))
        first = max(last, first + 1)


def _split(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The pieces between white space of all texts, and the borders between texts."""
    if pa.compute.any(pa.compute.match_substring_regex(texts, f"[{wordbpe.SEPARATORS}]")).as_py():
        lists = pa.array([wordbpe.pieces(text) for text in texts.to_pylist()], pa.list_(pa.string()))
    else:
        lists = pa.compute.utf8_split_whitespace(texts.fill_null(""))
    offsets = lists.offsets.to_numpy()
    return lists.flatten().dictionary_encode(), offsets - offsets[0]


def _encode(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for part in _slices(batch.column("text")):
                pieces, borders = _split(part)
                tokens, ends = _proposer(path).encode_pieces(pieces.dictionary.to_pylist())
                flat, ends = gathered(tokens, ends, pieces.indices.to_numpy())
                ids = pa.ListArray.from_arrays(pa.array(ends[borders], pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(part)), ids], ["doc_id", "ids"])
                first += len(part)

    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and ``ids``, the token ids of the whole text under the vocabulary file ``path``, which
    every worker can read. Null texts count as empty and have no ids. Special strings inside a text become
    their ids, none are added. Repeated rows are separate, other columns are not read.
    """
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(_encode(path), "doc_id bigint, ids array<int>")


def _joined(parts: pa.Array, borders: np.ndarray) -> pa.Array:
    return pa.compute.binary_join(pa.ListArray.from_arrays(pa.array(borders, pa.int32()), parts), " ")


def _digest(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = wordbpe.load(path).tokens
        spelled = [pa.array([spell(i) for i in range(max(names) + 1)], pa.string()) for spell in (str, lambda i: names.get(i, ""))]
        for batch in batches:
            first = 0
            for part in _slices(batch.column("text")):
                pieces, borders = _split(part)
                tokens, ends = _proposer(path).encode_pieces(pieces.dictionary.to_pylist())
                # a piece may have no token; it leaves no blank behind
                indices, sizes = pieces.indices.to_numpy(), np.diff(ends)
                some = sizes[indices] > 0
                kept = np.concatenate([[0], np.cumsum(some)])[borders]
                counts = np.concatenate([[0], np.cumsum(sizes[indices])])[borders]
                columns = []
                for spelling in spelled:
                    of_piece = _joined(spelling.take(pa.array(tokens)), ends)
                    texts = _joined(of_piece.take(pa.array(indices[some])), kept)
                    columns.append(pa.array([hashlib.sha256(t).hexdigest() for t in texts.cast(pa.binary()).to_pylist()], pa.string()))
                numbers = batch.column("doc_id").slice(first, len(part))
                yield pa.RecordBatch.from_arrays([numbers, pa.array(np.diff(counts)), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                first += len(part)

    return run


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, and the SHA-256 of the ids joined by blanks and of the text they decode
    to. Rows are treated as by ``encode``; ids stay in the task, so nothing large is shuffled or written.
    """
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return plain.mapInArrow(_digest(path), schema)
