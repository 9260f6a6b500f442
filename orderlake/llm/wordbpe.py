"""A byte-pair vocabulary with word ends, as a ``tokenizers`` file describes it.

No word crosses white space, so texts are cut there first, and each distinct piece between two blanks is
normalised and cut into words once per task or worker. What is merged into what is left to the callers.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
from tokenizers import Tokenizer

from orderlake.llm.staging import kept

#: Distinct pieces and words a task or worker remembers; beyond that it starts anew.
REMEMBERED = 1 << 19
#: Stands for the end of a word inside symbols; a private character no byte maps to.
END = "\ue000"

# White space of the file's normaliser, and its word pattern for lower-case ASCII.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECE = re.compile(f"[^{BLANKS}]+")
_ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
_ASCII_LINE = re.compile(_ASCII_WORD.pattern + "|\n")
#: Control characters that Python takes for blanks and the file does not.
SEPARATORS = "\x1c\x1d\x1e\x1f"


class WordBpe:
    """Vocabulary, merges and word cutting of one file."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text())
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or model["unk_token"] or spec["decoder"]:
            raise ValueError(f"{path} is not a byte-level vocabulary with word ends")
        suffix = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special tokens are taken literally only")
        self.tokens = {i: t for t, i in (self.ids | self.specials).items()}
        self.merges: list[tuple[int, int, int]] = []
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        for left, right in pairs:
            self.merges.append((self.ids[left], self.ids[right], self.ids[left + right]))
        #: Rank and product of every pair that can be merged.
        self.pairs = {(a, b): (rank, c) for rank, (a, b, c) in enumerate(self.merges)}
        self.symbols = {t: i for t, i in self.ids.items() if len(t) == 1}
        self.symbols |= {t[0] + END: i for t, i in self.ids.items() if len(t) == 1 + len(suffix) and t.endswith(suffix)}
        own = Tokenizer.from_file(path)
        self._normalise, self._cut = own.normalizer.normalize_str, own.pre_tokenizer.pre_tokenize_str
        self._special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None

    def words(self, piece: str) -> list[str]:
        """The words of a piece without white space; special tokens stand for themselves."""
        if piece.isascii() and piece.isprintable() and "<|" not in piece:
            return _ASCII_WORD.findall(piece.lower())
        parts = self._special.split(piece) if self._special else [piece]
        found: list[str] = []
        for part in parts:
            if part in self.specials:
                found.append(part)
            elif part:
                found += [word for word, _ in self._cut(self._normalise(part))]
        return found

    def words_of(self, pieces: list[str]) -> tuple[list[str], np.ndarray]:
        """The words of many pieces, and the piece each belongs to, in order; the patterns run over all pieces at
        once."""
        plain, rest, apart = [], [], []
        for i, piece in enumerate(pieces):
            if piece.isascii() and piece.isprintable() and "<|" not in piece:
                plain.append(i)
            else:
                (apart if "<|" in piece else rest).append(i)
        lines = _ASCII_LINE.findall("\n".join([pieces[i] for i in plain]).lower())
        borders = np.array([word == "\n" for word in lines], bool)
        owner = np.array(plain, np.int64)[np.cumsum(borders)] if lines else np.zeros(0, np.int64)
        words, owners = [word for word in lines if word != "\n"], [owner[~borders]]
        # white space is normalised to blanks, and no piece holds any
        normal = self._normalise(" ".join([pieces[i] for i in rest]))
        ends = np.cumsum([len(part) + 1 for part in normal.split(" ")])
        if len(ends) == len(rest):
            cut = self._cut(normal)
            starts = np.array([start for _, (start, _) in cut], np.int64)
            words += [word for word, _ in cut]
            owners.append(np.array(rest, np.int64)[np.searchsorted(ends, starts, "right")])
        else:
            apart += rest
        for i in apart:
            own = self.words(pieces[i])
            words += own
            owners.append(np.full(len(own), i))
        owner = np.concatenate(owners)
        if (np.diff(owner) < 0).any():
            order = np.argsort(owner, kind="stable")
            words, owner = [words[i] for i in order.tolist()], owner[order]
        return words, owner

    def initial(self, word: str) -> list[int]:
        """The symbols a word is merged from, one per byte, the last with the word's end."""
        return [*map(self.symbols.__getitem__, word[:-1]), self.symbols[word[-1] + END]]


@kept
def load(path: str) -> WordBpe:
    return WordBpe(path)


def pieces(text: str | None) -> list[str]:
    """A text cut at white space."""
    if not text:
        return []
    return _PIECE.findall(text) if any(c in text for c in SEPARATORS) else text.split()


class Remembered:
    """Answers for distinct keys, worked out for all new ones of a call together."""

    def __init__(self, answer: Callable[[list[str]], Iterable]):
        self._answer, self._known = answer, {}

    def __call__(self, wanted: set[str]) -> dict:
        new = wanted.difference(self._known)
        if len(self._known) + len(new) > REMEMBERED:
            self._known, new = {}, wanted
        new = list(new)
        self._known.update(zip(new, self._answer(new)))
        return self._known


def merge(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> tuple[list[int], int]:
    """Merge neighbours, the lowest rank and of these the leftmost first. Returns the symbols with -1 where
    one was swallowed, and the number of merges.

    The heap holds candidate pairs; the linked list of what is left tells whether one is still there.
    """
    n, merges = len(symbols), 0
    symbols = list(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []
    for i in range(n - 1):
        if (pair := (symbols[i], symbols[i + 1])) in pairs:
            heap.append((pairs[pair][0], i, *pair))
    heapify(heap)
    while heap:
        _, i, left, right = heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue
        symbols[i], symbols[j] = pairs[left, right][1], -1
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (pair := (symbols[i], symbols[k])) in pairs:
                heappush(heap, (pairs[pair][0], i, *pair))
        if (h := before[i]) >= 0 and (pair := (symbols[h], symbols[i])) in pairs:
            heappush(heap, (pairs[pair][0], h, *pair))
    return symbols, merges
