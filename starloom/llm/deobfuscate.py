"""Noisy-channel deobfuscation: Viterbi over the letters a disguised word may stand for.

Every character spans a small lattice of letters it may replace (leetspeak), a run of three or more
equal characters may stand for one or two of them, and a gap between short parts (``i d i``, ``i.di.ot``)
is the end of a word or nothing. A character trigram model, learned from plain words, picks the path.
Four or more letters spaced out one by one are read joined in any case. A word of letters without such
a run or gap has a single path and is returned as it is.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from itertools import chain

# The letters that digits and signs commonly stand for.
LEET: dict[str, str] = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c", "*": "aeiou", "#": "h", "%": "o",
}

SUBSTITUTE = math.log(0.3)
DROP_SIGN = math.log(0.02)
COLLAPSE = math.log(0.45)
GAP = math.log(0.1)
_OUTER = ".,;:!?\"'()[]{}<>*#$%&@|+~`-_=/\\"
_SPACED = re.compile(r"(?<![^\W_])[^\W_](?:[ .\-_*]{1,2}[^\W_]){3,}(?![^\W_])")
# Three parts or more of one or two characters (the last up to three); a lattice is made of those in which
# two parts are single.
_PARTS = re.compile(r"(?<![^\W_])(?:[^\W_]{1,2}[ .\-_*]{1,2}){2,}[^\W_]{1,3}(?![^\W_])")
_SEPARATOR = re.compile(r"[ .\-_*]+")
_RUN = re.compile(r"(.)\1{2,}", re.DOTALL)


class CharModel:
    """Trigram model over letters with ``^`` before and ``$`` after a word, interpolated with
    bigrams and unigrams. Its size is bounded by the alphabet, not by the corpus. ``bi`` and ``one`` count the
    endings of all trigrams where ``counts`` holds only some."""

    def __init__(self, counts: dict[str, int], bi: dict[str, int] | None = None, one: dict[str, int] | None = None):
        self.tri: dict[str, int] = {}
        self.ctx: Counter[str] = Counter()
        self.bi: Counter[str] = Counter()
        self.one: Counter[str] = Counter()
        for gram, n in counts.items():
            self.tri[gram] = self.tri.get(gram, 0) + n
            self.ctx[gram[:2]] += n
            self.bi[gram[1:]] += n
            self.one[gram[2]] += n
        if bi is not None:
            self.bi = Counter(bi)
        if one is not None:
            self.one = Counter(one)
        self.first: Counter[str] = Counter()
        for gram, n in self.bi.items():
            self.first[gram[0]] += n
        self.total = sum(self.one.values())
        self.size = len(self.one) + 1
        self._memo: dict[str, float] = {}

    @staticmethod
    def grams(word: str) -> Iterable[str]:
        padded = f"^^{word}$"
        return (padded[i : i + 3] for i in range(len(padded) - 2))

    def logp(self, gram: str) -> float:
        """log P(third | first two)."""
        p = self._memo.get(gram)
        if p is None:
            one = (self.one[gram[2]] + 0.5) / (self.total + 0.5 * self.size)
            two = (self.bi[gram[1:]] + 2 * one) / (self.first[gram[1]] + 2)
            p = math.log((self.tri.get(gram, 0) + 2 * two) / (self.ctx[gram[:2]] + 2))
            if len(self._memo) > 200_000:
                self._memo.clear()
            self._memo[gram] = p
        return p


def is_plain(word: str) -> bool:
    return word.isalpha() and not _RUN.search(word)


def _segments(word: str) -> list[list[tuple[str, float]]]:
    """Per run of equal characters: the letter strings it may stand for, with channel log scores."""
    out = []
    i = 0
    while i < len(word):
        j = i
        while j < len(word) and word[j] == word[i]:
            j += 1
        c, n = word[i], j - i
        lengths = [(n, 0.0)] if n < 3 else [(1, COLLAPSE), (2, COLLAPSE)]
        options: list[tuple[str, float]] = []
        if c.isalpha():
            options += [(c * k, s) for k, s in lengths]
        else:
            for letter in LEET.get(c, ""):
                options += [(letter * k, s + k * SUBSTITUTE) for k, s in lengths]
            options.append(("", n * DROP_SIGN if n < 3 else 2 * DROP_SIGN))
        out.append(options)
        i = j
    return out


_END = "\x00"  # on a path: a word ends here


def _best_path(lattice: list[list[tuple[str, float]]], model: CharModel) -> str:
    """The likeliest letters. States are the last two letters; linear in the length of the lattice."""
    states: dict[str, tuple[float, tuple]] = {"^^": (0.0, ())}
    for options in lattice:
        new: dict[str, tuple[float, tuple]] = {}
        for ctx, (score, path) in states.items():
            for letters, cost in options:
                s, c = score + cost, ctx
                if letters == _END:
                    s, c = s + model.logp(c + "$"), "^^"
                else:
                    for x in letters:
                        s += model.logp(c + x)
                        c = c[1] + x
                if c not in new or s > new[c][0]:
                    new[c] = (s, (path, letters) if letters else path)
        states = new
    _, path = max(((s + model.logp(c + "$"), p) for c, (s, p) in states.items()), key=lambda x: x[0])
    parts = []
    while path:
        path, letters = path
        parts.append(letters)
    return "".join(reversed(parts))


def decode(word: str, model: CharModel) -> str:
    """The likeliest plain word."""
    return _best_path(_segments(word), model)


def decode_spaced(parts: list[str], model: CharModel) -> list[str]:
    """The likeliest plain words of parts with gaps between them: each gap ends a word or is none."""
    lattice = _segments(parts[0])
    for p in parts[1:]:
        lattice.append([("", GAP), (_END, 0.0)])
        lattice += _segments(p)
    return [w for w in _best_path(lattice, model).split(_END) if w]


def joined(text: str) -> str:
    """Letters spaced out one by one, put together."""
    return _SPACED.sub(lambda m: re.sub(r"[ .\-_*]", "", m.group()), text)


class Restorer:
    """Texts to lists of restored lower-case words; a bounded memo of distinct tokens."""

    LIMIT = 200_000

    def __init__(self, model: CharModel):
        self.model = model
        self.memo: dict[str, tuple[str, ...]] = {}

    def token(self, token: str) -> tuple[str, ...]:
        """The words one token may be read as: without its outer signs and, where these may stand
        for letters (``a$$``), with them."""
        core = token.strip(_OUTER)
        if is_plain(core):
            return (core,)
        out = []
        for form in dict.fromkeys((core, token.strip(".,;:?\"'"))):
            if any(c.isalpha() for c in form):
                out.append(form if is_plain(form) else decode(form, self.model))
        return tuple(dict.fromkeys(w for w in out if w))

    def __call__(self, text: str | None) -> set[str]:
        """The distinct restored words of a text."""
        if not text:
            return set()
        found: set[str] = set()
        memo = self.memo
        low = text.lower()
        runs = set(_PARTS.findall(low))
        for run in runs:
            parts = _SEPARATOR.split(run)
            if sum(len(p) == 1 for p in parts) >= 2:
                found.update(decode_spaced(parts, self.model))
        # Letters spaced out one by one are such a run too.
        tokens = set((joined(low) if runs else low).split())
        new = tokens.difference(memo)
        if len(memo) + len(new) > self.LIMIT:
            memo.clear()
            new = tokens
        for t in new:
            memo[t] = self.token(t)
        found.update(chain.from_iterable(map(memo.__getitem__, tokens)))
        return found
