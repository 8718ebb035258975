"""Whole texts to token ids of a public tokenizer, with a bounded memo of words.

White space never crosses a token of ``word_bpe_49k.json`` (its pre-tokenizer drops white space and
its normalizer works on single words alike), so a text's ids are its words' ids in order, and a word
needs to be encoded once. A word's ids are those of its pieces: letters, contractions, single digits and runs
of signs, lower-cased. ASCII words are cut into pieces here, so that the tokenizer's merges see a piece
once, without its normalizer and its pre-tokenizer.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from starloom.llm.common import claim, word_codes

TOKENIZER = "word_bpe_49k.json"
EOD = 2


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _gather(table: np.ndarray, width: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The entries of ``table``, which are ``width`` long each and lie one after another, by their numbers."""
    first, n = np.cumsum(width) - width, width[numbers]
    return table[np.arange(n.sum()) + np.repeat(first[numbers] - (np.cumsum(n) - n), n)]


SIGNS = ".,!?:;"
# Letters of ASCII and Latin-1, which all engines lower-case alike and which are composed, then signs.
_SIMPLE = rf"^[A-Za-zÀ-ÖØ-öø-ÿ]+[{SIGNS}]*$"
_PRINTED = re.compile(r"[!-~]+")
# The tokenizer's own pieces, for printed ASCII in lower case.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


class Encoder:
    """``encode_all(texts)``: per text its ids as little-endian unsigned 16-bit bytes.

    Words of printed ASCII, and words of letters with sentence signs after them, are looked up by their
    pieces; other words are encoded as they are. ``LIMIT`` bounds the memo of pieces that stays between
    batches. The strings of special tokens give their ids, by the tokenizer's own rule; with ``plain``
    they are ordinary text.
    """

    LIMIT = 500_000
    GROUP = 1000

    def __init__(self, path: str, plain: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        vocab = self.tokenizer.get_vocab()
        if max(vocab.values()) >= 65536:
            raise ValueError("ids must fit in 16 bits")
        model = self.tokenizer.model
        model._resize_cache(0)  # the memo knows what was met before
        self.merges = Tokenizer(model)
        self.merges.pre_tokenizer = WhitespaceSplit()
        self.ends_word = np.zeros(65536, bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.memo: dict[str, bytes] = {}

    def _encode(self, parts: list[str], tokenizer: Tokenizer) -> list[bytes]:
        """Ids of single words. Many are encoded as one text, split again at the word ends."""
        groups = [parts[i : i + self.GROUP] for i in range(0, len(parts), self.GROUP)]
        out: list[bytes] = []
        for group, e in zip(groups, tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u2")
            ends = (2 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
            if len(ends) == len(group):
                raw = ids.tobytes()
                out += [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            else:  # some are more than one word
                out += [np.array(x.ids, "<u2").tobytes() for x in tokenizer.encode_batch_fast(group, add_special_tokens=False)]
        return out

    def _learn(self, pieces: list[str]) -> None:
        """Put the pieces that the memo lacks into it."""
        new = [p for p in dict.fromkeys(pieces) if p not in self.memo]
        ascii_ = [p for p in new if p.isascii()]
        other = [p for p in new if not p.isascii()]
        self.memo.update(zip(ascii_, self._encode(ascii_, self.merges), strict=True))
        self.memo.update(zip(other, self._encode(other, self.tokenizer), strict=True))

    @staticmethod
    def _pieces(word: str) -> tuple[str, ...] | None:
        """The pieces of a word of printed ASCII, or (lower-case letters, signs) if the word is letters, then
        signs that make one token."""
        low = word.lower()
        if _PRINTED.fullmatch(word):
            return tuple(_PIECES.findall(low)) if "<|" not in word else None  # may be a special token
        core = low.rstrip(SIGNS)
        if core.isalpha() and unicodedata.is_normalized("NFC", word) and "\u03c2" not in low:
            return (core, low[len(core) :]) if len(core) < len(low) else (core,)
        return None

    def _words(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all words, one word after another; the number of ids of each)."""
        memo = self.memo
        if len(memo) >= self.LIMIT:
            memo.clear()
        raw = chunks.view(pa.string())
        is_simple = pc.match_substring_regex(raw, _SIMPLE)
        simple = is_simple.to_numpy(zero_copy_only=False)
        low = pc.utf8_lower(raw.filter(is_simple))
        core = pc.ascii_rtrim(low, SIGNS)
        signed = pc.greater(pc.binary_length(low), pc.binary_length(core))
        cores = core.dictionary_encode()
        tails = pc.replace_substring_regex(low.filter(signed), f"^[^{SIGNS}]+", "").dictionary_encode()
        letters, signs = cores.dictionary.to_pylist(), tails.dictionary.to_pylist()
        # The rest one by one.
        odd = np.flatnonzero(~simple)
        words = [c.decode("utf-8", "replace") for c in chunks.take(pa.array(odd)).to_pylist()]
        parts = [self._pieces(w) for w in words]
        self._learn([*letters, *signs, *(p for own in parts if own for p in own)])
        whole = iter(self.tokenizer.encode_batch_fast([w for w, own in zip(words, parts, strict=True) if own is None], add_special_tokens=False))
        encoded = [b"".join(map(memo.__getitem__, own)) if own is not None else np.array(next(whole).ids, "<u2").tobytes() for own in parts]
        # Two parts a word, of which the second may be empty.
        own = [b"", *map(memo.__getitem__, letters), *map(memo.__getitem__, signs), *encoded]
        both = np.zeros((len(chunks), 2), np.int64)
        both[simple, 0] = cores.indices.to_numpy() + 1
        both[np.flatnonzero(simple)[signed.to_numpy(zero_copy_only=False)], 1] = tails.indices.to_numpy() + 1 + len(letters)
        both[odd, 0] = np.arange(len(odd)) + 1 + len(letters) + len(signs)
        width = np.fromiter(map(len, own), np.int64, len(own)) // 2
        ids = _gather(np.frombuffer(b"".join(own), "<u2"), width, both.reshape(-1))
        return ids, width[both].sum(axis=1)

    def encode_column(self, texts: pa.Array, end: int | None = EOD) -> pa.Array:
        """Per text its ids, then ``end``, as binary."""
        chunks, numbers, sizes = word_codes(texts)
        table, width = self._words(chunks)
        ids, n = _gather(table, width, numbers), width[numbers]  # n: ids of each word in turn
        per_text = np.zeros(len(sizes), np.int64)
        full = np.flatnonzero(sizes)
        if len(full):
            per_text[full] = np.add.reduceat(n, (np.cumsum(sizes) - sizes)[full])
        tail = 0 if end is None else 1
        ends = np.cumsum(per_text + tail)
        if tail:
            out = np.full(ends[-1] if len(ends) else 0, end, "<u2")
            kept = np.ones(len(out), bool)
            kept[ends - 1] = False
            out[kept] = ids
            ids = out
        offsets = np.concatenate([[0], 2 * ends]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids))])

    def encode_all(self, texts: list[str | None], end: int | None = EOD) -> list[bytes]:
        """:meth:`encode_column` for a list."""
        return self.encode_column(pa.array(texts, pa.string()), end).to_pylist()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker process: tasks that follow find its words known."""
    claim("encoder", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
