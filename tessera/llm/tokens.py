"""Token ids of texts, with words encoded once per Python worker.

For a tokenizer that drops white space and takes no token across it, as the
default does, a text's ids are those of its parts between blanks, tabs and line
ends (other white space stays inside a part and is left to the tokenizer).  A
part of letters with ASCII signs before or behind it is the tokens of the signs
and of its letters, which are looked up without regard to case.  All
other parts are encoded as they are.

What is learnt stays with the worker process, so later tasks start with it; at
most ``MEMO`` entries are remembered, and the oldest half goes first.
"""

from __future__ import annotations

import os
import string
from itertools import islice
from unicodedata import normalize

import numpy as np

MEMO = 3 << 18
SIGNS = string.punctuation
_workers: dict[tuple[str, bool], Encoder] = {}


def load(tokenizer: str):
    """A tokenizer by file path, or by the name of a public vocabulary file."""
    import public_tokenizers
    from tokenizers import Tokenizer
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer))


class Encoder:
    """Texts to arrays of unsigned 32-bit ids."""

    def __init__(self, tokenizer, by_word: bool = True):
        self.tokenizer, self.by_word = tokenizer, by_word
        self.parts, self.units = {"": b""}, {"": b""}
        vocabulary = tokenizer.get_vocab() if by_word else {}
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # tokens that end a word, if the vocabulary marks them
        self.ends[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True

    def _learn(self, letters: list[str], others: list[str]) -> None:
        """Encode units: runs of letters are a word each; of others a token is of the unit that its first character is in."""
        if letters:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(letters)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(letters):
                others = others + letters
            else:
                self._keep(letters, ids, cuts)
        if others:
            e = self.tokenizer.encode(" ".join(others), add_special_tokens=False)
            at = np.array([x for x, _ in e.offsets], np.int64)
            self._keep(others, np.array(e.ids, "<u4"), np.searchsorted(at, np.cumsum([len(w) + 1 for w in others])))

    def _keep(self, units: list[str], ids: np.ndarray, cuts: np.ndarray) -> None:
        raw, last = ids.tobytes(), 0
        for w, k in zip(units, (4 * cuts).tolist(), strict=True):
            self.units[w] = raw[last:k]
            last = k

    @staticmethod
    def _letters(core: str) -> str | None:
        """The letters as the tokenizer sees them, in small form; None if it sees others than letters."""
        if not core.isalpha():
            return None
        if core.isascii():
            return core.lower()
        core = normalize("NFC", core)
        small = core.lower()
        if not small.isalpha():
            return None
        return core if "\u03a3" in core else small  # the capital whose small form depends on its place

    def _split(self, part: str) -> tuple[str, str, str] | None:
        """Signs, letters, signs; None where that is not surely how the tokenizer sees it."""
        core = part.strip(SIGNS)
        letters = self._letters(core)
        if letters is None:
            return None
        if len(core) == len(part):
            return "", letters, ""
        lead, _, tail = part.partition(core)
        # an apostrophe before letters may belong to them; signs around may spell a special token
        return None if "'" in lead or "|" in lead else (lead, letters, tail)

    def _new(self, fresh: set[str]) -> None:
        split = {p: self._split(p) for p in fresh}
        letters = {x[1] for x in split.values() if x}.difference(self.units)
        others = {p for p, x in split.items() if not x}.union(*({x[0], x[2]} for x in split.values() if x and (x[0] or x[2]))).difference(self.units)
        self._learn(list(letters), list(others))
        units, parts = self.units, self.parts
        for p, x in split.items():
            parts[p] = units[p] if not x else units[x[0]] + units[x[1]] + units[x[2]] if x[0] or x[2] else units[x[1]]

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        if not self.by_word:
            return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch([x or "" for x in texts], add_special_tokens=False)]
        parts = [(t or "").replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        fresh = set().union(*parts).difference(self.parts)
        if fresh:
            self._new(fresh)
        out = [np.frombuffer(b"".join(map(self.parts.__getitem__, p)), "<u4") for p in parts]
        for memo in (self.parts, self.units):
            if len(memo) > MEMO:
                for key in list(islice(memo, 1, len(memo) // 2)):  # the empty string stays
                    del memo[key]
        return out


def worker_encoder(tokenizer: str, by_word: bool = True) -> Encoder:
    """This Python worker's encoder: made at first use, kept for its later tasks."""
    if (tokenizer, by_word) not in _workers:
        _workers[tokenizer, by_word] = Encoder(load(tokenizer), by_word)
    return _workers[tokenizer, by_word]
