"""Token ids of whole texts, with a cache of words in each Python worker.

The vocabulary splits a text at white space and then by one pattern, and encodes every
piece alone. So a text of plain characters is looked up word by word, and only words
not seen before go through the tokenizer. Any other text goes through it whole.
"""

from __future__ import annotations

import gc
import os
import re

import numpy as np

# How the word-level vocabulary splits a lower-case text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Characters for which lower-casing, composing and white space mean the same to Python as to the tokenizer.
_UNUSUAL = re.compile("[^\t-\r -~ -įı-ɏ]")
_SPECIAL = "<|"
LONGEST_KEPT = 64  # characters; longer words are encoded, but not remembered
KEPT_WORDS = 400_000  # per generation of a cache; a full generation becomes the old one


class _Cache:
    """A dictionary of two generations: bounded memory, and frequent words stay."""

    def __init__(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, words: set[str]) -> list[str]:
        """Words that neither generation has; those of the old one move to the young."""
        unknown = []
        for word in words - self.young.keys():
            if (ids := self.old.get(word)) is None:
                unknown.append(word)
            else:
                self.young[word] = ids
        return unknown

    def turn(self) -> None:
        """Between batches only, so that what a batch has looked up stays for it."""
        if len(self.young) >= KEPT_WORDS:
            self.old, self.young = self.young, {}


class WordTokenizer:
    """``encode_batch`` gives each text's ids as an array, equal to the tokenizer's own."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab()
        self._dtype = np.dtype("<u2") if max(vocabulary.values()) < 1 << 16 else np.dtype("<u4")
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._pieces = regex.compile(PIECES).findall
        self._words, self._parts = _Cache(), _Cache()

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        gc.disable()  # nothing here forms cycles, and the caches would be searched for them again and again
        try:
            return self._encode_batch(texts)
        finally:
            gc.enable()

    def _encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        split = [None if _SPECIAL in t or _UNUSUAL.search(t) else t.lower().split() for t in texts]
        words = set().union(*[w for w in split if w is not None])
        long = self._encode_words(self._words.missing(words))
        whole = iter(self._tokenizer.encode_batch_fast([t for t, w in zip(texts, split) if w is None],
                                                       add_special_tokens=False))
        young, result = self._words.young, []
        for words in split:
            if words is None:
                result.append(np.array(next(whole).ids, self._dtype))
                continue
            try:
                ids = b"".join([young[w] for w in words])
            except KeyError:
                ids = b"".join([young[w] if w in young else long[w] for w in words])
            result.append(np.frombuffer(ids, self._dtype))
        self._words.turn()
        self._parts.turn()
        return result

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Puts the words into the cache; those too long for it are returned."""
        # Most words are letters, or letters and one mark; letters mean the same to Python and the pattern.
        plain = [w for w in words if w.isalpha()]
        ended = {w: (w[:-1], w[-1]) for w in words if w[-1] in ",.;:!?" and w[:-1].isalpha()}
        others = {w: self._pieces(w) for w in words if not (w in ended or w.isalpha())}
        known = self._parts.young
        if fresh := self._parts.missing(set(plain).union(*ended.values(), *others.values())):
            # Each piece is encoded alone, and its last token alone has a word end.
            ids = np.array(self._tokenizer.encode_batch_fast([" ".join(fresh)], add_special_tokens=False)[0].ids, self._dtype)
            ends = (np.flatnonzero(self._ends[ids]) + 1).tolist()
            if len(ends) != len(fresh):
                raise ValueError("the vocabulary does not end each piece with an end-of-word token")
            size, data, start = self._dtype.itemsize, ids.tobytes(), 0
            for part, end in zip(fresh, ends):
                known[part] = data[start * size:end * size]
                start = end
        found = {w: known[w] for w in plain}
        found.update((w, known[a] + known[b]) for w, (a, b) in ended.items())
        found.update((w, b"".join([known[p] for p in parts])) for w, parts in others.items())
        self._words.young.update((w, ids) for w, ids in found.items() if len(w) <= LONGEST_KEPT)
        long = {w: ids for w, ids in found.items() if len(w) > LONGEST_KEPT}
        for part in [p for p in fresh if len(p) > LONGEST_KEPT]:
            del known[part]
        return long


_BY_PATH: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One per vocabulary and Python worker, so that its caches serve all tasks of the worker."""
    if path not in _BY_PATH:
        _BY_PATH[path] = WordTokenizer(path)
    return _BY_PATH[path]
