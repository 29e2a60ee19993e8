"""Token ids of whole texts inside a task, with a bounded word memory per Python worker."""

from __future__ import annotations

import os
from array import array
from functools import cache

#: ``str.split`` also splits at these four; the tokenizer takes them as symbols.
_NOT_SPACE = "\x1c\x1d\x1e\x1f"
#: Marks that end a word and are one piece for the tokenizer.
_MARKS = ".,;:!?"
#: Letters below this code point have no composed or context-dependent forms.
_LATIN_END = "\u0250"
#: Words with more characters than this are not remembered.
_LONG = 100


def default_tokenizer() -> str:
    """Place of the word-end BPE file in the public tokenizer package (``MILEPOST_TOKENIZERS`` names another folder)."""
    if folder := os.environ.get("MILEPOST_TOKENIZERS"):
        return os.path.join(folder, "word_bpe_49k.json")
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Memory(dict):
    """Values computed once by ``make``."""

    def __init__(self, make):
        super().__init__()
        self._make = make

    def __missing__(self, key):
        value = self[key] = self._make(key)
        return value


class WordEncoder:
    """Ids of a text as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and never merges across it, so the ids of a text are those of its
    words in order. Words seen before come from a dictionary, which is emptied when it is full. A new word
    of Latin letters takes the ids of its lower-case letters, from the same dictionary or straight from the tokenizer's
    model, and those of the marks after it; any other one goes through the whole tokenizer.
    """

    def __init__(self, path: str, words: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._spelled = _Memory(lambda char: "".join(p for p, _ in letters.pre_tokenize_str(char)))
        self._known = _Memory(self._word)
        self._marks = _Memory(self._encode)
        self._limit = words

    def _encode(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _stem(self, low: str) -> bytes:
        spelled = low if low.isascii() else "".join(map(self._spelled.__getitem__, low))
        return array("I", [t.id for t in self._model.tokenize(spelled)]).tobytes()

    def _word(self, word: str) -> bytes:
        stem = word.rstrip(_MARKS)
        if stem.isascii():
            low = stem.lower()
        elif max(stem) < _LATIN_END:
            low = "".join(map(str.lower, stem))
        else:
            return self._encode(word)
        if not low.isalpha() or len(low) > _LONG:
            return self._encode(word)
        ids = self._stem(low) if low == word else self._known[low]
        return ids if len(stem) == len(word) else ids + self._marks[word[len(stem) :]]

    def __call__(self, text: str) -> bytes:
        if any(c in text for c in _NOT_SPACE):
            return self._encode(text)
        words = text.split()
        if max(map(len, words), default=0) > _LONG:
            return b"".join(self._encode(w) if len(w) > _LONG else self._known[w] for w in words)
        ids = b"".join(map(self._known.__getitem__, words))
        if len(self._known) > self._limit:
            self._known.clear()
            self._marks.clear()
        return ids


@cache
def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker; workers are reused by later tasks."""
    return WordEncoder(path)


def cut(ids: bytes, capacity: int) -> list[tuple[int, bytes]]:
    """(start, ids) of each piece of at most ``capacity`` ids; only the last may be shorter."""
    step = 4 * capacity
    return [(at // 4, ids[at : at + step]) for at in range(0, len(ids), step)]
