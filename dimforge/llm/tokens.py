"""Token ids of whole texts by the ``tokenizers`` library.

A byte-level BPE encodes each run of letters, digits or signs (with the one
space before it) by itself, so a text may be cut before any space that
follows a printable character without changing its ids.  Words recur far more
often than texts, so the ids of such words are kept in a bounded memo; the
library encodes every word that is not there, and whole texts with white
space that makes the cut unsafe, or with the string of an added token.
"""

from __future__ import annotations

import gc
import os
from collections.abc import Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa

BYTE_BPE = "byte_bpe_50k.json"


def tokenizer_path(name: str = BYTE_BPE) -> str:
    """Place of a public vocabulary file on this machine."""
    return public_tokenizers.path(name)


class Encoder:
    """Encodes texts to little-endian id bytes (``dtype``).

    The ids are those of the library as it is: the string of a special token
    inside a text is that token.  ``memo`` bounds the bytes of the words kept,
    with what an entry costs beside them; a full memo starts anew, and words
    of more than ``_LONGEST`` characters are not kept.
    """

    _SENTENCE_ENDS = ".,"
    _JOINED = 200
    _LONGEST = 64
    _ENTRY = 150

    def __init__(self, path: str, memo: int = 112 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # what all of them begin with is looked for first
        self.added_start = os.path.commonprefix(self.added)
        # a token with a space in it could arise between words that are encoded together
        self.never_cut = self.tokenizer.normalizer is not None or any(" " in t for t in self.added)
        vocabulary = self.tokenizer.get_vocab()
        size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        # byte-level vocabularies write the space as this letter
        self.spaced = np.zeros(size, dtype=bool)
        self.spaced[[i for piece, i in vocabulary.items() if piece[0] == "\u0120"]] = True
        self.most = memo
        self.forget()
        self.ends = dict(zip(self._SENTENCE_ENDS, self._library(list(self._SENTENCE_ENDS))))

    def forget(self) -> None:
        """Empties the memo."""
        self.memo, self.held = {}, 0

    def _library(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in encoded]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of each word with one space before it.  Words have no space
        inside, so an id that begins with a space begins a word."""
        out, wide = [], self.dtype.itemsize
        joined = [" " + " ".join(words[i:i + self._JOINED]) for i in range(0, len(words), self._JOINED)]
        for encoded in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            ids = np.array(encoded.ids, dtype=self.dtype)
            cuts = [*(np.flatnonzero(self.spaced[ids]) * wide).tolist(), len(ids) * wide]
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        if len(out) != len(words):
            raise ValueError("the vocabulary is not a byte-level BPE")
        return out

    def _learn(self, words: set[str]) -> None:
        """Fills the memo; a word that can't be cut from its text gets no ids."""
        memo, before = self.memo, len(self.memo)
        ended, plain = [], []
        for w in words:
            if not w or not (w[0].isprintable() and w[-1].isprintable()):
                memo[w] = b""
            elif w[-1] in self.ends and w[:-1].isalpha():
                ended.append(w)
            else:
                plain.append(w)
        plain = list({*plain, *(w[:-1] for w in ended if w[:-1] not in memo)})
        memo.update(zip(plain, self._words(plain)))
        for w in ended:
            memo[w] = memo[w[:-1]] + self.ends[w[-1]]
        self.held += self._ENTRY * (len(memo) - before) + sum(map(len, words))

    def __call__(self, texts: Sequence[str | None]) -> list[bytes]:
        """Id bytes per text; None is the empty text."""
        # millions of strings in lists, no cycles: the collector only costs time
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: Sequence[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        firsts, rows, missing = [], [], set()
        if self.held > self.most:
            self.forget()
        memo, whole = self.memo, []
        for i, text in enumerate(texts):
            if text and (self.never_cut or self.added_start in text and any(t in text for t in self.added)):
                whole.append(i)
            elif text:
                first, *words = text.split(" ")
                found = list(map(memo.get, words))
                if None in found:
                    missing.update(w for w, f in zip(words, found) if f is None)
                firsts.append(first)
                rows.append((i, words, found))
        if missing:
            self._learn(missing)
        for (i, words, found), first, ids in zip(rows, firsts, self._library(firsts)):
            if None in found:
                found = [memo[w] if f is None else f for w, f in zip(words, found)]
            if b"" in found or not first or not first[-1].isprintable():
                whole.append(i)
            else:
                out[i] = ids + b"".join(found)
        for i, ids in zip(whole, self._library([texts[i] for i in whole])):
            out[i] = ids
        for w in missing:
            if len(w) > self._LONGEST:
                del memo[w]
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget_words() -> None:
    """Empties the memos of this Python worker.  Spark hands its workers on to
    the next steps, which would hold them beside their own."""
    for one in _encoders.values():
        one.forget()
    pa.default_memory_pool().release_unused()
