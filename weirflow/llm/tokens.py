"""Token ids of whole texts, exactly as a tokenizer file gives them, with a cache of words."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from .common import UPPER

_ASCII_LOWER = bytes(c + 32 if chr(c) in UPPER else c for c in range(256))
#: Signs that end a run of letters and start a token of their own kind. Not the
#: apostrophe (it starts contractions) and not ``<`` (it starts special tokens).
_SIGNS = b"!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
#: So many words are encoded by one call.
TOGETHER = 512
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz")


@lru_cache(maxsize=2)
def _loaded(path: str) -> tuple[Tokenizer, np.ndarray]:
    """A tokenizer, loaded once per process, and which of its ids end a word."""
    tokenizer = Tokenizer.from_file(path)
    vocabulary = tokenizer.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    return tokenizer, ends


class WordCache:
    """Ids of texts for a tokenizer that drops white space and lower-cases, such as word_bpe_49k.

    What stands between two ASCII blanks is encoded by itself and remembered, so
    a frequent word is encoded once; the ids of a text are those of its words in
    order. A word followed by signs is remembered in two parts. Texts are taken
    in parts of about ``part_bytes``, so that no more than the words of one part
    are objects at a time. About ``most`` words are remembered: when there are
    more, those met in one part only go first, and all go if that is not enough.
    """

    def __init__(self, path: str, most: int = 250_000, part_bytes: int = 1_000_000):
        self.tokenizer, self.ends = _loaded(path)
        self.most, self.part_bytes = most, part_bytes
        self.known: dict[bytes, bytes] = {}
        self.once: set[bytes] = set()  # those of the known ones that one part alone held so far

    def ids(self, texts: list[bytes | None]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit numbers; none for null."""
        found: list[bytes] = []
        first = size = 0
        for at, text in enumerate(texts, 1):
            size += len(text or b"")
            if size >= self.part_bytes or at == len(texts):
                found += self._ids(texts[first:at])
                first, size = at, 0
        return found

    def _ids(self, texts: list[bytes | None]) -> list[bytes]:
        split = [
            (text if b"<|" in text else text.translate(_ASCII_LOWER)).split() if text else [] for text in texts
        ]
        words = set().union(*split)
        self.once -= words
        if len(self.known) > self.most:
            self._forget()
        self._learn(words.difference(self.known))
        look = self.known.__getitem__
        return [b"".join(map(look, chunks)) for chunks in split]

    def _forget(self) -> None:
        if len(self.known) - len(self.once) > self.most * 3 // 5:
            self.known.clear()
        else:
            for word in self.once:
                del self.known[word]
        self.once.clear()

    def _learn(self, chunks: set[bytes]) -> None:
        known, signed, parts = self.known, [], set()
        words = [chunk for chunk in chunks if chunk.isalpha()]
        for chunk in chunks.difference(words):
            word = chunk.rstrip(_SIGNS)
            if len(word) < len(chunk) and word and word[-1] in _LETTERS:
                signs = chunk[len(word) :]
                signed.append((chunk, word, signs))
                parts.add(word)
                parts.add(signs)
            else:
                parts.add(chunk)
        self.once -= parts
        parts = parts.difference(known, words)
        self._encode(words, parts)
        known.update([(chunk, known[word] + known[signs]) for chunk, word, signs in signed])
        self.once.update(words, parts, [chunk for chunk, _, _ in signed])

    def _encode(self, words: list[bytes], parts: set[bytes]) -> None:
        """Ids of words and parts; runs of letters, which are one word each, many at a time."""
        others: list[bytes] = []
        for part in parts:
            (words if part.isalpha() or part.decode().isalpha() else others).append(part)
        for at in range(0, len(words), TOGETHER):
            some = words[at : at + TOGETHER]
            (encoded,) = self.tokenizer.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)
            ids = np.array(encoded.ids, "<u4")
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(stops) != len(some):  # not one run of letters each for the tokenizer
                others += some
                continue
            data, starts = ids.tobytes(), [0, *stops]
            self.known.update([(word, data[a:b]) for word, a, b in zip(some, starts, stops, strict=False)])
        for at in range(0, len(others), TOGETHER):
            some = others[at : at + TOGETHER]
            encoded = self.tokenizer.encode_batch_fast([o.decode() for o in some], add_special_tokens=False)
            self.known.update((o, np.array(e.ids, "<u4").tobytes()) for o, e in zip(some, encoded, strict=True))
