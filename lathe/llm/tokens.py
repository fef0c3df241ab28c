"""Token ids of whole texts with a public tokenizer, chunk by chunk.

The word tokenizer used here lower-cases and never joins characters over ASCII
blanks, so a text's ids are the ids of its blank-separated chunks one after
another; each distinct chunk of a worker is encoded once and kept in a bounded
cache.  Chunks that are one Latin word go straight to the tokenizer's model, as
normalising and splitting would leave them whole."""

from __future__ import annotations

from functools import lru_cache

import numpy as np


def _apart(text: bytes) -> bytes:
    """The text with a blank before each single stop or comma between a letter
    (a to z, or Latin-1 in UTF-8) and a blank, where it is a token of its own."""
    buf = np.frombuffer(text, np.uint8)
    at = np.flatnonzero((buf == ord(".")) | (buf == ord(",")))
    at = at[at > 0]
    if not len(at):
        return text
    after = buf[np.minimum(at + 1, len(buf) - 1)]
    at = at[(after == ord(" ")) | (after == ord("\n")) | (at == len(buf) - 1)]
    last, lead = buf[at - 1], buf[np.maximum(at - 2, 0)]
    ascii_letter = (last >= ord("a")) & (last <= ord("z"))
    latin_letter = (lead == 0xC3) & (at > 1) & (last >= 0x80) & (last <= 0xBF) & (last != 0x97) & (last != 0xB7)
    return np.insert(buf, at[ascii_letter | latin_letter], ord(" ")).tobytes()


_LATIN = "\u0250"  # letters below are composed already and have one lower case each, but for one


PART = 100_000  # chunks encoded at once


def _room(array: np.ndarray, n: int) -> np.ndarray:
    """The array, doubled until it holds ``n`` values."""
    while len(array) < n:
        array = np.concatenate([array, np.zeros_like(array)])
    return array


class ChunkTokenizer:
    CACHE = 400_000  # distinct chunks kept; the cache starts anew beyond

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.model = self.tokenizer.model
        self.spelled: dict[str, str] = {}  # a letter as the model's alphabet writes it
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _learn(self, chunks: list[bytes]) -> None:
        fresh = [self._word(c) for c in chunks]
        rest = [k for k, ids in enumerate(fresh) if ids is None]
        plain = self.tokenizer.encode_batch_fast([chunks[k].decode() for k in rest], add_special_tokens=False)
        for k, e in zip(rest, plain):
            fresh[k] = e.ids
        sizes = np.fromiter(map(len, fresh), np.int64, len(fresh))
        base, total = len(self.index), int(sizes.sum())
        self.flat = _room(self.flat, self.used + total)
        self.start, self.size = _room(self.start, base + len(fresh)), _room(self.size, base + len(fresh))
        self.flat[self.used:self.used + total] = np.fromiter((i for ids in fresh for i in ids), np.uint32, total)
        self.start[base:base + len(fresh)] = self.used + np.cumsum(sizes) - sizes
        self.size[base:base + len(fresh)] = sizes
        self.used += total
        self.index.update(zip(chunks, range(base, base + len(chunks))))

    def _word(self, chunk: bytes) -> list[int] | None:
        """Ids of a chunk that is one Latin word; None for any other."""
        word = chunk.decode()
        if chunk.isalpha() and chunk.islower():
            return [t.id for t in self.model.tokenize(word)]
        if not word.isalpha() or max(word) >= _LATIN or "\u0130" in word:
            return None
        if not (word.isascii() and word.islower()):
            word = word.lower()
            for c in word:
                if c not in self.spelled:
                    self.spelled[c] = self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0]
            word = "".join(map(self.spelled.__getitem__, word))
        return [t.id for t in self.model.tokenize(word)]

    @staticmethod
    def _chunks(text: bytes) -> list[bytes]:
        if b"<|" not in text:  # the text of a special token is left as it is
            text = _apart(text.lower())
        return text.split()

    def _ids(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks one after another, and how many each has."""
        fresh = list(set(chunks).difference(self.index))
        if fresh:
            if len(self.index) + len(fresh) > self.CACHE:
                self._clear()
                fresh = list(set(chunks))
            self._learn(fresh)
        at = np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))
        size = self.size[at]
        before = np.cumsum(size) - size
        return self.flat[np.repeat(self.start[at] - before, size) + np.arange(size.sum())], size

    def encode(self, text: bytes) -> np.ndarray:
        """The ids of one UTF-8 text, without special tokens."""
        chunks = self._chunks(text)
        out = [self._ids(chunks[a:a + PART])[0] for a in range(0, len(chunks), PART)]
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def encode_all(self, texts):
        """The ids of each of many texts, a part of them encoded at once."""
        held, chunks = [], []

        def settle():
            ids, size = self._ids(chunks)
            end = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *held])]
            return [ids[a:b] for a, b in zip(end[:-1], end[1:])]
        for text in texts:
            own = self._chunks(text)
            if len(chunks) + len(own) > PART and held:
                yield from settle()
                held, chunks = [], []
            if len(own) > PART:
                yield self.encode(text)
                continue
            held.append(len(own))
            chunks += own
        if held:
            yield from settle()


@lru_cache(maxsize=2)
def worker_tokenizer(path: str, special_as_text: bool = False) -> ChunkTokenizer:
    """One tokenizer for all tasks of a Python worker, which share its cache."""
    return ChunkTokenizer(path, special_as_text)


def default_tokenizer(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))
