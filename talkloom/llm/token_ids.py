"""Token ids of whole texts in numpy, one tokenizer call per distinct chunk.

The tokenizer must drop white space and never join across it (word-level BPE files do):
then the ids of a text are those of its chunks between ASCII white space. Where the
tokenizer also never joins an ASCII letter with ASCII punctuation, and lower-cases A-Z
(both are tried when it is loaded), chunks are cut there too and kept lower-cased, so that
a word is known whatever its case and punctuation. A worker keeps the ids of chunks it has
met, up to a fixed number of them.
"""

from __future__ import annotations

import os
import string

import numpy as np

from talkloom.llm.textbytes import Words

KNOWN_CHUNKS = 400_000
CHUNKS_PER_CALL = 256
LETTERS = string.ascii_lowercase
#: The apostrophe is no place to cut: word-level files often have rules for it.
MARKS = string.punctuation.replace("'", "")
CACHE_BITS = 20
U = np.uint64
_KIND = np.zeros(256, np.uint8)
_KIND[list(string.ascii_letters.encode())] = 1
_KIND[list(MARKS.encode())] = 2
_PLAIN = np.zeros(256, bool)
_PLAIN[list(string.ascii_letters.encode())] = True


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


class ChunkEncoder:
    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.lower = self._same(string.ascii_uppercase, LETTERS)
        self.cuts = all(self._same(f"ab{m}{n}cd", f"ab {m}{n} cd") for m in MARKS for n in ("", *MARKS))
        split = self.tokenizer.pre_tokenizer
        self.whole = split is not None and [piece for piece, _ in split.pre_tokenize_str(LETTERS)] == [LETTERS]
        self.whole = self.whole and (self.tokenizer.normalizer is None or self.tokenizer.normalizer.normalize_str(LETTERS) == LETTERS)
        self.clear()

    def _same(self, one: str, other: str) -> bool:
        return self._ids(one) == self._ids(other)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.pool = np.zeros(1 << 16, np.uint32)
        self.first = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.used = 0
        self.cached = np.zeros(1 << CACHE_BITS, U)  # a cell holds the last chunk looked up there
        self.cached_slot = np.full(1 << CACHE_BITS, -1, np.int32)

    def _store(self, hashes: list[int], ids: np.ndarray, count: np.ndarray) -> None:
        n, k = len(self.slot), len(hashes)
        while n + k > len(self.first):
            self.first, self.size = np.resize(self.first, 2 * len(self.first)), np.resize(self.size, 2 * len(self.size))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.pool[self.used : self.used + len(ids)] = ids
        self.first[n : n + k] = self.used + np.cumsum(count) - count
        self.size[n : n + k] = count
        self.used += len(ids)
        self.slot.update(zip(hashes, range(n, n + k)))

    def _add_whole(self, hashes: list[int], words: list[str]) -> None:
        """Ids of words of ASCII letters: nothing to normalise or to split, the model alone tokenizes them."""
        tokenize = self.tokenizer.model.tokenize
        found = [[t.id for t in tokenize(w)] for w in words]
        count = np.fromiter(map(len, found), np.int64, len(found))
        self._store(hashes, np.fromiter((i for ids in found for i in ids), np.uint32, int(count.sum())), count)

    def _add(self, hashes: list[int], chunks: list[str]) -> None:
        """Ids of other chunks: they are encoded joined by spaces and told apart by their places."""
        for at in range(0, len(chunks), CHUNKS_PER_CALL):
            part = chunks[at : at + CHUNKS_PER_CALL]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(found.ids, np.uint32)
            begins = np.fromiter((o[0] for o in found.offsets), np.int64, len(ids))
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            count = np.bincount(np.searchsorted(ends, begins, "right"), minlength=len(part))
            self._store(hashes[at : at + CHUNKS_PER_CALL], ids, count)

    def _chunks(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, hash) of the chunks and their bounds by text."""
        words = Words(data, off, lower=self.lower)
        if not (self.cuts and len(words.start)):
            return words.start, words.end, words.hash, words.bound
        kind = _KIND[data]
        first = np.zeros(len(data), bool)
        first[1:] = kind[:-1] + kind[1:] == 3
        first[words.start] = True
        start = np.flatnonzero(first)
        own = np.zeros(len(data), bool)
        own[words.start] = True
        end = np.minimum(np.append(start[1:], len(data)), words.end[np.cumsum(own[start]) - 1])
        return start, end, words.span_hash(start, end), np.searchsorted(start, off)

    def _slots(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Where the ids of every chunk lie: mostly in the cache, else in the table of known chunks, else they are added."""
        cell = (hashes >> U(64 - CACHE_BITS)).astype(np.int64)
        slots = self.cached_slot[cell].astype(np.int64)
        missed = np.flatnonzero((self.cached[cell] != hashes) | (slots < 0))
        if not len(missed):
            return slots
        distinct, at, inverse = np.unique(hashes[missed], return_index=True, return_inverse=True)
        keys = distinct.tolist()
        new = np.array([i for i, h in enumerate(keys) if h not in self.slot], np.int64)
        if len(new):
            places = missed[at[new]]
            odd = np.concatenate([[0], np.cumsum(~_PLAIN[data])])
            plain = (odd[end[places]] == odd[start[places]]) & self.whole
            text = data.tobytes()
            for kind, add in ((plain, self._add_whole), (~plain, self._add)):
                spots = places[kind]
                chunks = [text[a:b].decode("utf-8", "replace") for a, b in zip(start[spots].tolist(), end[spots].tolist())]
                if self.lower and add == self._add_whole:
                    chunks = [c.lower() for c in chunks]
                add(distinct[new[kind]].tolist(), chunks)
        found = np.fromiter(map(self.slot.__getitem__, keys), np.int64, len(keys))
        slots[missed] = found[inverse]
        cell = (distinct >> U(64 - CACHE_BITS)).astype(np.int64)
        self.cached[cell], self.cached_slot[cell] = distinct, found
        return slots

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds): text k has ``ids[bounds[k]:bounds[k + 1]]``."""
        if len(self.slot) > KNOWN_CHUNKS:
            self.clear()
        start, end, hashes, bound = self._chunks(data, off)
        slots = self._slots(data, start, end, hashes)
        sizes = self.size[slots]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.arange(ends[-1]) + np.repeat(self.first[slots] - ends[:-1], sizes)]
        return ids, ends[bound]


_encoders: dict[str, ChunkEncoder] = {}


def encoder_of(path: str) -> ChunkEncoder:
    """The encoder of this Python worker: later tasks of the worker find the vocabulary loaded and chunks known."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]
