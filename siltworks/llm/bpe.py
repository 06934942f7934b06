"""Byte-pair encoding of words under a public vocabulary, in two ways.

``RankArrayEncoder`` holds part boundaries and adjacent ranks of one short word in arrays and scans
for the minimum. ``linked_symbols`` keeps a linked list of symbols with a priority queue
of merges, which long words need, as a scan's time grows with the square of the length; ``LinkedCounter`` only counts what survives.
"""

from __future__ import annotations

import base64
import heapq
import os
from functools import lru_cache

import numpy as np
import regex

#: Where the vocabulary files lie; every query takes another folder as a parameter.
TOKENIZERS = "/opt/tokenizers"

#: The published pre-tokenization of the byte-level vocabularies (fixed value). White space is
#: the Unicode property, which unlike Python's ``\s`` leaves out U+001C to U+001F.
SPLIT = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

#: Bytes of a word above which it is not short.
SHORT = 128
#: Words whose codes a worker keeps; beyond it the cache starts anew (results do not change).
CACHE_WORDS = 400_000


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=4)
def splitter(pattern: str = SPLIT):
    return regex.compile(pattern).findall


class _Cache(dict):
    """Word -> code, computed on first sight."""

    def __init__(self, code):
        super().__init__()
        self.code = code

    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[word] = self.code(word)
        return found


def linked_symbols(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Where each symbol ends that survives all merges, 0 at places where none begins."""
    get = ranks.get
    n = len(data)
    # symbol i spans data[i:end[i]]; before links the neighbours, end 0 marks a dead symbol
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = get(data[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 1, i + 2))
    heapq.heapify(heap)
    while heap:
        _, left, middle, stop = heapq.heappop(heap)
        if end[left] != middle or middle >= n or end[middle] != stop:
            continue  # one of the two has changed since
        end[left], end[middle] = stop, 0
        if stop < n:
            before[stop] = left
            rank = get(data[left : end[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank, left, stop, end[stop]))
        if left:
            prior = before[left]
            rank = get(data[prior:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, prior, left, stop))
    return end


class RankArrayEncoder:
    """Ids of texts by a contiguous array of adjacent ranks.

    Per short word: ``parts`` are the pieces between boundaries, ``ranks[i]`` the rank of joining parts i and i + 1. The
    smallest rank is found by a scan, its boundary deleted, its two neighbours' ranks refreshed. Longer words give the same ids by
    ``linked_symbols``.
    """

    def __init__(self, path: str):
        self.ranks = load_ranks(path)
        self.words = _Cache(self._word)
        self.find = splitter()

    def _word(self, word: str) -> bytes:
        data = word.encode("utf-8", "surrogatepass")
        return np.array(self.encode_bytes(data), dtype="<i4").tobytes()

    def encode_bytes(self, data: bytes) -> list[int]:
        get = self.ranks.get
        whole = get(data)
        if whole is not None:
            return [whole]
        if len(data) > SHORT:
            return [self.ranks[data[i:z]] for i, z in enumerate(linked_symbols(data, self.ranks)) if z]
        none = 1 << 30
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = [get(data[i : i + 2], none) for i in range(len(data) - 1)]
        while ranks:
            low = min(ranks)
            if low == none:
                break
            i = ranks.index(low)
            parts[i] += parts.pop(i + 1)
            ranks.pop(i)
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], none)
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], none)
        return [self.ranks[p] for p in parts]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text; none for an empty or null one."""
        if not text:
            return np.empty(0, dtype="<i4")
        return np.frombuffer(b"".join(map(self.words.__getitem__, self.find(text))), dtype="<i4")


class LinkedCounter:
    """Number of symbols of a text that survive all merges, from a linked list and a heap."""

    def __init__(self, path: str):
        self.ranks = load_ranks(path)
        self.words = _Cache(self._word)
        self.find = splitter()

    def _word(self, word: str) -> int:
        return self.count_bytes(word.encode("utf-8", "surrogatepass"))

    def count_bytes(self, data: bytes) -> int:
        if data in self.ranks:
            return 1
        return sum(map(bool, linked_symbols(data, self.ranks)))

    def count(self, text: str | None) -> int:
        return sum(map(self.words.__getitem__, self.find(text))) if text else 0


@lru_cache(maxsize=4)
def encoder(path: str) -> RankArrayEncoder:
    """One encoder a worker process and file."""
    return RankArrayEncoder(path)


@lru_cache(maxsize=4)
def counter(path: str) -> LinkedCounter:
    return LinkedCounter(path)


def vocabulary(folder: str | None, name: str) -> str:
    return os.path.join(folder or TOKENIZERS, name)
