"""Words of a text for comparing texts, and the distinct runs of five of them."""

from __future__ import annotations

import html
import re
import unicodedata
import zlib

import numpy as np

RUN = 5

#: One Han character, or a run of other letters and digits.
_WORD = re.compile(r"[㐀-鿿豈-﫿]|[^\W_㐀-鿿豈-﫿]+")
_TAG = re.compile(r"</?(?:p|br|div)\b[^<>]{0,200}>", re.I)
#: Characters without width: soft hyphen, zero-width space and joiners, marks of direction, byte order mark.
_HIDDEN = re.compile("[­​-‏‪-‮⁠﻿]")

#: Odd multipliers for the positions of a run (fixed values).
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
_FINAL = np.uint64(0xC4CEB9FE1A85EC53)


class _Codes(dict):
    def __missing__(self, word):
        if len(self) > 200_000:
            self.clear()
        found = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return found


_codes = _Codes()


def clean(text: str) -> str:
    """Entities resolved, paragraph tags and characters without width gone, accents composed, case folded."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if not text.isascii():
        text = unicodedata.normalize("NFC", _HIDDEN.sub("", text))
    return text.casefold()


def words(text: str) -> list[str]:
    return _WORD.findall(clean(text))


def codes_of(found: list[str]) -> np.ndarray:
    """A 32-bit code per word."""
    return np.fromiter(map(_codes.__getitem__, found), np.uint32, len(found))


def word_codes(text: str) -> np.ndarray:
    return codes_of(words(text))


def runs(codes: np.ndarray) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of five words; of a shorter text, of the whole."""
    n = len(codes)
    if not n:
        return np.empty(0, np.int64)
    wide = codes.astype(np.uint64) + np.uint64(1)
    size = min(RUN, n)
    total = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        x = wide[k : n - size + 1 + k] * _MIX[k]
        total += x ^ (x >> np.uint64(29))
    total ^= total >> np.uint64(32)
    total *= _FINAL
    total ^= total >> np.uint64(29)
    return np.unique(total.view(np.int64))
