"""Pre-tokens of many texts at once: the splitting pattern of public_tokenizers, worked out over arrays.

The pattern is  's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+ . It covers every text and a match looks ahead by
at most one character behind its own run, so its borders follow from each character's class and its neighbours:
a border stands where the class changes, except behind a single space that the next token takes along; of several white
spaces before a word the last one stands apart; a lone apostrophe takes a contraction's letters.
"""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
import regex

from snapstats.llm import scan

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
APOSTROPHE = 0x27
# Contractions of the pattern, fixed values.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(1)
def char_classes() -> np.ndarray:
    """Class of every code point, from the regex module's own properties."""
    classes = np.zeros(sys.maxunicode + 1, np.uint8)
    text = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF)
    for pattern, value in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACE)):
        for m in regex.finditer(pattern, text):
            a, b = ord(text[m.start()]), ord(text[m.end() - 1])
            classes[a:b + 1] = value
    classes[0xD800:0xE000] = OTHER
    return classes


class PreTokens:
    """start, end (byte positions), hash, length in code points, and offsets by text of all pre-tokens."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        n = len(points)
        lead = np.flatnonzero((data & 0xC0) != 0x80) if n != len(data) else np.arange(n)
        doc_at = np.searchsorted(lead, offsets) if n != len(data) else offsets
        if not n:
            self.start = self.end = self.points = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
            self.offsets = np.zeros(len(offsets), np.int64)
            return
        kind = char_classes()[points]
        edge = np.zeros(n + 1, bool)
        edge[doc_at] = True
        space = kind == SPACE
        border = edge[:-1].copy()
        change = kind[1:] != kind[:-1]
        # Behind a plain space a token begins at the space.
        border[1:] |= change & ~(points[:-1] == 0x20)
        # The last of a run of white space stands apart if a word follows in the same text.
        last = np.zeros(n, bool)
        last[:-1] = space[:-1] & ~space[1:] & ~edge[1:-1]
        border |= last
        # Letters behind white space other than a plain space begin a token by the class change above.
        # A lone apostrophe at a token's start takes the letters of a contraction.
        lone = np.flatnonzero((points == APOSTROPHE) & border)
        if len(lone):
            lone = lone[(lone + 1 < n)]
            lone = lone[~edge[lone + 1] & (kind[lone + 1] == LETTER)]
            for letters in CONTRACTIONS:
                at = lone
                for k, c in enumerate(letters, 1):
                    at = at[at + k < n]
                    at = at[(points[at + k] == ord(c)) & ~edge[at + k]]
                border[at + 1] = False
                after = at + len(letters) + 1
                ok = after < n
                border[after[ok]] |= kind[after[ok]] == LETTER
                lone = np.setdiff1d(lone, at, assume_unique=True)
        first = np.flatnonzero(border)
        final = np.append(first[1:], n)
        sums = scan.running(points.astype(np.uint64) + np.uint64(1), small=True)
        self.hash = scan.spans_hash(sums, first, final)
        bytes_at = np.append(lead, len(data))
        self.start, self.end, self.points = bytes_at[first], bytes_at[final], final - first
        self.offsets = np.searchsorted(first, doc_at)
