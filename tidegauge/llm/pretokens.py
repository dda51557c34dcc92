"""Pre-tokens of the byte-level vocabularies, for many texts at once.

Equal to the matches of the pattern of those vocabularies: contractions, letters,
digits or other characters with at most one space before them, and white space, whose
last character is left to what follows.
"""

from __future__ import annotations

import functools
import sys

import numpy as np
import regex

LETTER, DIGIT, SPACE, OTHER = 1, 2, 3, 0
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]


@functools.cache
def classes() -> np.ndarray:
    """Class of each code point."""
    found = np.zeros(sys.maxunicode + 1, np.uint8)
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    for kind, pattern in ((LETTER, r"\p{L}"), (DIGIT, r"\p{N}"), (SPACE, r"\s")):
        found[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return found


def pretokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in bytes, of the pre-tokens of the texts between ``bounds``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    place = np.flatnonzero((data & 0xC0) != 0x80)
    size = len(points)
    kind = classes()[points]
    edge = np.zeros(size + 1, bool)  # a text starts here
    edge[np.searchsorted(place, bounds)] = True
    edge[0] = edge[size] = True
    turn = edge.copy()
    turn[1:size] |= kind[1:] != kind[:-1]
    blank = points == 32
    begins = turn[:size].copy()
    # The last white space before something else in the text stands apart, or opens that.
    leading = np.flatnonzero((kind == SPACE) & turn[1:] & ~edge[1:])
    begins[leading] = True
    taken = leading[blank[leading]]
    begins[taken + 1] = False
    quote = np.flatnonzero((points == 39) & turn[:size] & turn[1:] & ~edge[1:])
    quote = quote[begins[quote]]
    if len(quote):
        padded = np.concatenate([points, np.zeros(3, points.dtype)])
        ends = np.concatenate([edge, np.ones(3, bool)])
        for text in CONTRACTIONS:
            a, rest = ord(text[0]), text[1:]
            hit = quote[padded[quote + 1] == a]
            after = hit + 2
            if rest:
                inside = (padded[hit + 2] == ord(rest)) & ~ends[hit + 2]
                after = hit[inside] + 3
                hit = hit[inside]
            begins[hit + 1] = False
            after = after[after < size]
            begins[after] = True
    starts = place[np.flatnonzero(begins)]
    return starts, np.append(starts[1:], len(data))
