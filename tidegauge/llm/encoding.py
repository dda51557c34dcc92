"""Ids of many texts at once: pre-tokens are encoded once each and remembered."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from tidegauge.llm import ragged
from tidegauge.llm.pretokens import pretokens

# Ids that a worker keeps for remembered pre-tokens before it starts anew.
STORED = 1 << 23

Pieces = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def special_cuts(data: np.ndarray, bounds: np.ndarray, special: tuple[tuple[bytes, int], ...]
                 ) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Bounds with cuts around special strings, and (start, end, id) of these strings."""
    whole, found = data.tobytes(), []
    for content, number in special:
        at = whole.find(content)
        while at >= 0:
            if at + len(content) <= bounds[np.searchsorted(bounds, at, "right")]:
                found.append((at, at + len(content), number))
                at = whole.find(content, at + len(content))
            else:
                at = whole.find(content, at + 1)
    if not found:
        return bounds, []
    found.sort()
    cuts = [cut for start, end, _ in found for cut in (start, end)]
    return np.sort(np.concatenate([bounds, np.array(cuts, np.int64)])), found


def cut_pieces(data: np.ndarray, bounds: np.ndarray, special: tuple[tuple[bytes, int], ...]
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens, and the id of those that are special, else -1."""
    cuts, found = special_cuts(data, bounds, special)
    starts, ends = pretokens(data, cuts)
    ids = np.full(len(starts), -1, np.int64)
    if found:
        keep = np.ones(len(starts), bool)
        for start, end, number in found:
            first, after = np.searchsorted(starts, [start, end])
            ids[first], ends[first] = number, end
            keep[first + 1:after] = False
        starts, ends, ids = starts[keep], ends[keep], ids[keep]
    return starts, ends, ids


class Encoder:
    """``pieces(bytes, starts, lengths)`` gives the ids of pieces, flat, and their numbers."""

    def __init__(self, pieces: Pieces, special: tuple[tuple[bytes, int], ...] = ()):
        self.pieces, self.special = pieces, special
        self._forget()

    def _forget(self) -> None:
        self.memory, self.store, self.used = ragged.Memory(), np.empty(1 << 16, np.int32), 0

    def _keep(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        ids, sizes = self.pieces(data, starts, ends - starts)
        while self.used + len(ids) > len(self.store):
            self.store = np.concatenate([self.store, np.empty_like(self.store)])
        self.store[self.used:self.used + len(ids)] = ids
        rows = np.stack([self.used + np.cumsum(sizes) - sizes, sizes], 1)
        self.used += len(ids)
        return rows

    def __call__(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per chunk: first text, flat ids, number of ids per text, bytes of the texts."""
        for first, last, data, bounds in ragged.chunks(texts):
            starts, ends, fixed = cut_pieces(data, bounds, self.special)
            if not len(starts):
                yield first, np.zeros(0, np.int32), np.zeros(last - first, np.int64), data
                continue
            if self.used > STORED:
                self._forget()
            keys, places, which = ragged.distinct(ragged.hashes(data, starts, ends))
            begin, end = starts[places], ends[places]
            rows = self.memory.get(keys, lambda new: self._keep(data, begin[new], end[new]))
            rows = rows[which]
            ids = None
            special = np.flatnonzero(fixed >= 0)
            if len(special):  # one id, put at the end of the store for this chunk
                tail = np.concatenate([self.store[:self.used], fixed[special].astype(np.int32)])
                rows[special] = np.stack(
                    [self.used + np.arange(len(special)), np.ones(len(special), np.int64)], 1)
                ids = ragged.gathered(tail, rows[:, 0], rows[:, 1])
            else:
                ids = ragged.gathered(self.store, rows[:, 0], rows[:, 1])
            sizes = np.bincount(ragged.text_of(starts, bounds), rows[:, 1], last - first)
            yield first, ids, sizes.astype(np.int64), data
