"""Token counts by rank-synchronous array merging.

The different pre-tokens of a chunk of texts are held as one ragged array of symbols.
In each round every pre-token applies its own lowest-ranked pair, at all its places at
once; pre-tokens without a pair left are done. What survives is counted.

The vocabulary is a parameter; it is parsed once on the driver, and its arrays, whose
size is that of the vocabulary, go to the workers.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm import ragged
from tidegauge.llm.encoding import cut_pieces
from tidegauge.llm.tables import public_vocabulary, ship, table

LIMIT = 512
NO_PAIR = np.int32(2 ** 31 - 1)


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself if it prints, else one above 255."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Merges:
    """Byte symbols, and of each pair (left * 2**32 + right, ascending) rank and result."""

    bytes: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    results: np.ndarray
    special: tuple[tuple[bytes, int], ...]

    @functools.cached_property
    def slots(self) -> tuple[np.ndarray, np.ndarray]:
        """The pairs in a hash table: the places that share a slot follow one another."""
        size = 1 << max(4, int(len(self.pairs)).bit_length() + 3)
        slot = self.slot(self.pairs, size)
        order = np.argsort(slot, kind="stable")
        return order, np.searchsorted(slot[order], np.arange(size + 1))

    @staticmethod
    def slot(pairs: np.ndarray, size: int) -> np.ndarray:
        return (ragged.mixed(pairs.astype(np.uint64)) & np.uint64(size - 1)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; NO_PAIR where there is none."""
        order, firsts = self.slots
        keys = (left.astype(np.int64) << 32) | right
        slot = self.slot(keys, len(firsts) - 1)
        at, end = firsts[slot], firsts[slot + 1]
        ranks = np.full(len(keys), NO_PAIR, np.int32)
        results = np.zeros(len(keys), np.int32)
        open_ = np.flatnonzero(at < end)
        at = at[open_]
        while len(open_):
            place = order[at]
            hit = self.pairs[place] == keys[open_]
            ranks[open_[hit]] = self.ranks[place[hit]]
            results[open_[hit]] = self.results[place[hit]]
            at = at + 1
            more = ~hit & (at < end[open_])
            open_, at = open_[more], at[more]
        return ranks, results


def read_merges(path: str) -> Merges:
    """Merges of a byte-level vocabulary in the JSON form of the tokenizers library."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    ids = whole["model"]["vocab"]
    made = {}
    for rank, pair in enumerate(whole["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        made[ids[left] << 32 | ids[right]] = (rank, ids[left + right])
    pairs = np.array(sorted(made), np.int64)
    ranks, results = np.array([made[p] for p in pairs.tolist()], np.int32).T
    symbols = np.array([ids[c] for _, c in sorted(byte_characters().items())], np.int32)
    special = tuple((t["content"].encode(), t["id"]) for t in whole.get("added_tokens", []))
    return Merges(symbols, pairs, ranks.copy(), results.copy(), special)


def merged(symbols: np.ndarray, lengths: np.ndarray, merges: Merges
           ) -> tuple[np.ndarray, np.ndarray]:
    """Surviving symbols of ragged byte symbols, and how many each sequence has."""
    count = len(lengths)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    owner = np.repeat(np.arange(count), lengths)
    while len(symbols):
        together = owner[1:] == owner[:-1]
        ranks = np.full(len(symbols), NO_PAIR, np.int32)
        results = np.zeros(len(symbols), np.int32)
        at = np.flatnonzero(together)
        ranks[at], results[at] = merges.lookup(symbols[at], symbols[at + 1])
        firsts = np.flatnonzero(np.concatenate([[True], ~together]))
        lowest = np.minimum.reduceat(ranks, firsts)
        sizes = np.diff(np.append(firsts, len(symbols)))
        going = np.repeat(lowest != NO_PAIR, sizes)
        if not going.all():
            done.append((symbols[~going], owner[~going]))
        hit = going & (ranks == np.repeat(lowest, sizes))
        # Of overlapping places of one pair, as in "aaa", every second is taken.
        places = np.flatnonzero(hit)
        runs = np.concatenate([[True], np.diff(places) != 1]) if len(places) else places
        begun = np.maximum.accumulate(np.where(runs, np.arange(len(places)), 0))
        taken = places[(np.arange(len(places)) - begun) % 2 == 0]
        symbols[taken] = results[taken]
        going[taken + 1] = False
        symbols, owner = symbols[going], owner[going]
    if not done:
        return np.zeros(0, np.int32), np.zeros(count, np.int64)
    flat = np.concatenate([d[0] for d in done])
    owners = np.concatenate([d[1] for d in done])
    order = np.argsort(owners, kind="stable")
    return flat[order], np.bincount(owners, minlength=count)


class Counter:
    """Tokens per text; remembers the pre-tokens it has merged."""

    def __init__(self, merges: Merges):
        self.merges, self.memory = merges, ragged.Memory()

    def _sizes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = ends - starts
        symbols = self.merges.bytes[ragged.gathered(data, starts, lengths)]
        return merged(symbols, lengths, self.merges)[1].astype(np.int32)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and tokens of each text."""
        n_bytes, n_tokens = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for first, last, data, bounds in ragged.chunks(texts):
            n_bytes[first:last] = np.diff(bounds)
            starts, ends, special = cut_pieces(data, bounds, self.merges.special)
            if not len(starts):
                continue
            keys, places, which = ragged.distinct(ragged.hashes(data, starts, ends))
            begin, end = starts[places], ends[places]
            sizes = self.memory.get(
                keys, lambda missing: self._sizes(data, begin[missing], end[missing]))
            weights = np.where(special >= 0, 1, sizes[which])
            inside = ragged.text_of(starts, bounds)
            n_tokens[first:last] = np.bincount(inside, weights, last - first)
        return n_bytes, n_tokens


# Of a worker, by vocabulary.
_COUNTERS: dict[str, Counter] = {}


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) per row.

    ``vocabulary`` is the path of a byte-level vocabulary in JSON, read on the driver.
    Special strings of the vocabulary are one token each. Null and empty texts have no
    tokens. Rows are independent: repeated rows, null ids and other columns do not matter.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(read_merges(vocabulary))
    key = vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _COUNTERS.get(key) or _COUNTERS.setdefault(key, Counter(shared.value))
        for batch in batches:
            n_bytes, n_tokens = counter(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes), pa.array(n_tokens),
                 pa.array(n_tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(docs["doc_id"], docs["text"]).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op4(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"),
                        public_vocabulary("byte_bpe_50k.json"))
