"""Language-model scores by a probabilistic suffix tree over words.

The root is the add-one distribution of single tokens. A longer context becomes a state
when what follows it diverges from what the shorter state expects; its distribution
leans on that of the shorter state, which also shares out what the state has not listed.
A token is scored in the longest state that its preceding tokens end in.

1. Words are counted over all training text.
2. Then (context, next token) entries, one context length after the other. Tasks send
   partial sums, which are added up by a shuffle; least counts apply to the corpus sums
   only. A context or an ending that is itself below its least count cannot be part of an
   entry that is not, so these are left out early, by a filter of fixed size that may let
   too much through, never too little.
3. Each length is tested with joins on the shorter one.
4. An entry has a shorter one in the shorter context, so where a state lists a token it gives
   its share over the shorter one's, and where it does not, its backing off, whatever comes
   before. So a text's score is a sum over its runs of words: each run has one number, the
   same wherever it stands, and most have none (``run_values``).
5. Documents are scored in one pass. The numbers of the most frequent runs and words are sent
   to the workers; infrequent runs and words travel once for each chunk of texts to the
   bucket of their hash, and a chunk gets one sum per text and bucket back.

Words and runs of words are known by 64-bit hashes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegauge.llm import ragged
from tidegauge.llm.tables import discard, if_small, kept, let_go, ship, table

FOLDS, HELD_OUT = 7, 2
DEPTH = 3
# Words whose counts are sent to the workers; the others' are joined.
SENT_WORDS = 200_000
# Contexts and entries of the model that are sent to the workers.
SENT_ENTRIES = 3_000_000
# Least count of an entry and of a context over the corpus, weight of the shorter state in
# tokens, and log-likelihood that a state has to gain for each entry.
REPEATS = 3
LEAST = 8
LEANING = 2.0
DIVERGENCE = 3.0
# Words that have numbers on the way to their sums.
NUMBERED = 1 << 19
# Tokens that are summed at once, partial sums that are sent at once, and training tokens for each
# bucket of sums.
BLOCK = 1 << 19
MERGED = 1 << 20
BUCKET = 1 << 20
# Bits of a filter for each key, and the most bits it has.
KEY_BITS, MOST_BITS, SLAB, SLOTS = 12, 1 << 26, 1 << 18, 3
# Bytes of text handled at once, and positions of a bucket settled at once.
CHUNK = 1 << 20
SLICE = 1 << 18
# Shares of the texts that are scored one after the other: what travels of one is let go before
# the next. More take less disk and more CPU time, as each needs the sent tree in its tasks again.
ROUNDS = 1

U64 = np.uint64
END = U64(0x7A5C3D1E9B8F6042)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def round_of(doc_id: Column) -> Column:
    """Which of ROUNDS shares of the texts a row is scored with."""
    return F.floor(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) / FOLDS) % ROUNDS


def token_rows(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray,
                                                  np.ndarray]]:
    """Per chunk: first text, tokens of all texts with their ends, the text of each, its
    place there, and a hash of each text."""
    for first, last, data, bounds in ragged.chunks(texts, CHUNK):
        lowered = ragged.LOWERED[data]
        starts, ends, text = ragged.words(data, bounds)
        count = last - first
        sizes = np.bincount(text, minlength=count) + 1
        after = np.cumsum(sizes)
        tokens = np.full(int(after[-1]), END, U64)
        tokens[np.arange(len(starts)) + text] = ragged.hashes(lowered, starts, ends)
        owner = np.repeat(np.arange(count), sizes)
        place = np.arange(len(tokens)) - (after - sizes)[owner]
        yield first, tokens, owner, place, ragged.hashes(data, bounds[:-1], bounds[1:])


def contexts(tokens: np.ndarray, place: np.ndarray, depth: int = DEPTH) -> Iterator[
        tuple[np.ndarray, np.ndarray]]:
    """For each length: positions with that many tokens before them, and the context's key,
    which is also the key of the entry that ends in the context's last token."""
    at = np.flatnonzero(place >= 1)
    keys = tokens[at - 1]
    yield at, keys
    for length in range(2, depth + 1):
        ending = np.zeros(len(tokens), U64)
        ending[at] = entry_keys(keys, tokens[at])
        at = np.flatnonzero(place >= length)
        keys = ending[at - 1]
        yield at, keys


def entry_keys(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return ragged.mixed(context + token * U64(0xC2B2AE3D27D4EB4F) + U64(7))


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys, and where each different one begins in it."""
    order = np.argsort(keys)
    keys = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])


def squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def expanded(data: pa.Scalar) -> pa.Buffer:
    whole = data.as_buffer()
    return pa.decompress(whole[8:], int.from_bytes(whole[:8].to_pybytes(), "little"), "zstd")


class Keys:
    """Ascending keys, found by their leading bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = U64(64 - max(1, int(len(keys)).bit_length()))
        count = np.bincount((keys >> self.shift).astype(np.int64),
                            minlength=1 << (64 - int(self.shift)))
        self.starts = np.zeros(len(count) + 1, np.int32 if len(keys) < 1 << 31 else np.int64)
        np.cumsum(count, out=self.starts[1:])

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 if it is not there."""
        out = np.full(len(keys), -1)
        top = (keys >> self.shift).astype(np.int64)
        at, end = self.starts[top], self.starts[top + 1]
        left = np.flatnonzero(at < end)
        at, end, keys = at[left], end[left], keys[left]
        while len(left):
            hit = self.keys[at] == keys
            out[left[hit]] = at[hit]
            more = np.flatnonzero(~hit & (at + 1 < end))
            left, at, end, keys = left[more], at[more] + 1, end[more], keys[more]
        return out


class Filter:
    """Holds every key it was made from, and perhaps others."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, U64(len(bits) * 8 - 1)

    @staticmethod
    def slot(keys: np.ndarray, k: int, mask: np.uint64) -> np.ndarray:
        """The k-th of SLOTS bits of each key."""
        if k == 2:
            keys = keys * U64(0x9E3779B97F4A7C15)
        return (keys >> U64((0, 34, 36)[k])) & mask

    def bit(self, keys: np.ndarray, k: int) -> np.ndarray:
        slot = self.slot(keys, k, self.mask)
        return ((self.bits[slot >> U64(3)] >> (slot & U64(7)).astype(np.uint8)) & 1).astype(bool)

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = self.bit(keys, 0)
        for k in range(1, SLOTS):
            left = np.flatnonzero(found)
            if 2 * len(left) > len(keys):
                found &= self.bit(keys, k)
            else:
                found[left] = self.bit(keys[left], k)
        return found


def filter_of(rows: DataFrame) -> Filter:
    """Of the only column of ``rows``."""
    size = SLAB
    while size < min(rows.count() * KEY_BITS, MOST_BITS):
        size *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, bool)
        for batch in batches:
            keys = batch.column(0).to_numpy().view(U64)
            for k in range(SLOTS):
                bits[Filter.slot(keys, k, U64(size - 1))] = True
        slabs = np.packbits(bits, bitorder="little").reshape(-1, SLAB // 8)
        some = np.flatnonzero(slabs.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)),
             pa.array([squeezed(slabs[k].tobytes()) for k in some], pa.binary())],
            ["slab", "bits"])

    def merge(slabs: pa.Table) -> pa.Table:
        whole = np.zeros(SLAB // 8, np.uint8)
        for one in slabs.column("bits"):
            whole |= np.frombuffer(expanded(one), np.uint8)
        return pa.table({"slab": slabs.column("slab")[:1].cast(pa.int32()),
                         "bits": pa.array([whole.tobytes()], pa.binary())})

    found = rows.mapInArrow(run, "slab int, bits binary").groupBy("slab").applyInArrow(
        merge, "slab int, bits binary").toArrow()
    bits = np.zeros((size // SLAB, SLAB // 8), np.uint8)
    for slab, one in zip(found.column("slab").to_pylist(), found.column("bits").to_pylist()):
        bits[slab] = np.frombuffer(one, np.uint8)
    return Filter(bits.reshape(-1))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and their places in their texts, of many texts at once."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        for _, tokens, _, place, _ in token_rows(batch.column("text")):
            held.append((tokens, place))
            size += len(tokens)
            if size >= BLOCK:
                whole = [np.concatenate(x) for x in zip(*held)]
                held.clear()
                size = 0
                yield whole[0], whole[1]
                del whole
                ragged.release()
    if held:
        yield np.concatenate([t for t, _ in held]), np.concatenate([p for _, p in held])
    ragged.release()


def word_sums(docs: DataFrame) -> DataFrame:
    """(key, n) of all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, _ in blocks(batches):
            found, _, which = ragged.distinct(tokens)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)),
                 pa.array(np.bincount(which, minlength=len(found)))], ["key", "n"])

    return docs.select(docs["text"]).mapInArrow(run, "key long, n long").groupBy("key").agg(
        F.sum("n").alias("n"))


def _planes(values: np.ndarray) -> bytes:
    """Numbers of up to 32 bits by their bytes, which compress when most are small."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(planes: pa.Scalar | pa.Buffer) -> np.ndarray:
    if isinstance(planes, pa.Scalar):
        planes = planes.as_buffer()
    flat = np.frombuffer(planes, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(flat.T).view("<u4").reshape(-1).astype(np.int64)


class Frequent:
    """Frequent words. In packed rows they are numbers from 1, the most frequent first; 0 stands
    for another word, whose hash follows apart. ``sent``: so many of them are frequent enough to
    be sent with all their numbers."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, least: float):
        self.places, self.sent = Keys(words).places, int((counts >= least).sum())
        order = np.argsort(-counts, kind="stable")
        self.numbers = np.zeros(len(words) + 1, np.int32)
        self.numbers[order] = np.arange(1, len(words) + 1)
        self.words = np.append(U64(0), words[order])

    def numbered(self, words: np.ndarray) -> np.ndarray:
        return self.numbers[self.places(words)]

    def near(self, words: np.ndarray) -> np.ndarray:
        number = self.numbered(words)
        return (number > 0) & (number <= self.sent)

    def unpacked(self, numbers: np.ndarray, others: np.ndarray) -> np.ndarray:
        words = self.words[numbers]
        words[numbers == 0] = others
        return words


def _hash_planes(keys: np.ndarray) -> bytes:
    """Numbers of 64 bits by their bytes: of ascending ones the leading bytes compress."""
    return np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8).T).tobytes()


def _hashes(planes: pa.Buffer) -> np.ndarray:
    flat = np.frombuffer(planes, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(flat.T).view(U64).reshape(-1)


def _whole(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), U64) for x in column])


# Sums of many tokens for a bucket: the words of the contexts, one place after the other, how many
# next tokens each context has, these tokens and their counts. Words are numbers of frequent ones,
# or hashes in ``rare`` and ``others``.
PARTS = ("bucket long, contexts binary, rare binary, sizes binary, nexts binary, others binary, "
         "counts binary")
SUMS = "ctx long, next long, entry long, n long, near boolean, known boolean"


def entry_sums(docs: DataFrame, length: int, often: Filter, ending: Filter, total: int,
               sent: Frequent) -> DataFrame:
    """(ctx, next, entry, n) of contexts of that length, of all entries that come REPEATS
    times. ``often``: the contexts to count; ``ending``: what an entry without its first
    token has to be; ``sent``: the words that are numbers on the way. Adds whether context
    (``near``, of one word) and token (``known``) are among these."""
    shared = docs.sparkSession.sparkContext.broadcast((often, ending, sent))
    buckets = max(16, total // BUCKET)
    parts = max(16, buckets // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, ending, sent = shared.value
        held: list[tuple] = []
        for tokens, place in blocks(batches):
            *_, (before, shorter), (at, keys) = [(None, None), *contexts(tokens, place, length)]
            some = often.has(keys)
            at, keys = at[some], keys[some]
            if length == 1:
                last = tokens[at]
            else:
                suffix = np.zeros(len(tokens), U64)
                suffix[before] = shorter
                last = entry_keys(suffix[at], tokens[at])
            some = ending.has(last)
            keys, token = keys[some], tokens[at[some]]
            found, at = entry_keys(keys, token), at[some]
            order, starts = grouped(found)
            first = order[starts]
            held.append((found[first], keys[first],
                         np.diff(np.append(starts, len(order))).astype(np.int32),
                         *(tokens[at[first] - k] for k in range(length + 1))))
            del keys, token, found, order, first
            if sum(len(h[0]) for h in held) >= MERGED:
                yield packed(held, sent)
                ragged.release()
        if held:
            yield packed(held, sent)
        ragged.release()

    def packed(held: list[tuple], sent: Frequent) -> pa.RecordBatch:
        found, keys, n, *words_ = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order, starts = grouped(found)
        n = np.add.reduceat(n[order], starts, dtype=np.int64) if len(starts) else n
        first = order[starts]
        keys, (token, *context) = keys[first], [w[first] for w in words_]
        del found, words_, order
        bucket = ragged.mixed(keys + token % U64(parts)) % U64(buckets)
        # By bucket, last word and context. Contexts that agree in the bits that are left may
        # take turns, so that one is listed twice, which costs a few bytes.
        last = sent.numbered(context[0])
        order = np.argsort((bucket << U64(44)) | (last.astype(U64) << U64(24)) | (keys >> U64(40)))
        keys, n, bucket = keys[order], n[order], bucket[order]
        start = np.concatenate([[True], (keys[1:] != keys[:-1]) | (bucket[1:] != bucket[:-1])])
        firsts = np.flatnonzero(start[:len(keys)])
        sizes = np.diff(np.append(firsts, len(keys)))
        token, context = token[order], [w[order][firsts] for w in context]
        number = sent.numbered(token)
        numbers = [last[order][firsts], *(sent.numbered(w) for w in context[1:])]
        edges = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
        cuts = np.searchsorted(firsts, np.append(edges, len(keys)))
        rows: list[list] = [[], [], [], [], [], [], []]
        for a, b, i, j in zip(edges, np.append(edges[1:], len(keys)), cuts, cuts[1:]):
            for column, value in zip(rows, (
                    int(bucket[a]), squeezed(b"".join(_planes(x[i:j]) for x in numbers)),
                    b"".join(w[i:j][x[i:j] == 0].tobytes() for w, x in zip(context, numbers)),
                    squeezed(_planes(sizes[i:j])), squeezed(_planes(number[a:b])),
                    token[a:b][number[a:b] == 0].tobytes(), squeezed(_planes(n[a:b])))):
                column.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.int64()), *(pa.array(r, pa.binary()) for r in rows[1:])],
            [c.split()[0] for c in PARTS.split(", ")])

    def context_keys(part: pa.Table, sent: Frequent) -> np.ndarray:
        keys = []
        for planes, rare in zip(part.column("contexts"), part.column("rare")):
            whole = np.frombuffer(expanded(planes), np.uint8).reshape(length, -1)
            last, *before = sent.unpacked(
                np.concatenate([_numbers(pa.py_buffer(x)) for x in whole]),
                np.frombuffer(rare.as_buffer(), U64)).reshape(length, -1)
            if before:
                *others, key = before
                for word in others[::-1]:
                    key = entry_keys(key, word)
                last = entry_keys(key, last)
            keys.append(last)
        return np.concatenate(keys)

    def add(part: pa.Table) -> pa.Table:
        *_, sent = shared.value
        sizes, n = (np.concatenate([_numbers(expanded(x)) for x in part.column(c)])
                    for c in ("sizes", "counts"))
        keys = np.repeat(context_keys(part, sent), sizes)
        token = sent.unpacked(np.concatenate([_numbers(expanded(x)) for x in part.column("nexts")]),
                              _whole(part.column("others")))
        found = entry_keys(keys, token)
        order, starts = grouped(found)
        n = np.add.reduceat(n[order], starts) if len(starts) else n
        some = n >= REPEATS
        at = order[starts[some]]
        near = sent.near(keys[at]) if length == 1 else np.zeros(len(at), bool)
        return pa.table({"ctx": keys[at].view(np.int64), "next": token[at].view(np.int64),
                         "entry": found[at].view(np.int64), "n": n[some], "near": near,
                         "known": sent.near(token[at])})

    return docs.select(docs["text"]).mapInArrow(run, PARTS).groupBy("bucket").applyInArrow(
        add, SUMS)


ROWS = "ctx long, entry long, n long, near boolean, count long, tail long, more boolean"


def with_tail(rows: DataFrame) -> DataFrame:
    """Tail instead of suffix: the key of the entry without its first token. ``more``: whether the
    entry is a context of the next length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            suffix, token = (batch.column(c).to_numpy().view(U64) for c in ("suffix", "next"))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("ctx", "entry", "n", "near", "count")),
                 pa.array(entry_keys(suffix, token).view(np.int64)), batch.column("more")],
                [c.split()[0] for c in ROWS.split(", ")])

    return rows.mapInArrow(run, ROWS)


def looked_up(rows: DataFrame, known: DataFrame, key: str, sent: str) -> DataFrame:
    """``rows`` joined with ``known``, whose column of the name ``sent`` says which of its rows
    go to all workers. That of ``rows`` says which find theirs there; only the others are
    shuffled."""
    near, far = known.filter(sent).drop(sent), known.filter(~F.col(sent)).drop(sent)
    return rows.filter(sent).join(F.broadcast(near), key).unionByName(
        rows.filter(~F.col(sent)).join(if_small(far), key))


def tested(rows: DataFrame, label: str, sent: bool = False) -> tuple[DataFrame, DataFrame]:
    """Entries with ``shorter``, their share in the shorter state: gives entry, n, tail (of those
    that are contexts of the next length), whether the context is a state, the share that then
    holds, and what the entry of a state adds to a score that has backed off (``value``). Then
    the contexts: ctx, count, near, state, backing. ``sent``: those that are near go to all
    workers."""
    share = (F.col("n") + LEANING * F.col("shorter")) / (F.col("count") + LEANING)
    sums = rows.withColumn("share", share).groupBy("ctx").agg(
        F.max("count").alias("count"), F.max("near").alias("near"),
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("listed"), F.sum("share").alias("shares"),
        F.sum("shorter").alias("shorters"),
        F.sum(F.col("n") * F.log(F.col("share") / F.col("shorter"))).alias("gain"))
    backing = (F.greatest(1 - F.col("shares"), F.lit(1e-12))
               / F.greatest(1 - F.col("shorters"), F.lit(1e-12)))
    gain = F.col("gain") + (F.col("count") - F.col("listed")) * F.log(backing)
    state = gain > DIVERGENCE * (1 + F.col("size"))
    states = kept(sums.select(
        "ctx", "count", "near", state.alias("state"),
        F.when(state, F.log10(backing)).otherwise(0.0).alias("backing")), f"contexts-{label}")
    rows = rows.drop("count", *([] if sent else ["near"]))
    of_state = states.select("ctx", "count", "state", "backing", *(["near"] if sent else []))
    rows = looked_up(rows, of_state, "ctx", "near") if sent else rows.join(
        if_small(of_state), "ctx")
    return kept(rows.select(
        "entry", "n", F.when(F.col("more"), F.col("tail")).alias("tail"), "state",
        F.when(F.col("state"), share).otherwise(F.col("shorter")).alias("share"),
        F.when(F.col("state"), F.log10(share / F.col("shorter")) - F.col("backing"))
        .alias("value")),
        f"level-{label}"), states


def levels(learning: DataFrame, words: DataFrame, total: int, kinds: int
           ) -> list[tuple[DataFrame, DataFrame]]:
    """Per length of context: the tested entries and the contexts."""
    found: list[tuple[DataFrame, DataFrame]] = []
    least = least_count(words, SENT_WORDS)
    sent = Frequent(*_ordered(words.filter(F.col("n") >= least_count(words, NUMBERED))), least)
    candidates = words.filter((F.col("n") >= LEAST) & (F.col("key") != int(END.view(np.int64)))
                              ).select(F.col("key").alias("ctx"), F.col("n").alias("count"),
                                       (F.col("n") >= least).alias("near"))
    ending = words.filter(F.col("n") >= REPEATS).select("key")
    for length in range(1, DEPTH + 1):
        sums = kept(entry_sums(learning, length, filter_of(candidates.select("ctx")),
                               filter_of(ending), total, sent), f"sums-{length}")
        rows = sums.withColumn("more", (F.col("n") >= LEAST)
                               & (F.col("next") != int(END.view(np.int64))))
        if length == 1:
            rows = looked_up(rows, candidates, "ctx", "near")
            rows = looked_up(rows.withColumnRenamed("next", "tail"), words.select(
                F.col("key").alias("tail"), (F.col("n") >= least).alias("known"),
                ((F.col("n") + 1) / (total + kinds + 1)).alias("shorter")), "tail", "known")
        else:
            rows = with_tail(rows.drop("known").join(if_small(candidates), "ctx")).join(
                if_small(found[-1][0].select(F.col("entry").alias("tail"),
                                             F.col("share").alias("shorter"))), "tail")
        let_go(learning.sparkSession)
        rows = kept(rows, f"shorter-{length}")
        discard(sums)
        found.append(tested(rows, str(length), length == 1))
        discard(rows)
        candidates = found[-1][0].filter(F.col("tail").isNotNull()).select(
            F.col("entry").alias("ctx"), F.col("tail").alias("suffix"), F.col("n").alias("count"))
        ending = found[-1][0].select("entry")
    return found


@dataclass
class Model:
    """Frequent words with their counts, frequent contexts and the entries of those that are
    states, in ascending order of their keys."""

    words: np.ndarray
    word_counts: np.ndarray
    states: list[tuple[np.ndarray, np.ndarray]]  # per length: contexts, log10 of backing off
    entries: np.ndarray
    entry_logs: np.ndarray
    rest: Filter | None = None  # states that are not here

    def __post_init__(self) -> None:
        self.word_places = Keys(self.words).places
        self.state_places = [Keys(s).places for s, _ in self.states]
        self.entry_places = Keys(self.entries).places

    def scored(self, tokens: np.ndarray, place: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """log10 given by the longest state of each token, and whether it is complete, else
        the token's share at the root has to be added; whether other states may follow; and
        per length the contexts that are not here (0 if the context is)."""
        logs, covered = np.zeros(len(tokens)), np.zeros(len(tokens), bool)
        unsure, missing = np.zeros(len(tokens), bool), np.zeros((DEPTH, len(tokens)), U64)
        for k, ((at, keys), places, (_, backing)) in enumerate(zip(
                contexts(tokens, place), self.state_places, self.states)):
            spot = places(keys)
            hit = spot >= 0
            if self.rest is not None:
                missing[k, at[~hit]] = keys[~hit]
                unsure[at[~hit]] |= self.rest.has(keys[~hit])
            at, keys, spot = at[hit], keys[hit], spot[hit]
            follow(logs, covered, at, backing[spot], self.entry_places(
                entry_keys(keys, tokens[at])), self.entry_logs)
        return logs, covered, unsure, missing


def follow(logs: np.ndarray, covered: np.ndarray, at: np.ndarray, backing: np.ndarray,
           entry: np.ndarray, entry_logs: np.ndarray) -> None:
    """Go on to a longer state at the places ``at``, where ``entry`` is -1 if it does not list
    the token."""
    listed = entry >= 0
    logs[at[listed]] = entry_logs[entry[listed]]
    covered[at[listed]] = True
    logs[at[~listed]] += backing[~listed]


def _column(rows: pa.Table, name: str) -> np.ndarray:
    values = rows.column(name).to_numpy()
    return values.view(U64) if values.dtype == np.int64 and name != "n" else values


def _ordered(rows: DataFrame) -> list[np.ndarray]:
    """Both columns of ``rows``, by the first, a key."""
    found = rows.toArrow()
    key, value = (_column(found, c) for c in found.column_names)
    order = np.argsort(key)
    return [key[order], value[order]]


def least_count(rows: DataFrame, most: int) -> float:
    """Least n of the most frequent rows, by quarters of a power of two, so that at most ``most``
    have it; 0 if all may be taken."""
    steps = (rows.groupBy(F.floor(4 * F.log2("n")).alias("quarter")).count()
             .orderBy(F.desc("quarter")).collect())
    total, bar = 0, 2.0 ** 63
    for step in steps:
        total += step["count"]
        if total > most:
            return bar
        bar = 2.0 ** (step["quarter"] / 4)
    return 0.0


def grown(docs: DataFrame) -> tuple[DataFrame, list[tuple[DataFrame, DataFrame]], int, int]:
    """Word counts, the tested entries and contexts per length, the number of training tokens
    and that of different ones."""
    ship(docs.sparkSession)
    learning = docs.select(docs["doc_id"], docs["text"]).filter(fold(docs["doc_id"]) != HELD_OUT)
    words = kept(word_sums(learning), "words")
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    return words, levels(learning, words, total, kinds), total, kinds


def gathered(words: DataFrame, found: list[tuple[DataFrame, DataFrame]]) -> Model:
    """The whole tree in the memory of one process."""
    states = [tuple(_ordered(c.select("ctx", "backing"))) for _, c in found]
    entries = [_ordered(level.filter("state").select("entry", F.log10("share").alias("log")))
               for level, _ in found]
    keys, logs = (np.concatenate(x) for x in zip(*entries))
    order = np.argsort(keys)
    return Model(*_ordered(words.filter(F.col("n") >= least_count(words, SENT_WORDS))),
                 states, keys[order], logs[order])


def train(docs: DataFrame) -> tuple[Model, DataFrame, int, int]:
    """The whole model in memory, the counts of all words, the number of training tokens and
    that of different ones."""
    words, found, total, kinds = grown(docs)
    return gathered(words, found), words, total, kinds


# The form by position: what is left of a score travels with each position. ``scores`` sends
# runs instead.
POSITIONS = ("bucket long, ids array<long>, texts array<long>, starts binary, words binary, "
             "tokens binary, logs binary, marks binary, keys binary")
SETTLED = "doc_id long, text_id long, logs double, open double, n_open long, rare long"


BITS = np.arange(DEPTH, dtype=np.uint8)
# Beside the contexts that may be states: whether the token is covered, and has logs so far.
COVERED, GIVEN = 1 << DEPTH, 1 << DEPTH + 1


def positions(model: Model, ids: pa.Array, first: int, tokens: np.ndarray, owner: np.ndarray,
              place: np.ndarray, text_id: np.ndarray, buckets: int) -> pa.RecordBatch:
    """The positions of a chunk that the model is unsure of, packed, a row for each bucket. Texts
    are known by where a new one starts, words that were sent by their place."""
    logs, covered, unsure, missing = model.scored(tokens, place)
    at = np.flatnonzero(unsure)
    keys = missing[:, at].T
    anchor = keys[np.arange(len(at)), (keys != 0).argmax(axis=1)]
    bucket = (ragged.mixed(anchor) % U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    at, keys, bucket = at[order], keys[order], bucket[order]
    # Only the contexts that may be states travel.
    likely = (keys != 0) & model.rest.has(keys.ravel()).reshape(keys.shape)
    owner, tokens, logs = owner[at], tokens[at], logs[at]
    word = model.word_places(tokens)
    rare, given = word < 0, logs != 0
    marks = ((likely << BITS).sum(axis=1) + COVERED * covered[at] + GIVEN * given).astype(np.uint8)
    edge = np.diff(bucket, prepend=-1) != 0
    start = edge | (np.diff(owner, prepend=-1) != 0)
    edges = np.flatnonzero(edge)
    rows: list[list] = [[] for _ in range(9)]
    for a, b in zip(edges, np.append(edges[1:], len(at))):
        own = owner[a:b][start[a:b]]
        for column, value in zip(rows, (
                int(bucket[a]), ids.take(pa.array(first + own)).to_pylist(),
                text_id[own].view(np.int64), np.packbits(start[a:b]).tobytes(),
                _planes(word[a:b] + 1), tokens[a:b][rare[a:b]].tobytes(),
                logs[a:b][given[a:b]].tobytes(), marks[a:b].tobytes(),
                keys[a:b][likely[a:b]].tobytes())):
            column.append(value)
    kinds = [pa.int64(), *[pa.list_(pa.int64())] * 2, *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays(
        [pa.array(r, k) for r, k in zip(rows, kinds)],
        [c.split()[0] for c in POSITIONS.split(", ")])


class Bucket:
    """Settles positions by the states of their bucket."""

    def __init__(self, rest: pa.Table, words: np.ndarray, word_counts: np.ndarray):
        ctx, entry = (rest.column(c).to_numpy().view(U64) for c in ("ctx", "entry"))
        by_entry = np.argsort(entry)
        states, first = np.unique(ctx, return_index=True)
        self.backing = rest.column("backing").to_numpy()[first]
        self.entry_logs = rest.column("log").to_numpy()[by_entry]
        self.state_places, self.entry_places = Keys(states).places, Keys(entry[by_entry]).places
        self.words, self.shares = words, np.append(np.log10(word_counts + 1.0), 0.0)

    def settled(self, rows: pa.Table) -> pa.Table:
        def each(name: str) -> list[pa.Buffer]:
            return [x.as_buffer() for x in rows.column(name)]

        def whole(name: str, kind) -> np.ndarray:
            return np.concatenate([np.frombuffer(x, kind) for x in each(name)])

        marks = whole("marks", np.uint8)
        word = np.concatenate([_numbers(x) for x in rows.column("words")]) - 1
        tokens = np.empty(len(word), U64)
        tokens[word >= 0] = self.words[word[word >= 0]]
        tokens[word < 0] = whole("tokens", U64)
        logs, covered = np.zeros(len(word)), (marks & COVERED) != 0
        logs[(marks & GIVEN) != 0] = whole("logs", np.float64)
        likely = (marks[:, None] >> BITS & 1).astype(bool)
        keys = np.zeros(likely.shape, U64)
        keys[likely] = whole("keys", U64)
        for k in range(DEPTH):
            at = np.flatnonzero(likely[:, k])
            spot = self.state_places(keys[at, k])
            at, spot = at[spot >= 0], spot[spot >= 0]
            follow(logs, covered, at, self.backing[spot],
                   self.entry_places(entry_keys(keys[at, k], tokens[at])), self.entry_logs)
        del keys, likely
        rare = ~covered & (word < 0)
        # Each row starts with a text of its own.
        owner = pa.array(np.cumsum(np.concatenate([
            np.unpackbits(np.frombuffer(x, np.uint8), count=len(m)) for x, m in zip(
                each("starts"), each("marks"))]), dtype=np.int64) - 1)
        ids, texts = (rows.column(c).combine_chunks().flatten().take(owner)
                      for c in ("ids", "texts"))
        out = pa.table({"doc_id": ids, "text_id": texts, "logs": logs,
                        "open": np.where(covered, 0.0, self.shares[word]),
                        "n_open": (~covered).astype(np.int64),
                        "rare": pa.array(tokens.view(np.int64), mask=~rare)})
        # Most positions of a text need not be told apart any more.
        return out.group_by(["doc_id", "text_id", "rare"]).aggregate(
            [("logs", "sum"), ("open", "sum"), ("n_open", "sum")]).rename_columns(
            ["doc_id", "text_id", "rare", "logs", "open", "n_open"]).select(
            ["doc_id", "text_id", "logs", "open", "n_open", "rare"])


def settle(rows: pa.Table, rest: pa.Table, words: np.ndarray, word_counts: np.ndarray) -> pa.Table:
    """A whole bucket, some of its rows at once: what is unpacked does not grow with it."""
    bucket = Bucket(rest, words, word_counts)
    sizes = np.array([len(x.as_buffer()) for x in rows.column("marks")], np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE, prepend=-1))
    done = [bucket.settled(rows.slice(a, b - a))
            for a, b in zip(cuts, np.append(cuts[1:], len(sizes)))]
    kinds = pa.schema([(c.split()[0], pa.float64() if c.endswith("double") else pa.int64())
                       for c in SETTLED.split(", ")])
    return pa.concat_tables([kinds.empty_table(), *done])


def grams(tokens: np.ndarray, place: np.ndarray, longest: int = DEPTH + 1) -> Iterator[
        tuple[np.ndarray, np.ndarray]]:
    """For each length: where runs of that many tokens end, and their keys."""
    at, keys = np.arange(len(tokens)), tokens
    yield at, keys
    for length in range(2, longest + 1):
        ending = np.zeros(len(tokens), U64)
        ending[at] = keys
        at = np.flatnonzero(place >= length - 1)
        keys = entry_keys(ending[at - 1], tokens[at])
        yield at, keys


def run_values(found: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(key, n, value) of the runs of tokens that add to a score, n: how often they come. A run
    adds, as an entry of a state, what the state gives beyond the shorter one in place of its
    backing off; and, as a state, its backing off from the token that follows. It has a row for
    either."""
    rows = [one for level, contexts_ in found for one in (
        level.filter("state").select(F.col("entry").alias("key"), "n", "value"),
        contexts_.filter("state").select(F.col("ctx").alias("key"), F.col("count").alias("n"),
                                         F.col("backing").alias("value")))]
    return functools.reduce(DataFrame.union, rows)


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending different keys and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    return keys[first], np.add.reduceat(values, first) if len(first) else values


# A chunk's infrequent runs and words in a bucket: their keys, in how many of its texts each is,
# in which, and how often. Its texts' own numbers travel beside them, in a row without keys.
KEYED = ("bucket long, chunk long, ids array<long>, own binary, "
         "runs binary, run_texts binary, run_text binary, run_n binary, "
         "words binary, word_texts binary, word_text binary, word_n binary")
ANSWERS = "chunk long, bucket long, ids array<long>, own binary, texts binary, sums binary"
SUMMED = "doc_id long, n_tokens long, n_known long, base double, value double"
WIDTH = 4  # numbers of a text: tokens, known ones, base and value


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> U64(20)) % U64(buckets)).astype(np.int64)


def keyed(keys: np.ndarray, owner: np.ndarray, buckets: int
          ) -> Iterator[tuple[int, tuple[bytes, bytes, bytes, bytes]]]:
    """By bucket: the keys with their texts, packed."""
    order, first = grouped(ragged.mixed(keys + owner.astype(U64) * U64(0xD1342543DE82EF95)))
    n = np.diff(np.append(first, len(order)))
    keys, owner = keys[order[first]], owner[order[first]]
    bucket = bucket_of(keys, buckets)
    order = np.argsort((bucket.astype(U64) << U64(44)) | (keys >> U64(20)))
    keys, owner, n, bucket = keys[order], owner[order], n[order], bucket[order]
    starts = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    texts = np.diff(np.append(starts, len(keys)))
    edges = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(edges, np.append(edges[1:], len(keys))):
        i, j = np.searchsorted(starts, (a, b))
        yield int(bucket[a]), (keys[starts[i:j]].tobytes(), _planes(texts[i:j]),
                               _planes(owner[a:b]), _planes(n[a:b]))


NOTHING = (b"", b"", b"", b"")


def keyed_rows(chunk: int, ids: list, own: np.ndarray, runs: tuple, words: tuple, buckets: int
               ) -> pa.RecordBatch:
    """All that travels of a chunk of texts: runs and words as keys with their texts."""
    by_run, by_word = dict(keyed(*runs, buckets)), dict(keyed(*words, buckets))
    rows = [[chunk % buckets, chunk, ids, own.tobytes(), *NOTHING, *NOTHING]]
    rows += [[bucket, chunk, None, None, *by_run.get(bucket, NOTHING),
              *by_word.get(bucket, NOTHING)] for bucket in sorted({*by_run, *by_word})]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 9]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
        [c.split()[0] for c in KEYED.split(", ")])


def answer(rows: pa.Table, rest: pa.Table) -> pa.Table:
    """What a bucket's runs and words add to the texts of each chunk, a row for each row."""
    def lookup(word: bool) -> tuple:
        own = rest.filter(pc.equal(rest.column("word"), word))
        keys, values = summed(own.column("key").to_numpy().view(U64),
                              own.column("value").to_numpy())
        return Keys(keys).places, np.append(values, 0.0)

    (run_places, run_logs), (word_places, word_logs) = lookup(False), lookup(True)

    def added(row: int, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of each key with each of its texts, that text, and how often."""
        keys = np.frombuffer(rows.column(f"{kind}s")[row].as_buffer(), U64)
        texts, text, n = (_numbers(rows.column(f"{kind}_{c}")[row]) for c in ("texts", "text", "n"))
        spot = (word_places if kind == "word" else run_places)(keys)
        return np.repeat(spot, texts), text, n

    texts, sums = [], []
    for row in range(rows.num_rows):
        spot, text, n = added(row, "run")
        rare, rare_text, rare_n = added(row, "word")
        size = max(text.max(initial=-1), rare_text.max(initial=-1)) + 1
        out = np.zeros((size, WIDTH - 1))
        if size:
            out[:, 0] = np.bincount(rare_text, rare_n * (rare >= 0), size)
            out[:, 1] = np.bincount(rare_text, rare_n * word_logs[rare], size)
            out[:, 2] = np.bincount(text, n * run_logs[spot], size)
        some = np.flatnonzero(out.any(axis=1))
        texts.append(_planes(some))
        sums.append(out[some].T.tobytes())
    return pa.table({**{c: rows.column(c) for c in ("chunk", "bucket", "ids", "own")},
                     "texts": pa.array(texts, pa.binary()), "sums": pa.array(sums, pa.binary())})


def together(answers: pa.Table) -> pa.Table:
    """The numbers of a chunk's texts, added up in the order of the buckets, so that equal texts
    get equal sums."""
    own = pc.filter(answers.column("own"), pc.is_valid(answers.column("own")))[0]
    ids = pc.filter(answers.column("ids"), pc.is_valid(answers.column("own"))).combine_chunks()
    out = np.frombuffer(own.as_buffer(), np.float64).reshape(WIDTH, -1).copy()
    for row in np.argsort(answers.column("bucket").to_numpy(), kind="stable"):
        text = _numbers(answers.column("texts")[row])
        out[1:, text] += np.frombuffer(answers.column("sums")[row].as_buffer(),
                                       np.float64).reshape(WIDTH - 1, -1)
    return pa.table([ids.flatten(), *(out[k].astype(np.int64) for k in (0, 1)), out[2], out[3]],
                    names=[c.split()[0] for c in SUMMED.split(", ")])


# Keys of a bucket and their values (of words, their counts) by their bytes.
LOOKUPS = "bucket long, word boolean, keys binary, values binary"


def lookup_rows(rows: DataFrame, buckets: int) -> DataFrame:
    """(key, value, word) packed by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(len(b) for b in held) >= MERGED:
                yield packed(pa.Table.from_batches(held))
                held.clear()
        if held:
            yield packed(pa.Table.from_batches(held))

    def packed(part: pa.Table) -> pa.RecordBatch:
        keys, values, word = (part.column(c).to_numpy() for c in ("key", "value", "word"))
        keys = keys.view(U64)
        place = bucket_of(keys, buckets) * 2 + word
        order = np.lexsort((keys, place))
        keys, values, place = keys[order], values[order].view(U64), place[order]
        edges = np.flatnonzero(np.diff(place, prepend=-1))
        ends = np.append(edges[1:], len(place))
        return pa.RecordBatch.from_arrays(
            [pa.array(place[edges] // 2), pa.array(place[edges] % 2 == 1),
             *(pa.array([squeezed(_hash_planes(x[a:b])) for a, b in zip(edges, ends)], pa.binary())
               for x in (keys, values))], [c.split()[0] for c in LOOKUPS.split(", ")])

    return rows.mapInArrow(run, LOOKUPS)


def looked(rows: pa.Table) -> pa.Table:
    """The rows that ``lookup_rows`` packed, words with log10(count + 1)."""
    parts = [pa.table({"key": pa.array(np.zeros(0, np.int64)), "value": np.zeros(0),
                       "word": pa.array([], pa.bool_())})]
    for word, keys, values in zip(*(rows.column(c) for c in ("word", "keys", "values"))):
        value = _hashes(expanded(values)).view(np.float64)
        parts.append(pa.table({
            "key": _hashes(expanded(keys)).view(np.int64),
            "value": np.log10(value + 1.0) if word.as_py() else value,
            "word": np.full(len(value), word.as_py())}))
    return pa.concat_tables(parts)


def text_sums(docs: DataFrame, words: DataFrame, found: list[tuple[DataFrame, DataFrame]],
              total: int) -> DataFrame:
    """Per row of ``docs``: its tokens, the known ones, their log10(count + 1) and the values of
    its runs, added up. What is not among the most frequent travels, of ROUNDS shares of the texts
    one after the other. ``words`` and ``found`` are discarded."""
    values = run_values(found)
    often, least = least_count(words, SENT_WORDS), least_count(values, SENT_ENTRIES)
    sent = values.filter(F.col("n") >= least).select("key", "value").toArrow()
    own, counts = _ordered(words.filter(F.col("n") >= often))
    rest = values.filter(F.col("n") < least).select("key", "value")
    shared = docs.sparkSession.sparkContext.broadcast(
        (own, np.log10(counts + 1.0), *summed(_column(sent, "key"), _column(sent, "value")),
         filter_of(rest.select("key")) if least else None))
    del sent
    buckets = max(16, total // (4 * BUCKET))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_, shares, keys_, values_, rest = shared.value
        word_places, run_places = Keys(words_).places, Keys(keys_).places
        shares, values_ = np.append(shares, 0.0), np.append(values_, 0.0)
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column("doc_id")
            for first, tokens, owner, place, text_id in token_rows(batch.column("text")):
                size = len(text_id)
                word = word_places(tokens)
                value = np.zeros(size)
                far: list[tuple[np.ndarray, np.ndarray]] = []
                for at, keys in grams(tokens, place):
                    spot = run_places(keys)
                    value += np.bincount(owner[at], values_[spot], size)
                    if rest is not None:
                        away = np.flatnonzero(spot < 0)
                        away = away[rest.has(keys[away])]
                        far.append((keys[away], owner[at[away]]))
                rare = np.flatnonzero(word < 0)
                own = np.stack([np.bincount(owner, minlength=size),
                                np.bincount(owner, word >= 0, size),
                                np.bincount(owner, shares[word], size), value])
                runs = (tuple(np.concatenate(x) for x in zip(*far)) if far
                        else (tokens[:0], owner[:0]))
                yield keyed_rows(chunk, ids.slice(first, size).to_pylist(), own, runs,
                                 (tokens[rare], owner[rare]), buckets)
                chunk += 1
        ragged.release()

    def answers(rows: pa.Table, rest: pa.Table) -> pa.Table:
        done = answer(rows, looked(rest))
        ragged.release()
        return done

    let_go(docs.sparkSession)
    lookups = kept(lookup_rows(rest.withColumn("word", F.lit(False)).union(
        words.filter(F.col("n") < often).select("key", F.col("n").cast("double"), F.lit(True))),
        buckets), "lookups")
    discard(words, *(one for level in found for one in level))
    done = []
    for share in range(ROUNDS):
        done.append(kept(docs.filter(round_of(docs["doc_id"]) == share).mapInArrow(run, KEYED)
                         .groupBy("bucket").cogroup(lookups.groupBy("bucket"))
                         .applyInArrow(answers, ANSWERS).groupBy("chunk")
                         .applyInArrow(together, SUMMED), f"summed-{share}"))
        let_go(docs.sparkSession)
    rows = kept(functools.reduce(DataFrame.union, done), "scored")
    discard(lookups, *done)
    return rows


def scores(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose fold is not the held-out one. A null or empty text is its
    end alone; texts of any length are read whole. Null ids count as empty text in the fold;
    repeated rows are learned from as often as they come, and get equal scores. An empty
    table gives no rows; other columns are ignored.
    """
    docs = docs.select(docs["doc_id"], docs["text"])
    words, found, total, kinds = grown(docs)
    rows = text_sums(docs, words, found, total)
    base = F.col("base") - F.col("n_tokens") * F.log10(F.lit(float(total + kinds + 1)))
    return rows.select(
        "doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"),
        (base + F.col("value")).alias("score"))


def op3(spark: SparkSession, folder: str) -> DataFrame:
    return scores(table(spark, folder, "documents"))
