"""Cost-balanced packing of token ids into sequences.

A document's cost is linear in its tokens plus quadratic, for attention within it.
Whole stretches of the sequence length become sequences of their own. The rest of each
document is dealt to groups by hash; a group opens just as many sequences as its tokens
need and gives its documents, longest first, to the sequence of least cost that has room
for them. A document that fits nowhere is cut at the room that is left. So a group's
padding is less than one sequence in all, whatever the lengths are, and groups keep their
size at any scale. Rows that repeat are numbered in their task and dealt by that number too,
so however many there are, no group gets them all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegauge.llm import ragged
from tidegauge.llm.encoding import Encoder
from tidegauge.llm.tables import public_vocabulary, ship, table
from tidegauge.llm.token_counts import merged, read_merges

SEQUENCE = 2048
END_ID = 1
LINEAR, QUADRATIC = 1.0, 1 / 1024
GROUP_ROWS = 2048
# Different rows among which a task looks for repeats.
REMEMBERED = 1 << 20

PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, "
         "mark long, turn long")
PACKED = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
_ENCODERS: dict[str, Encoder] = {}


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def balanced(lengths: np.ndarray, capacity: int, linear: float = LINEAR,
             quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """(item, start in it, length, sequence, offset) of each piece.

    Longest item first, each to the sequence of least cost with room for all of it, or
    cut at the most room there is. All room but that of less than one sequence is filled.
    """
    bins = -(-int(lengths.sum()) // capacity)
    used, cost = np.zeros(bins, np.int64), np.zeros(bins)
    pieces = []
    for item in np.argsort(-lengths, kind="stable"):
        start, left = 0, int(lengths[item])
        while left:
            fits = used + left <= capacity
            if fits.any():
                chosen, size = int(np.argmin(np.where(fits, cost, np.inf))), left
            else:
                chosen = int(np.argmin(used))
                size = capacity - int(used[chosen])
            pieces.append((int(item), start, size, chosen, int(used[chosen])))
            used[chosen] += size
            cost[chosen] += linear * size + quadratic * size * size
            start, left = start + size, left - size
    return pieces


def pieces(docs: DataFrame, vocabulary: str, sequence: int, end_id: int) -> DataFrame:
    """Documents in stretches of the sequence length and a shorter rest, which has its ids.

    ``mark`` and ``turn``, the number of like rows before in the task, spread rows over groups.
    The number does not depend on the order of up to ``REMEMBERED`` rows.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(read_merges(vocabulary))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(vocabulary)
        if encoder is None:
            merges = shared.value

            def work(data, starts, lengths):
                symbols = merges.bytes[ragged.gathered(data, starts, lengths)]
                return merged(symbols, lengths, merges)

            encoder = _ENCODERS[vocabulary] = Encoder(work, merges.special)
        seen: dict[tuple, int] = {}
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for first, ids, sizes, _ in encoder(batch.column("text")):
                rows: list[list] = [[] for _ in range(8)]
                at = 0
                for doc_id, size in zip(doc_ids[first:], sizes.tolist()):
                    own = np.append(ids[at:at + size], end_id).astype("<u4")
                    at += size
                    mark = crc32(own)
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    turn = seen.get((doc_id, mark), 0)
                    seen[doc_id, mark] = turn + 1
                    for start in range(0, len(own), sequence):
                        part = own[start:start + sequence]
                        whole = len(part) == sequence
                        narrow = part if size and part.max() > 0xFFFF else part.astype("<u2")
                        for column, value in zip(rows, (
                                doc_id, start, len(part), crc32(part), len(own),
                                None if whole else narrow.tobytes(), mark, turn)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.binary() if i == 5 else pa.int64())
                     for i, c in enumerate(rows)],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "mark",
                     "turn"])
        seen.clear()
        ragged.release()

    return docs.select(docs["doc_id"], docs["text"]).mapInArrow(encode, PIECE)


def pack(docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE, end_id: int = END_ID,
         linear: float = LINEAR, quadratic: float = QUADRATIC,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each document's ids and ``end_id`` lie in exactly one piece each; a null or empty text
    is ``end_id`` alone. Repeated rows are packed as often as they come, null ids like
    others; no documents give no rows. ``vocabulary`` is a byte-level vocabulary in JSON.
    Other columns are ignored.
    """
    groups = max(1, -(-docs.count() // group_rows))
    parts = pieces(docs, vocabulary, sequence, end_id).withColumn(
        "group", F.pmod(F.xxhash64("doc_id", "mark", "turn"), F.lit(groups)))

    def assign(rows: pa.Table) -> pa.Table:
        # One order, however the rows came in.
        rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "mark", "start", "length")])
        given = rows.to_pydict()
        lengths = np.array(given["length"], np.int64)
        rests = np.flatnonzero(lengths < sequence)
        base = given["group"][0] << 32
        out = []
        for item, start, size, chosen, offset in balanced(
                lengths[rests], sequence, linear, quadratic):
            at = int(rests[item])
            raw = given["ids"][at]
            ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * lengths[at] else "<u4")
            check = (given["ids_crc32"][at] if size == lengths[at]
                     else crc32(ids[start:start + size]))
            out.append((given["doc_id"][at], given["start"][at] + start, size, check,
                        given["doc_tokens"][at], base + chosen, offset))
        following = base + len(rests)  # there are no more sequences than rests
        for place, at in enumerate(np.flatnonzero(lengths == sequence).tolist()):
            out.append((given["doc_id"][at], given["start"][at], sequence,
                        given["ids_crc32"][at], given["doc_tokens"][at], following + place, 0))
        return pa.table([pa.array(column, pa.int64()) for column in zip(*out)],
                        ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         "offset"])

    return parts.groupBy("group").applyInArrow(assign, PACKED)


def op5(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), public_vocabulary("byte_bpe_50k.json"))
