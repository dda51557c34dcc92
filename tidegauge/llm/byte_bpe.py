"""Byte-level BPE encoding and decoding with the tokenizers library.

The rank file becomes a model of that library: each token's last merge is found by
merging its bytes with the earlier ranks. Bytes are mapped to printing characters, one
each, so that the library's offsets are byte offsets. Different pre-tokens of a chunk of
Arrow texts are encoded once. Decoding looks up the bytes of each id; bytes that end
inside a character wait for the rest of it.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer
from tokenizers.models import BPE

from tidegauge.llm import ragged
from tidegauge.llm.encoding import Encoder
from tidegauge.llm.tables import public_vocabulary, ship, table
from tidegauge.llm.token_counts import byte_characters

# Pieces the library is given at once; it keeps about a kilobyte of each meanwhile.
AT_ONCE = 4096
_CODECS: dict[str, Codec] = {}


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank."""
    with open(path, "rb") as file:
        found = {int(rank): base64.b64decode(token)
                 for token, rank in (line.split() for line in file if line.strip())}
    return [found[rank] for rank in range(len(found))]


def _last_merge(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Parts of ``token`` once all merges before its own are applied."""
    parts, limit = [token[i:i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        found = [ranks.get(parts[i] + parts[i + 1], limit) for i in range(len(parts) - 1)]
        lowest = min(found)
        if lowest >= limit:
            break
        at = found.index(lowest)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


def library_model(tokens: list[bytes]) -> str:
    """The tokenizers library's serialised form of a rank file."""
    names = byte_characters()
    spelled = ["".join(names[b] for b in token) for token in tokens]
    ranks = {token: rank for rank, token in enumerate(tokens)}
    merges = []
    for token in tokens:
        if len(token) > 1:
            parts = _last_merge(token, ranks)
            # A token that its parts don't lead to is found only as a whole pre-token.
            if len(parts) == 2 and all(part in ranks for part in parts):
                merges.append(tuple("".join(names[b] for b in part) for part in parts))
    vocab = {name: rank for rank, name in enumerate(spelled)}
    return Tokenizer(BPE(vocab, merges, ignore_merges=True)).to_str()


class Codec:
    """Ids of texts and bytes of ids."""

    def __init__(self, model: str, tokens: list[bytes]):
        self.tokenizer = Tokenizer.from_str(model)
        self.characters = np.array([ord(c) for _, c in sorted(byte_characters().items())], "<u4")
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array([len(token) for token in tokens], np.int64)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.encode = Encoder(self._pieces)

    def _pieces(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
        spelled = self.characters[ragged.gathered(data, starts, lengths)]
        whole, ends = spelled.tobytes().decode("utf-32-le"), np.cumsum(lengths).tolist()
        texts = [whole[a:b] for a, b in zip([0, *ends], ends)]
        found = [e.ids for first in range(0, len(texts), AT_ONCE) for e in
                 self.tokenizer.encode_batch_fast(texts[first:first + AT_ONCE],
                                                  add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.int32, int(sizes.sum())), sizes

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte where each id begins, in the text that the ids are of."""
        return np.cumsum(self.sizes[ids]) - self.sizes[ids]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return ragged.gathered(self.flat, self.firsts[ids], self.sizes[ids])

    def decoded_parts(self, ids: Iterable[int]) -> Iterator[str]:
        """Text that each id completes; a split character comes with its last byte, and
        bytes that are no UTF-8 as the replacement character."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for number in ids:
            first = self.firsts[number]
            yield decoder.decode(self.flat[first:first + self.sizes[number]].tobytes())
        yield decoder.decode(b"", True)


def _codec(name: str, shared) -> Codec:
    if name not in _CODECS:
        _CODECS[name] = Codec(*shared.value)
    return _CODECS[name]


def encode(docs: DataFrame, ranks: str) -> DataFrame:
    """doc_id, ids, offsets (byte of the text where each id begins) per row.

    ``ranks`` is the path of a rank file, read on the driver. A null text counts as empty
    and has no ids; repeated rows, null ids and other columns do not matter.
    """
    ship(docs.sparkSession)
    tokens = read_ranks(ranks)
    shared = docs.sparkSession.sparkContext.broadcast((library_model(tokens), tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, shared)
        for batch in batches:
            for first, ids, sizes, _ in codec.encode(batch.column("text")):
                ends = np.concatenate([[0], np.cumsum(sizes)])
                starts = codec.offsets(ids)
                firsts = np.append(starts, 0)[np.minimum(ends[:-1], max(len(ids) - 1, 0))]
                starts = starts - np.repeat(firsts, sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(sizes)),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                              pa.array(starts, pa.int64()))],
                    ["doc_id", "ids", "offsets"])

    return docs.select(docs["doc_id"], docs["text"]).mapInArrow(
        run, "doc_id long, ids array<int>, offsets array<long>")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded (bytes) of rows with doc_id and ids."""
    ship(encoded.sparkSession)
    tokens = read_ranks(ranks)
    shared = encoded.sparkSession.sparkContext.broadcast((library_model(tokens), tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, shared)
        for batch in batches:
            rows = batch.column("ids").fill_null([])
            flat = rows.flatten().to_numpy(zero_copy_only=False)
            sizes = rows.value_lengths().to_numpy(zero_copy_only=False)
            digests, decoded, at = [], [], 0
            for size in sizes.tolist():
                ids = flat[at:at + size]
                digests.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(codec.decode(ids).tobytes())
                at += size
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(digests),
                 pa.array(decoded, pa.binary())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded"])

    return encoded.select(encoded["doc_id"], encoded["ids"]).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded binary")


def round_trip(docs: DataFrame, ranks: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text encoded, its ids decoded.

    As ``encode`` and ``decode`` do, in one pass that keeps ids in the worker.
    """
    ship(docs.sparkSession)
    tokens = read_ranks(ranks)
    shared = docs.sparkSession.sparkContext.broadcast((library_model(tokens), tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, shared)
        for batch in batches:
            for first, ids, sizes, _ in codec.encode(batch.column("text")):
                own, decoded, at = [], [], 0
                for size in sizes.tolist():
                    part = ids[at:at + size]
                    own.append(hashlib.sha256(part.astype("<u4").tobytes()).hexdigest())
                    decoded.append(hashlib.sha256(codec.decode(part)).hexdigest())
                    at += size
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(sizes)), pa.array(sizes),
                     pa.array(own), pa.array(decoded)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(docs["doc_id"], docs["text"]).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(table(spark, folder, "documents"),
                      public_vocabulary("byte_bpe_multi_50k.tiktoken"))
