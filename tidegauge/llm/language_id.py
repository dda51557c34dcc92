"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's
probability is the sum over all ways to cut it into pieces, found by a forward pass; a
text's is the product over its words. The piece probabilities are fitted by expectation
maximisation over the same segmentations, on a sample of labelled documents of bounded
size. Every document is predicted from its whole text.

Words are runs of letters, lower-cased, with a space before them as in the vocabulary. A
run is cut every ``LONGEST`` bytes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegauge.llm import ragged
from tidegauge.llm.byte_bpe import read_ranks
from tidegauge.llm.pretokens import LETTER, classes
from tidegauge.llm.tables import public_vocabulary, ship, table

FOLDS, HELD_OUT = 3, 1
# Labelled documents of a language, about, that the model is fitted on.
SAMPLE = 400
ROUNDS = 4
LONGEST = 64
# Probabilities below this are worked out in logs.
TINY = 1e-290
# Weight of the pieces' shares over all languages in those of one.
LEANING = 200.0
UNKNOWN = "und"
# Bytes of text handled at once.
CHUNK = 1 << 19

U64 = np.uint64


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


@dataclass
class Pieces:
    """Hashes of the usable pieces, ascending, and the place of each in the shares."""

    keys: np.ndarray
    longest: int

    @classmethod
    def read(cls, path: str) -> Pieces:
        usable = sorted({t for t in read_ranks(path)
                         if len(t) == 1 or (len(t) <= LONGEST + 1 and _is_word_part(t))})
        lengths = np.array([len(t) for t in usable])
        ends = np.cumsum(lengths)
        return cls(np.sort(ragged.hashes(np.frombuffer(b"".join(usable), np.uint8),
                                         ends - lengths, ends)), int(lengths.max()))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each hash, or one past the last."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, len(self.keys))


def _is_word_part(token: bytes) -> bool:
    text = token.decode("utf-8", "replace")
    bare = text[1:] if text.startswith(" ") else text
    return bare == "" or (bare == bare.lower() and all(c.isalpha() or c == "�" for c in bare))


def letter_runs(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray,
                                                   np.ndarray, int]]:
    """Per chunk: first text, its lower-cased bytes, starts and ends of words, their text,
    number of texts."""
    lowered = pc.utf8_lower(texts.fill_null("").cast(pa.large_string()))
    for first, last, data, bounds in ragged.chunks(lowered, CHUNK):
        if not len(data):
            none = np.zeros(0, np.int64)
            yield first, data, none, none, none, last - first
            continue
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
        place = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        letter = classes()[points] == LETTER
        edge = np.zeros(len(points) + 1, bool)
        edge[np.searchsorted(place, bounds)] = True
        opens, closes = letter.copy(), letter.copy()
        opens[1:] &= ~letter[:-1] | edge[1:-1]
        closes[:-1] &= ~letter[1:] | edge[1:-1]
        starts, ends = place[np.flatnonzero(opens)], place[np.flatnonzero(closes) + 1]
        parts = -(-(ends - starts) // LONGEST)
        if len(parts) and parts.max() > 1:  # long runs in stretches
            step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            starts, ends = np.repeat(starts, parts) + step * LONGEST, np.repeat(ends, parts)
            ends = np.minimum(ends, starts + LONGEST)
        yield first, data, starts, ends, ragged.text_of(starts, bounds), last - first


def by_length(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, pieces: Pieces
              ) -> Iterator[tuple[np.ndarray, int, dict[tuple[int, int], np.ndarray]]]:
    """Words of one length: their numbers, the length with the space, and the piece between
    every two places, if it can be one."""
    lengths = ends - starts
    for length in np.unique(lengths):
        words = np.flatnonzero(lengths == length)
        pairs = sum(min(end, pieces.longest) for end in range(1, length + 2))
        for some in np.array_split(words, -(-len(words) * pairs // 4_800_000)):
            block = np.full((len(some), length + 1), 32, np.uint8)
            block[:, 1:] = data[starts[some][:, None] + np.arange(length)]
            flat, row = block.ravel(), np.arange(len(some)) * (length + 1)
            found = {}
            for end in range(1, length + 2):
                for begin in range(max(0, end - pieces.longest), end):
                    found[begin, end] = (row + begin, row + end)
            spans = list(found)
            keys = ragged.hashes(flat, np.concatenate([found[s][0] for s in spans]),
                                 np.concatenate([found[s][1] for s in spans]))
            places = pieces.find(keys).reshape(len(spans), len(some))
            yield some, int(length) + 1, dict(zip(spans, places))


def begins(spans: dict[tuple[int, int], np.ndarray], end: int) -> list[int]:
    return [begin for begin in range(end) if (begin, end) in spans]


def forward(length: int, spans: dict[tuple[int, int], np.ndarray], shares: np.ndarray,
            growth: np.ndarray | float = 1.0) -> list[np.ndarray]:
    """Summed probability of all segmentations of each prefix, per word and language, times
    ``growth`` for each byte.

    ``shares`` has a row of zeros after the last piece.
    """
    sums = [np.ones((len(next(iter(spans.values()))), shares.shape[1]))]
    plain = np.isscalar(growth)
    for end in range(1, length + 1):
        sums.append(sum(sums[begin] * shares[spans[begin, end]]
                        * (1.0 if plain else growth ** (end - begin))
                        for begin in begins(spans, end)))
    return sums


def log_forward(length: int, spans: dict[tuple[int, int], np.ndarray], shares: np.ndarray
                ) -> np.ndarray:
    """log of the last of ``forward``, however small."""
    with np.errstate(divide="ignore"):
        logs = np.log(shares)
    sums = [np.zeros((len(next(iter(spans.values()))), shares.shape[1]))]
    for end in range(1, length + 1):
        whole = np.full_like(sums[0], -np.inf)
        for begin in begins(spans, end):
            whole = np.logaddexp(whole, sums[begin] + logs[spans[begin, end]])
        sums.append(whole)
    return sums[-1]


def log_likelihoods(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, pieces: Pieces,
                    shares: np.ndarray) -> np.ndarray:
    out = np.zeros((len(starts), shares.shape[1]))
    for words, length, spans in by_length(data, starts, ends, pieces):
        whole = forward(length, spans, shares)[-1]
        tiny = np.flatnonzero((whole < TINY).any(1))
        out[words] = np.log(np.maximum(whole, TINY))
        if len(tiny):
            out[words[tiny]] = log_forward(length, {k: v[tiny] for k, v in spans.items()}, shares)
    return out


def fitted(words: list[bytes], counts: np.ndarray, pieces: Pieces, rounds: int) -> np.ndarray:
    """Piece shares per language from word counts (a column per language)."""
    lengths = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(lengths)
    flat = np.frombuffer(b"".join(words), np.uint8)
    groups = [(counts[some].astype(float), length, spans) for some, length, spans in
              by_length(flat, ends - lengths, ends, pieces)]
    size, languages = len(pieces.keys), counts.shape[1]
    shares = np.full((size + 1, languages), 1 / size)
    shares[-1] = 0
    for _ in range(rounds):
        expected = np.zeros_like(shares)
        for weight, length, spans in groups:
            before, growth = forward(length, spans, shares), None
            if (before[-1] < TINY).any():
                growth = np.exp(-log_forward(length, spans, shares) / length)
                before = forward(length, spans, shares, growth)
            after = [np.ones_like(before[0]) for _ in range(length + 1)]
            for begin in range(length - 1, -1, -1):
                after[begin] = sum(shares[spans[begin, end]] * after[end]
                                   * (1.0 if growth is None else growth ** (end - begin))
                                   for end in range(begin + 1, length + 1)
                                   if (begin, end) in spans)
            scale = weight / before[-1]
            for (begin, end), piece in spans.items():
                used = before[begin] * shares[piece] * after[end] * scale
                if growth is not None:
                    used *= growth ** (end - begin)
                for language in range(languages):
                    expected[:, language] += np.bincount(piece, used[:, language], size + 1)
        expected[-1] = 0
        whole = expected.sum(1, keepdims=True) + 0.01
        whole[-1] = 0
        whole /= whole.sum()
        shares = (expected + LEANING * whole) / (expected.sum(0) + LEANING)
    return shares


@dataclass
class Model:
    languages: list[str]
    pieces: Pieces
    shares: np.ndarray


def train(docs: DataFrame, vocabulary: str, sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """A model of the languages in column lang, from about ``sample`` documents of each.

    The sample is chosen by a hash of id and text, so it is the same however the table is
    dealt out; only its word counts reach the driver.
    """
    ship(docs.sparkSession)
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()
                        & (fold(F.col("doc_id")) != HELD_OUT)).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    pieces = Pieces.read(vocabulary)
    if not languages:
        return Model([], pieces, np.zeros((len(pieces.keys) + 1, 0)))
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    share = F.element_at(F.create_map(*(F.lit(x) for name in languages for x in (
        name, min(1.0, sample / sizes[name])))), F.col("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, starts, ends, text, n in letter_runs(batch.column("text")):
                if not len(starts):
                    continue
                whole = data.tobytes()
                words = [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
                langs = batch.column("lang").slice(first, n).take(pa.array(text))
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), langs],
                                                 ["word", "lang"])

    rows = (known.filter(chance < share).mapInArrow(count, "word binary, lang string")
            .groupBy("word", "lang").count().toArrow().sort_by("word"))
    coded = rows.column("word").combine_chunks().dictionary_encode()
    words = coded.dictionary.to_pylist()
    if not words:
        return Model([], pieces, np.zeros((len(pieces.keys) + 1, 0)))
    counts = np.zeros((len(words), len(languages)))
    spoken = pc.index_in(rows.column("lang"), pa.array(languages)).to_numpy()
    counts[coded.indices.to_numpy(), spoken] = rows.column("count").to_numpy()
    model = Model(languages, pieces, fitted(words, counts, pieces, rounds))
    # The driver goes on to other work, and need not hold what fitting took.
    del rows, coded, words, counts, spoken
    ragged.release()
    return model


# Of a worker: what it knows of words, by the model it saw last.
_MEMORIES: dict[str, ragged.Memory] = {}


def with_language(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (or all) of ``docs`` in a struct ``row``, lang_pred and score.

    ``score`` is the posterior probability of the language, all being as likely before.
    A text that is null or has no letter is ``und`` with score 0, as is every text for a
    model without languages. Only the text decides: equal texts get equal results. Null
    ids, repeated rows and other columns do not matter; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    token = uuid.uuid4().hex

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        if token not in _MEMORIES:
            _MEMORIES.clear()
        memory = _MEMORIES.setdefault(token, ragged.Memory(1 << 20))
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            row = batch.column("row")
            texts = batch.column("text") if apart else row.field("text")
            best = np.full(batch.num_rows, len(model.languages))
            score = np.zeros(batch.num_rows)
            for first, data, starts, ends, text, n in letter_runs(texts):
                if not len(starts) or not model.languages:
                    continue
                keys, places, which = ragged.distinct(ragged.hashes(data, starts, ends))
                begin, end = starts[places], ends[places]
                known = memory.get(keys, lambda new: log_likelihoods(
                    data, begin[new], end[new], model.pieces, model.shares))[which]
                total = np.stack([np.bincount(text, known[:, k], n)
                                  for k in range(known.shape[1])], 1)
                has = np.bincount(text, minlength=n) > 0
                top = total.argmax(1)
                odds = np.exp(total - total.max(1, keepdims=True)).sum(1)
                best[first:first + n][has] = top[has]
                score[first:first + n][has] = 1 / odds[has]
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(names[best], pa.string()), pa.array(score)],
                ["row", "lang_pred", "score"])
        ragged.release()

    keep = keep or docs.columns
    apart = "text" not in keep
    rows = docs.select(F.struct(*(docs[c] for c in keep)).alias("row"),
                       *([docs["text"]] if apart else []))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(predict, f"row {kind}, lang_pred string, score double")


def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = train(docs, public_vocabulary("byte_bpe_multi_50k.tiktoken"))
    # The prediction sees id and text alone.
    found = with_language(docs.select("doc_id", "text"), model, ["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"),
                        (fold(F.col("row.doc_id")) == HELD_OUT).alias("held_out"),
                        "lang_pred", "score")
