"""Ranked lexical search over bit-sliced Bloom signatures.

Each document has a Bloom signature of its terms. Documents of like length form blocks; a
block is stored by slices: for each bit of the signature, a bitmap with one bit per document.
The bitmaps of a term's bits, and-ed, cover every document that holds the term and a few
more. A term is entered once per frequency level it reaches, so the bitmaps also bound how
often a document holds it. Weighted sums over these bitmaps are upper bounds of scores.

A search reads the index twice. First it takes, per item, the documents of the highest
bounds and scores them exactly; the k-th best of these scores is a floor that the true
k-th best cannot be below. Then every document whose bound reaches a floor is scored
exactly: none is left out unless its bound proves that it cannot be among the best.

Items are taken in blocks; what goes to the workers is their terms, weights and floors.
Best lists are kept per task, then per item in two rounds, so no task gets more than k rows
of another. Terms are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidegauge.llm import ragged
from tidegauge.llm.tables import if_small, kept, ship, table

BEST = 20
# Documents of a block, bytes of its slices, bits of a signature per entry and per document.
BLOCK_DOCS = 2048
SLICE_BYTES = 1 << 21
BITS = 12
HASHES = 3
# Least number of occurrences of each frequency level.
LEVELS = (1, 2, 3, 5, 9, 17, 33)
# Entries held back until their blocks are full.
HELD = 1 << 21
# Documents with the highest bounds that set the floor of an item.
SCOUTS = 64
# Items, and bytes of their texts, that are searched for together.
ITEMS = 512
ITEM_BYTES = 1 << 24
SALTS = 64

U64 = np.uint64
# All ASCII bytes but digits and letters stand between terms.
BETWEEN = np.zeros(256, bool)
BETWEEN[:0x80] = True
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    BETWEEN[_low:_high + 1] = False


def text_terms(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: first text, its texts' different terms (hashes, flat), how often each
    occurs, and how many different ones each text has."""
    for first, last, data, bounds in ragged.chunks(texts):
        starts, ends, owner = ragged.words(data, bounds, BETWEEN)
        keys = ragged.hashes(ragged.LOWERED[data], starts, ends)
        order = np.lexsort((keys, owner))
        keys, owner = keys[order], owner[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(keys)))
        yield first, keys[at], times, np.bincount(owner[at], minlength=last - first)


def per_text(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the flat values of each text."""
    sums = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


def statistics(docs: DataFrame, terms: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms with repeats, and the documents that hold each
    of the ascending ``terms``. Every task sends one row per term at most."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        found = np.zeros(len(known) + 2, np.int64)
        for batch in batches:
            for _, keys, times, sizes in text_terms(batch.column("text")):
                found[-2] += np.count_nonzero(sizes)
                found[-1] += times.sum()
                if len(known):
                    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                    found[:-2] += np.bincount(at[known[at] == keys], minlength=len(known))
        ragged.release()
        places = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(found[places])],
                                         ["place", "n"])

    counts = docs.select("text").mapInArrow(run, "place long, n long")
    total = np.zeros(len(terms) + 2, np.int64)
    for row in counts.groupBy("place").agg(F.sum("n").alias("n")).collect():
        total[row["place"]] = row["n"]
    return int(total[-2]), int(total[-1]), total[:-2]


# The index.

def bit_places(keys: np.ndarray, level: int, width: int) -> np.ndarray:
    """Bits of a term at a frequency level, one row per term."""
    first = ragged.mixed(keys + U64((level + 1) * 0xA24BAED4963EE407 % 2 ** 64))
    step = ragged.mixed(first ^ U64(0x5851F42D4C957F2D)) | U64(1)
    return np.stack([((first + step * U64(j)) % U64(width)) for j in range(HASHES)],
                    1).astype(np.int64)


def block_of(held: list[tuple], width: int) -> list:
    """One row of the index: width, documents' ids and lengths, slices."""
    count = len(held)
    across = -(-count // 8) * 8
    bits = np.zeros((width, across), bool)
    for at, (_, _, keys, times) in enumerate(held):
        for level, least in enumerate(LEVELS):
            entered = keys if least == 1 else keys[times >= least]
            if not len(entered):
                break
            bits[bit_places(entered, level, width), at] = True
    return [width, [h[0] for h in held], [h[1] for h in held],
            np.packbits(bits, axis=1, bitorder="little").tobytes()]


def signature_index(docs: DataFrame) -> DataFrame:
    """width, ids, lengths, slices: a row per block of documents that have a term.

    A signature has ``BITS`` bits for each entry its length class allows, so long documents
    are covered as tightly as short ones.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[int, list[tuple]] = {}
        weight: dict[int, int] = {}

        def rows(width: int) -> pa.RecordBatch:
            del weight[width]
            columns = zip(block_of(open_blocks.pop(width), width))
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["width", "ids", "lengths", "slices"])

        for batch in batches:
            ids = batch.column("doc_id")
            for first, keys, times, sizes in text_terms(batch.column("text")):
                lengths = per_text(times, sizes)
                entries = per_text(np.searchsorted(LEVELS, times, "right"), sizes)
                ends = np.cumsum(sizes)
                for i in np.flatnonzero(sizes).tolist():
                    width = BITS << int(entries[i] - 1).bit_length()
                    part = slice(ends[i] - sizes[i], ends[i])
                    open_blocks.setdefault(width, []).append(
                        (ids[first + i].as_py(), int(lengths[i]), keys[part].copy(),
                         times[part].astype(np.int32)))
                    weight[width] = weight.get(width, 0) + int(sizes[i])
                    most = min(BLOCK_DOCS, max(8, SLICE_BYTES * 8 // width))
                    if len(open_blocks[width]) >= most:
                        yield rows(width)
                while sum(weight.values()) > HELD:
                    yield rows(max(weight, key=weight.get))
        for width in list(open_blocks):
            yield rows(width)
        ragged.release()

    return docs.select("doc_id", "text").mapInArrow(
        run, "width long, ids array<long>, lengths array<long>, slices binary")


# Searching.

@dataclass
class Items:
    """Items of a block: the terms of all, ascending, and each item's share of them."""

    ids: list
    terms: np.ndarray
    places: np.ndarray  # of each item's different terms, flat
    repeats: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray | None = None  # of the terms
    scale: tuple[int, int] = (0, 0)  # documents and terms of the corpus

    @staticmethod
    def of(rows: pa.Table) -> Items:
        parts = list(text_terms(rows.column("text")))
        keys, times, sizes = (np.concatenate([p[k] for p in parts]) if parts else
                              np.zeros(0, kind) for k, kind in ((1, U64), (2, int), (3, int)))
        terms, places = np.unique(keys, return_inverse=True)
        return Items(rows.column("item_id").to_pylist(), terms, places, times, sizes)

    def weigh(self, documents: int, total: int, holding: np.ndarray) -> None:
        self.scale = documents, total
        self.weights = np.floor(1000 * np.log(
            (2 * documents + 2) / (2 * holding + 1))).astype(np.int64)

    def lengths_scale(self, lengths: np.ndarray) -> np.ndarray:
        """m of documents with so many terms."""
        documents, total = self.scale
        return 75 + 25 * lengths * documents // total


def share(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term of weight 1 that occurs so often adds to a score; grows with ``times``."""
    return 1_000_000_000 * times // (1000 * times + 12 * m)


def bounds_of(items: Items, width: int, lengths: np.ndarray, slices: bytes) -> np.ndarray:
    """Upper bounds of scores, items by documents of a block."""
    count = len(lengths)
    table_ = np.frombuffer(slices, np.uint8).reshape(width, -1)
    m = items.lengths_scale(lengths)
    ends = np.cumsum(items.sizes)
    out = np.zeros((len(items.sizes), count))
    below, covered = np.zeros(count, np.int64), None
    for level in range(len(LEVELS)):
        if covered is None:
            at = np.arange(len(items.terms))
        else:
            at = np.flatnonzero(covered.any(axis=1))
        if not len(at) or LEVELS[level] > lengths.max():
            break
        places = bit_places(items.terms[at], level, width)
        seen = table_[places[:, 0]]
        for j in range(1, HASHES):
            seen &= table_[places[:, j]]
        if covered is not None:
            seen &= covered[at]
        covered = np.zeros((len(items.terms), table_.shape[1]), np.uint8)
        covered[at] = seen
        most = lengths if level + 1 == len(LEVELS) else np.minimum(lengths, LEVELS[level + 1] - 1)
        above = share(most, m)
        held = covered.any(axis=1)
        for i, end in enumerate(ends):
            own = slice(end - items.sizes[i], end)
            places = items.places[own]
            use = held[places]
            if use.any():
                worth = (items.weights[places] * items.repeats[own])[use].astype(np.float64)
                bits = np.unpackbits(covered[places[use]], axis=1, count=count,
                                     bitorder="little")
                out[i] += (worth @ bits.astype(np.float64)) * (above - below)
        below = above
    return out * (1 + 1e-12)


def promising(index: DataFrame, items: Items, floors: np.ndarray | None) -> DataFrame:
    """Without floors: (item, doc_id, bound), the ``SCOUTS`` highest bounds of each task and
    item. With them: the doc_id of every document whose bound reaches a floor."""
    shared = index.sparkSession.sparkContext.broadcast((items, floors))

    def blocks(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].values
                yield ids, bounds_of(
                    shared.value[0], batch.column("width")[i].as_py(),
                    batch.column("lengths")[i].values.to_numpy(), batch.column("slices")[i].as_py())

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = len(shared.value[0].sizes)
        rows = pa.table({"item": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64()),
                         "bound": pa.array([], pa.float64())})
        for ids, bounds in blocks(batches):
            most = min(SCOUTS, bounds.shape[1])
            at = np.argpartition(-bounds, most - 1, axis=1)[:, :most]
            new = pa.table({"item": np.repeat(np.arange(count), most),
                            "doc_id": ids.take(pa.array(at.ravel())),
                            "bound": np.take_along_axis(bounds, at, 1).ravel()})
            rows = pa.concat_tables([rows, new])
            if rows.num_rows > 8 * SCOUTS * count:
                rows = best_rows(rows, "bound", SCOUTS)
        ragged.release()
        yield from best_rows(rows, "bound", SCOUTS).to_batches()

    def reaching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, bounds in blocks(batches):
            reach = (bounds >= np.maximum(shared.value[1], 1)[:, None]).any(axis=0)
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(reach))], ["doc_id"])
        ragged.release()

    if floors is None:
        return index.mapInArrow(highest, "item long, doc_id long, bound double")
    return index.mapInArrow(reaching, "doc_id long").distinct()


def best_rows(rows: pa.Table, by: str, most: int) -> pa.Table:
    """Of each item the rows with the most, equal ones by ascending doc_id, nulls last."""
    rows = rows.combine_chunks().sort_by([("item", "ascending"), (by, "descending"),
                                          ("doc_id", "ascending")])
    item = rows.column("item").to_numpy()
    places = np.arange(len(item)) - np.searchsorted(item, item)
    return rows.filter(pa.array((places < most) & (rows.column(by).to_numpy() > 0)))


def scored(docs: DataFrame, items: Items, best: int) -> DataFrame:
    """(item, doc_id, score): exact scores over 0, the best of each task and item."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        some = np.flatnonzero(items.sizes)  # items with a term
        starts = (np.cumsum(items.sizes) - items.sizes)[some]
        worth = items.weights[items.places] * items.repeats
        rows, held = [], 0

        def cut() -> pa.Table:
            item, doc_id, score = zip(*rows)
            return best_rows(pa.table({
                "item": np.concatenate(item), "doc_id": pa.concat_arrays(doc_id),
                "score": np.concatenate(score)}), "score", best)

        for batch in batches:
            ids = batch.column("doc_id")
            for first, keys, times, sizes in text_terms(batch.column("text")):
                m = items.lengths_scale(per_text(times, sizes)) if items.scale[1] else None
                at = np.minimum(np.searchsorted(items.terms, keys), len(items.terms) - 1)
                known = items.terms[at] == keys
                ends = np.cumsum(sizes)
                for i in np.flatnonzero(sizes).tolist():
                    part = slice(ends[i] - sizes[i], ends[i])
                    shares = np.zeros(len(items.terms), np.int64)
                    own = known[part]
                    shares[at[part][own]] = share(times[part][own], m[i])
                    score = np.add.reduceat(worth * shares[items.places], starts)
                    hit = np.flatnonzero(score)
                    rows.append((some[hit], ids.slice(first + i, 1).take(
                        pa.array(np.zeros(len(hit), np.int64))), score[hit]))
                    held += len(hit)
                    if held > 16 * best * len(items.sizes):
                        done = cut()
                        rows = [tuple(done.column(c).combine_chunks() if c == "doc_id" else
                                      done.column(c).to_numpy() for c in done.column_names)]
                        held = len(rows[0][0])
        ragged.release()
        if rows:
            yield from cut().to_batches()

    return docs.select("doc_id", "text").mapInArrow(run, "item long, doc_id long, score long")


def top(rows: DataFrame, by: str, most: int) -> DataFrame:
    """The best rows per item with their rank; parts of an item first, as many tasks send
    rows of it."""
    order = [F.desc(by), F.asc_nulls_last("doc_id")]
    some = Window.partitionBy("item", "salt").orderBy(*order)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", by), F.lit(SALTS)))
    fewer = salted.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= most)
    every = Window.partitionBy("item").orderBy(*order)
    return (fewer.drop("salt", "rank").withColumn("rank", F.row_number().over(every))
            .filter(F.col("rank") <= most))


def _of_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    ids = if_small(ids.select(F.col("doc_id").alias("_chosen")))
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_chosen"]), "left_semi")


def _search(docs: DataFrame, index: DataFrame, items: Items, best: int) -> DataFrame:
    documents, total, holding = statistics(docs, items.terms)
    items.weigh(documents, total, holding)
    scouts = top(promising(index, items, None), "bound", max(SCOUTS, best))
    scouts = kept(scouts.select("doc_id").distinct(), "search-scouts")
    first = top(scored(_of_ids(docs, scouts), items, best), "score", best)
    floors = np.zeros(len(items.sizes), np.int64)
    for row in first.filter(F.col("rank") == best).select("item", "score").collect():
        floors[row["item"]] = row["score"]
    chosen = kept(promising(index, items, floors), "search-chosen")
    names = docs.sparkSession.createDataFrame(
        list(enumerate(items.ids)), "number long, item_id long")
    found = kept(top(scored(_of_ids(docs, chosen), items, best), "score", best), "search-best")
    return found.join(F.broadcast(names), found["item"] == names["number"]).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents of each row of ``queries`` (item_id,
    text) among all rows of ``docs`` (doc_id, text).

    Terms are runs of ASCII digits and letters and of all other characters beyond ASCII, A-Z
    lower-cased. Equal scores come by ascending doc_id, null ids last; ranks are unique.
    Every row of ``docs`` is a document of its own, whatever its id, and every row of
    ``queries`` an item of its own, so repeated rows give repeated rows. A null text has no
    terms: as a document it is not found and does not count, as an item it finds nothing.
    Texts of any length are read whole. Without documents or items there are no rows.
    Other columns do not matter.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    rows = kept(queries.select(queries["item_id"].cast("long").alias("item_id"), queries["text"],
                               F.monotonically_increasing_id().alias("number")), "search-items")
    size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    parts = max(1, -(-size[0] // ITEMS), -(-(size[1] or 0) // ITEM_BYTES))
    index = kept(signature_index(docs), "signatures")
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for part in range(parts):
        own = rows.filter(F.pmod(F.xxhash64("number"), F.lit(parts)) == part)
        items = Items.of(own.select("item_id", "text").toArrow())
        if len(items.terms):
            found = found.union(_search(docs, index, items, best))
    return found


def op13(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


OP13_SQL = r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, corpus GROUP BY term, docs),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT a.item_id, c.doc_id,
         sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 12 * (75 + (25 * l.n * docs) // total))))
           ::BIGINT AS score
  FROM asked a JOIN counts c ON a.term = c.term JOIN weights w ON a.term = w.term
  JOIN lengths l ON c.doc_id = l.doc_id, corpus
  GROUP BY a.item_id, c.doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank,
         doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
