"""Jaccard self-join of documents on word n-grams with token-combination prefixes.

Tokens are 64-bit hashes of shingles. The join runs in steps that each touch less:

1. Documents with the same set are one class. In a fixed random order of tokens, the
   first half of a set must share a known number of tokens with the same part of any
   set it links to; counting shared tokens leaves the few classes that can link at all.
   Counts are combined per block before the shuffle, so a token of very many documents
   sends one row per block.
2. Tokens that many candidates hold are frequent, at most ``MOST_FREQUENT`` of them. A
   candidate's tokens are ordered rare ones first. Its prefix is indexed by single rare
   tokens and, for frequent tokens, by pairs within small classes of them; the prefix is
   extended by a token per class, so that two linked sets share a signature still.
3. Neighbours under a signature, in a random order, are verified first. This connects
   large groups of near copies without looking at all their pairs. Then, under each
   signature, all pairs of different components are verified, so no link is lost that
   could change a component.

Before two sets are compared, bounds on size, position and a parity sketch (which never
reject a link) are applied, then tokens decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegauge.llm import ragged
from tidegauge.llm.components import components
from tidegauge.llm.tables import if_small, kept, ship, table

WORDS = 5
PERCENT = 75
# Least number of candidates that makes a token frequent, and most tokens that are.
FREQUENT = 128
MOST_FREQUENT = 100_000
# Classes of frequent tokens; pairs are formed within one.
CLASSES = 24
CELL_DOCS = 4096
# Tokens whose counts are combined before the shuffle, and bytes of text handled at once.
BLOCK = 1 << 20
CHUNK = 1 << 20
SKETCH = 2048  # bits

U64 = np.uint64
_PLACE = np.random.Generator(np.random.PCG64(91)).integers(
    1, 2 ** 64, 64, dtype=np.uint64, endpoint=False) | U64(1)


def errors(n, percent: int):
    """Most tokens of a set of n that a linked set can lack."""
    return n - -(-percent * n // 100)


def shingle_sets(texts: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per chunk: first text, its texts' different tokens in ascending order, flat, and
    their numbers. A text with fewer words is one token; one without words has none."""
    place = _PLACE[:words]
    for first, last, data, bounds in ragged.chunks(texts, CHUNK):
        lowered = ragged.LOWERED[data]
        starts, ends, text = ragged.words(data, bounds)
        word = ragged.hashes(lowered, starts, ends)
        n_words = np.bincount(text, minlength=last - first)
        size = max(0, len(word) - words + 1)
        tokens = np.zeros(size, U64)
        for k in range(words):
            tokens += word[k:k + size] * place[k]
        inside = text[words - 1:] == text[:size] if size else np.zeros(0, bool)
        tokens, owner = ragged.mixed(tokens[inside]), text[:size][inside]
        short = np.flatnonzero((n_words > 0) & (n_words < words))
        if len(short):
            begin = np.searchsorted(text, short)
            whole = np.zeros(len(short), U64)
            for k in range(words - 1):
                has = n_words[short] > k
                whole[has] += word[begin[has] + k] * place[k]
            whole = ragged.mixed(whole + n_words[short].astype(U64) * U64(0xA24BAED4963EE407))
            tokens, owner = np.concatenate([tokens, whole]), np.concatenate([owner, short])
        order = np.lexsort((tokens, owner))
        tokens, owner = tokens[order], owner[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
        tokens, owner = tokens[new], owner[new]
        yield first, tokens, np.bincount(owner, minlength=last - first)


def set_ids(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit id of each set."""
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(ragged.mixed(tokens + U64(0x51ED270B)),
                                                       dtype=U64)])
    ends = np.cumsum(sizes)
    return ragged.mixed(sums[ends] - sums[ends - sizes] + sizes.astype(U64)).view(np.int64)


def documents_of(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n (size of the set), set_id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, tokens, sizes in shingle_sets(batch.column("text"), words):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(sizes)),
                     pa.array(sizes.astype(np.int64)), pa.array(set_ids(tokens, sizes))],
                    ["doc_id", "n", "set_id"])
        ragged.release()

    return docs.select(docs["doc_id"], docs["text"]).mapInArrow(
        run, "doc_id long, n long, set_id long")


# Step 1: which classes share enough tokens to link at all.

_PARTS = [("low", "<u4"), ("owner", "<u8"), ("many", "<u4"), ("own", "<u8"),
          ("own_shared", "<u4")]


def _combined(tokens: np.ndarray, owners: np.ndarray, cells: int) -> Iterator[list]:
    """Rows (cell, parts) of one block: tokens of one owner with it, others once without.

    What several owners of the block share is credited to them here.
    """
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    firsts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    lengths = np.diff(np.append(firsts, len(tokens)))
    alone = np.repeat(lengths == 1, lengths)
    own, counts = np.unique(owners[~alone], return_counts=True)
    head = tokens[firsts][lengths > 1]
    arrays = {"low": tokens[alone], "owner": owners[alone], "many": head, "own": own,
              "own_shared": counts}
    keys = {"low": tokens[alone], "many": head, "own": own}
    cell_of = {name: cell_numbers(values, cells) for name, values in keys.items()}
    some = np.unique(np.concatenate(list(cell_of.values())))
    leader = {"low": "low", "owner": "low", "many": "many", "own": "own", "own_shared": "own"}
    cut = {}
    for name, cell in cell_of.items():
        by = np.argsort(cell, kind="stable")
        cut[name] = by, *(np.searchsorted(cell[by], some, side) for side in ("left", "right"))
    sorted_ = {name: (arrays[name] & U64(0xFFFFFFFF) if name in ("low", "many")
                      else arrays[name]).astype(kind)[cut[leader[name]][0]]
               for name, kind in _PARTS}
    for at, cell in enumerate(some.tolist()):
        yield [cell, *(sorted_[name][cut[leader[name]][1][at]:cut[leader[name]][2][at]].tobytes()
                       for name, _ in _PARTS)]


def cell_numbers(tokens: np.ndarray, cells: int) -> np.ndarray:
    return ((tokens >> U64(32)) % U64(cells)).astype(np.int64)


def _counted(rows: pa.Table) -> pa.Table:
    """(set_id, n) of one cell: the tokens in it that a set shares with another."""
    parts = {name: np.frombuffer(b"".join(rows.column(name).to_pylist()), kind)
             for name, kind in _PARTS}
    order = np.lexsort((parts["owner"], parts["low"]))
    low, owner = parts["low"][order], parts["owner"][order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])
    low, owner = low[new], owner[new]
    names, which = np.unique(np.concatenate([low, parts["many"]]), return_inverse=True)
    alone, many = which[:len(low)], which[len(low):]
    singles = np.bincount(alone, minlength=len(names))
    both = (singles + 2 * np.bincount(many, minlength=len(names)))[alone] > 1
    sets, at = np.unique(np.concatenate([owner[both], parts["own"]]), return_inverse=True)
    weights = np.concatenate([np.ones(both.sum()), parts["own_shared"]])
    shared = np.bincount(at, weights, len(sets)).astype(np.int64)
    return pa.table([pa.array(sets.view(np.int64)), pa.array(shared)], ["set_id", "n"])


def shared_counts(docs: DataFrame, words: int, percent: int, cells: int) -> DataFrame:
    """Rows of ``_counted`` over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            whole = [np.concatenate(x) for x in zip(*held)]
            held.clear()
            columns = list(zip(*_combined(*whole, cells)))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()),
                 *(pa.array(column, pa.binary()) for column in columns[1:])],
                ["cell", *(name for name, _ in _PARTS)])

        held: list[tuple] = []
        seen: set[int] = set()
        size = 0
        for batch in batches:
            for _, tokens, sizes in shingle_sets(batch.column("text"), words):
                ids = set_ids(tokens, sizes)
                fresh = np.zeros(len(ids), bool)
                for i, number in enumerate(ids.tolist()):
                    if sizes[i] and number not in seen:
                        seen.add(number)
                        fresh[i] = True
                starts = np.cumsum(sizes) - sizes
                rank = np.arange(len(tokens)) - np.repeat(starts, sizes)
                limit = errors(sizes, percent) + np.maximum(1, sizes * (100 - percent) // 100)
                keep = np.repeat(fresh, sizes) & (rank < np.repeat(limit, sizes))
                held.append((tokens[keep], np.repeat(ids.view(U64), sizes)[keep]))
                size += int(keep.sum())
                if size >= BLOCK:
                    yield flush()
                    size = 0
                    seen.clear()
                    ragged.release()
        if size:
            yield flush()
        ragged.release()

    schema = "cell long, " + ", ".join(f"{name} binary" for name, _ in _PARTS)
    blocks = docs.select(docs["text"]).mapInArrow(run, schema)
    return blocks.groupBy("cell").applyInArrow(_counted, "set_id long, n long")


def frequent_tokens(sets: DataFrame, least: int, most: int) -> np.ndarray:
    """Tokens of at least ``least`` sets, ascending. The bar doubles until they are few enough,
    so what goes to the workers is bounded whatever the input."""
    counts = kept(sets.select(F.explode("tokens").alias("token")).groupBy("token")
                  .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least), "frequent")
    steps = (counts.groupBy(F.floor(F.log2("n")).alias("power")).count()
             .orderBy(F.desc("power")).collect())
    total, bar = 0, None
    for step in steps:
        total += step["count"]
        if total > most:
            break
        bar = step["power"]
    if bar is None:
        return np.zeros(0, U64)
    rows = counts.filter(F.col("n") >= 2.0 ** bar).select("token").toArrow()
    return np.sort(rows.column("token").to_numpy().view(U64))


# Step 2: token sets and signatures of the candidates.

def candidate_sets(texts: DataFrame, words: int) -> DataFrame:
    """set_id, n, tokens (ascending), bits (parity sketch), one row per set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, tokens, sizes in shingle_sets(batch.column("text"), words):
                ids = set_ids(tokens, sizes)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                spot = (ragged.mixed(tokens ^ U64(77)) >> U64(64 - 11)).astype(np.int64)
                odd = np.bincount(owner * SKETCH + spot, minlength=len(sizes) * SKETCH) & 1
                bits = np.packbits(odd.astype(np.uint8).reshape(-1, SKETCH), axis=1,
                                   bitorder="little").view("<i8")
                wide = np.arange(0, bits.size + 1, SKETCH // 64, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(sizes.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens.view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(wide), pa.array(bits.ravel()))],
                    ["set_id", "n", "tokens", "bits"])
        ragged.release()

    found = texts.select(texts["text"]).mapInArrow(
        run, "set_id long, n long, tokens array<long>, bits array<long>")
    return found.groupBy("set_id").agg(
        F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.first("bits").alias("bits"))


def signed(tokens: np.ndarray, sizes: np.ndarray, frequent: np.ndarray, percent: int
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signature, set number and room of the extended prefixes of flat sets.

    Room bounds the overlap of two sets at the first signature they share. Before the first
    shared pair of frequent tokens, each earlier class has one common token at most, and
    between the two there is none.
    """
    # Where the classes of frequent tokens cannot cost too much of a small set, single
    # tokens serve all; sets of the size between are indexed both ways.
    least = -(-(CLASSES + 1) * 100 // percent)
    both = -(-least * 100 // percent)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    often = np.zeros(len(tokens), bool)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        often = frequent[at] == tokens
    group = np.where(often, (ragged.mixed(tokens ^ U64(5)) % U64(CLASSES)).astype(np.int64), -1)
    order = np.lexsort((tokens, group, owner))
    tokens, often, group = tokens[order], often[order], group[order]
    n = sizes[owner]
    starts = (np.cumsum(sizes) - sizes)[owner]
    paired = n >= least
    turn = np.ones(len(tokens), bool)
    turn[1:] = (group[1:] != group[:-1]) | (owner[1:] != owner[:-1])
    gain = ~(often & paired & turn)
    covered = np.cumsum(gain)
    covered = covered - (covered - gain)[starts] if len(tokens) else covered
    chosen = covered - gain < errors(n, percent) + 1
    room = n - (np.arange(len(tokens)) - starts)
    single = np.flatnonzero(chosen & (~often | (n < both)))
    found = [(tokens[single], owner[single], room[single])]
    left = np.flatnonzero(chosen & often & paired)
    for step in range(1, len(left)):
        a, b = left[:-step], left[step:]
        same = (owner[a] == owner[b]) & (group[a] == group[b])
        if not same.any():
            break
        a, b = a[same], b[same]
        found.append((ragged.mixed(tokens[a] * U64(3) + ragged.mixed(tokens[b])), owner[a],
                      room[b] + 1 + group[a]))
    signature, owner, room = (np.concatenate(x) for x in zip(*found))
    return signature.view(np.int64), owner, room


def signatures(sets: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """signature, set_id, n, room, k0..k3 (sketch folded to 256 bits)."""
    shared = sets.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                column = part.column("tokens")
                sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                tokens = column.flatten().to_numpy(zero_copy_only=False).view(U64)
                signature, owner, room = signed(tokens, sizes, shared.value, percent)
                folded = np.bitwise_xor.reduce(
                    part.column("bits").flatten().to_numpy(zero_copy_only=False)
                    .reshape(len(sizes), -1, 4), axis=1)
                ids = part.column("set_id").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signature), pa.array(ids[owner]),
                     pa.array(sizes[owner].astype(np.int32)), pa.array(room.astype(np.int32)),
                     *(pa.array(folded[owner, k]) for k in range(4))],
                    ["signature", "set_id", "n", "room", "k0", "k1", "k2", "k3"])
        ragged.release()

    return sets.select("set_id", "tokens", "bits").mapInArrow(
        run, "signature long, set_id long, n int, room int, k0 long, k1 long, k2 long, k3 long")


# Step 3: pairs and their verification.

def _needed(total: Column, percent: int) -> Column:
    """Least overlap of two linked sets, by the sum of their sizes."""
    return F.ceil(total * percent / (100 + percent) - 1e-9)


def neighbours(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b) that stand side by side under a signature, in a random order of sets.

    Any signature will do here, so the bound on positions is not applied. Ranges of the
    order are dealt to tasks, so a signature of very many sets is split.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            rows = [batch.column(c).to_numpy(zero_copy_only=False)
                    for c in ("signature", "set_id", "n")]
            if before is not None:
                rows = [np.concatenate([x, y]) for x, y in zip(before, rows)]
            before = [x[-1:] for x in rows]
            signature, sets, n = rows
            total = n[1:].astype(np.int64) + n[:-1]
            needed = -(-total * percent // (100 + percent))
            fits = ((signature[1:] == signature[:-1]) & (sets[1:] != sets[:-1])
                    & (np.minimum(n[1:], n[:-1]) >= needed))
            a, b = np.minimum(sets[1:], sets[:-1])[fits], np.maximum(sets[1:], sets[:-1])[fits]
            pairs = np.unique(np.stack([a, b], 1), axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])
        ragged.release()

    ordered = (entries.select("signature", "set_id", "n", F.xxhash64("set_id").alias("place"))
               .repartitionByRange("signature", "place").sortWithinPartitions("signature", "place"))
    return ordered.mapInArrow(run, "a long, b long").distinct()


def cross_pairs(entries: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different components that share a signature, as far as bounds allow a link.

    Under each signature the largest component is only paired with the others, never
    with itself.
    """
    entries = entries.join(if_small(labels), entries["set_id"] == labels["node"], "left").select(
        "signature", "set_id", "n", "room", "k0", "k1", "k2", "k3",
        F.coalesce("component", "set_id").alias("component"))
    main = (entries.groupBy("signature", "component").count().groupBy("signature")
            .agg(F.max_by("component", "count").alias("main"), F.count(F.lit(1)).alias("parts"))
            .filter("parts > 1").select("signature", "main"))
    mixed = kept(entries.join(main, "signature"), "signatures")
    one = mixed.filter("component <> main").alias("x")
    other = mixed.alias("y")
    col = F.col
    needed = _needed(col("x.n") + col("y.n"), percent)
    differing = sum((F.bit_count(col(f"x.k{k}").bitwiseXOR(col(f"y.k{k}"))) for k in range(4)),
                    F.lit(0))
    return (one.join(other, (col("x.signature") == col("y.signature"))
                     & (col("x.component") != col("y.component"))
                     & ((col("y.component") == col("y.main")) | (col("x.set_id") < col("y.set_id")))
                     & (F.least(col("x.n"), col("y.n"), col("x.room"), col("y.room")) >= needed)
                     & (differing <= col("x.n") + col("y.n") - 2 * needed))
            .select(F.least("x.set_id", "y.set_id").alias("a"),
                    F.greatest("x.set_id", "y.set_id").alias("b")).distinct())


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link: first the whole sketches, then the tokens."""
    def both(pairs: DataFrame, *what: str) -> DataFrame:
        ends = pairs.select("a", "b", F.col("a").alias("set_id")).union(
            pairs.select("a", "b", F.col("b").alias("set_id")))
        return (sets.select("set_id", "n", *what).join(if_small(ends), "set_id")
                .groupBy("a", "b").agg(F.sum("n").alias("total"),
                                       *(F.collect_list(w).alias(w) for w in what)))

    drawn = both(pairs, "bits")
    differing = F.aggregate(
        F.zip_with(F.get("bits", F.lit(0)), F.get("bits", F.lit(1)),
                   lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    near = drawn.filter(differing <= F.col("total") - 2 * _needed(F.col("total"), percent))
    near = kept(near.select("a", "b"), "near-pairs")
    common = F.size(F.array_intersect(F.get("tokens", F.lit(0)), F.get("tokens", F.lit(1))))
    return both(near, "tokens").filter(
        common * 100 >= (F.col("total") - common) * percent).select("a", "b")


def joined_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components once more links are known. The links of two components count once, so many
    between large ones cost no rounds."""
    def lifted(links: DataFrame, end: str) -> DataFrame:
        return links.join(if_small(labels), links[end] == labels["node"], "left").withColumn(
            end, F.coalesce("component", end)).select("a", "b")

    above = components(lifted(lifted(links, "a"), "b").distinct())
    upper = above.select(F.col("node").alias("of"), F.col("component").alias("to"))
    every = labels.union(above.select("node", F.col("node").alias("component"))).distinct()
    return every.join(upper, every["component"] == upper["of"], "left").select(
        "node", F.coalesce("to", "component").alias("component"))


def jaccard_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, the smallest doc_id reachable by links.

    Two documents link when 100 * |x & y| >= percent * |x | y| over their sets of
    lower-cased word shingles. A text with fewer words is one shingle; a null text or one
    without words has none and links with nothing. Equal texts link. Null ids take part,
    but name no component unless all its ids are null. Repeated rows are in one
    component; an empty table gives no rows; other columns are ignored.
    """
    ship(docs.sparkSession)
    docs = docs.select(docs["doc_id"], docs["text"])
    rows = kept(documents_of(docs, words), "shingled")
    cells = max(64, -(-rows.count() // CELL_DOCS))
    classes = rows.filter("n > 0").groupBy("set_id").agg(
        F.first("n").alias("n"), F.min("doc_id").alias("doc_id"))
    counts = kept(shared_counts(docs, words, percent, cells), "shared-tokens")
    shared = counts.groupBy("set_id").agg(F.sum("n").alias("shared"))
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100 - 1e-9)
                                         * (100 - percent) / 100))
    able = kept(classes.join(shared, "set_id").filter(F.col("shared") >= least)
                .select("set_id", F.col("doc_id").alias("of")), "candidates")
    chosen = if_small(able.select("of").distinct())
    texts = docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["of"]), "left_semi")
    sets = kept(candidate_sets(texts, words), "candidate-sets")
    frequent = frequent_tokens(sets, FREQUENT, MOST_FREQUENT)
    entries = signatures(sets, frequent, percent)
    links = kept(verified(kept(neighbours(entries, percent), "pairs"), sets, percent), "near")
    labels = components(links)
    more = kept(verified(kept(cross_pairs(entries, labels, percent), "pairs"), sets, percent),
                "near")
    labels = joined_components(labels, more)
    named = classes.join(labels, classes["set_id"] == labels["node"], "left").select(
        "set_id", "doc_id", "component")
    least_id = named.filter("component is not null").groupBy("component").agg(
        F.min("doc_id").alias("least_id"))
    named = named.join(least_id, "component", "left").select(
        "set_id", F.coalesce("least_id", "doc_id").alias("component_id"))
    result = rows.filter("n > 0").join(named, "set_id").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
    return result.union(rows.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def op1(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_groups(table(spark, folder, "documents"))
