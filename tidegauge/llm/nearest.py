"""Approximate nearest neighbours by learned partitions.

On a sample of bounded size a neighbour graph is built and cut into parts of equal size
that keep neighbours together. A small classifier learns the part of a vector. Every
vector is put into its most probable part; a query is routed to several of the most
probable parts, and the vectors there are ranked by their exact inner products.

Equal vectors are one row of the index with as many of their smallest ids as an answer
can hold. Large parts are dealt out in blocks, and the queries of a part in blocks too,
so no task holds a part; each pair of blocks gives its best few per query, and the best
of these are the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidegauge.llm.tables import kept, ship, table

QUERY_STEP = 20
NEAREST = 20
# Distinct vectors, about, that the partition is learned from.
SAMPLE = 6000
PARTS = 48
# Near-random vectors, as in the test tables, need about two thirds of the parts for a recall
# above 0.9; clustered ones need few.
ROUTES = 33
GRAPH = 12
BLOCK_ROWS = 4096
BLOCK_QUERIES = 1024


@dataclass
class Router:
    """A linear classifier with one hidden layer over scaled vectors."""

    layers: list[tuple[np.ndarray, np.ndarray]]

    @property
    def parts(self) -> int:
        return len(self.layers[-1][1])

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        x = _scaled(vectors)
        for weight, bias in self.layers[:-1]:
            x = np.maximum(x @ weight + bias, 0)
        return x @ self.layers[-1][0] + self.layers[-1][1]

    def best(self, vectors: np.ndarray, count: int) -> np.ndarray:
        scores = self.scores(vectors)
        count = min(count, scores.shape[1])
        return np.argsort(-scores, axis=1, kind="stable")[:, :count]


def _scaled(vectors: np.ndarray) -> np.ndarray:
    # By the largest component first, so that squares of extreme values stay finite.
    x = vectors / np.abs(vectors).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _neighbours(x: np.ndarray, count: int) -> np.ndarray:
    found = []
    for first in range(0, len(x), 1024):
        near = x[first:first + 1024] @ x.T
        near[np.arange(len(near)), first + np.arange(len(near))] = -np.inf
        found.append(np.argpartition(-near, min(count, near.shape[1] - 1), axis=1)[:, :count])
    return np.concatenate(found)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator,
                   rounds: int = 12) -> np.ndarray:
    """Part of each node: equal sizes, with neighbours together as far as possible.

    Nodes begin with the closest of random centres that has room. In each round they move,
    those that gain most first, to the part most of their neighbours are in, if it has
    room.
    """
    room = -(-len(x) // parts)
    centres = x[rng.choice(len(x), parts, replace=False)]
    for _ in range(6):
        near = (x @ centres.T).argmax(1)
        for part in range(parts):
            if (near == part).any():
                centre = x[near == part].mean(0)
                centres[part] = centre / max(np.linalg.norm(centre), 1e-12)
    near = x @ centres.T
    label, size = np.full(len(x), -1), np.zeros(parts, int)
    for node in np.argsort(-near.max(1), kind="stable"):
        for part in np.argsort(-near[node], kind="stable"):
            if size[part] < room:
                label[node], size[part] = part, size[part] + 1
                break
    slack = room + max(1, room // 8)
    both = [np.concatenate([np.arange(len(x)).repeat(graph.shape[1]), graph.ravel()]),
            np.concatenate([graph.ravel(), np.arange(len(x)).repeat(graph.shape[1])])]
    for _ in range(rounds):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (both[0], label[both[1]]), 1)
        wish = votes.argmax(1)
        gain = votes[np.arange(len(x)), wish] - votes[np.arange(len(x)), label]
        moved = 0
        for node in np.argsort(-gain, kind="stable"):
            if gain[node] <= 0:
                break
            if size[wish[node]] < slack:
                size[label[node]] -= 1
                label[node] = wish[node]
                size[wish[node]] += 1
                moved += 1
        if not moved:
            break
    return label


def fitted_router(vectors: np.ndarray, parts: int, seed: int = 5, hidden: int = 128,
                  epochs: int = 25) -> Router:
    """The classifier of a balanced partition; soft targets are the parts of a vector's
    neighbours and its own."""
    rng = np.random.default_rng(seed)
    x = _scaled(vectors)
    parts = max(1, min(parts, len(x) // 8))
    if parts == 1:
        return Router([(np.zeros((x.shape[1], 1)), np.zeros(1))])
    graph = _neighbours(x, min(GRAPH, len(x) - 1))
    label = balanced_parts(x, graph, parts, rng)
    target = np.zeros((len(x), parts))
    target[np.arange(len(x)), label] = 1.0
    np.add.at(target, (np.arange(len(x)).repeat(graph.shape[1]), label[graph.ravel()]),
              1.0 / graph.shape[1])
    target /= target.sum(1, keepdims=True)
    sizes = [x.shape[1], hidden, parts]
    values = [v for a, b in zip(sizes, sizes[1:])
              for v in (rng.normal(0, np.sqrt(2 / a), (a, b)), np.zeros(b))]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for start in range(0, len(x), 256):
            rows = order[start:start + 256]
            a = x[rows]
            h = np.maximum(a @ values[0] + values[1], 0)
            out = h @ values[2] + values[3]
            out = np.exp(out - out.max(1, keepdims=True))
            error = (out / out.sum(1, keepdims=True) - target[rows]) / len(rows)
            back = (error @ values[2].T) * (h > 0)
            step += 1
            for i, slope in enumerate((a.T @ back, back.sum(0), h.T @ error, error.sum(0))):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope ** 2
                values[i] -= 0.003 * (first[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    return Router([(values[0], values[1]), (values[2], values[3])])


def usable(vectors: DataFrame, dimension: int | None = None) -> DataFrame:
    """vec_id and vector (doubles) of rows that take part: not null, not zero, all finite,
    and of the dimension most rows have."""
    rows = vectors.select(vectors["vec_id"], vectors["embedding"].cast("array<double>")
                          .alias("vector")).filter(F.col("vec_id").isNotNull())
    rows = rows.filter(F.col("vector").isNotNull() & F.exists("vector", lambda v: v != 0)
                       & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v)
                                  & (F.abs(v) < float("inf"))))
    if dimension is None:
        common = (rows.groupBy(F.size("vector").alias("d")).count()
                  .orderBy(F.desc("count"), "d").first())
        dimension = common["d"] if common else 0
    return rows.filter(F.size("vector") == dimension)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _top(query: np.ndarray, ids: np.ndarray, score: np.ndarray, count: int) -> np.ndarray:
    """Rows that hold the best ``count`` of each query, ties to the smaller id."""
    order = np.lexsort((ids, -score, query))
    at = query[order]
    firsts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    rank = np.arange(len(at)) - np.repeat(firsts, np.diff(np.append(firsts, len(at))))
    return order[rank < count]


def search(vectors: DataFrame, queries: DataFrame, count: int = NEAREST, sample: int = SAMPLE,
           parts: int = PARTS, routes: int = ROUTES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the ``count`` nearest rows found.

    Nearest is the largest inner product in double precision; ties go to the smaller
    vec_id, and a query's own row is left out. ``queries`` are rows of ``vectors``.
    Vectors that are null, zero or not finite take no part, nor do those of another
    dimension than most. Rows that repeat an id and vector are one candidate. No usable
    rows give no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = usable(vectors)
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    # As many ids of equal vectors as can matter: the answer's and the query's own. The
    # smallest of each hashed share first, so that no task sorts a very common vector.
    share = F.row_number().over(Window.partitionBy("vector", "salt").orderBy("vec_id"))
    few = (rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64))).distinct()
           .withColumn("place", share).filter(F.col("place") <= count + 1))
    few = few.withColumn("place", place).filter(F.col("place") <= count + 1)
    distinct = kept(few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")),
                    "vectors")
    total = distinct.count()
    chance = F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) / float(1 << 30)
    drawn = distinct.filter(chance < min(1.0, sample / max(total, 1))).select("vector").collect()
    known = np.array(sorted([r[0] for r in drawn]), float)
    if not len(known):  # a tiny table may have no row in the sample
        known = np.array(sorted([r[0] for r in distinct.select("vector").limit(sample).collect()]),
                         float)
    if not len(known):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    router = fitted_router(known, parts)
    shared = spark.sparkContext.broadcast(router)

    def routed(most: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                best = shared.value.best(_matrix(batch.column("vector")), most)
                flat = pa.array(best.ravel().astype(np.int32))
                offsets = pa.array(np.arange(0, best.size + 1, best.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.ListArray.from_arrays(offsets, flat)],
                    [*batch.schema.names, "parts"])
        return run

    index = kept(distinct.mapInArrow(
        routed(1), "vector array<double>, ids array<long>, parts array<int>")
        .select("vector", "ids", F.get("parts", F.lit(0)).alias("part")), "index")
    asked = queries.select(queries["vec_id"]).distinct().join(rows, "vec_id").distinct()
    asked = kept(asked.mapInArrow(routed(routes),
                                  "vec_id long, vector array<double>, parts array<int>")
                 .withColumn("part", F.explode("parts")).drop("parts"), "queries")
    # Blocks of a part: the sizes are a row per part.
    blocks = (index.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks"))
              .join(asked.groupBy("part").agg(
                  F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).alias("groups")), "part"))
    blocks = F.broadcast(blocks)  # no more rows than parts
    placed = (index.join(blocks, "part")
              .withColumn("block", F.pmod(F.xxhash64("vector"), "blocks"))
              .withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
              .select("part", "block", "group", "vector", "ids"))
    spread = (asked.join(blocks, "part")
              .withColumn("group", F.pmod(F.xxhash64("vec_id"), "groups"))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("part", "block", "group", "vec_id", "vector"))

    def ranked(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(left) and len(right):
            table_ = _matrix(left.column("vector").combine_chunks())
            lists = left.column("ids").combine_chunks()
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            names = right.column("vec_id").to_numpy()
            wanted = _matrix(right.column("vector").combine_chunks())
            for first in range(0, len(names), 64):
                score = wanted[first:first + 64] @ table_.T
                keep = min(count + 1, score.shape[1])
                # All vectors as near as the last of the best, so that ties are whole.
                bar = -np.partition(-score, keep - 1, axis=1)[:, keep - 1]
                q, v = np.nonzero(score >= (bar - 1e-9 * np.abs(bar))[:, None])
                exact = np.einsum("ij,ij->i", wanted[first + q], table_[v])
                begin = np.cumsum(sizes) - sizes
                each = np.repeat(np.arange(len(q)), sizes[v])
                at = np.arange(len(each)) - np.repeat(np.cumsum(sizes[v]) - sizes[v], sizes[v])
                other = ids[begin[v][each] + at]
                query, value = names[first + q][each], exact[each]
                mine = query != other
                query, other, value = query[mine], other[mine], value[mine]
                best = _top(query, other, value, count)
                found.append((query[best], other[best], value[best]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                         pa.array(columns[2], pa.float64())], ["query_id", "vec_id", "score"])

    key = ["part", "block", "group"]
    pairs = placed.groupBy(*key).cogroup(spread.groupBy(*key)).applyInArrow(
        ranked, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)
            .select("query_id", "rank", "vec_id", "score"))


def op9(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return search(vectors, vectors.filter(F.pmod("vec_id", F.lit(QUERY_STEP)) == 0))
