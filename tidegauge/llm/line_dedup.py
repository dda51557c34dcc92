"""Line deduplication against levelled sorted runs of line hashes.

Documents are taken in batches of ascending doc_id. Each batch reduces its lines to one
row per hash, sort-merge anti-joins the runs, and adds what is new as a run of its own,
bucketed and sorted by hash. Earlier batches hold smaller ids, so a line that a run
knows is a repeat, and the first document of a new line is its keeper. When a level
has ``FAN_OUT`` runs they are merged into one run of the next level, so that there are
only logarithmically many to join, and each hash is rewritten once per level.

Repeated hashes are few next to all lines. Joined back to the lines they give the
positions to cut, and only these are joined to the texts. A line that very many
documents hold is one row per task in the reduction; in the join back adaptive
execution splits it.
"""

from __future__ import annotations

import functools
import itertools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegauge.llm import bucketed
from tidegauge.llm.tables import kept, new_folder, table

WHITE = " \t\n\v\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_POINTS = 10
BATCHES = 4
FAN_OUT = 2


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    bare = F.trim(line, F.lit(WHITE))
    # lower() is right, and faster, for a line of ASCII characters only.
    return (F.when(F.octet_length(bare) == F.length(bare), F.lower(bare))
            .otherwise(F.translate(bare, UPPER, LOWER)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed_lines(docs: DataFrame, least_points: int) -> DataFrame:
    """doc_id, text_id, position and 16-byte hash of each line with a long enough key.

    ``text_id`` tells apart different texts under one doc_id.
    """
    return (docs.select("doc_id", _text_id().alias("text_id"),
                        F.posexplode(_lines(F.col("text"))).alias("position", "line"))
            .select("doc_id", "text_id", "position", line_key(F.col("line")).alias("key"))
            .filter(F.length("key") >= least_points)
            .select("doc_id", "text_id", "position", F.unhex(F.md5("key")).alias("hash")))


def _text_id() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


class LevelledRuns:
    """Sorted runs of line hashes in levels; every hash is in exactly one run."""

    def __init__(self, spark: SparkSession, location: str, buckets: int,
                 fan_out: int = FAN_OUT):
        self.spark, self.location = spark, location
        self.buckets, self.fan_out = buckets, fan_out
        self.levels: list[list[str]] = []
        self.written = 0

    def _write(self, hashes: DataFrame) -> str:
        self.written += 1
        name = bucketed.create(self.spark, f"{self.location}/run-{self.written}",
                               "hash BINARY", "hash", self.buckets)
        bucketed.append(hashes, name, "hash", self.buckets)
        return name

    def unknown(self, hashes: DataFrame) -> DataFrame:
        """The rows of ``hashes`` that no run holds."""
        for name in itertools.chain(*self.levels):
            hashes = hashes.join(self.spark.table(name).hint("merge"), "hash", "left_anti")
        return hashes

    def add(self, hashes: DataFrame) -> None:
        """Add a run of hashes that no run holds; merge each level that is full."""
        run, level = self._write(hashes), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fan_out:
                return
            full, self.levels[level] = self.levels[level], []
            run = self._write(functools.reduce(DataFrame.union, map(self.spark.table, full)))
            level += 1


def repeats(lines: DataFrame, ranges: list[Column], runs: LevelledRuns) -> DataFrame:
    """(batch, hash, keeper, known): hashes whose lines go in that batch.

    All its lines go if a run knows the hash from an earlier batch, else all but those
    of ``keeper``.
    """
    found = []
    for number, inside in enumerate(ranges):
        held = (lines.filter(inside).groupBy("hash")
                .agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"),
                     F.max(F.col("doc_id").isNull()).alias("unnamed")))
        held = kept(held, "line-batch")
        fresh = kept(runs.unknown(held), "line-fresh") if number else held
        several = ((F.col("last") != F.col("keeper"))
                   | (F.col("unnamed") & F.col("keeper").isNotNull()))
        found.append(fresh.filter(several).select(
            F.lit(number).alias("batch"), "hash", "keeper", F.lit(False).alias("known")))
        if number:
            found.append(held.join(fresh.select("hash").hint("merge"), "hash", "left_anti")
                         .select(F.lit(number).alias("batch"), "hash", "keeper",
                                 F.lit(True).alias("known")))
        if number + 1 < len(ranges):
            runs.add(fresh)
    return functools.reduce(DataFrame.union, found)


def _without(lines: Column, cut: Column) -> Column:
    """``lines`` without the ascending zero-based positions ``cut``: the stretches between
    them, each taken once, so the work is linear in both."""
    stretch = lambda i: F.slice(
        lines, F.when(i == 0, 1).otherwise(F.get(cut, i - 1) + 2),
        F.coalesce(F.get(cut, i), F.size(lines))
        - F.when(i == 0, 0).otherwise(F.get(cut, i - 1) + 1))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(cut)), stretch))


def dedup_lines(docs: DataFrame, least_points: int = LEAST_POINTS, batches: int = BATCHES,
                buckets: int | None = None, fan_out: int = FAN_OUT) -> DataFrame:
    """Columns: row (all columns of ``docs`` but text), text (kept lines joined by newline),
    n_lines (before), n_dropped.

    A key of at least ``least_points`` code points that several documents hold loses its
    lines everywhere but in the smallest doc_id. Null or empty text is one empty line.
    Rows that share a doc_id, those without one too, count as one document, and a
    missing doc_id is larger than any. An empty table gives no rows. Other columns,
    whatever their names, are carried in ``row``.
    """
    spark = docs.sparkSession
    lines = kept(hashed_lines(docs, least_points), "lines")
    ranges = bucketed.id_ranges(lines, batches)
    runs = LevelledRuns(spark, new_folder(spark, "line-runs"),
                        buckets or bucketed.default_buckets(spark), fan_out)
    cut = kept(repeats(lines, ranges, runs), "line-repeats")
    number = functools.reduce(lambda rest, i: F.when(ranges[i], i).otherwise(rest),
                              range(len(ranges)), F.lit(None))
    gone = (lines.withColumn("batch", number).join(cut.hint("merge"), ["batch", "hash"])
            .filter(F.col("known") | ~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("doc_id", "text_id").agg(F.sort_array(F.collect_set("position")).alias("cut")))
    rest = [docs[c] for c in docs.columns if c != "text"]
    texts = docs.select(F.struct(*rest).alias("row"), F.col("text"), _text_id().alias("text_id"))
    gone = gone.withColumnRenamed("text_id", "of_text")
    joined = texts.join(gone.hint("merge"), (F.col("row.doc_id").eqNullSafe(F.col("doc_id")))
                        & (F.col("text_id") == F.col("of_text")), "left")
    split = joined.select("row", _lines(F.col("text")).alias("lines"),
                          F.coalesce("cut", F.array().cast("array<int>")).alias("cut"))
    return split.select(
        "row", F.array_join(_without(F.col("lines"), F.col("cut")), "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size("cut").cast("long").alias("n_dropped"))


def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
        F.sha2("text", 256).alias("kept_sha256"))


OP8_SQL = """
WITH lines AS (
  SELECT doc_id, position, list[position] AS line,
         translate(trim(list[position], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, list, unnest(range(1, len(list) + 1)) AS position
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS list
              FROM documents))),
keepers AS (
  SELECT key, min(doc_id) AS keeper FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (
  SELECT l.*, k.keeper IS NOT NULL AND k.keeper <> l.doc_id AS gone
  FROM lines l LEFT JOIN keepers k ON l.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id
"""
