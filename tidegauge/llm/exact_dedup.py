"""Exact deduplication against a persistent index of text digests.

The index is a table bucketed and sorted by digest. A batch is first reduced to one
row per digest (combined before the shuffle, so a text with a third of all rows is one
row per task), then sort-merge anti-joined with the index: what is left is new and is
appended. Digests that the index knows already are appended as later sightings, so
that sizes and the best copy stay right over all batches. Neither step shuffles the
index. Every entry names its batch: one that is admitted again after a failure finds the
same texts new, and counts once.

Digests are SHA-256 of the text without white space; equal digests count as equal
texts.
"""

from __future__ import annotations

import uuid
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegauge.llm import bucketed
from tidegauge.llm.tables import kept, new_folder, table

WHITE = [" ", "\t", "\n", "\v", "\f", "\r"]
ARRIVALS = 3
# One number orders copies: most code points first, then the smallest id, null ids last.
STEP, ORIGIN, NO_ID = Decimal(2 ** 65), Decimal(2 ** 63 + 1), Decimal(2 ** 64 + 1)


def normalised(text: Column) -> Column:
    """The text without the six ASCII white-space characters; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    for character in WHITE:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars (code points of the original text) and digest (32 bytes)."""
    return docs.select(
        "doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n_chars"),
        F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"))


def _standing(n_chars: Column, doc_id: Column) -> Column:
    """A decimal, larger for the copy to keep; with it the aggregate stays hashed."""
    place = F.coalesce(doc_id.cast("decimal(20,0)") + F.lit(ORIGIN), F.lit(NO_ID))
    return (n_chars.cast("decimal(10,0)") * F.lit(STEP) - place).cast("decimal(38,0)")


def _doc_of(best: Column) -> Column:
    # A remainder takes the sign of its dividend.
    place = (F.lit(STEP) - best % F.lit(STEP)) % F.lit(STEP)
    return F.when(place != F.lit(NO_ID), (place - F.lit(ORIGIN)).cast("long"))


class DigestIndex:
    """A table of (digest, best, copies, batch), one row per digest and batch that held it,
    or several equal ones if the batch was admitted again.

    ``location`` outlives the session: opening it again, with the same number of
    buckets, continues the index.
    """

    FIELDS = "digest BINARY, best DECIMAL(38,0), copies BIGINT, batch STRING"

    def __init__(self, spark: SparkSession, location: str, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.name = bucketed.create(spark, location, self.FIELDS, "digest", buckets)

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def admit(self, batch: DataFrame, name: str | None = None) -> DataFrame:
        """Add rows of ``digests``; gives the groups whose text no other batch held before.

        A batch that may be admitted again, with the same rows, needs a name of its own.
        """
        name = name or uuid.uuid4().hex
        groups = (batch.groupBy("digest")
                  .agg(F.max(_standing(F.col("n_chars"), F.col("doc_id"))).alias("best"),
                       F.count(F.lit(1)).alias("copies"))
                  .withColumn("batch", F.lit(name)))
        groups = kept(groups, "digest-batch")
        known = self.entries().filter(F.col("batch") != name).select("digest").hint("merge")
        fresh = kept(groups.join(known, "digest", "left_anti"), "digest-fresh")
        again = groups.join(known, "digest", "left_semi")
        bucketed.append(fresh.union(kept(again, "digest-again")), self.name, "digest",
                        self.buckets)
        return fresh

    def settled(self) -> DataFrame:
        """One row per digest over all batches; buckets are aggregated where they lie."""
        once = (self.entries().groupBy("digest", "batch")
                .agg(F.max("best").alias("best"), F.max("copies").alias("copies")))
        return (once.groupBy("digest")
                .agg(F.max("best").alias("best"), F.sum("copies").alias("copies")))


def exact_groups(docs: DataFrame, location: str | None = None, buckets: int | None = None,
                 batches: int = ARRIVALS, name: str | None = None) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the one with the most code points stays, then the smallest doc_id; a
    null doc_id is larger than any. Null and empty texts are one group. Rows repeated
    with one doc_id count each, and are kept or dropped together. An empty table gives
    no rows; other columns do not matter. ``location`` names a persistent index that
    earlier calls may have filled: its texts count too. A call that may have to be repeated
    gives the same rows and ``name`` each time, and its rows count once.
    """
    spark = docs.sparkSession
    rows = kept(digests(docs), "digests")
    index = DigestIndex(spark, location or new_folder(spark, "digest-index"),
                        buckets or bucketed.default_buckets(spark))
    name = name or uuid.uuid4().hex
    # By hash, so a repeated call cuts the same batches.
    part = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for number in range(batches):
        index.admit(rows.filter(part == number), f"{name}-{number}")
    groups = kept(index.settled(), "digest-groups")
    keep = _doc_of(F.col("best"))
    return rows.join(groups.hint("merge"), "digest", "left").select(
        "doc_id", keep.alias("keep_id"), F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def op10(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"))


OP10_SQL = """
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS digest
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY digest ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY digest) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY digest ORDER BY n DESC, doc_id) AS kept,
       digest AS text_sha256
FROM texts
"""
