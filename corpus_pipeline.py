"""Documents from raw to packed: language, repeated lines, near copies, sequences.

Each stage's rows are written as Parquet in the shared folder and read again by the next,
so a lost executor costs no earlier stage. All stages but the last keep the columns of
documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegauge.llm import language_id, line_dedup, ngram_join, packing
from tidegauge.llm.tables import kept, public_vocabulary

# A text of at least so many letters is rejected if its best language is less probable than
# this; fewer letters may be as likely in several languages and tell nothing.
LEAST_SCORE = 0.5
TELLING_LETTERS = 200


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that the model knows.

    Texts that are null or have no letters go, and long ones that no language fits. Without a
    labelled text there is no model, and all rows stay. Rows are judged by their text alone:
    repeated rows stay or go together, null ids, sources and other columns, whatever their
    names, do not matter; texts of any length are read whole; an empty table stays empty.
    """
    model = language_id.train(docs, public_vocabulary("byte_bpe_multi_50k.tiktoken"))
    if not model.languages:
        return docs
    found = language_id.with_language(docs, model)
    letters = F.length(F.regexp_replace("row.text", r"[^\p{L}]+", ""))
    kept_rows = found.filter((F.col("lang_pred") != language_id.UNKNOWN)
                             & ((F.col("score") >= LEAST_SCORE) | (letters < TELLING_LETTERS)))
    return kept_rows.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that an earlier document holds; n_chars, if there is one, follows the text.

    No row goes. A null text becomes an empty one. Rows that share a doc_id, or have none,
    count as one document, so rows that repeat keep their lines together. Other columns,
    whatever their names, are carried; texts of any length are split whole; an empty table
    stays empty.
    """
    found = line_dedup.dedup_lines(docs)
    values = {c: F.col(f"row.`{c}`") for c in docs.columns if c != "text"}
    values["text"] = F.col("text")
    if "n_chars" in values:
        values["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return found.select(*(values[c].alias(c) for c in docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies: that with the smallest doc_id.

    Rows are told apart by a number of their own, so one row of a group stays also if ids
    repeat or are null (a null id is larger than any). Texts without words are alike to
    nothing and all stay. Other columns, whatever their names, are carried; texts of any
    length are compared whole; an empty table stays empty.
    """
    number = "row_number"
    while number in docs.columns:
        number += "_"
    numbered = kept(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    groups = ngram_join.jaccard_groups(numbered.select(F.col(number).alias("doc_id"), "text"))
    ids = numbered.select(F.col(number).alias("number"), F.col("doc_id").alias("id"))
    standing = F.struct(F.col("id").isNull().alias("unnamed"), "id", "number")
    keepers = (groups.join(ids, groups["doc_id"] == ids["number"]).groupBy("component_id")
               .agg(F.min(standing)["number"].alias("keeper")).select("keeper"))
    keepers = kept(keepers, "keepers")
    return numbered.join(keepers.hint("merge"), numbered[number] == keepers["keeper"],
                         "left_semi").select(*(numbered[c] for c in docs.columns))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into training sequences; one row per piece.

    A null or empty text is its end token alone. Every row is a document of its own, also
    if rows repeat or have no id; long texts are cut into pieces; other columns do not
    matter; an empty table gives no pieces.
    """
    return packing.pack(docs, public_vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", languages),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("packing", sequences),
]

# The stages use trained piece probabilities, components and packing, which SQL cannot
# express; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = kept(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
