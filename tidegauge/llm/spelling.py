"""Spelling variants: words that differ by one code point, found in a dictionary of trie nodes.

Every prefix of a word is a node of a forward trie and every suffix a node of a reversed
one. Nodes are numbered by a 64-bit digest of their path, so no task needs to see the whole
trie and a word gives its own pairs. A word of k code points has

* k + 1 plain pairs (prefix node, suffix node), one where each position would be inserted;
* k skipped pairs, which leave out the code point between prefix and suffix.

Two words are near exactly if a skipped pair of one is a skipped pair of the other (one code
point replaced) or a plain pair of the other (one inserted or deleted). All words under a
pair agree but for one code point, so a pair has at most as many words as the alphabet has
letters, whatever the vocabulary: no group is hot, and no pairs of words are made. Each
member only needs the number of the others and the best of them, which windows give.

A code point that repeats its left neighbour is not skipped for an insertion, as leaving
out the first of the run gives the same word: every near pair is counted once.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidegauge.llm.tables import if_small, kept, table

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_POINTS = 7
LEAST_COUNT = 2
# How many times as frequent as a word its form must be.
RATIO = 10
# One occurrence in so many is read with a code point left out.
DAMAGED = 31
STEP = Decimal(2 ** 64)


def _lowered(word: Column) -> Column:
    # lower() is right, and faster, for ASCII words.
    return (F.when(F.octet_length(word) == F.length(word), F.lower(word))
            .otherwise(F.translate(word, UPPER, LOWER)))


def _damaged(doc_id: Column, word: Column, one_in: int) -> Column:
    """The word, without one code point where the checksum of document and word says so."""
    checksum = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word))
    at = (checksum % F.length(word)).cast("int")
    cut = F.concat(F.substr(word, F.lit(1), at), F.substr(word, at + 2))
    return F.when(checksum % one_in == 0, cut).otherwise(word)


def word_counts(docs: DataFrame, least_points: int = LEAST_POINTS,
                least_count: int = LEAST_COUNT, one_in: int | None = DAMAGED) -> DataFrame:
    """(word, n) of the words of at least so many code points and occurrences.

    Shorter runs of letters cannot become long enough, so the pattern leaves them out.
    Counts are combined before the shuffle.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(
        "text", F.lit(f"[{LETTERS}]{{{least_points},}}"), F.lit(0))).alias("run"))
    word = _lowered(F.col("run"))
    if one_in:
        runs = runs.select("doc_id", word.alias("run"))
        word = _damaged(F.col("doc_id"), F.col("run"), one_in)
    return (runs.select(word.alias("word")).filter(F.length("word") >= least_points)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count))


def numbered(words: DataFrame) -> DataFrame:
    """id, word, n; ids ascend with the words in code-point order."""
    ordered = words.repartitionByRange("word").sortWithinPartitions("word")
    return kept(ordered.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")


def node_pairs(words: DataFrame) -> DataFrame:
    """id, n, prefix and suffix node, skips (whether a code point is left out between them)
    and inserts (whether this is the one way to see that code point as inserted)."""
    word, at = F.col("word"), F.col("at")
    places = words.select("id", "n", "word",
                          F.explode(F.sequence(F.lit(1), F.length("word") + 1)).alias("at"))
    rest = F.substr(word, at)
    point = F.substr(rest, F.lit(1), F.lit(1))
    new_run = (at == 1) | (point != F.substr(word, at - 1, F.lit(1)))
    both = F.array(
        F.struct(F.xxhash64(rest).alias("suffix"), F.lit(False).alias("skips"),
                 F.lit(False).alias("inserts")),
        F.struct(F.xxhash64(F.substr(rest, F.lit(2))).alias("suffix"),
                 F.lit(True).alias("skips"), new_run.alias("inserts")))
    pairs = places.select("id", "n", F.xxhash64(F.substr(word, F.lit(1), at - 1)).alias("prefix"),
                          (at <= F.length(word)).alias("inside"), F.inline(both))
    return pairs.filter(F.col("inside") | ~F.col("skips")).drop("inside")


def neighbourhoods(words: DataFrame) -> DataFrame:
    """id, n_near (number of near words) and best_id (of them the most frequent, then the
    first in code-point order) of the words (id, word, n) that have any."""
    of_pair = Window.partitionBy("prefix", "suffix")
    ranked = of_pair.orderBy(F.desc("skips"), F.desc("n"), "id")
    standing = F.struct(F.col("n").alias("n"), (-F.col("id")).alias("back"))
    skips, inserts = F.col("skips"), F.col("inserts")
    seen = node_pairs(words).select(
        "id", "skips", "inserts",
        F.count_if(skips).over(of_pair).alias("n_skips"),
        F.count_if(inserts).over(of_pair).alias("n_inserts"),
        F.max(F.when(inserts, standing)).over(of_pair).alias("best_insert"),
        F.max(F.when(~skips, standing)).over(of_pair).alias("plain"),
        F.row_number().over(ranked).alias("place"),
        F.max(F.when(skips, standing)).over(of_pair).alias("first"),
        F.lead(F.when(skips, standing)).over(ranked).alias("next"))
    other = F.when(F.col("place") == 1, F.col("next")).otherwise(F.col("first"))
    plain = F.when(inserts, F.col("plain"))
    found = seen.select(
        "id",
        F.when(skips, F.col("n_skips") - 1 + plain.isNotNull().cast("long"))
        .otherwise(F.col("n_inserts")).alias("n_near"),
        F.when(skips, F.greatest(other, plain)).otherwise(F.col("best_insert")).alias("best")
    ).filter("n_near > 0")
    # One number per standing keeps the aggregate hashed.
    packed = (F.col("best.n").cast("decimal(18,0)") * F.lit(STEP)
              + F.col("best.back").cast("decimal(19,0)")).cast("decimal(38,0)")
    best = (found.select("id", "n_near", packed.alias("best")).groupBy("id")
            .agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best")))
    back = F.lit(STEP) - F.col("best") % F.lit(STEP)
    return best.select("id", "n_near", (back % F.lit(STEP)).cast("long").alias("best_id"))


def roots(forms: DataFrame, greatest: int, ratio: int) -> DataFrame:
    """(id, root_id): where the links (id, form_id) end.

    Each link multiplies the count by ``ratio``, so the greatest count bounds the length of
    a chain; every round doubles the links that have been followed.
    """
    steps, far = 0, max(ratio, 2)
    while far <= greatest:
        steps, far = steps + 1, far * max(ratio, 2)
    now = kept(forms.select("id", F.col("form_id").alias("root_id")), "roots")
    for _ in range(max(0, steps - 1).bit_length()):
        ahead = if_small(now.select(F.col("id").alias("of"), F.col("root_id").alias("further")))
        now = kept(now.join(ahead, now["root_id"] == ahead["of"], "left").select(
            "id", F.coalesce("further", "root_id").alias("root_id")), "roots")
    return now


def variant_groups(docs: DataFrame, least_points: int = LEAST_POINTS,
                   least_count: int = LEAST_COUNT, ratio: int = RATIO,
                   one_in: int | None = DAMAGED) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are runs of Latin letters, A-Z lower-cased, read with one code point left out
    where a checksum of doc_id and word says so (``one_in``; None reads them as they are).
    A word's form is its most frequent near word (ties: the first in code-point order) if
    that is at least ``ratio`` times as frequent; root follows forms to the end.

    A null text has no words, and a null doc_id is an empty one in the checksum. Texts of
    any length are read whole. Repeated rows count each time. A table without words gives
    no rows; columns other than doc_id and text do not matter.
    """
    words = numbered(word_counts(docs.select(docs["doc_id"], docs["text"]), least_points,
                                 least_count, one_in))
    near = kept(neighbourhoods(words), "near-words")
    named = words.select(F.col("id").alias("best_id"), F.col("word").alias("best_word"),
                         F.col("n").alias("best_n"))
    joined = words.join(near.hint("merge"), "id", "left").join(
        named.hint("merge"), "best_id", "left")
    has_form = F.col("best_n") >= ratio * F.col("n")
    full = kept(joined.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, F.col("best_id")).alias("form_id"),
        F.when(has_form, F.col("best_word")).alias("form"),
        F.when(has_form, F.col("best_n")).alias("form_n")), "word-forms")
    greatest = words.agg(F.max("n")).first()[0] or 0
    ends = roots(full.filter("form_id is not null"), greatest, ratio)
    root_words = words.select(F.col("id").alias("root_id"), F.col("word").alias("root_word"))
    ends = ends.join(root_words.hint("merge"), "root_id").select("id", "root_word")
    return full.join(ends.hint("merge"), "id", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def op12(spark: SparkSession, folder: str) -> DataFrame:
    return variant_groups(table(spark, folder, "documents"))


# The checksum is worked out byte by byte with a table of 256 remainders.
OP12_SQL = r"""
WITH RECURSIVE remainders AS (
  SELECT list(r ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k:
             CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r
    FROM (SELECT unnest(range(256)) AS b))),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[a-z\x{C0}-\x{FF}]{7,}')) AS run
  FROM documents),
hexed AS (
  SELECT doc_id, run, count(*) AS n, hex(concat(doc_id, ':', run)) AS h
  FROM runs GROUP BY doc_id, run),
sums AS (
  SELECT run, n, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i:
             (strpos('123456789ABCDEF', h[2 * i + 1]) * 16
              + strpos('123456789ABCDEF', h[2 * i + 2]))::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc
  FROM hexed, remainders),
read_words AS (
  SELECT CASE WHEN crc % 31 = 0
              THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2)
              ELSE run END AS word, n
  FROM sums),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM read_words
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
skips AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS p, substr(word, i + 1) AS s
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word AS word, b.word AS near FROM skips a JOIN skips b
    ON a.p = b.p AND a.s = b.s AND a.word <> b.word
  UNION SELECT y.word, x.word FROM skips y JOIN words x ON y.p || y.s = x.word
  UNION SELECT x.word, y.word FROM skips y JOIN words x ON y.p || y.s = x.word),
best AS (
  SELECT p.word, count(*) AS n_near,
         arg_min(p.near, (-w.n, p.near)) AS near, max(w.n) AS near_n
  FROM pairs p JOIN words w ON p.near = w.word GROUP BY p.word),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN near_n >= 10 * w.n THEN b.near END AS form,
         CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
ways AS (
  SELECT word, word AS stop, 0 AS steps FROM formed
  UNION ALL SELECT v.word, f.form, v.steps + 1 FROM ways v JOIN formed f ON v.stop = f.word
  WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(stop, steps) AS root FROM ways GROUP BY word)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n
FROM formed f JOIN ends e ON f.word = e.word
"""
