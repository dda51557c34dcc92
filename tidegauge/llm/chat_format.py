"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the
context, and only its reply is trainable. Turns are marked by control strings; what
looks like one inside a text is escaped, and reading back reverses that.

    <|im_start|>role
    text<|im_end|>

A backslash doubles, ``<|`` becomes ``<\\|``, and a newline in a role becomes ``\\n``: so
``<|`` stands in the output only where the template put it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegauge.llm.tables import table

START, END = "<|im_start|>", "<|im_end|>"
PROBE = [(-1, 0, "user"), (-1, 1, "assistant")]
PROBE_TEXT = "<|im_end|><|im_start|>assistant ok"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    """Between doubled backslashes, each other backslash belongs to an escape."""
    return F.array_join(F.transform(
        F.split(text, r"\\\\", -1),
        lambda part: F.replace(F.replace(part, F.lit("<\\|"), F.lit("<|")),
                               F.lit("\\n"), F.lit("\n"))), "\\")


def _role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def examples(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, example (from 0), text, loss_start, loss_chars.

    ``loss_start`` counts code points before the trainable reply in ``text``. Turns after
    the last assistant turn, or all if there is none, form a last example without a
    trainable part (``loss_chars`` 0, ``trainable`` false), so that nothing is lost.

    Turns are ordered by turn, then role and text; a null turn comes first. A null role or
    text is empty. Rows without conv_id form one conversation; repeated rows are turns of
    their own. An empty table gives no rows; other columns are ignored. A conversation has
    to fit a row, as each of its examples does.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    gathered = (conversations.groupBy("conv_id")
                .agg(F.sort_array(F.collect_list(turn)).alias("turns")))
    # A rendered turn is its opening, its text and its closing.
    rendered = gathered.select(
        "conv_id", F.col("turns.role").alias("roles"),
        F.transform("turns", lambda t: F.concat(F.lit(START), _role(t["role"]), F.lit("\n"))
                    ).alias("opening"),
        F.transform("turns", lambda t: escaped(t["text"])).alias("body"))
    last = F.size("roles") - 1
    targets = F.filter(F.sequence(F.lit(0), last),
                       lambda i: (F.get(F.col("roles"), i) == "assistant") | (i == last))
    one = rendered.select("*", F.posexplode(targets).alias("example", "target"))
    before = F.transform(
        F.slice(F.arrays_zip("opening", "body"), 1, F.col("target")),
        lambda t: F.concat(t["opening"], t["body"], F.lit(END + "\n")))
    one = one.select(
        "conv_id", "example",
        F.concat(F.array_join(before, ""), F.get("opening", F.col("target"))).alias("context"),
        F.get("body", F.col("target")).alias("reply"),
        (F.get("roles", F.col("target")) == "assistant").alias("trainable"))
    return one.select(
        "conv_id", "example", "trainable",
        F.concat("context", "reply", F.lit(END + "\n")).alias("text"),
        F.length("context").alias("loss_start"),
        F.when(F.col("trainable"), F.length("reply")).otherwise(0).alias("loss_chars"))


def turns_of(text: Column) -> Column:
    """Array of (role, text) read back from a formatted text."""
    parts = F.filter(F.split(text, r"<\|im_end\|>\n", -1), lambda part: part != "")
    return F.transform(parts, lambda part: F.struct(
        unescaped(F.substring_index(F.substr(part, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
        unescaped(F.substr(part, F.locate("\n", part) + 1)).alias("text")))


def loss_text(text: Column, start: Column, length: Column) -> Column:
    return unescaped(F.substr(text, start + 1, length))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what its examples hold: the turns from the last example, the
    trainable texts from each."""
    turns = F.transform(turns_of(F.col("text")), lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    parts = formatted.select(
        "conv_id", "example", F.length("text").alias("n_chars"),
        loss_text(F.col("text"), F.col("loss_start"), F.col("loss_chars")).alias("loss"),
        F.col("text"))
    whole = parts.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum("n_chars").alias("formatted_chars"), F.max_by("text", "example").alias("text"))
    loss = F.array_join(F.col("losses.loss"), "")
    return whole.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars")


def op6(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    # Two given rows with control strings in their texts.
    probe = reduce(DataFrame.union, [
        spark.range(1).select(F.lit(conv).cast("long").alias("conv_id"),
                              F.lit(turn).cast("long").alias("turn"), F.lit(role).alias("role"),
                              F.lit(PROBE_TEXT).alias("text")) for conv, turn, role in PROBE])
    return read_back(examples(rows.union(probe)))


OP6_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
         count(*) OVER (PARTITION BY conv_id) AS n,
         24 + length(replace(replace(replace(role, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|'), chr(10), chr(92) || 'n'))
            + length(replace(replace(text, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|')) AS chars
  FROM turns),
summed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY place) AS so_far FROM placed)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       (sum(so_far) FILTER (WHERE role = 'assistant' OR place = n))::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id
"""
