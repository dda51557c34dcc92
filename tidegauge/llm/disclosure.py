"""Personal data and the terms that give it away, by what the corpus itself reveals.

Patterns find the protected entities: e-mail and network addresses, cards, phones. A term
near an entity discloses it as far as seeing the term tells which entity is meant. In bits,
over the different texts of the corpus, that is the pointwise mutual information of the two;
its share of the entity's own information is the *disclosure*, 1 for a term that never
comes without the entity. Terms at or above a threshold are generalised to their shape
wherever they stand, and removed where disclosure is complete.

Chance and copies must not count as evidence. A term counts only if several texts have it
near the entity, in surroundings that mostly differ, and copies of a text count as one.

Everything is built-in functions. The text around and between matches comes from splitting
at the same pattern, so offsets are sums of lengths and the work is linear in the text. The
patterns are possessive and start only where a run of their characters starts, which gives
the same matches as trying every position, without going back over long runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegauge.llm.tables import if_small, kept, table

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this has no match; most texts are passed over by it.
NEEDED = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
BYTE = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2}|)"
# Written in place of an entity; no letters or digits, so no terms.
MARKS = {"email": "[@]", "ip": "[.]", "card": "[=]", "phone": "[+]"}
TERM_CHARACTERS = r"\p{L}\p{N}"
LEAST_TERM = 3
# Terms on each side of an entity, and code points in which they are looked for.
NEAR = 6
REACH = 120
# Different texts and surroundings that must have a term near the entity, and the least
# number of surroundings per text.
SUPPORT = 3
DIVERSITY = 0.5
# Share of an entity's information from which a term is generalised.
THRESHOLD = 0.9


def _text(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit(""))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def added(total: Column, place: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - place, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(place % 2 == 0, digit).otherwise(
            F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), added) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """Whether what the pattern of ``kind`` matched is one."""
    if kind == "ip":
        return value.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def entity(kind: Column, value: Column) -> Column:
    """One name for all ways to write an entity."""
    bare = (F.when(kind == "email", F.lower(value))
            .when(kind == "ip", F.regexp_replace(value, r"(?<![0-9])0+(?=[0-9])", ""))
            .otherwise(_digits(value)))
    return F.concat(kind, F.lit(":"), bare)


def _running_totals(sizes: Column) -> Column:
    """Sums of an array up to each place. Stretches of the root of its length are summed
    first, as each sum reads the array from its start."""
    total = lambda values: F.aggregate(values, F.lit(0), lambda s, x: s + x)
    each = lambda value, f: F.flatten(F.transform(F.array(value), f))
    width = F.ceil(F.sqrt(F.size(sizes))).cast("int")

    def within(own: Column, before: Column) -> Column:
        return F.transform(own, lambda _, k: before + total(F.slice(own, F.lit(1), k + 1)))

    def over(stretches: Column) -> Column:
        return each(F.transform(stretches, total), lambda sums: F.flatten(F.transform(
            stretches, lambda own, c: each(total(F.slice(sums, F.lit(1), c)),
                                           lambda before: within(own, before)))))

    firsts = F.sequence(F.lit(1), F.size(sizes), width)
    return each(F.transform(firsts, lambda at: F.slice(sizes, at, width)), over)


def _split(rows: DataFrame, name: str, text: Column, pattern: Column, inside: Column) -> DataFrame:
    """Adds the matches of ``pattern`` and the stretches between, then the ends of matches,
    as columns named after ``name``; null where ``inside`` is not true or nothing matches."""
    found, between, ends = f"{name}_found", f"{name}_between", f"{name}_ends"
    rows = rows.withColumns({
        found: F.when(inside, F.regexp_extract_all(text, pattern, F.lit(0))),
        between: F.when(inside, F.split(text, pattern, -1))})
    sizes = F.transform(F.col(found), lambda v, i: F.length(v) + F.length(F.get(F.col(between), i)))
    rows = rows.withColumn(f"{name}_sizes", F.when(F.size(found) > 0, sizes))
    return rows.withColumn(ends, F.when(F.col(f"{name}_sizes").isNotNull(),
                                        _running_totals(F.col(f"{name}_sizes"))))


def _spans(name: str, order: int, kind: str) -> Column:
    """Matches as an array of (start, order, end, kind, value, before, after)."""
    found, between, ends = (F.col(f"{name}_{x}") for x in ("found", "between", "ends"))

    def span(value: Column, i: Column) -> Column:
        end = F.get(ends, i)
        return F.struct(
            (end - F.length(value)).alias("start"), F.lit(order).alias("order"),
            end.alias("end"), F.lit(kind).alias("kind"), value.alias("value"),
            F.right(F.get(between, i), F.lit(REACH)).alias("before"),
            F.left(F.get(between, i + 1), F.lit(REACH)).alias("after"))

    return F.transform(F.when(ends.isNotNull(), found), span)


SPAN = ("array<struct<start:int,order:int,end:int,kind:string,value:string,"
        "before:string,after:string>>")


def entities(docs: DataFrame) -> DataFrame:
    """Columns of ``docs`` in row, text_id, spans: valid matches of all kinds by start."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns if c != "text")).alias("row"),
                       _text(docs).alias("text"))
    for kind in KINDS:
        inside = (F.contains("text", F.lit(NEEDED[kind])) if kind == "email"
                  else F.col("text").rlike(NEEDED[kind]))
        rows = _split(rows, kind, F.col("text"), F.lit(PATTERNS[kind]), inside)
    def checked(order: int, kind: str) -> Column:
        spans = F.filter(_spans(kind, order, kind), lambda s: valid(kind, s["value"]))
        return F.coalesce(spans, F.array().cast(SPAN))

    every = [checked(order, kind) for order, kind in enumerate(KINDS)]
    return rows.select("row", _text_id(F.col("text")).alias("text_id"),
                       F.array_sort(F.concat(*every)).alias("spans"))


def _text_id(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{TERM_CHARACTERS}]{{{LEAST_TERM},}}"),
                                F.lit(0))


def _near(spans: Column) -> tuple[Column, Column]:
    """Terms before and after a span, without one that the reach cuts."""
    before, after = _terms(spans["before"]), _terms(spans["after"])
    cut = F.length(spans["before"]) == REACH
    before = F.when(cut, F.slice(before, F.lit(2), F.greatest(F.size(before) - 1, F.lit(0)))
                    ).otherwise(before)
    cut = F.length(spans["after"]) == REACH
    after = F.when(cut, F.slice(after, F.lit(1), F.greatest(F.size(after) - 1, F.lit(0)))
                   ).otherwise(after)
    near = F.least(F.size(before), F.lit(NEAR))
    return (F.slice(before, F.size(before) - near + 1, near), F.slice(after, F.lit(1), F.lit(NEAR)))


def _share(total: int, texts: Column, term_texts: Column) -> Column:
    """Mutual information of an entity and a term as a share of the entity's own, which is
    nothing if every text has the entity."""
    own = F.log(F.lit(float(total)) / F.col("entity_texts"))
    return F.when(own > 0, (own + F.log(texts / term_texts)) / own)


def co_occurrences(found: DataFrame, total: int, threshold: float) -> DataFrame:
    """entity, term, texts (that have the term near the entity), entity_texts, over different
    texts; ``total`` is their number.

    A term is in at least as many texts as have it near any entity. That alone rules out
    most terms, common words above all, before the corpus is searched for the others.
    """
    spans = found.filter(F.size("spans") > 0).select("text_id", F.explode("spans").alias("span"))
    span = F.col("span")
    before, after = _near(span)
    seen = spans.select(entity(span["kind"], span["value"]).alias("entity"), "text_id",
                        before.alias("before"), after.alias("after"))
    seen = kept(seen.select("entity", "text_id", F.xxhash64("before", "after").alias("around"),
                            F.array_distinct(F.concat("before", "after")).alias("terms"))
                .distinct(), "entity-places")
    pairs = seen.select("entity", F.explode("terms").alias("term"), "text_id", "around")

    def different(rows: DataFrame, of: str, count: str, *key: str) -> DataFrame:
        # Two plain steps: no task gets all rows of a key that is everywhere.
        return rows.select(*key, of).distinct().groupBy(*key).agg(F.count(F.lit(1)).alias(count))

    texts = different(pairs, "text_id", "texts", "entity", "term").filter(
        F.col("texts") >= SUPPORT)
    around = different(pairs, "around", "surroundings", "entity", "term").filter(
        F.col("surroundings") >= SUPPORT)
    both = texts.join(around, ["entity", "term"]).filter(
        F.col("surroundings") >= DIVERSITY * F.col("texts")).drop("surroundings")
    both = both.join(different(seen, "text_id", "entity_texts", "entity"), "entity")
    both = both.join(different(pairs, "text_id", "least_texts", "term"), "term")
    return both.filter(_share(total, F.col("texts"), F.col("least_texts")) >= threshold
                       ).drop("least_texts")


def _texts_with(docs: DataFrame, terms: DataFrame, *columns: str) -> DataFrame:
    """text_id and ``columns`` of ``terms`` for each different one of them in a row's text."""
    own = docs.select(_text_id(_text(docs)).alias("text_id"),
                      F.explode(F.array_distinct(_terms(_text(docs)))).alias("term"))
    return own.join(if_small(terms), "term").select("text_id", *columns)


def disclosing_terms(docs: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    """(term, disclosure): the greatest share of any entity's information that it gives."""
    per_text = found.groupBy("text_id").agg(F.count(F.lit(1)).alias("rows"))
    total = per_text.count()
    pairs = kept(co_occurrences(found, total, threshold), "term-pairs")
    # Rows of a text with copies weigh as much as one, so no text has to be moved.
    copies = kept(per_text.filter("rows > 1"), "text-copies")
    terms = kept(pairs.select("term").distinct(), "near-terms")
    holding = _texts_with(docs, terms, "term")
    copies = if_small(copies.withColumnRenamed("text_id", "of"))
    holding = holding.join(copies, F.col("text_id") == F.col("of"), "left").groupBy("term").agg(
        F.round(F.sum(1 / F.coalesce("rows", F.lit(1)))).alias("term_texts"))
    share = _share(total, F.col("texts"), F.col("term_texts"))
    return (pairs.join(holding, "term").select("term", share.alias("disclosure"))
            .groupBy("term").agg(F.max("disclosure").alias("disclosure"))
            .filter(F.col("disclosure") >= threshold))


def _term_pattern(terms: Column) -> Column:
    return F.concat(F.lit(f"(?iu)(?<![{TERM_CHARACTERS}])(?:"), F.array_join(terms, "|"),
                    F.lit(f")(?![{TERM_CHARACTERS}])"))


def _shape(value: Column) -> Column:
    for characters, mark in ((r"\p{N}+", "0"), (r"\p{Lu}+", "X"), (r"[\p{L}&&[^X]]+", "x")):
        value = F.regexp_replace(value, characters, mark)
    return value


def disclosures(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Spans per row, and the terms that disclose.

    The first has row (all columns of ``docs`` but text), text_id, spans (base, by start and
    kind) and term_spans; a term that overlaps a base span is left to that. Spans have start,
    end (code points, end exclusive), kind and value. The second has term, disclosure.

    Null text is empty. Texts of any length are searched whole. Repeated rows and rows with
    equal texts have equal spans and count as one text in the statistics; ids do not matter.
    An empty table gives no rows; other columns, whatever their names, are carried in row.
    """
    found = kept(entities(docs), "entities")
    terms = kept(disclosing_terms(docs, found, threshold), "disclosing-terms")
    # Per text only the terms that it holds, however many the corpus has.
    holding = kept(_texts_with(docs, terms.select("term"), "term").distinct().groupBy("text_id")
                   .agg(F.sort_array(F.collect_set("term")).alias("terms")), "texts-with-terms")
    holding = holding.withColumnRenamed("text_id", "of")
    rows = docs.select(_text(docs).alias("text"), _text_id(_text(docs)).alias("text_id"))
    rows = rows.join(if_small(holding), F.col("text_id") == F.col("of")).drop("of")
    rows = _split(rows, TERM, F.col("text"), _term_pattern(F.col("terms")), F.lit(True))
    spans = rows.select("text_id", _spans(TERM, len(KINDS), TERM).alias("term_spans"))
    spans = kept(spans.groupBy("text_id").agg(F.first("term_spans").alias("term_spans")),
                 "term-spans").withColumnRenamed("text_id", "of")
    joined = found.join(if_small(spans), F.col("text_id") == F.col("of"), "left")
    apart = F.filter("term_spans", lambda t: ~F.exists(
        "spans", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return joined.select("row", "text_id", "spans", F.coalesce(
        apart, F.array().cast(SPAN)).alias("term_spans")), terms


def sanitised(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with its text sanitised: entities give way to the mark of their kind, terms
    that disclose to their shape, and those that disclose completely to nothing.

    Nulls, repeats, empty tables and other columns are as in ``disclosures``; a null text
    stays null.
    """
    _, terms = disclosures(docs, threshold)
    holding = _texts_with(docs, terms, F.struct("term", (F.col("disclosure") >= 1).alias("gone"))
                          .alias("term")).distinct()
    holding = kept(holding.groupBy("text_id").agg(F.collect_list("term").alias("terms")),
                   "texts-with-terms").withColumnRenamed("text_id", "of")
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns if c != "text")).alias("row"),
                       docs["text"], _text_id(_text(docs)).alias("text_id"))
    rows = rows.join(if_small(holding), F.col("text_id") == F.col("of"), "left")

    def marked(kind: str):
        return lambda v: F.when(valid(kind, v), F.lit(MARKS[kind])).otherwise(v)

    for kind in KINDS:
        rows = _replaced(rows, kind, F.lit(PATTERNS[kind]), F.lit(True), marked(kind))
    terms = lambda test: F.transform(
        F.filter("terms", test), lambda t: t["term"])
    for test, made in ((lambda t: t["gone"], lambda v: F.lit("")), (lambda t: ~t["gone"], _shape)):
        own = terms(test)
        rows = _replaced(rows, TERM, _term_pattern(own), F.size(own) > 0, made)
    return rows.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c)
                         for c in docs.columns))


def _replaced(rows: DataFrame, name: str, pattern: Column, inside: Column, made) -> DataFrame:
    columns = [c for c in rows.columns if not c.startswith(f"{name}_")]
    rows = rows.select(*columns).withColumns({
        f"{name}_found": F.when(inside, F.regexp_extract_all("text", pattern, F.lit(0))),
        f"{name}_between": F.when(inside, F.split("text", pattern, -1))})
    between = F.col(f"{name}_between")
    parts = F.transform(F.col(f"{name}_found"),
                        lambda v, i: F.concat(F.get(between, i), made(v)))
    return rows.withColumn("text", F.when(
        F.size(f"{name}_found") > 0,
        F.concat(F.array_join(parts, ""), F.get(between, F.size(f"{name}_found")))
    ).otherwise(F.col("text"))).select(*columns)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"], s["end"])), ",")


def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found, _ = disclosures(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("row.doc_id").alias("doc_id"), *(count(k).alias(f"n_{k}") for k in KINDS),
        F.sha2(_listed(F.col("spans")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("spans", "term_spans"))).alias("spans"))
