"""Personal data and disclosing terms, spelling variants, ranked search."""

import random

import numpy as np
import plain
import pytest
from plain import SMALL
from pyspark.sql import functions as F

from tidegauge.llm import disclosure, lexical_search, spelling
from tidegauge.llm.tables import ship

ODD = [
    "a@b.c_d@e.f x@y z.@q.r-s.t..u me@host", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1112 and 4111  1111 1111 1111", "+1 (555) 123-4567",
    "+49.30.123456 7890 +1 2 +1234567890123456 ++12 345 678 901 +1+1+1+123456789012)",
    "12 3-4 5 10.0.0.1@x.y +1 10.0.0.1 4111111111111111@mail.de \U0001F600 é a@b.c",
    "", None, "@ + . 1 2-", "\n", "a@b\nc.d 1.2.\n3.4", "+1 555 123\n4567",
]


@pytest.fixture
def words_of(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, text string")


def spans_of(frame):
    return {r.row.doc_id: [(s.start, s.order, s.end, s.kind, s.value) for s in r.spans]
            for r in frame.collect()}


def test_base_spans(documents):
    texts = [*ODD, "x" * 5_000, "1" * 3_000 + " " + "9." * 2_000 + "9",
             "a.b@c.d " * 3_000 + "+1 (" + "(" * 5_000]
    # The plain patterns need the square of a run's length, the operator's do not.
    long = ["x" * 500_000 + "@", "1" * 200_000 + "." * 200_000, "+1" + "(" * 300_000]
    docs = documents(list(enumerate([*texts, *long])))
    assert spans_of(disclosure.entities(docs)) == {
        i: plain.personal(t) for i, t in enumerate(texts)} | {
        len(texts) + i: [] for i in range(len(long))}


def test_base_spans_of_random_texts(documents):
    draw = random.Random(5)
    texts = ["".join(draw.choices("ab1234567890.-+@ ()é\n", k=draw.randint(1, 90)))
             for _ in range(600)]
    docs = documents(list(enumerate(texts)))
    assert spans_of(disclosure.entities(docs)) == {
        i: plain.personal(t) for i, t in enumerate(texts)}


@pytest.fixture
def names(clashing):
    """Zebulon comes with one address only, Maria with many; copies count once."""
    draw = random.Random(3)
    filler = lambda: " ".join(draw.choices(
        ["river", "stone", "cloud", "paper", "green", "wheel", "money", "table"], k=6))
    rows = [(i, f"{filler()} Zebulon zeb@post.org {filler()}") for i in range(20)]
    rows += [(40 + i, f"{filler()} Maria m{i % 3}@post.org {filler()}") for i in range(6)]
    rows += [(100 + i, filler()) for i in range(60)]
    rows += [(60 + i, "copied passage near once@post.org always") for i in range(9)]
    rows += [(80, f"{filler()} zebulon!"), (81, None), (None, "ZEBULON"), (None, "ZEBULON"), (82, "")]
    return clashing(rows), rows


def test_disclosing_terms(names):
    docs, rows = names
    found, terms = disclosure.disclosures(docs)
    want = plain.disclosing([t for _, t in rows])
    assert set(want) == {"zebulon"}
    got = {r.term: r.disclosure for r in terms.collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[t] - want[t]) < 1e-9 for t in want)
    spans = found.select("row.doc_id", F.explode("term_spans").alias("s")).select("doc_id", "s.*")
    values = [(r.doc_id, r.start, r.value) for r in spans.collect()]
    expected = [(i, t.lower().index("zebulon"), t[t.lower().index("zebulon"):][:7])
                for i, t in rows if t and "zebulon" in t.lower()]
    assert sorted(values, key=str) == sorted(expected, key=str)
    assert found.count() == len(rows)


def test_sanitised(names):
    docs, rows = names
    found = disclosure.sanitised(docs)
    assert found.columns == docs.columns
    texts = {r.doc_id: r.text for r in found.collect() if r.doc_id is not None}
    assert "zeb" not in " ".join(t for t in texts.values() if t).lower()
    assert "[@]" in texts[0] and "Maria [@]" in texts[40] and texts[81] is None
    assert texts[100] == dict(rows)[100] and texts[60] == "copied passage near [@] always"
    shapes = {r.text for r in found.filter("doc_id is null").collect()}
    assert shapes <= {"X", ""}


def test_disclosure_over_a_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    terms = plain.disclosing([t for _, t in rows])
    got = disclosure.op11(spark, SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        base = plain.personal(dict(rows)[r.doc_id])
        listed = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind, _ in base)
        assert r.base_sha256 == plain.sha256(listed)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(s[3] == kind for s in base) for kind in plain.BASE]
        if not terms:
            assert r.spans == listed


def test_disclosure_of_empty_table(documents):
    found, terms = disclosure.disclosures(documents([]))
    assert found.count() == 0 and terms.count() == 0


def read_variants(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


def test_variants_of_random_words(clashing):
    draw = random.Random(11)
    rows = [(draw.choice([None, 1, 2, 3, i]), " ".join(
        "".join(draw.choices("aabÀé", k=draw.randint(4, 7))) for _ in range(60)))
        for i in range(60)]
    rows += [(7, None), (8, ""), (9, "AAAAAAA aaaaaaa, ÀÀ1aaaaaaa_aaaaaaa")]
    for one_in in (31, None):
        got = read_variants(spelling.variant_groups(clashing(rows), 5, 2, 2, one_in))
        want = plain.variants(rows, 5, 2, 2, one_in)
        assert got == want and len(want) > 100
        assert sum(w[1] != w[0] and w[0] is not None for w in want.values()) > 0


def test_variant_chain_and_ties(words_of):
    text = "wordsss " * 400 + "wordss1 " + "wordxss " * 40 + "wordxxs " * 4 + "wordxsz " * 40
    rows = [(1, text), (1, text), (2, "x" * 100_000 + " " + "x" * 100_001 + " y" * 5)]
    got = read_variants(spelling.variant_groups(words_of(rows), one_in=None))
    assert got == plain.variants(rows, one_in=None)
    assert got["wordxxs"][:2] == ("wordxss", "wordsss")


def test_variants_of_nothing(words_of):
    assert spelling.variant_groups(words_of([])).count() == 0
    assert spelling.variant_groups(words_of([(1, None), (2, "short words")])).count() == 0


def read_search(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()),
                  key=str)


@pytest.fixture
def asked(spark):
    return lambda rows: spark.createDataFrame(
        [(*r, 1, 2) for r in rows], "item_id long, text string, number long, rank long")


def test_search_of_random_texts(clashing, asked, monkeypatch):
    draw = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["Über", "ÜBER", "x1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda k: "; ".join(draw.choices(vocabulary, weights, k=k))
    rows = [(i, text(draw.choice([1, 3, 30, 200]))) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(30)] + [(3, rows[3][1]), (None, text(9))] * 2
    rows += [(300, None), (301, ""), (302, "..."), (303, "w1 " * 30_000)]
    items = [(i, text(8)) for i in range(6)] + [(0, "w5"), (None, "w7 w7"), (9, None), (10, "?!"),
                                               (11, "absent terms"), (1, rows[3][1])]
    want = sorted(plain.search(rows, items), key=str)
    assert read_search(lexical_search.search(clashing(rows), asked(items))) == want
    # Small blocks and several blocks of items change nothing.
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 16)
    monkeypatch.setattr(lexical_search, "ITEMS", 4)
    monkeypatch.setattr(lexical_search, "HELD", 50)
    assert read_search(lexical_search.search(clashing(rows), asked(items))) == want


def test_search_without_rows(documents, asked):
    assert lexical_search.search(documents([]), asked([(1, "w")])).count() == 0
    assert lexical_search.search(documents([(1, "w")]), asked([])).count() == 0


def test_bounds_cover_scores_and_exclude_most(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = lexical_search.Items.of(
        spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").toArrow())
    items.weigh(*lexical_search.statistics(docs, items.terms))
    ship(spark)
    scores = {(r["item"], r["doc_id"]): r["score"]
              for r in lexical_search.scored(docs, items, 1_000).collect()}
    close = total = 0
    for row in lexical_search.signature_index(docs).collect():
        bounds = lexical_search.bounds_of(items, row.width, np.array(row.lengths),
                                          bytes(row.slices))
        for at, doc_id in enumerate(row.ids):
            for item in range(len(items.sizes)):
                score = scores.get((item, doc_id), 0)
                assert bounds[item, at] >= score
                total += 1
                close += bounds[item, at] <= 1.35 * score + 1
    assert close > 0.8 * total
