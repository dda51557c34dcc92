"""Exact, line and near-copy deduplication against plain versions."""

import random

import plain
import pytest

from tidegauge.llm import bucketed, components, exact_dedup, line_dedup, ngram_join
from tidegauge.llm.tables import new_folder

TEXTS = ["", None, " ", "one", "ONE two", "one\ttwo", "one two ", "a b c d e", "a b c d e f",
         "A b c d e", "the same long line\nother line here\nthe same long line",
         "  The same long line \nshort\nshort", "short\nlong line number two", "é" * 12 + "\nx",
         "É" * 12, "é" * 12]


@pytest.fixture
def small():
    return list(enumerate(TEXTS))


def near_copies(count, size=60, edits=3, seed=1):
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(size)]
    out = []
    for i in range(count):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(size)] = f"x{rng.randrange(10 ** 6)}"
        out.append((i, " ".join(words)))
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def groups_of(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_exact_groups(small, documents):
    got = exact_dedup.exact_groups(documents(small)).collect()
    assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == plain.exact_groups(small)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    assert {r.doc_id: r.text_sha256 for r in got}[5] == plain.sha256("onetwo")


def test_exact_index_continues(spark, documents):
    place = new_folder(spark, "index")
    exact_dedup.exact_groups(documents([(1, "a b"), (2, "c")]), place, 4, 1)
    again = exact_dedup.exact_groups(documents([(3, "ab "), (4, "a  b"), (5, "d")]), place, 4, 1)
    got = {r.doc_id: (r.keep_id, r.group_size) for r in again.collect()}
    assert got == {3: (4, 3), 4: (4, 3), 5: (5, 1)}


def test_batch_admitted_again_counts_once(spark, documents):
    index = exact_dedup.DigestIndex(spark, new_folder(spark, "index"), 4)
    first, second = (exact_dedup.digests(documents(rows)) for rows in (
        [(1, "a"), (2, "a"), (3, "b")], [(4, "a"), (5, "c")]))
    index.admit(first, "one")
    fresh = [rows_of(index.admit(second, "two")) for _ in range(2)]
    assert fresh[0] == fresh[1] and len(fresh[0]) == 1
    index.admit(first, "one")
    assert sorted(r.copies for r in index.settled().collect()) == [1, 1, 3]


def test_exact_call_repeated_by_name_counts_once(spark, documents):
    place, docs = new_folder(spark, "index"), documents([(i, f"t{i % 4}") for i in range(20)])
    first, again = (rows_of(exact_dedup.exact_groups(docs, place, 4, 3, "load-1"))
                    for _ in range(2))
    assert first == again and {r[2] for r in first} == {5}


def test_exact_nulls_repeats_and_names(clashing):
    rows = [(None, "x"), (None, "x y"), (2, "x"), (2, "x"), (-5, "q")]
    got = sorted(
        ((str(r.doc_id), r.keep_id, r.group_size, r.kept)
         for r in exact_dedup.exact_groups(clashing(rows)).collect()), key=str)
    assert got == [("-5", -5, 1, True), ("2", 2, 3, True), ("2", 2, 3, True),
                   ("None", 2, 3, False), ("None", None, 1, True)]
    assert exact_dedup.exact_groups(clashing([])).count() == 0


@pytest.mark.parametrize("batches", [1, 3])
def test_line_dedup(small, documents, batches):
    got = line_dedup.dedup_lines(documents(small), batches=batches, buckets=3).collect()
    assert {r.row.doc_id: (r.text, r.n_lines, r.n_dropped) for r in got} == plain.dedup_lines(small)


def test_line_dedup_random(documents):
    rng = random.Random(4)
    lines = [f"line number {i} of many" for i in range(40)] + ["", "tiny", "TINY "]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 9))))
            for i in range(80)]
    got = line_dedup.dedup_lines(documents(rows), batches=5, buckets=2, fan_out=2).collect()
    assert {r.row.doc_id: (r.text, r.n_lines, r.n_dropped) for r in got} == plain.dedup_lines(rows)


def test_line_dedup_nulls_repeats_and_names(clashing):
    line = "a line that is long"
    rows = [(None, line), (None, f"{line}\nx"), (3, line), (3, f"y\n{line}"), (3, line)]
    got = sorted((str(r.row.doc_id), r.text) for r in line_dedup.dedup_lines(clashing(rows)).collect())
    assert got == [("3", line), ("3", line), ("3", f"y\n{line}"), ("None", ""), ("None", "x")]
    assert line_dedup.dedup_lines(clashing([])).count() == 0
    alone = line_dedup.dedup_lines(clashing([(None, line), (None, line)])).collect()
    assert [r.text for r in alone] == [line, line]


def test_runs_compact(spark):
    runs = line_dedup.LevelledRuns(spark, new_folder(spark, "runs"), 2, fan_out=2)
    for i in range(5):
        runs.add(spark.createDataFrame([(bytes([i]),)], "hash binary"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    asked = spark.createDataFrame([(bytes([i]),) for i in range(7)], "hash binary")
    assert {bytes(r.hash) for r in runs.unknown(asked).collect()} == {b"\x05", b"\x06"}


def test_id_ranges_cover(documents):
    rows = documents([(i, "") for i in (-7, 0, 5, 5, 90)] + [(None, "")])
    found = [rows.filter(c).count() for c in bucketed.id_ranges(rows, 3)]
    assert sum(found) == 6


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (3, 2), (3, 4), (9, 8), (9, 9), (20, 21), (21, 22)],
                                  "a long, b long")
    got = {r.node: r.component for r in components.components(links).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8, 20: 20, 21: 20, 22: 20}
    assert components.components(links.limit(0)).count() == 0
    more = spark.createDataFrame([(22, 4), (9, 30), (40, 41)], "a long, b long")
    got = {r.node: r.component
           for r in ngram_join.joined_components(components.components(links), more).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8, 30: 8, 20: 1, 21: 1, 22: 1, 40: 40, 41: 40}


def test_jaccard_small(small, documents):
    assert groups_of(ngram_join.jaccard_groups(documents(small))) == plain.jaccard_groups(small)


@pytest.mark.parametrize("frequent", [4, 128])
def test_jaccard_near_copies(documents, monkeypatch, frequent):
    rows = near_copies(60) + [(100 + i, t) for i, t in near_copies(30, 20, 2, 7)]
    shared = " ".join(f"p{i}" for i in range(16))
    rows += [(200 + i, f"{shared} q{i} r{i} s{i} t{i}") for i in range(40)] + [(300, shared)]
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    assert groups_of(ngram_join.jaccard_groups(documents(rows))) == plain.jaccard_groups(rows)


def test_signed_pairs_share_a_signature():
    """Linked sets share a signature, whichever of their tokens are frequent."""
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(150):
        size = int(rng.integers(1, 140))
        x = np.unique(rng.integers(0, 2 ** 64, size, dtype=np.uint64))
        lost = rng.integers(0, max(1, len(x) // 7) + 1)
        y = np.unique(np.concatenate([rng.permutation(x)[lost:], rng.integers(
            0, 2 ** 64, int(rng.integers(0, max(1, len(x) // 7) + 1)), dtype=np.uint64)]))
        common = len(np.intersect1d(x, y))
        if 100 * common < 75 * (len(x) + len(y) - common):
            continue
        every = np.unique(np.concatenate([x, y]))
        often = rng.permutation(every)[:int(rng.integers(0, len(every) + 1))]
        found = [dict(zip(s.tolist(), room.tolist())) for s, _, room in (
            ngram_join.signed(t, np.array([len(t)]), np.sort(often), 75) for t in (x, y))]
        needed = -(-(len(x) + len(y)) * 75 // 175)
        assert any(min(found[0][s], found[1][s]) >= needed for s in found[0].keys() & found[1])


def test_jaccard_nulls_repeats_and_names(clashing):
    a = " ".join("abcdefgh")
    rows = [(None, a), (7, a), (7, a), (3, a + " i"), (None, "lonely"), (None, None), (8, "")]
    got = sorted(((str(r.doc_id), r.component_id, r.n_shingles)
                  for r in ngram_join.jaccard_groups(clashing(rows)).collect()), key=str)
    assert got == [("3", 3, 5), ("7", 3, 4), ("7", 3, 4), ("8", 8, 0), ("None", 3, 4),
                   ("None", None, 0), ("None", None, 1)]
    assert ngram_join.jaccard_groups(clashing([])).count() == 0
