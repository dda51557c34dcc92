"""Language ID, suffix tree and nearest neighbours by accuracy and brute force."""

import os
import random
import tracemalloc
import zlib

import numpy as np
import plain
import public_tokenizers as P
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from plain import SMALL

from tidegauge.llm import language_id, nearest, suffix_tree

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def fold(doc_id, count):
    return zlib.crc32(str(doc_id).encode()) % count


@pytest.fixture(scope="module")
def documents_table(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents_table):
    return language_id.train(documents_table, RANKS)


def test_languages_of_held_out_documents(spark, documents_table):
    found = {r.doc_id: r for r in language_id.op2(spark, SMALL).collect()}
    rows = documents_table.collect()
    assert all(found[r.doc_id].held_out == (fold(r.doc_id, 3) == 1) for r in rows)
    held = [found[r.doc_id].lang_pred == r.lang for r in rows if found[r.doc_id].held_out]
    assert np.mean(held) > 0.97


def test_forward_sums_all_segmentations(model):
    pieces, shares = model.pieces, model.shares
    word = b"reines"
    data = np.frombuffer(word, np.uint8)
    got = language_id.log_likelihoods(data, np.array([0]), np.array([6]), pieces, shares)[0]
    text = np.frombuffer(b" " + word, np.uint8)

    def chance(begin):
        if begin == len(text):
            return np.ones(shares.shape[1])
        ends = np.arange(begin + 1, len(text) + 1)
        keys = language_id.ragged.hashes(text, np.full(len(ends), begin), ends)
        return sum(shares[place] * chance(end) for place, end in zip(pieces.find(keys), ends))

    assert np.allclose(got, np.log(chance(0)))


def test_language_edge_cases(clashing, model):
    rows = [(1, None), (None, ""), (3, "123 !?"), (3, "123 !?"), (4, "x" * 5000), (5, "the İ and")]
    got = language_id.with_language(clashing(rows), model).collect()
    assert len(got) == 6
    by = {(r.row.doc_id, r.row.text): r for r in got}
    assert all(by[k].lang_pred == "und" and by[k].score == 0
               for k in ((1, None), (None, ""), (3, "123 !?")))
    assert by[4, "x" * 5000].lang_pred in model.languages and 0 <= by[5, "the İ and"].score <= 1
    assert language_id.with_language(clashing([]), model).count() == 0
    empty = language_id.train(clashing([]), RANKS)
    assert [r.lang_pred for r in language_id.with_language(clashing([(1, "a")]), empty).collect()] == ["und"]


def test_unlikely_words_and_long_pieces(model):
    word = "\u1200\u1208\u1210\u1218".encode() * 5 + b"xyzw"
    data, at, end = np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)])
    least = np.where(np.arange(len(model.shares))[:, None] < len(model.pieces.keys), 1e-11, 0.0)
    logs = language_id.log_likelihoods(data, at, end, model.pieces, least * np.ones((1, 2)))
    assert np.isfinite(logs).all() and (logs < np.log(1e-308)).all()
    assert model.pieces.longest > 12


def test_base_scores_and_gain(spark, documents_table):
    found = {r.doc_id: r for r in suffix_tree.op3(spark, SMALL).collect()}
    rows = [(r.doc_id, r.text) for r in documents_table.select("doc_id", "text").collect()]
    want = plain.base_scores(rows, lambda i: fold(i, 7) != 2)
    total = sum(n for i, (n, _, _) in want.items() if fold(i, 7) != 2)
    for doc_id, (tokens, known, base) in want.items():
        row = found[doc_id]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (tokens, known, total)
        assert row.base_score == pytest.approx(base, rel=1e-9)
    learned = [r for r in found.values() if not r.held_out]
    assert sum(r.score for r in learned) > sum(r.base_score for r in learned)


def test_distributions_sum_to_one(documents):
    """With a closed vocabulary, each state's next-token shares and the root's add up."""
    texts = ["a b c d"] * 20 + ["a b x d"] * 4 + ["c a d b", "d c b a"] * 6
    docs = documents([(i, t) for i, t in enumerate(texts)])
    model, _, total, kinds = suffix_tree.train(docs)
    words = model.words[model.word_counts > 0]
    assert any(len(s) for s, _ in model.states)
    for before in ([], [words[0]], [words[1], words[2]]):
        whole = 0.0
        for word in words:
            tokens = np.array([*before, word], np.uint64)
            logs, covered, *_ = model.scored(tokens, np.arange(len(tokens)))
            count = model.word_counts[model.words == word][0]
            whole += 10 ** logs[-1] * (1.0 if covered[-1] else (count + 1) / (total + kinds + 1))
        assert whole <= 1 + 1e-9 and whole > 0.9


def test_score_edge_cases(clashing):
    rows = [(None, None), (None, None), (1, ""), (2, "w " * 4000), (2, "rare one"), (2, "rare one")]
    got = suffix_tree.scores(clashing(rows)).collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 1, 3, 3, 4001]
    twice = [r for r in got if r.n_tokens == 3]
    assert twice[0] == twice[1]
    assert suffix_tree.scores(clashing([])).count() == 0


def tree_rows():
    """Each of 60 phrases comes 14 times, evenly mixed."""
    return [(i, f"a{i % 60} b{i % 60} c{i % 60} d{i % 60}") for i in range(840)]


def test_states_need_no_repeats_in_a_block(documents, monkeypatch):
    monkeypatch.setattr(suffix_tree, "BLOCK", 50)
    model, _, _, _ = suffix_tree.train(documents(tree_rows()).repartition(40))
    assert len(model.states[0][0]) >= 60 and len(model.entries) >= 60


def test_scores_do_not_depend_on_blocks_or_splits(documents, monkeypatch):
    def found(parts, block):
        monkeypatch.setattr(suffix_tree, "BLOCK", block)
        rows = suffix_tree.scores(documents(tree_rows()).repartition(parts)).collect()
        return [round(r.score, 6) for r in sorted(rows, key=lambda r: r.doc_id)]

    assert found(1, 1 << 20) == found(30, 40)


def mixed_rows():
    """Texts over few words, with phrases that make states of every length."""
    draw = random.Random(4)
    phrases = ["a b c d", "x b c e", "y z a b", "c d x", "e e e e", "b c"]
    return [(i, " ".join(draw.choices(phrases, k=draw.randint(1, 9)))) for i in range(160)]


@pytest.mark.parametrize("most", [10 ** 6, 60, 12, 0])
def test_scores_equal_a_plain_suffix_tree(documents, monkeypatch, most):
    """Whatever share of the tree is sent."""
    rows = mixed_rows() + [(900, "new words a b c"), (901, None)]
    want, states = plain.suffix_tree_scores(rows, lambda i: fold(i, 7) != 2)
    assert all(states.values()) and len(states) == 3
    monkeypatch.setattr(suffix_tree, "SENT_ENTRIES", most)
    monkeypatch.setattr(suffix_tree, "SENT_WORDS", 4 if most < 20 else 1_000)
    got = {r.doc_id: r.score for r in suffix_tree.scores(documents(rows)).collect()}
    assert got == pytest.approx(want, rel=1e-9)


def test_joined_scores_equal_those_of_a_sent_model(clashing, monkeypatch):
    rows = tree_rows() + [(None, "a1 b1 c1 x"), (None, "a1 b1 c1 x"), (9000, ""), (9001, None)]

    def found():
        return sorted((r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6),
                       round(r.score, 6)) for r in suffix_tree.scores(clashing(rows)).collect())

    sent = found()
    monkeypatch.setattr(suffix_tree, "SENT_ENTRIES", 0)
    monkeypatch.setattr(suffix_tree, "SENT_WORDS", 20)
    assert found() == sent


def packed(chunks, size=8_000):
    """A bucket of positions that no context settled, 20 texts in a chunk, and states for some."""
    draw = np.random.default_rng(3)
    words = np.sort(draw.integers(1, 2 ** 64, 400, np.uint64))
    none = (np.zeros(0, np.uint64), np.zeros(0))
    model = suffix_tree.Model(words[::2], np.arange(200), [none] * 3, *none,
                              suffix_tree.Filter(np.full(64, 255, np.uint8)))
    parts, states = [], []
    for k in range(chunks):
        tokens = words[draw.integers(0, 400, size)]
        owner = np.sort(draw.integers(0, 20, size))
        place = np.arange(size) - np.searchsorted(owner, owner)
        parts.append(suffix_tree.positions(
            model, pa.array([None, *range(1, 20)], pa.int64()), 0, tokens, owner, place,
            np.arange(20).astype(np.uint64) + np.uint64(100 * k), 1))
        at, keys = list(suffix_tree.contexts(tokens, place))[k % 3]
        states.append((keys[:50], suffix_tree.entry_keys(keys[:50], tokens[at[:50]])))
    ctx, entry = (np.concatenate(x) for x in zip(*states))
    rest = pa.table({"ctx": ctx.view(np.int64), "entry": entry.view(np.int64),
                     "log": -np.arange(1.0, len(ctx) + 1), "backing": np.full(len(ctx), -0.5)})
    return pa.Table.from_batches(parts), rest, model.words, model.word_counts


def test_what_a_bucket_unpacks_does_not_grow_with_it(monkeypatch):
    monkeypatch.setattr(suffix_tree, "SLICE", 1 << 14)

    def peak(chunks):
        bucket = packed(chunks)
        tracemalloc.start()
        suffix_tree.settle(*bucket)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    peak(2)
    assert peak(40) < 2 * peak(4)


def test_slices_of_a_bucket_change_nothing(monkeypatch):
    def sums(most):
        monkeypatch.setattr(suffix_tree, "SLICE", most)
        found = suffix_tree.settle(*packed(5)).to_pylist()
        return sorted(((r["text_id"], r["rare"] or 0, r["n_open"], round(r["logs"], 6),
                        round(r["open"], 6)) for r in found))

    whole = sums(1 << 30)
    assert len({r[0] for r in whole}) == 100 and any(r[1] for r in whole)
    assert any(r[3] for r in whole) and sums(100) == whole


def test_positions_travel_in_few_bytes():
    """Beside their contexts, which are hashes, less than half of tokens and logs unpacked."""
    rows = packed(1)[0]
    places = sum(len(x.as_buffer()) for x in rows.column("marks"))
    sizes = {c: sum(len(x.as_buffer()) for x in rows.column(c))
             for c in ("starts", "words", "tokens", "logs", "marks")}
    assert places > 7_000 and sum(sizes.values()) < 0.5 * places * (8 + 8 + 4 + 1)


def test_infrequent_runs_travel_once_for_each_chunk():
    """As a key with its texts, whatever precedes it: not with logs, token and contexts."""
    draw = np.random.default_rng(5)
    size, buckets = 20_000, 16
    keys = draw.integers(1, 2 ** 64, 4_000, np.uint64)[draw.integers(0, 4_000, size)]
    owner = np.sort(draw.integers(0, 50, size))
    none = keys[:0], owner[:0]
    own = np.zeros((suffix_tree.WIDTH, 50))
    rows = suffix_tree.keyed_rows(3, [*range(49), None], own, (keys, owner), none, buckets)
    sizes = [sum(len(x.as_buffer()) for x in rows.column(c) if x.is_valid)
             for c in ("runs", "run_texts", "run_text", "run_n")]
    assert sizes[0] == 8 * len(set(keys.tolist())) and sum(sizes) < 14 * size
    values = draw.normal(size=4_000)
    known = np.unique(keys)[::2]
    rest = pa.table({"key": known.view(np.int64), "value": values[:len(known)],
                     "word": np.zeros(len(known), bool)})
    answers = [suffix_tree.answer(pa.table(rows).filter(pc.equal(rows.column("bucket"), b)), rest)
               for b in range(buckets)]
    got = suffix_tree.together(pa.concat_tables(answers[::-1]))
    value = dict(zip(known.tolist(), values))
    want = np.zeros(50)
    for key, text in zip(keys.tolist(), owner):
        want[text] += value.get(key, 0.0)
    assert got.column("value").to_pylist() == pytest.approx(want, rel=1e-9, abs=1e-9)
    assert got.column("doc_id").to_pylist() == [*range(49), None]


def test_what_travels_of_a_text_is_its_sums(documents, monkeypatch):
    """Scoring makes one row for each text, also where most of the tree and words is not sent."""
    monkeypatch.setattr(suffix_tree, "SENT_ENTRIES", 12)
    monkeypatch.setattr(suffix_tree, "SENT_WORDS", 4)
    seen = {}

    def counted(df, label, kept=suffix_tree.kept):
        seen[label] = kept(df, label)
        if label in ("scored", "settled"):
            seen[label, "rows"] = seen[label].count()
        return seen[label]

    monkeypatch.setattr(suffix_tree, "kept", counted)
    rows = mixed_rows() + [(900, "new words a b c"), (901, None)]
    suffix_tree.scores(documents(rows)).count()
    assert seen["scored", "rows"] == len(rows) and "settled" not in seen


def test_tables_are_gone_before_texts_travel_in_shares(documents, monkeypatch):
    """What lies on disk at once: no level of the tree beside what texts send, and one share of
    the texts after the other."""
    monkeypatch.setattr(suffix_tree, "SENT_ENTRIES", 12)
    monkeypatch.setattr(suffix_tree, "SENT_WORDS", 4)
    monkeypatch.setattr(suffix_tree, "ROUNDS", 3)
    paths, there, shares = {}, {}, {}

    def counted(df, label, kept=suffix_tree.kept):
        there[label] = {name for name, path in paths.items() if os.path.exists(path)}
        done = kept(df, label)
        paths[label] = done._kept_at.removeprefix("file:")
        shares[label] = done.count() if label.startswith("summed") else 0
        return done

    monkeypatch.setattr(suffix_tree, "kept", counted)
    rows = mixed_rows() + [(None, None)]
    assert suffix_tree.scores(documents(rows)).count() == len(rows)
    assert "sums-1" in paths and "level-1" in there["lookups"] and there["summed-0"] == {"lookups"}
    assert sum(shares.values()) == len(rows) and sum(n > 0 for n in shares.values()) > 1


def test_sums_travel_as_numbers_of_words():
    """Frequent words as numbers, which compress, others as their hashes."""
    draw = np.random.default_rng(8)
    words = np.sort(np.unique(draw.integers(1, 2 ** 64, 3_000, np.uint64)))
    counts = draw.permutation(len(words)) + 1
    frequent = suffix_tree.Frequent(words[::2], counts[::2], float(np.median(counts[::2])))
    tokens = words[draw.integers(0, len(words), 5_000)]
    numbers = frequent.numbered(tokens)
    others = tokens[numbers == 0]
    assert (numbers == 0).tolist() == (np.searchsorted(words, tokens) % 2 == 1).tolist()
    assert frequent.unpacked(numbers, others).tolist() == tokens.tolist()
    assert frequent.near(tokens).sum() < (numbers > 0).sum()
    packed = pa.scalar(suffix_tree.squeezed(suffix_tree._planes(numbers)), pa.binary())
    assert len(packed.as_py()) < 2.5 * len(tokens)
    assert suffix_tree._numbers(suffix_tree.expanded(packed)).tolist() == numbers.tolist()


VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, query, count):
    vectors = {i: np.array(v, float) for i, v in rows}
    score = [(-float(np.dot(vectors[query], v)), i) for i, v in vectors.items() if i != query]
    return [i for _, i in sorted(score)[:count]]


def test_recall(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(20, 16))
    data = [(i, [float(x) for x in centres[i % 20] + 0.3 * rng.normal(size=16)], 0)
            for i in range(800)]
    frame = spark.createDataFrame(data, VECTORS)
    found = nearest.search(frame, frame.filter("vec_id % 40 = 0"), 10, routes=8, parts=20).collect()
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    hits = [r.vec_id in brute(rows, r.query_id, 10) for r in found]
    assert len(found) == 200 and np.mean(hits) >= 0.9


def test_equal_vectors_and_bad_ones(spark):
    same = [1.0, 2.0]
    data = ([(i, same, 0) for i in range(50)] + [(100, [2.0, 4.0], 0), (101, [-1.0, 0.5], 0)]
            + [(200, None, 0), (201, [0.0, 0.0], 0), (202, [float("nan"), 1.0], 0),
               (203, [None, 1.0], 0), (204, [float("inf"), 1.0], 0), (None, same, 0), (7, same, 0)])
    frame = spark.createDataFrame(data, VECTORS)
    got = nearest.search(frame, frame.filter("vec_id in (7, 100, 200, 201)"), 5).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert by == {7: [100, 0, 1, 2, 3], 100: [0, 1, 2, 3, 4]}
    assert nearest.search(frame.limit(0), frame.limit(0)).count() == 0
    alone = frame.filter("vec_id = 100")
    assert nearest.search(alone, alone).count() == 0
