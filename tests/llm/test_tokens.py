"""Tokenisers, packing and chat formatting against libraries and exact round trips."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidegauge.llm import byte_bpe, chat_format, packing, token_counts

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
BITS = ["a", "s", "t", "re", "ll", " ", "  ", "\n", "\t", "'", "aaa", "''", "'s", "1", "é", "!",
        " ", "漢", "　", "d", "😀", "١", "'ve", "<|endoftext|>", "<|", "the", "and", "ing",
        "tion", "Привет", "\u0085"]


def random_texts(count, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 14))) for _ in range(count)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def tokens():
    return byte_bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def codec(tokens):
    return byte_bpe.Codec(byte_bpe.library_model(tokens), tokens)


@pytest.fixture(scope="module")
def peer(tokens):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                             mergeable_ranks={t: i for i, t in enumerate(tokens)})


def test_counts_equal_the_library(library):
    texts = [*random_texts(3000), None, "", "x" * 5000, "<|endoftext|>" * 3]
    counter = token_counts.Counter(token_counts.read_merges(JSON))
    n_bytes, n_tokens = counter(pa.array(texts))
    assert n_tokens.tolist() == [len(library.encode(t or "", add_special_tokens=False).ids)
                                 for t in texts]
    assert n_bytes.tolist() == [len((t or "").encode()) for t in texts]


def test_counts_query_shape(clashing):
    rows = [(None, "a b"), (1, None), (1, None), (2, "word " * 600)]
    got = sorted((str(r.doc_id), r.n_tokens, r.over_limit)
                 for r in token_counts.token_counts(clashing(rows), JSON).collect())
    assert got == [("1", 0, False), ("1", 0, False), ("2", 601, True), ("None", 2, False)]
    assert token_counts.token_counts(clashing([]), JSON).count() == 0


def test_encoding_equals_tiktoken(codec, peer):
    texts = [*random_texts(3000, 5), None, "", "日本語" * 40]
    at = 0
    for first, ids, sizes, _ in codec.encode(pa.array(texts)):
        for i, size in enumerate(sizes.tolist()):
            text, own = texts[first + i] or "", ids[at:at + size]
            assert own.tolist() == peer.encode_ordinary(text)
            assert codec.decode(own).tobytes() == text.encode()
            assert "".join(codec.decoded_parts(own.tolist())) == text
            at += size
        at = 0


def test_split_characters_and_bad_bytes(codec, tokens):
    by_token = {t: i for i, t in enumerate(tokens)}
    first, *rest = (by_token[bytes([b])] for b in "😀".encode())
    assert list(codec.decoded_parts([first, *rest])) == ["", "", "", "😀", ""]
    assert "".join(codec.decoded_parts([first])) == "�"


def test_encode_decode_frames(clashing):
    rows = [(1, "one two"), (None, "É 1"), (2, None), (2, "")]
    encoded = byte_bpe.encode(clashing(rows), RANKS)
    found = {(r.doc_id, bytes(r.decoded).decode()) for r in byte_bpe.decode(encoded, RANKS).collect()}
    assert found == {(1, "one two"), (None, "É 1"), (2, "")}
    offsets = {r.doc_id: r.offsets for r in encoded.filter("doc_id = 1").collect()}[1]
    assert offsets[0] == 0 and offsets == sorted(offsets)
    trip = {r.doc_id: r for r in byte_bpe.round_trip(clashing(rows), RANKS).collect()}
    assert trip[1].decoded_sha256 == hashlib.sha256(b"one two").hexdigest()
    assert byte_bpe.round_trip(clashing([]), RANKS).count() == 0


def packed_rightly(rows, docs, library, sequence):
    ids = {k: [*library.encode(t or "", add_special_tokens=False).ids, 1] for k, t in docs}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        assert r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans, total in [*((pieces[k], len(ids[k])) for k in ids),
                         *((s, None) for s in sequences.values())]:
        at = 0
        for start, length in sorted(spans):
            assert start == at and length > 0
            at += length
        assert total is None and at <= sequence or at == total
    return sequences


def test_packing(documents, library):
    docs = [(i, t) for i, t in enumerate([*random_texts(150), None, "", "word " * 500])]
    rows = packing.pack(documents(docs), JSON, sequence=64, group_rows=40).collect()
    sequences = packed_rightly(rows, docs, library, 64)
    assert sum(64 - sum(n for _, n in s) for s in sequences.values()) < 4 * 64


def test_balanced_is_full_and_even():
    lengths = np.random.default_rng(2).integers(1, 100, 500)
    pieces = packing.balanced(lengths, 100)
    used = np.bincount([p[3] for p in pieces], [p[2] for p in pieces])
    assert len(used) == -(-lengths.sum() // 100) and used.max() <= 100
    cost = np.bincount([p[3] for p in pieces], [p[2] + p[2] ** 2 / 1024 for p in pieces])
    assert cost.max() < 1.1 * cost.mean()


def test_packing_repeats_and_empty(clashing):
    got = packing.pack(clashing([(None, "a"), (5, ""), (5, "")]), JSON).collect()
    assert sorted((str(r.doc_id), r.doc_tokens) for r in got) == [("5", 1), ("5", 1), ("None", 2)]
    assert packing.pack(clashing([]), JSON).count() == 0


def test_packing_deals_repeats_over_groups(documents):
    rows = documents([(None, "")] * 300 + [(7, "the same text")] * 300)
    got = packing.pack(rows.coalesce(1), JSON, sequence=64, group_rows=30).collect()
    assert sum(r.length for r in got) == sum(r.doc_tokens for r in got if r.start == 0)
    held = {}
    for r in got:
        key = (r.doc_id, r.sequence_id >> 32)
        held[key] = held.get(key, 0) + (r.start == 0)
    assert max(held.values()) < 60 and sum(held.values()) == 600


CHAT = "conv_id long, turn long, role string, text string"


def test_chat_round_trip(spark):
    rng = random.Random(8)
    bits = ["<|", "|>", "<|im_end|>", "<|im_start|>", "\\", "\n", "a", "<", "|", "é", "\\n", "user",
            "<\\|"]
    rows, want = [], {}
    for conv in range(60):
        turns = [(rng.choice(["user", "assistant", "system", "a\nb", "x\\", ""]),
                  "".join(rng.choice(bits) for _ in range(rng.randint(0, 9))))
                 for _ in range(rng.randint(1, 7))]
        rows += [(conv, i, *t) for i, t in enumerate(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        want[conv] = (len(turns), hashlib.sha256("".join(
            f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())
    found = chat_format.read_back(chat_format.examples(spark.createDataFrame(rows, CHAT))).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
            for r in found} == want


def test_chat_examples(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "r"), (1, 2, "user", "s"),
            (1, 3, "assistant", "t"), (2, 0, "user", "only")]
    got = {(r.conv_id, r.example): r for r in chat_format.examples(
        spark.createDataFrame(rows, CHAT)).collect()}
    assert len(got) == 3
    first, second = got[1, 0], got[1, 1]
    assert second.text.startswith(first.text) and second.trainable
    assert second.text[second.loss_start:second.loss_start + second.loss_chars] == "t"
    assert not got[2, 0].trainable and got[2, 0].loss_chars == 0


def test_chat_nulls_and_ties(spark):
    rows = [(None, None, None, None), (None, 1, "assistant", "b"), (None, 1, "assistant", "a"),
            (None, 1, "assistant", "a")]
    chats = spark.createDataFrame([(*r, 1) for r in rows], CHAT + ", example int")
    got = chat_format.read_back(chat_format.examples(chats)).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in got] == [(None, 4, 3)]
    assert got[0].loss_sha256 == hashlib.sha256(b"aab").hexdigest()
    assert chat_format.examples(chats.limit(0)).count() == 0
