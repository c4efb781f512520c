"""Tokens against the public library, and the way back."""

import random

import numpy as np
import pytest
import tiktoken

from helioledger.llm import bpe
from tests.llm.data import frame, rows

PATH, PATTERN = bpe.public_vocabulary()


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(bpe.vocabulary(PATH), PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def ids(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


def test_random_texts(codec, library):
    rng = random.Random(1)
    parts = [*"abet ", "th", "  ", "\n", "\t", "é", "ß", "漢", "🙂", "12", "'s", "'ll", "!", "--", "\x85", "\x1c", "ing", "İ", "́", "\x00", " ", "<|endoftext|>", "\U0003ea4a"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) if rng.random() < 0.9 else chr(rng.choice([rng.randrange(1, 0xD7FF), rng.randrange(0xE000, 0x110000)])) for _ in range(rng.randrange(25)))
        assert ids(codec, text) == library.encode_ordinary(text), ascii(text)
        assert codec.decode(codec.encode(text)).decode() == text


def test_random_bytes(codec, library):
    rng = random.Random(2)
    for _ in range(3000):
        piece = bytes(rng.choice(b"aeinort \xc3\xa9\x00\xff") for _ in range(rng.randrange(1, 30)))
        assert codec.encode_piece(piece) == library._core_bpe.encode_single_piece(piece)


def test_long_pieces_take_linear_time(codec):
    for text in ("a" * 100_000, "ab" * 50_000, " " * 100_000):
        assert codec.decode(codec.encode(text)).decode() == text


def test_documents(spark, library):
    got = bpe.encode_texts(frame(spark), PATH, PATTERN).collect()
    want = sorted((repr(i), len(x := library.encode_ordinary(t or "")), np.array(x, "<u4").tobytes(), (t or "").encode()) for i, t in rows())
    assert sorted((repr(r.doc_id), r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in got) == want
    assert bpe.digests(bpe.encode_texts(frame(spark, []), PATH, PATTERN)).count() == 0


def test_tables_stay_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    table = bpe.Remembered(lambda key: -key)
    assert [table[k] for k in [*range(100), *range(100)]] == [-k for k in [*range(100), *range(100)]]
    assert len(table) <= 10 and len(table.old) <= 10
