"""Packing against the tokenizer itself and against the rule, spelled out."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helioledger.llm import packing
from tests.llm.data import found, frame, rows


WHOLE = Tokenizer.from_file(packing.public_vocabulary())
WHOLE.encode_special_tokens = True


@pytest.fixture
def tokenizer():
    return WHOLE


ODD = ["á ́b", "a\x1cb\x85c d e", "don't we'll 's", "İstanbul ΣΑΣ ς", "<|endoftext|> x<|startoftext|>y <|", "한국어 가", "12 3,4", "\x00 \x0b\x0c", "x" * 5000, ""]


def test_ids_are_those_of_whole_texts(tokenizer):
    encode = packing.TextEncoder(packing.public_vocabulary())
    texts = [*ODD, *(t or "" for _, t in rows())]
    for _ in range(2):
        assert [i.tolist() for i in encode.ids(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t\x1c\x85\xa0×÷ßÿ'slmÀ́ͅ<|>ab1")), max_size=30), max_size=4))
def test_ids_of_odd_texts(texts):
    encode = packing.encoder(packing.public_vocabulary())
    assert [i.tolist() for i in encode.ids(texts)] == [WHOLE.encode(t, add_special_tokens=False).ids for t in texts]


def test_little_memory(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    monkeypatch.setattr(packing, "WORDS_AT_ONCE", 2)
    encode = packing.TextEncoder(packing.public_vocabulary())
    for text in ["one two three four five six seven eight", "one nine ten 1 2 3", "six seven"]:
        assert encode.ids([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_other_rules_are_left_to_the_tokenizer(tmp_path, tokenizer):
    other = Tokenizer.from_file(packing.public_vocabulary())
    other.normalizer = None
    other.save(str(tmp_path / "other.json"))
    other.encode_special_tokens = True
    encode = packing.TextEncoder(str(tmp_path / "other.json"))
    assert [i.tolist() for i in encode.ids(ODD)] == [other.encode(t, add_special_tokens=False).ids for t in ODD]


def squares(gaps, most):
    counts = {}
    for gap in gaps:
        if 0 < gap < most:
            counts[gap] = counts.get(gap, 0) + 1
    return sum(c * c for c in counts.values())


@pytest.mark.parametrize("eager", [True, False])
@pytest.mark.parametrize("seed", range(6))
def test_every_piece_goes_where_the_sum_is_smallest(seed, eager):
    rng, most = random.Random(seed), 12
    lengths = np.array([rng.choice([1, 2, 3, 5, 7, 11, 12]) for _ in range(120)])
    sequence, offset, number = packing.place(lengths, most, eager)
    gaps: dict[int, int] = {}
    for size, taken, at in zip(lengths.tolist(), sequence.tolist(), offset.tolist(), strict=True):
        sums = {}
        for one, gap in [*gaps.items(), (len(gaps), most)]:
            if gap >= size:
                after = gaps | {one: gap - size}
                sums[one] = squares(after.values(), most)
        known = {one: s for one, s in sums.items() if one in gaps}
        allowed = sums if eager or not known else known
        assert allowed[taken] == min(allowed.values())
        assert at == most - gaps.get(taken, most)
        gaps[taken] = gaps.get(taken, most) - size
    assert len(gaps) == number and min(gaps.values()) >= 0


def check(out, texts, tokenizer, most):
    """Every document is there once, whole; sequences are gapless and hold no more than ``most``."""
    want = []
    for doc, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want += [(doc, n, at, len(ids[at : at + most]), zlib.crc32(np.array(ids[at : at + most], "<u4").tobytes())) for n, at in enumerate(range(0, len(ids), most))]
    assert sorted((tuple(r)[:5] for r in out), key=repr) == sorted(want, key=repr)
    by: dict[int, list] = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= most
    return len(by), sum(r.length for r in out)


@pytest.mark.parametrize("most", [16, 4096])
def test_documents(spark, tokenizer, most, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 500)
    made = packing.pieces(frame(spark), packing.public_vocabulary(), most)
    packed = packing.pack(made, most)
    columns = "doc_id", "piece", "start", "length", F.crc32("ids"), "sequence_id", "offset"
    out = made.join(packed, "_piece").select(*columns).collect()
    number, total = check(out, rows(), tokenizer, most)
    assert number <= 1.02 * total / most + 2
    whole = packing.sequences(made, packed).collect()
    assert len(whole) == number
    ids = {(r.doc_id, r.piece, bytes(r.ids)) for r in made.collect()}
    for r in whole:
        assert len(r.ids) == 4 * sum(p.length for p in r.parts) and [p.offset for p in r.parts] == sorted(p.offset for p in r.parts)
        for p in r.parts:
            assert (p.doc_id, p.piece, bytes(r.ids[4 * p.offset : 4 * (p.offset + p.length)])) in ids


def test_few_sequences():
    """As few as can be, or nearly: lengths that leave gaps, lengths that fill up, and lengths of one kind."""
    rng = np.random.default_rng(1)
    for lengths, most_waste in ((rng.integers(1, 4096, 4000), 0.02), (rng.choice([1366, 2000, 700, 30], 4000), 0.03), (rng.integers(1, 300, 4000), 0.01)):
        down = lengths[np.argsort(-lengths)]
        number = min(packing.place(lengths, 4096, True)[2], packing.place(down, 4096, False)[2])
        assert number <= (1 + most_waste) * lengths.sum() / 4096 + 1
    assert packing.place(np.full(100, 1500), 4096, False)[2] == 50


def test_empty_table_and_whole_pieces(spark, tokenizer):
    empty = packing.pieces(frame(spark).limit(0), packing.public_vocabulary())
    assert found(empty) == [] == found(packing.pack(empty)) == found(packing.sequences(empty, packing.pack(empty)))
    one = packing.pieces(spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string"), packing.public_vocabulary(), 3)
    assert sorted(tuple(r)[1:4] for r in one.drop("_piece").collect()) == [(0, 0, 3), (1, 3, 3)]
    assert {r.offset for r in packing.pack(one, 3).collect()} == {0}
    with pytest.raises(ValueError, match="one token"):
        packing.pieces(one, packing.public_vocabulary(), 0)
