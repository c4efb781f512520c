"""What is removed against counting every window."""

import random
from collections import Counter

import pytest

from helioledger.llm import suffixes
from tests.llm.data import frame, rows


def plain(texts, window):
    words = [(i, (t or "").encode().split()) for i, t in texts]
    times = Counter(tuple(w[k : k + window]) for _, w in words for k in range(len(w) - window + 1))
    out = []
    for i, w in words:
        keep = [True] * len(w)
        for k in range(len(w) - window + 1):
            if times[tuple(w[k : k + window])] > 1:
                keep[k : k + window] = [False] * window
        out.append((repr(i), len(w), len(w) - sum(keep), b" ".join(x for x, y in zip(w, keep, strict=True) if y).decode()))
    return sorted(out)


def got(frame, window=suffixes.WINDOW):
    return sorted((repr(r.doc_id), r.n_words, r.n_removed, r.kept) for r in suffixes.remove_repeats(frame, window).collect())


@pytest.mark.parametrize("group", [1, 500])
def test_documents(spark, monkeypatch, group):
    """With a group of 1 every repeated anchor goes the way of large groups."""
    monkeypatch.setattr(suffixes, "GROUP", group)
    assert got(frame(spark)) == plain(rows(), 35)


@pytest.mark.parametrize("window", [3, 12])
def test_few_words_make_many_repeats(spark, window):
    rng = random.Random(window)
    texts = [(i, " ".join(rng.choice("ab") if i % 3 else rng.choice("abcdefgh") for _ in range(rng.randrange(60)))) for i in range(80)]
    texts += [(100, "z " * 200), (101, "z " * (window - 1)), (102, "y " * window)]
    assert got(frame(spark, texts), window) == plain(texts, window)


def test_runs_cover_every_window_once():
    words = [b"w%d" % (i % 50) for i in range(400)]
    first, place, hashes = suffixes.runs(words, 35)
    assert first[0] == 0 and (first[1:] > first[:-1]).all() and ((place >= first) & (place < first + 35)).all()
    assert len(first) == len(hashes)


def test_deep_leaves():
    a, b = [b"x", b"y", b"z", b"u"], [b"v", b"y", b"z", b"u"]
    assert sorted(suffixes.deep_leaves([(1, 10, 1, a), (2, 20, 1, b)], 3)) == [(1, 11), (2, 21)]
    assert suffixes.deep_leaves([(1, 10, 1, a), (2, 20, 1, b)], 4) == []


def test_empty(spark):
    assert got(frame(spark, [])) == []
    assert got(frame(spark, [(1, None), (2, "")])) == [("1", 0, 0, ""), ("2", 0, 0, "")]
