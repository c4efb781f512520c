"""Counts against a plain reading of their rules, and verdicts on clean and odd texts."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from helioledger.llm import quality
from tests.llm.data import DE, found, frame, prose, rows


def base(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else {w for w, n in __import__("collections").Counter(windows).items() if n > 1}
    covered = {i + j for i, w in enumerate(windows) if w in seen for j in range(5)}
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_base_counts():
    for _, text in rows():
        assert quality.base_counts(text or "") == base(text)
    assert quality.base_counts("a b c d e a b c d e")[4] == 10
    assert quality.base_counts("a b c d e f") == (6, 6, 0, 0, 0)


def test_distances():
    p, q = np.array([[0.5, 0.5, 0.0]]), np.array([[0.0, 0.0, 1.0]])
    assert quality.distances(p, q)[0] == 1 and quality.distances(p, p)[0] == 0
    middle = quality.distances(np.array([[1.0, 0.0]]), np.array([[0.5, 0.5]]))[0]
    assert abs(middle**2 - (0.5 * np.log2(4 / 3) + 0.25 * np.log2(2 / 3) + 0.25)) < 1e-12


def test_verdicts(spark):
    docs = frame(spark)
    got = quality.judge_documents(docs).collect()
    kept = [r.doc_id for r in got if r.kept]
    assert {1, 2, 3, 9, 10, 13, 18, *range(100, 140)} <= set(kept) and kept.count(2) == 2
    assert not {4, 5, 6, 7, 8, 11, 12, 15, 16, 17} & set(kept)
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in got)
    whole = quality.keep_documents(docs)
    assert whole.columns == docs.columns and sorted(r.doc_id or 0 for r in whole.collect()) == sorted(i or 0 for i in kept)


def test_short_odd_and_empty(spark):
    german = frame(spark, [(i, prose(i, 200, DE)) for i in range(8)] + [(50, "+1 555 12 34, 56 78! 9 ten words here and some more words then"), (51, "*" * 150)])
    got = {r.doc_id: r.kept for r in quality.judge_documents(german).collect()}
    assert got == dict.fromkeys(range(8), True) | {50: True, 51: False}
    assert found(quality.judge_documents(frame(spark, []))) == []
    assert quality.judge_documents(frame(spark, [(1, None)])).first().base_failed


def salad(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def test_words_and_short_texts_are_judged(spark):
    texts = [(i, prose(i, 300)) for i in range(40)] + [(50 + i, salad(i, 400)) for i in range(3)]
    texts += [(60, prose(60, 14)), (61, " ".join(f"{w}&&&" for w in prose(61, 14).split()))]
    got = {r.doc_id: r for r in quality.judge_documents(frame(spark, texts)).collect()}
    assert {i for i, r in got.items() if r.kept} == {*range(40), 60}
    assert len(texts[-1][1]) < quality.GUARD_CHARS and not any(r.base_failed for r in got.values())
    assert all(got[i].class_distance <= quality.CLASS_LIMIT for i in (50, 51, 52))


def test_languages_have_references_of_their_own(spark):
    """The smallest language of the others is clean, though far from the median of all others; so is one with few documents."""
    rng = random.Random(3)
    russian = "и в не на что с как по это он она они так его но да ты к у же вы за бы".split()

    def other(letters, common):
        return " ".join(rng.choice(common) if rng.random() < 0.5 else "".join(rng.choice(letters) for _ in range(6)) for _ in range(200))

    texts = [(i, other("абвгдежзиклмнопрст", russian)) for i in range(40)]
    texts += [(100 + i, other("漢字文章世界人民大会", list("的是不了在我有他这中来上国个到说们为子和你地出道也时年得就那要下以生会自着去之过家学对可里后小么心多天而能好都然没日于起还发成事只作当想看文无开手用主行方又如前所本见经头面公同三已老从动两长"))) for i in range(15)]
    texts += [(200, other("αβγδεζηθικλμ", ["και", "το", "να"])), (300, salad(1, 400))]
    tag = F.when(F.col("doc_id") < 100, "ru").when(F.col("doc_id") < 200, "zh").when(F.col("doc_id") < 300, "el").otherwise("ru")
    docs = frame(spark, texts).withColumn("lang", tag)
    got = {r.doc_id: r.kept for r in quality.judge_documents(docs).collect()}
    assert got == dict.fromkeys([i for i, _ in texts[:-1]], True) | {300: False}
    assert {r.lang for r in quality.references(docs)} == {"ru", "zh"}


def test_words_rare_in_a_batch_are_counted(spark):
    """A common word counts in every document, also where a batch holds it in a few only."""
    often = [("zeta " + "plain words of a long text " * 10, "en") for _ in range(100)]
    seldom = [(("zeta " if n < 5 else "") + "plain words of a long text " * 10, "en") for n in range(500)]
    docs = spark.createDataFrame(often, "text string, lang string").coalesce(1).unionByName(spark.createDataFrame(seldom, "text string, lang string").coalesce(1))
    [row] = quality.references(docs)
    assert [(w.texts, w.n) for w in row.common if w.word == "zeta"] == [(105, 105)]
