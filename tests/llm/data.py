"""Small documents that hold the awkward cases."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, shard int, n_words string, kept string, _row string, epoch int"

EN = "the quick brown fox jumps over the lazy dog and it was not that they have seen this with you from their house".split()
DE = "der schnelle braune fuchs springt über den faulen hund und es war nicht so dass sie mit ihnen von haus aus gehen".split()


def prose(seed, n=400, words=EN):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + rng.choice(["", "", "", "x", "ing", "er"]) + rng.choice(["", "", "", "", ",", "."]) for _ in range(n))


def rows():
    """(doc_id, text): null and empty texts, null and repeated ids, copies, near copies, long and odd texts."""
    base = prose(1)
    shared = prose(2, 60)
    texts = [
        (1, base), (2, base), (2, base), (3, base.replace("quick", "Quick")), (4, None), (5, ""), (6, " \t\n\x0b\x0c\r"), (None, base), (None, None),
        (7, "one two"), (8, "one two"), (9, prose(3, 50) + " " + shared + " " + prose(4, 50)), (10, prose(5, 20) + "\n" + shared + "\n" + prose(6, 70)),
        (11, "same line here\n" * 40), (12, "a " * 300), (13, prose(7, 30_000)), (14, "word word   \U0001f642 \x00 İ end" * 9), (15, "x" * 50_000),
        (16, " ".join(f"{w}***" for w in prose(8).split())), (17, prose(9).upper().replace(" ", "!! ")), (18, prose(10, 300, DE)),
    ]
    texts += [(100 + i, prose(100 + i)) for i in range(40)]
    return texts


def frame(spark, texts=None):
    texts = rows() if texts is None else texts
    sources = ["a", "a", "b", None]
    full = [(i, t, "en", sources[n % 4], None if t is None else len(t), 7, "x", "y", "z", 3) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(full, DOCUMENTS)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
