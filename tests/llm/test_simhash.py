"""Fingerprints bit by bit, and groups against all pairs."""

import random
import re

import xxhash

from helioledger.llm import simhash
from tests.llm.data import frame, rows


def plain(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def unions(prints, radius):
    """The least position that links reach, from all pairs."""
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


def test_documents(spark):
    texts = [(i, t) for i, t in rows() if len(t or "") < 30_000]
    texts += [(200, texts[0][1] + " end"), (201, texts[0][1] + " another end")]
    prints = [plain(t) for _, t in texts]
    groups = unions(prints, 2)
    least = {g: min((texts[k][0] for k, r in enumerate(groups) if r == g and texts[k][0] is not None), default=None) for g in set(groups)}
    want = sorted((repr(i), f"{p:016x}", least[g]) for (i, _), p, g in zip(texts, prints, groups, strict=True))
    assert sorted((repr(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicates(frame(spark, texts)).collect()) == want
    docs = frame(spark, texts)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(x) for x in least.values())


def test_chains_and_radii(spark):
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(30)]
    for start in prints[:4]:
        for _ in range(25):
            start ^= 1 << rng.randrange(64)
            start ^= 1 << rng.randrange(64)
            prints.append(start)
    prints += [0, 1, 2, 4, 7, (1 << 63) | 1, 1 << 63]
    prints = sorted(set(prints))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    for radius in (0, 1, 2, 3):
        table = spark.createDataFrame(signed, "_fingerprint long")
        got = {r.fp: r.root for r in simhash.groups(table, radius).collect()}
        groups = unions(prints, radius)
        want = {}
        for (fp,), g in zip(signed, groups, strict=True):
            want[fp] = min(s for (s,), h in zip(signed, groups, strict=True) if h == g)
        assert got == want


def test_empty(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0 == simhash.keep_one(frame(spark, [])).count()
    assert [r.fingerprint for r in simhash.near_duplicates(frame(spark, [(1, None), (2, "")])).collect()] == ["0" * 16] * 2
