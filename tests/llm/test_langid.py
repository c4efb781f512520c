"""Accuracy on held-out documents, and what each kind of evidence does."""

import random

import numpy as np
from pyspark.sql import functions as F

from helioledger.llm import langid

ITEMS = "page_id long, text string, html string, address string, lang string, said string"


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    langs, model = langid.train(docs.filter("doc_id % 2 = 0"))
    assert langs == ["de", "en", "es", "fr"]
    rest = docs.filter("doc_id % 2 = 1 AND n_chars > 100")
    items = rest.select("doc_id", "text", F.lit(None).cast("string").alias("html"), F.lit(None).cast("string").alias("address"))
    got = langid.identify(items, ["doc_id"], langs, model).join(rest.select("doc_id", F.col("lang").alias("truth")), "doc_id")
    assert got.filter("lang = truth").count() >= 0.98 * got.count() > 50


def model():
    langs = ["de", "en"]
    table = np.full((2, langid.BUCKETS), 0.5)
    for i, text in enumerate(("der die das und nicht ist ein", "the and not this is that with")):
        np.add.at(table[i], langid.trigrams(" ".join([text] * 20)), 1)
    return langs, np.log(table / table.sum(axis=1, keepdims=True))


def identify(spark, rows):
    langs, table = model()
    frame = spark.createDataFrame([(i, t, h, a, "x", "y") for i, (t, h, a) in enumerate(rows)], ITEMS)
    return {r.page_id: r for r in langid.identify(frame, ["page_id"], langs, table).collect()}


def test_evidence(spark):
    german = [("der die das und nicht ist ein " * 3, None, "http://a.firm.de/1")] * 10
    english = [(None, "<html lang='EN-gb'><script>der die das und</script><p>the and not this is that with", "http://b.firm.com/1")] * 10
    odd = [
        (None, None, None), ("", "", ""), ("zzqq", None, "http://a.firm.de/9"), (None, "<html lang=en><p>qq", "http://other.com/"),
        (None, "", "http://new.firm.com/"), ("the and not this is that with " * 500, "<html lang=de>", "http://a.firm.de/2"), ("漢字", "<html lang=xx>", "ftp:x"),
    ]
    got = identify(spark, german + english + odd)
    assert len(got) == 27
    assert {got[i].lang for i in range(10)} == {"de"} and {got[i].lang for i in range(10, 20)} == {"en"}
    assert got[10].declared == "en" and got[0].declared is None and got[26].declared == "other"
    assert got[20].text_lang is None and got[20].lang in ("de", "en") and got[21].lang == got[20].lang
    assert got[22].lang == "de" and got[23].lang == "en"  # by the host, by the declaration
    assert got[24].lang == "en"  # a new host follows its domain
    assert got[25].lang == "en"  # a long text outweighs all else
    assert all(0.5 <= r.posterior <= 1 for r in got.values())


def test_empty(spark):
    assert identify(spark, []) == {}
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    langs, table = langid.train(none)
    items = spark.createDataFrame([(1, "text", None, None, "x", "y")], ITEMS)
    assert langs == [] and langid.identify(items, ["page_id"], langs, table).first().lang is None


def test_trigrams_part_words():
    assert len(langid.trigrams("a")) == 1 and len(langid.trigrams("")) == 0 and len(langid.trigrams(" 12 .. ")) == 0
    assert (langid.trigrams("ab cd") == langid.trigrams("AB, 7 cd!")).all()


def test_no_language_is_lost(spark, monkeypatch):
    """Many languages, and one with few documents beside one with many."""
    monkeypatch.setattr(langid, "TRAIN_ROWS", 40, raising=False)
    monkeypatch.setattr(langid, "LANGUAGE_ROWS", 40, raising=False)
    names = [f"{a}{b}" for a in "abcdefg" for b in "klmopqrstu"]
    rows = [(i, f"the and not this is that with {i}", "en") for i in range(2000)] + [(9000, "der die das und nicht ist ein", "de")]
    rows += [(5000 + i, f"{n}{n[::-1]}{n} {n * 3} {n[0] * 3}{n[1]}", n) for i, n in enumerate(names)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, table = langid.train(labelled)
    assert langs == sorted([*names, "de", "en"]) and len(table) == 72
    few = labelled.filter("doc_id >= 1990").select("doc_id", F.concat_ws(" ", "text", "text", "text").alias("text"), F.lit(None).cast("string").alias("html"), F.lit(None).cast("string").alias("address"), F.col("lang").alias("truth"))
    got = langid.identify(few.drop("truth"), ["doc_id"], langs, table).join(few.select("doc_id", "truth"), "doc_id").collect()
    assert len(got) == 81 and all(r.text_lang == r.truth for r in got)


def test_declarations():
    for html, want in (
        ('<!--[if lt IE 9]><html lang="en"><![endif]--><html data-lang="fr" lang="de">', "de"), ("<html xml:lang=en>", None), ("<!-- <html lang=en>", None),
        ("<html class='a>b' title=\"x lang='fr'\" LANG = 'ES-mx'>", "es"), ("<html>\n<p lang=de>", None), ("<htmlx lang=de>", None), ("<html\nlang=it", "it"), ("", None), (None, None),
    ):
        assert langid.declared(html) == want, html
    assert langid.domain_of("a.shop.co.uk") == "shop.co.uk" and langid.domain_of("www.firm.de") == "firm.de" and langid.domain_of("x") == "x"


def test_against_a_plain_fusion(spark):
    rng, words = random.Random(7), {"de": "der die das und nicht ist ein".split(), "en": "the and not this is that with".split()}
    langs, table = model()
    items = []
    for n in range(160):
        lang = rng.choice(langs)
        mixed = [rng.choice(words[lang if rng.random() < 0.7 else rng.choice(langs)]) for _ in range(rng.choice([0, 1, 2, 5, 30]))]
        text = rng.choice([" ".join(mixed), " ".join(mixed), None])
        host = rng.choice(["a.firm.de", "b.firm.de", "a.shop.co.uk", "b.shop.co.uk", "c.other.co.uk", "one", ""])
        items.append((text, rng.choice([None, f"<html lang={lang}>", "<html lang=en>", "<html lang=xx>"]), f"http://{host}/{n}"))
    got = identify(spark, items)

    table = table.astype(np.float32)
    seen = []
    for text, html, address in items:
        found = langid.trigrams(text if text is not None else langid.visible(html))
        log = table[:, found].astype(float).mean(axis=1) * min(len(found), langid.EFFECTIVE) if len(found) else np.zeros(2)
        share = np.exp(log - log.max()) / np.exp(log - log.max()).sum()
        host, said = address[7:].split("/")[0], langid.declared(html)
        ends = host.split(".")
        seen.append((log, share if len(found) else None, host, langid.domain_of(host), "other" if said == "xx" else said, ends[-1] if len(ends) > 1 else None))
    texts = [i for i, s in enumerate(seen) if s[1] is not None]

    def trust(place, value):
        values = {s[place] for i, s in enumerate(seen) if i in texts and s[place]}
        if value not in values:
            return np.zeros(2)
        sums = {v: 0.5 + sum(seen[i][1] for i in texts if seen[i][place] == v) for v in values}
        return np.log(sums[value] / (sum(sums.values()) + 0.5))

    for n, (log, _, host, domain, said, suffix) in enumerate(seen):
        others = [i for i in texts if i != n]
        prior = (sum((seen[i][1] for i in others), np.zeros(2)) + 1) / (len(others) + 2)
        for place, value in ((3, domain), (2, host)):
            near = [seen[i][1] for i in others if seen[i][place] == value]
            prior = (sum(near, np.zeros(2)) + langid.STRENGTH * prior) / (len(near) + langid.STRENGTH)
        total = log + np.log(prior) + trust(4, said) + trust(5, suffix)
        posterior = np.exp(total - total.max()) / np.exp(total - total.max()).sum()
        assert abs(got[n].posterior - posterior.max()) < 1e-4, n
        assert abs(posterior[0] - posterior[1]) < 1e-6 or got[n].lang == langs[int(posterior.argmax())], n
