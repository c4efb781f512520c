"""Language identification by Bayesian fusion of evidence.

Four sources of evidence are multiplied: the likelihood of the text by character trigrams, what the markup declares,
the country suffix of the address, and a prior of the host.  How far a declaration or a suffix can be trusted is
counted in the data: the languages that texts show under each.  A host's prior is smoothed by that of its domain and
that by the share of all texts, so a host with few pages follows its domain.  All counts are grouped sums over all rows.
"""

from __future__ import annotations

import html as entities
import re
import sys
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioledger.llm.tables import land, read, ship
from helioledger.llm.wrappers import host_of

#: About so many labelled documents of each language are used for the trigrams, drawn by a hash of their id; all, where
#: there are fewer.
LANGUAGE_ROWS = 5_000
#: Hash buckets of trigrams, and the pseudo-count of each.
BUCKETS, PSEUDO = 1 << 15, 0.5
#: A text's trigrams depend on each other; together they weigh no more than so many independent ones.
EFFECTIVE = 60
#: Weight of the next level when a host's or a domain's counts are smoothed, in texts.
STRENGTH = 5.0

_HIDDEN = re.compile(r"<(script|style|template|noscript)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_DECLARED = re.compile(r"""<html(?=\s)(?:[^>"']|"[^"]*"|'[^']*')*?\slang\s*=\s*["']?\s*([A-Za-z]+)""", re.I)


@cache
def _letters() -> np.ndarray:
    """Code points that are letters; others part words."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def trigrams(text: str) -> np.ndarray:
    """Buckets of all trigrams of the letters, with one space between words."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[points]
    points = np.where(letter, points, 32)[letter | np.append(True, letter[:-1])].astype(np.uint64)
    if len(points) < 3:
        return np.zeros(0, np.int64)
    mixed = ((points[:-2] * np.uint64(0x1F1F1F1F) + points[1:-1]) * np.uint64(0x9E3779B1) + points[2:]) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(49)).astype(np.int64)


def visible(html: str | None) -> str:
    """A page without markup, scripts and styles."""
    return entities.unescape(_HIDDEN.sub(" ", html or ""))


def declared(html: str | None) -> str | None:
    """The primary language that the page's root element declares by its ``lang``; comments and other attributes don't count."""
    found = _DECLARED.search(_COMMENT.sub(" ", html or ""))
    return found[1].lower() if found else None


def domain_of(host: str) -> str:
    """The last two labels of a host, three where the second is a short one below a country, as in ``co.uk``."""
    labels = host.split(".")
    short = len(labels) > 2 and len(labels[-1]) == 2 and len(labels[-2]) <= 3
    return ".".join(labels[-3 if short else -2 :])


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the log probability of each bucket in each, from rows with ``text`` and ``lang``.

    The languages are those of all rows.  The sample is bounded for each of them, so one with few rows keeps all.
    """
    ship(labelled.sparkSession)
    labelled = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = land(labelled.groupBy("lang").count(), "labels")
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < F.least(F.lit(1.0), F.lit(float(LANGUAGE_ROWS)) / F.col("count")) * float(1 << 40)
    drawn = labelled.join(F.broadcast(counts), "lang").filter(drawn).select("text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[lang] = sums.get(lang, 0) + np.bincount(trigrams(text), minlength=BUCKETS)
                texts[lang] = texts.get(lang, 0) + 1
        kinds = [pa.string(), pa.int64(), pa.list_(pa.int64())]
        columns = [list(sums), [texts[x] for x in sums], [sums[x].tolist() for x in sums]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "texts", "counts"])

    counted = land(drawn.mapInArrow(run, "lang string, texts long, counts array<long>"), "trigrams")
    langs = [r.lang for r in counts.orderBy("lang").toLocalIterator()]
    at = {lang: i for i, lang in enumerate(langs)}
    places = counted.select("lang", F.posexplode("counts")).filter("col > 0")
    table = np.full((len(langs), BUCKETS), PSEUDO)
    for lang, bucket, n in places.groupBy("lang", "pos").agg(F.sum("col")).toLocalIterator():
        table[at[lang], bucket] += n
    return langs, np.log(table / table.sum(axis=1, keepdims=True)) if langs else table


def text_evidence(found: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Log likelihoods of a text's trigrams, held to the weight of ``EFFECTIVE`` of them; zeros for none."""
    if not len(found):
        return np.zeros(len(model))
    total = sum(model[:, found[at : at + 65536]].sum(axis=1, dtype=np.float64) for at in range(0, len(found), 65536))
    return total / len(found) * min(len(found), EFFECTIVE)


def _scored(items: DataFrame, keys: Sequence[str], langs: list[str], model: np.ndarray) -> DataFrame:
    """Keys, host, domain, suffix, declaration and text evidence of every item; written, as it is used several times."""
    sent = items.sparkSession.sparkContext.broadcast(model.astype(np.float32))  # languages x buckets, 128 KB for each language
    known = frozenset(langs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        n = len(keys)
        for batch in batches:
            out = []
            for text, html, address in zip(*[c.to_pylist() for c in batch.columns[n:]], strict=True):
                host = host_of(address)
                labels = host.split(".")
                suffix = labels[-1] if len(labels) > 1 and re.fullmatch("[a-z]{2}", labels[-1]) else None  # a country's
                said = declared(html)
                found = trigrams(text if text is not None else visible(html))
                evidence = text_evidence(found, table).tolist()
                out.append((host, domain_of(host), suffix, said if said in known or said is None else "other", len(found) > 0, evidence))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.float64())]
            new = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *new], [*keys, "host", "domain", "suffix", "said", "has_text", "evidence"])

    own = ", ".join(f"`{k}` {items.schema[k].dataType.simpleString()}" for k in keys)
    ddl = f"{own}, host string, domain string, suffix string, said string, has_text boolean, evidence array<double>"
    return land(items.select(*keys, "text", "html", "address").mapInArrow(run, ddl), "language-evidence")


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _softmax(a: Column) -> Column:
    powers = F.transform(a, lambda x: F.exp(x - F.array_max(a)))
    total = F.aggregate(powers, F.lit(0.0), lambda s, x: s + x)
    return F.transform(powers, lambda x: x / total)


def _sums(n: int) -> Column:
    return F.array(*[F.coalesce(F.sum(F.col("share")[i]), F.lit(0.0)) for i in range(n)])


def _log(a: Column) -> Column:
    return F.transform(a, lambda x: F.ln(x))


def identify(items: DataFrame, keys: Sequence[str], langs: list[str], model: np.ndarray) -> DataFrame:
    """Keys, ``lang``, ``posterior``, ``text_lang`` (by the text alone) and ``declared`` of every item.

    Items have ``text``, ``html`` and ``address``, each of which may be null; the page's visible text is used if there is
    no text.  Missing evidence says nothing.  An item without any follows its host, then its domain, then all texts;
    equal posteriors go to the first language by name.  Repeated rows are items each.  Without a trained language,
    all results are null.
    """
    ship(items.sparkSession)
    if not langs:
        return items.select(*keys, *[F.lit(None).cast(k).alias(c) for c, k in (("lang", "string"), ("posterior", "double"), ("text_lang", "string"), ("declared", "string"))])
    n, names = len(langs), F.array(*map(F.lit, langs))
    scored = _scored(items, keys, langs, model).withColumn("share", _softmax(F.col("evidence")))
    texts = scored.filter("has_text")
    hosts = land(texts.groupBy("host", "domain").agg(F.count("*").cast("double").alias("texts"), _sums(n).alias("sums")), "host-counts")
    every = hosts.agg(F.array(*[F.coalesce(F.sum(F.col("sums")[i]), F.lit(0.0)) for i in range(n)]).alias("sums")).first()[0]

    def reliability(column: str) -> DataFrame:
        """Log probability of each value given each language; at most a row per declaration or country."""
        counts = texts.filter(F.col(column).isNotNull()).groupBy(column).agg(_sums(n).alias("sums")).collect()
        table = np.array([r["sums"] for r in counts], float).reshape(len(counts), n) + 0.5
        table = np.log(table / (table.sum(axis=0, keepdims=True) + 0.5))
        rows = [(r[column], line) for r, line in zip(counts, table.tolist(), strict=True)]
        return items.sparkSession.createDataFrame(rows, f"{column} string, {column}_evidence array<double>")

    # An item's own text is in its likelihood, so its share comes out of the counts of its host, its domain and of all.
    zeros = F.array(*[F.lit(0.0)] * n)
    own, mine = F.when(F.col("has_text"), F.col("share")).otherwise(zeros), F.col("has_text").cast("double")

    def without_own(sums: Column) -> Column:
        return F.zip_with(F.coalesce(sums, own), own, lambda x, y: F.greatest(x - y, F.lit(0.0)))

    def smoothed(level: str, upper: Column) -> Column:
        texts = F.coalesce(F.col(f"{level}_texts"), mine) - mine
        return F.zip_with(without_own(F.col(f"{level}_sums")), upper, lambda x, y: (x + STRENGTH * y) / (texts + STRENGTH))

    total = F.lit(float(sum(every))) - mine + n
    whole = F.transform(without_own(F.array(*[F.lit(float(x)) for x in every])), lambda x: (x + 1) / total)
    domains = hosts.groupBy("domain").agg(F.sum("texts").alias("domain_texts"), F.array(*[F.sum(F.col("sums")[i]) for i in range(n)]).alias("domain_sums"))
    counts = hosts.join(domains, "domain").select("host", F.col("texts").alias("host_texts"), F.col("sums").alias("host_sums"), "domain_texts", "domain_sums")
    joined = scored.join(F.broadcast(reliability("said")), "said", "left").join(F.broadcast(reliability("suffix")), "suffix", "left")
    joined = joined.join(counts, "host", "left").withColumn("whole", whole)
    joined = joined.withColumn("prior", smoothed("domain", F.col("whole"))).withColumn("prior", smoothed("host", F.col("prior")))
    total = _plus(F.col("evidence"), _log(F.col("prior")))
    for column in ("said_evidence", "suffix_evidence"):
        total = _plus(total, F.coalesce(F.col(column), zeros))
    fused = joined.withColumn("total", total).withColumn("fused", _softmax(F.col("total")))

    def best(column: str) -> Column:
        return F.element_at(names, F.array_position(F.col(column), F.array_max(F.col(column))).cast("int"))

    return fused.select(
        *keys,
        best("fused").alias("lang"),
        F.round(F.array_max("fused"), 6).alias("posterior"),
        F.when(F.col("has_text"), best("share")).alias("text_lang"),
        F.col("said").alias("declared"),
    )


def op1_evidence_fusion(spark, sf_dir: str) -> DataFrame:
    """Languages of all pages, by all evidence, and of all documents, by their text and their source as host."""
    documents = read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    langs, model = train(documents)
    none = F.lit(None)
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html").select(
        none.cast("long").alias("doc_id"), "page_id", none.cast("string").alias("text"), "html", F.col("url").alias("address")
    )
    texts = documents.select("doc_id", none.cast("long").alias("page_id"), F.coalesce("text", F.lit("")).alias("text"), none.cast("string").alias("html"), F.concat(F.lit("source://"), "source").alias("address"))
    return identify(texts.unionByName(pages), ["doc_id", "page_id"], langs, model)
